"""Document fingerprints by content-defined chunking.

A gear hash runs over a text's bytes; where its low bits are zero the text is cut, with a
harder mask before the target size and an easier one after it (normalised chunking), and
a smallest and largest chunk. Cuts depend on the last 16 bytes only, so an insertion shifts
chunks without changing those further on. A fingerprint is the set of chunk digests
with their lengths; likeness is containment: the share of one text's fingerprint, weighted by
chunk length, that the other has too.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import U, few_rows, mix, powers, released, seeds

# Smallest, target and largest chunk, in bytes. The hash window is the smallest chunk, so
# a cut never depends on bytes before its own chunk.
LEAST, TARGET, MOST = 16, 48, 192
HARD, EASY = np.uint16(0b1111110000000000), np.uint16(0b1111000000000000)
GEAR = (seeds(256, 21) >> U(48)).astype(np.uint16)
BASE = U(0x9FB21C651E98DF25)
SALTS = seeds(256, 23)
# Bytes hashed at once.
PIECE = 4 << 20


def gear(data: np.ndarray) -> np.ndarray:
    """The 16-bit gear hash at every byte: the sum of ``GEAR[byte] << age`` over the last 16
    bytes, by doubling the covered stretch."""
    h = GEAR[data]
    for k in (1, 2, 4, 8):
        h[k:] += h[:-k] << np.uint16(k)
    return h


def cuts(data: np.ndarray) -> list[int]:
    """The ends of a text's chunks."""
    n = len(data)
    if not n:
        return []
    hard, easy = [], []
    for lo in range(0, n, PIECE):
        part = gear(data[max(0, lo - LEAST): lo + PIECE])[lo - max(0, lo - LEAST):]
        maybe = np.flatnonzero((part & EASY) == 0)
        easy.append(maybe + lo + 1)
        hard.append(maybe[(part[maybe] & HARD) == 0] + lo + 1)
    hard, easy = np.concatenate(hard).tolist() + [n], np.concatenate(easy).tolist() + [n]
    out, at, i, j = [], 0, 0, 0
    while at < n:
        while hard[i] < at + LEAST and hard[i] < n:
            i += 1
        end = hard[i]
        if end >= at + TARGET:
            while easy[j] < at + TARGET and easy[j] < n:
                j += 1
            end = min(easy[j], at + MOST)
        at = min(end, n)
        out.append(at)
    return out


def chunk_set(text: bytes) -> dict[int, int]:
    """Digest -> length of each distinct chunk."""
    data = np.frombuffer(text, np.uint8)
    ends = np.array(cuts(data), np.int64)
    if not len(ends):
        return {}
    size = np.diff(ends, prepend=0)
    start = ends - size
    at = np.arange(len(data)) - np.repeat(start, size)
    value = SALTS[data] * powers(BASE, MOST)[at]
    digest = mix(np.add.reduceat(value, start) + size.astype(U))
    return dict(zip(digest.tolist(), size.tolist(), strict=True))


def written(chunks: dict[int, int]) -> str:
    """The fingerprint as text: 12 characters (8 bytes of digest, 1 of length) per distinct
    chunk, in the order of the digests."""
    raw = np.zeros((len(chunks), 9), np.uint8)
    if chunks:
        keys = np.array(sorted(chunks), U)
        raw[:, :8] = keys.astype(">u8").view(np.uint8).reshape(-1, 8)
        raw[:, 8] = [chunks[int(k)] for k in keys]
    return base64.b64encode(raw.tobytes()).decode()


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    """The share of ``a``, by chunk length, that ``b`` has too; two empty sets are alike."""
    total = sum(a.values())
    if not total:
        return float(not b)
    return sum(size for digest, size in a.items() if digest in b) / total


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n / 2) code points replaced by the first as many of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double")


@released
def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range sorted by place, closed by the row that follows the range."""
    held: list[tuple] = []
    before = None
    for batch in few_rows(batches):
        cols = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "closing")), strict=True)
        for doc_id, text, closing in cols:
            text = text or ""
            raw = text.encode()
            chunks = chunk_set(raw)
            if before is not None:
                last_id, last, last_chunks = before
                new = edited(last, text).encode()
                new_chunks = chunk_set(new)
                held.append((last_id, len(last), hashlib.sha256(new).hexdigest(), written(last_chunks), written(new_chunks),
                             containment(last_chunks, new_chunks), containment(last_chunks, chunks)))
            before = None if closing else (doc_id, text, chunks)
            if len(held) == 500:
                yield _rows(held)
                held = []
    yield _rows(held)


def _rows(held: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    cols = list(zip(*held, strict=True)) or [()] * 7
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)


# Text bytes in one range of ids.
RANGE_BYTES = 8 << 20


def _numbered(rows: DataFrame, bounds: np.ndarray) -> DataFrame:
    """``rows`` with the number of the id range each belongs to; null ids are in the last."""
    every = rows.sparkSession.sparkContext.broadcast(bounds)

    @F.pandas_udf("int")
    def nth(ids: pd.Series) -> pd.Series:
        # ids as text: a nullable long would arrive as a float
        known = ids.notna()
        out = np.full(len(ids), len(every.value), np.int32)
        out[known] = np.searchsorted(every.value, ids[known].astype(np.int64), "right")
        return pd.Series(out)

    return rows.withColumn("part", nth(F.col("doc_id").cast("string")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next
    of every row of ``docs`` (doc_id, text; other columns are ignored).

    The next document is the next by (doc_id, text), null ids last and null texts as
    empty; after the last comes the first, also when it is the only one. Rows are dealt
    once, into ranges of ids; each range is closed by the first row of the next one.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long")).alias("bytes"), F.count("doc_id").alias("ids")).first()
    parts = max(2 * spark.sparkContext.defaultParallelism, int((size["bytes"] or 0) // RANGE_BYTES) + 1)
    # the bounds come from a quantile sketch, not from the ids themselves
    shares = [k / parts for k in range(1, parts)]
    bounds = rows.approxQuantile("doc_id", shares, 0.2 / parts) if size["ids"] else []
    bounds = np.unique(np.array(bounds, np.float64).astype(np.int64))
    ids = _numbered(rows.select("doc_id"), bounds)
    firsts = [(r["part"], r["first"]) for r in ids.groupBy("part").agg(F.min("doc_id").alias("first")).collect()]  # one row a range
    if not firsts:
        return spark.createDataFrame([], OUT)
    firsts.sort()
    follows = [(firsts[k - 1][0], first) for k, (_, first) in enumerate(firsts)]
    wanted = F.broadcast(spark.createDataFrame(follows, "part int, first long"))
    heads = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["first"])).groupBy("doc_id", "part").agg(F.min("text").alias("text"))
    every = _numbered(rows, bounds).withColumn("closing", F.lit(False)).unionByName(heads.withColumn("closing", F.lit(True)))
    order = ["part", "closing", F.col("doc_id").isNull(), "doc_id", "text"]
    return every.repartition(parts, "part").sortWithinPartitions(*order).mapInArrow(_fingerprint, OUT)
