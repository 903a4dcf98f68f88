"""MinHash near-deduplication by fast similarity sketching, banding and exact verification.

Each document's set (5-word shingles of the lower-cased words) is hashed into a sketch
filled by rounds of bin placement: in round ``i`` every element falls into one of the
``t`` bins by that round's hash, later rounds never overwrite earlier ones, and after
``t`` rounds bin ``i - t`` takes the round's minimum over all elements; so every
coordinate fills, at a cost near the set's size. Bands of ``rows`` coordinates
propose candidates; links are confirmed on the full sets, rebuilt from the texts.

No group is expanded into pairs. Equal sets are collapsed first. In each bucket every
member meets the bucket's smallest and largest member; after those links are confirmed,
only members of different components that share a bucket are still open: longer sketches of them
are compared in blocks of a bounded number of members, and pairs whose sketches agree
well below the threshold are dismissed there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import (
    LOWER, U, components, few_rows, fresh, gram_hashes, mix, only_ids, powers, released, seeds, text_slices, word_hashes, word_spans)

SHINGLE = 5
ROWS, BANDS = 4, 36
# A link of similarity 0.75 shares no band with probability (1 - 0.75**4) ** 36 = 1.1e-6.
SIZE = ROWS * BANDS
# Coordinates of the longer sketches that open pairs are judged by, one byte each, and the
# agreement under which a pair is dismissed: five standard deviations (0.0135 each) below what a
# pair of similarity 0.75 shows.
MARKS, AGREE = 1024, 0.682
# Members of one bucket whose sketches meet in one block.
BLOCK = 1500


def shingle_set(words: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of a document's word hashes; fewer words than ``n``
    are one shingle, no words an empty set."""
    if not len(words):
        return np.zeros(0, U)
    return np.unique(gram_hashes(words, min(n, len(words))))


def sketch(items: np.ndarray, t: int = SIZE) -> np.ndarray:
    """The ``t`` coordinates (round in the high, hash in the low 32 bits) of a non-empty set."""
    out = np.full(t, np.iinfo(np.uint64).max, U)
    salts = seeds(2 * t, 7)
    step = max(1, 4 * t // len(items))
    for lo in range(0, 2 * t, step):
        rounds = np.arange(lo, min(2 * t, lo + step))
        x = mix(items[None, :] ^ salts[rounds][:, None])
        bins = (((x >> U(32)) * U(t)) >> U(32)).astype(np.int64)
        late = rounds >= t
        bins[late] = (rounds[late] - t)[:, None]
        np.minimum.at(out, bins.ravel(), ((rounds.astype(U) << U(32))[:, None] | (x & U(0xFFFFFFFF))).ravel())
        if out.max() != np.iinfo(np.uint64).max:
            break
    return mix(out)


def band_keys(sk: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band of ``rows`` coordinates; the band's number is part of it."""
    m = sk.reshape(-1, rows) * powers(U(0xE7037ED1A0B428DB), rows)[None, :]
    return mix(m.sum(axis=1, dtype=U) + seeds(len(m), 3))


SIGNED = "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>"


@released
def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id")
        for lo, hi, data, offs in text_slices(batch, "text"):
            data = LOWER[data]
            start, end, first = word_spans(data, offs)
            words = word_hashes(data, start, end)
            n, d1, d2, bands = [], [], [], []
            for r in range(hi - lo):
                items = shingle_set(words[first[r]: first[r + 1]])
                n.append(len(items))
                d1.append(int(mix(items).sum(dtype=U).view(np.int64)))
                d2.append(int(mix(items ^ U(0x5851F42D4C957F2D)).sum(dtype=U).view(np.int64)))
                bands.append(band_keys(sketch(items)).view(np.int64) if len(items) else None)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "d1", "d2", "bands"])


@released
def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The long sketch of each document that has words, a byte for each coordinate."""
    for batch in batches:
        ids = batch.column("doc_id")
        for lo, hi, data, offs in text_slices(batch, "text"):
            data = LOWER[data]
            start, end, first = word_spans(data, offs)
            words = word_hashes(data, start, end)
            sets = [shingle_set(words[first[r]: first[r + 1]]) for r in range(hi - lo)]
            marks = [(sketch(s, MARKS) >> U(56)).astype(np.uint8).tobytes() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array(marks, pa.binary())], names=["doc_id", "marks"])


@released
def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with both texts -> the pairs with 100 * |intersection| >= 75 * |union|."""
    for batch in few_rows(batches):
        left, right = [], []
        sets = []
        for side in ("text_a", "text_b"):
            own = []
            for lo, hi, data, offs in text_slices(batch, side):
                data = LOWER[data]
                start, end, first = word_spans(data, offs)
                words = word_hashes(data, start, end)
                own += [shingle_set(words[first[r]: first[r + 1]]) for r in range(hi - lo)]
            sets.append(own)
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        for i, (x, y) in enumerate(zip(*sets, strict=True)):
            if len(x) and len(y) and 100 * min(len(x), len(y)) >= 75 * max(len(x), len(y)):
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= 75 * (len(x) + len(y) - both):
                    left.append(a[i])
                    right.append(b[i])
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])


def confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The written candidate ``pairs`` (a, b) that hold on the documents' full sets."""
    ids = fresh(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "pair-ids")
    texts = only_ids(docs.select("doc_id", "text"), "doc_id", ids, ids.count())
    one = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b").mapInArrow(_confirm, "a long, b long")


@released
def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of open buckets, sorted by (key, i, j) -> pairs of different components whose
    sketches agree in at least ``AGREE`` of the coordinates and whose sizes allow a link.
    A pair that shares several buckets is judged in its first common band only."""
    held: list[tuple] = []
    at = None

    def pairs():
        band = held[0][5]
        ids, comp, n, part = (np.array([h[k] for h in held]) for k in (0, 1, 2, 6))
        marks = np.frombuffer(b"".join(h[3] for h in held), np.uint8).reshape(len(held), -1)
        bands = np.array([h[4] for h in held])
        i, j = at[1], at[2]
        left, right = [], []
        rows, cols = np.flatnonzero(part == i), np.flatnonzero(part == j)
        for r in rows:
            c = cols[(comp[cols] != comp[r]) & (100 * np.minimum(n[cols], n[r]) >= 75 * np.maximum(n[cols], n[r]))]
            c = c[c > r] if i == j else c
            c = c[(bands[c] == bands[r]).argmax(axis=1) == band]
            c = c[(marks[c] == marks[r]).mean(axis=1) >= AGREE]
            left += np.minimum(ids[c], ids[r]).tolist()
            right += np.maximum(ids[c], ids[r]).tolist()
        return pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("key", "i", "j", "rep", "component", "n_shingles", "marks", "bands", "band", "part")]
        for key, i, j, *row in zip(*cols, strict=True):
            if (key, i, j) != at:
                if len(held) > 1:
                    yield pairs()
                held, at = [], (key, i, j)
            held.append(tuple(row))
    if len(held) > 1:
        yield pairs()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text;
    other columns are ignored).

    A null or wordless text has an empty set and is linked with nothing; fewer than five
    words are one shingle. Rows repeating a doc_id share its component and its ``kept``.
    A null doc_id is linked with nothing: its component_id is null and it is kept.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = fresh(docs.mapInArrow(_sign, SIGNED), "signed")
    sets = fresh(
        signed.filter("doc_id IS NOT NULL AND n_shingles > 0").groupBy("n_shingles", "d1", "d2")
        .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "sets").select("rep", "n_shingles", "d1", "d2")
    reps = fresh(
        sets.join(signed.filter("bands IS NOT NULL").withColumnRenamed("doc_id", "rep"), ["rep", "n_shingles", "d1", "d2"])
        .dropDuplicates(["rep", "d1", "d2"]).select("rep", "n_shingles", "bands"), "reps")
    rows = reps.select("rep", F.posexplode("bands").alias("band", "key"))
    buckets = rows.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo < hi")
    members = fresh(rows.join(buckets, "key"), "members")
    ends = members.select(F.explode(F.array(F.struct(F.col("lo").alias("a"), F.col("rep").alias("b")),
                                            F.struct(F.col("rep").alias("a"), F.col("hi").alias("b")))).alias("p")).select("p.*")
    links = fresh(confirmed(fresh(ends.filter("a < b").distinct(), "pairs"), docs), "links")
    part = components(links)

    # Buckets whose members are still in different components.
    placed = members.join(part, members["rep"] == part["id"], "left").select(
        "key", "band", "rep", F.coalesce("component", "rep").alias("component"))
    open_keys = placed.groupBy("key").agg(
        F.min("component").alias("c0"), F.max("component").alias("c1"), F.count(F.lit(1)).alias("size")).filter("c0 < c1")
    blocks = (F.col("size") / BLOCK).cast("long") + 1
    held = placed.join(open_keys.select("key", "size"), "key").withColumn("parts", blocks).withColumn(
        "part", F.pmod(F.xxhash64("rep", "key"), F.col("parts")))
    held = fresh(held, "open")
    ids = fresh(held.select("rep").distinct(), "open-ids")
    marks = only_ids(docs, "doc_id", ids, ids.count()).mapInArrow(_mark, "doc_id long, marks binary").filter("marks IS NOT NULL")
    held = held.join(reps, "rep").join(marks.withColumnRenamed("doc_id", "rep"), "rep")
    meets = held.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other")).select(
        "key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
        "rep", "component", "n_shingles", "marks", "bands", "band", "part")
    more = meets.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_agreeing, "a long, b long")
    more = fresh(more.distinct(), "open-pairs")
    if not more.isEmpty():
        extra = fresh(confirmed(more, docs), "open-links")
        joint = components(links.union(extra))
    else:
        joint = part

    classes = sets.join(joint, sets["rep"] == joint["id"], "left").select(
        "n_shingles", "d1", "d2", F.coalesce("component", "rep").alias("class"))
    same = ["n_shingles", "d1", "d2"]
    out = signed.select("doc_id", *same).join(classes, same, "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("class")).otherwise(F.col("doc_id"))).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS sh FROM w),
e AS (SELECT doc_id, unnest(sh) AS g FROM s),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM met JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * n >= 75 * (len(x.sh) + len(y.sh) - n)),
near AS (SELECT a AS x, b AS y FROM links UNION SELECT b, a FROM links),
reach AS (SELECT x, y FROM near UNION SELECT r.x, n.y FROM reach r JOIN near n ON r.y = n.x),
low AS (SELECT x, min(y) AS m FROM reach GROUP BY x)
SELECT s.doc_id, len(s.sh) AS n_shingles, least(s.doc_id, coalesce(low.m, s.doc_id)) AS component_id,
       s.doc_id = least(s.doc_id, coalesce(low.m, s.doc_id)) AS kept
FROM s LEFT JOIN low ON low.x = s.doc_id
"""
