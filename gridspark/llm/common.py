"""Helpers shared by the operators: bounded slices of Arrow text, vectorised word spans
and hashes, written intermediates, and connected components as Spark joins."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.session import scratch_path

# Text bytes handled at once inside a task (a longer document is one slice by itself); the
# arrays made for a slice take some 50 times its size.
SLICE_BYTES = 1 << 20

# Rows of one Arrow batch of text: a batch is held by the JVM and the Python worker at once.
BATCH_ROWS = 500

# Largest id list sent to every executor; longer lists are joined by a shuffle.
BROADCAST_IDS = 2_000_000

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (multiply and shift rounds; arithmetic wraps)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def seeds(n: int, salt: int = 0) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values for a given salt."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=U) + U(salt * 1_000_003)) * U(0x9E3779B97F4A7C15))


BYTE_VALUES = seeds(256, 1)
WORD_BASE = U(0xD6E8FEB86659FD93)
GRAM_BASE = U(0xA0761D6478BD642F)


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, U)
    out[0] = 1
    return np.cumprod(out, dtype=U)


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return freed memory to the system."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def released(run):
    """A batch function that gives freed memory back to the system when its task ends: Python
    workers live on for other stages, and what they keep would add up beside theirs."""
    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def few_rows(batches: Iterator[pa.RecordBatch], n: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``n`` rows, for work that holds Python objects of all
    rows at once."""
    for batch in batches:
        for lo in range(0, len(batch), n):
            yield batch.slice(lo, n)


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, UTF-8 bytes, row offsets into them) of consecutive rows with
    at most ``limit`` bytes of text together, or one longer row. Nulls read as empty."""
    col = batch.column(column).cast(pa.large_string()).fill_null("")
    n = len(col)
    if not n:
        return
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset: col.offset + n + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, hi, data[offs[lo]: offs[hi]], offs[lo: hi + 1] - offs[lo]
        lo = hi


def word_spans(data: np.ndarray, offs: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of every word, and per row the index of its first word (one more
    entry closes the last row). Words are runs of bytes that ``space`` does not mark (by
    default space and \\t..\\r) and never cross a row's end."""
    inside = ~space[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    at = offs[:-1][offs[:-1] < offs[1:]]
    first[at] = inside[at]
    at = offs[1:][offs[:-1] < offs[1:]] - 1
    last[at] = inside[at]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, offs)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(start):
        return np.zeros(0, U)
    size = end - start
    at = np.cumsum(size) - size
    k = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(at, size)
    values = BYTE_VALUES[data[k + np.repeat(start, size)]] * powers(WORD_BASE, int(size.max()))[k]
    return mix(np.add.reduceat(values, at) + size.astype(U))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of each ``n`` consecutive word hashes (fewer words: an empty result)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, U)
    p = powers(GRAM_BASE, n)
    out = np.zeros(m, U)
    for j in range(n):
        out += words[j: j + m] * p[j]
    return mix(out)


def small_batches(spark: SparkSession) -> None:
    """Hand text to the Python workers in batches of ``BATCH_ROWS`` rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def fresh(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: lineage is cut there,
    and the planner knows the written size."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def only_ids(df: DataFrame, column: str, ids: DataFrame, count: int, limit: int = BROADCAST_IDS) -> DataFrame:
    """Rows of ``df`` whose ``column`` is in the one-column frame ``ids``: by a broadcast
    when the measured ``count`` is within ``limit``, else by a shuffle join."""
    ids = ids.toDF("wanted_id")
    ids = F.broadcast(ids) if count <= limit else ids
    return df.join(ids, df[column] == ids["wanted_id"], "left_semi")


def without_ids(df: DataFrame, column: str, ids: DataFrame, count: int, limit: int = BROADCAST_IDS) -> DataFrame:
    """Rows of ``df`` whose ``column`` is not in the one-column frame ``ids`` (null equals
    null), joined as in ``only_ids``."""
    ids = ids.toDF("unwanted_id")
    ids = F.broadcast(ids) if count <= limit else ids
    return df.join(ids, df[column].eqNullSafe(ids["unwanted_id"]), "left_anti")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id reachable from each id named by an edge.

    Labels start at the smallest neighbour and are lowered by the neighbours' labels and
    by the label of the label (path halving), each round one written table in the shared
    folder, until no label changes: a few rounds even for long chains.
    """
    both = fresh(
        edges.select(F.col(a).alias("x"), F.col(b).alias("y"))
        .union(edges.select(F.col(b).alias("x"), F.col(a).alias("y")))
        .filter("x <> y").distinct(), "links")
    labels = fresh(both.groupBy(F.col("x").alias("id")).agg(F.least(F.min("y"), F.first("x")).alias("component")), "labels")
    while True:
        seen = both.join(labels, both["y"] == labels["id"]).groupBy(F.col("x").alias("k")).agg(F.min("component").alias("near"))
        low = labels.join(seen, labels["id"] == seen["k"], "left").select(
            "id", F.col("component").alias("was"), F.least("component", F.coalesce("near", "component")).alias("component"))
        up = labels.select(F.col("id").alias("k"), F.col("component").alias("up"))
        new = fresh(low.join(up, low["component"] == up["k"], "left").select(
            "id", "was", F.least("component", F.coalesce("up", "component")).alias("component")), "labels")
        if new.filter("was <> component").isEmpty():
            return new.select("id", "component")
        labels = new.select("id", "component")
