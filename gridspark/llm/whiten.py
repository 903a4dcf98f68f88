"""Embedding whitening with MLlib's BlockMatrix.

Centred rows get consecutive numbers and become distributed blocks; the blocks' transpose times
the blocks is the scatter matrix, whose eigenvectors (of a dims x dims matrix) are found on the
driver; the blocks times the whitening matrix are the projected rows. The multiplication
splits its inner dimension over all tasks, and tables beyond ``PANEL_ROWS`` rows are taken in panels,
because BlockMatrix plans each multiplication on the driver by the places of all its blocks.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import fresh

# Components returned, entries of one block, rows of one panel.
COMPONENTS = 32
BLOCK_ENTRIES = 1 << 20
PANEL_ROWS = 1 << 28
# Eigenvalues below this share of their sum are taken for zero: such components have no scale.
LEAST_SHARE = 1e-12
# Entries beyond this size are taken as of this size, so that 64 times them is a long.
MOST = float(1 << 55)
# The low bits of monotonically_increasing_id number the rows of a partition.
ROW_BITS = 33


class Numbered:
    """Written rows (row, ...) with consecutive numbers, in panels of whole partitions."""

    def __init__(self, rows: DataFrame, name: str, panel_rows: int = PANEL_ROWS):
        self.rows = fresh(rows.withColumn("row", F.monotonically_increasing_id()), name)
        part = F.shiftright("row", ROW_BITS).cast("long")
        counts = sorted((r["part"], r["n"]) for r in self.rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
        self.n = sum(n for _, n in counts)
        # a panel: its first and last partition, its rows, and (partition, rows before it in the panel)
        self.panels: list[list] = []
        for p, n in counts:
            if not self.panels or self.panels[-1][2] + n > panel_rows:
                self.panels.append([p, p, 0, []])
            held = self.panels[-1]
            held[1] = p
            held[3].append((p, held[2]))
            held[2] += n

    def panel(self, k: int) -> DataFrame:
        """The rows of a panel with ``index``, their numbers from 0."""
        lo, hi, _, before = self.panels[k]
        own = self.rows.filter((F.col("row") >= lo << ROW_BITS) & (F.col("row") < (hi + 1) << ROW_BITS))
        starts = self.rows.sparkSession.createDataFrame(before, "part int, before long")  # one row per partition
        own = own.join(F.broadcast(starts), F.shiftright("row", ROW_BITS).cast("int") == F.col("part")).drop("part")
        return own.withColumn("index", F.col("before") + F.col("row").bitwiseAND((1 << ROW_BITS) - 1)).drop("before")


def blocks(rows: DataFrame, n: int, dims: int) -> BlockMatrix:
    """(index, entries array<double>) as a matrix of blocks of whole rows; built in the JVM."""
    spread = 2 * rows.sparkSession.sparkContext.defaultParallelism
    size = max(1, min(BLOCK_ENTRIES // dims, -(-n // spread)))
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector("entries").alias("entries")), "entries")
    return IndexedRowMatrix(callMLlibFunc("createIndexedRowMatrix", vectors, n, dims)).toBlockMatrix(size, dims)


def scatter(rows: Numbered, entries: Column, dims: int) -> np.ndarray:
    """The sum over all rows of entry times entry, for each pair of dimensions."""
    total = np.zeros((dims, dims))
    for k, (_, _, n, _) in enumerate(rows.panels):
        held = blocks(rows.panel(k).withColumn("entries", entries), n, dims)
        java = held.transpose()._java_matrix_wrapper.call(
            "multiply", held._java_matrix_wrapper._java_model, rows.rows.sparkSession.sparkContext.defaultParallelism)
        total += BlockMatrix(java, dims, dims).toLocalMatrix().toArray()
    return total


def projected(rows: Numbered, entries: Column, weights: np.ndarray) -> DataFrame:
    """(row, entries) of all rows times ``weights`` (dims x components)."""
    spark = rows.rows.sparkSession
    dims, k = weights.shape
    right = BlockMatrix(spark.sparkContext.parallelize([((0, 0), Matrices.dense(dims, k, weights.T.ravel().tolist()))], 1), dims, k)
    out = None
    for p, (_, _, n, _) in enumerate(rows.panels):
        own = rows.panel(p)
        product = blocks(own.withColumn("entries", entries), n, dims).multiply(right).toIndexedRowMatrix()
        got = callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model).toDF("index", "vector")
        got = own.select("row", "index").join(got, "index").select("row", vector_to_array("vector").alias("entries"))
        out = got if out is None else out.union(got)
    return out


def fit_rows(vectors: DataFrame, name: str, panel_rows: int) -> tuple[Numbered, int]:
    """The written rows (vec_id, entries array<double>, row) of usable ``vectors``, and their length: vectors that are
    null or empty, or hold null or non-finite entries, are dropped, and so are those of another length than the most common
    one (ties: the greater)."""
    entries = F.col("vector").cast("array<double>")
    good = F.forall(entries, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    held = vectors.select("vec_id", entries.alias("entries")).filter((F.size("entries") > 0) & good)
    sizes = held.groupBy(F.size("entries").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    top = sizes.orderBy(F.desc("n"), F.desc("dims")).limit(1).collect()
    dims = top[0]["dims"] if top else 0
    return Numbered(held.filter(F.size("entries") == dims), name, panel_rows), dims


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened_grid(vectors: DataFrame, components: int = COMPONENTS, panel_rows: int = PANEL_ROWS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for every usable row of ``vectors`` (vec_id,
    vector) and up to ``components`` components; see ``fit_rows`` for the rows that are left out.

    Entries are taken as x = floor(64 * entry) + 1000000. ``n`` rows are fitted (rows that repeat count each time);
    ``deviation`` is the exact sum over dimensions of (n * x - S)**2, null where it is beyond a long; ``whitened`` is the
    centred row's share of the component over the square root of its eigenvalue; ``explained`` is that eigenvalue's share
    of all; ``identity_error`` is the largest entry of the whitened rows' covariance less the identity.
    Components without variance are not returned; a table without any gives an empty result. A null vec_id stays null.
    """
    spark = vectors.sparkSession
    rows, dims = fit_rows(vectors, "whiten-rows", panel_rows)
    if not rows.n:
        return spark.createDataFrame([], OUT)
    n = rows.n
    x = F.transform("entries", lambda e: F.floor(64 * F.greatest(F.least(e, F.lit(MOST)), F.lit(-MOST))) + 1_000_000)
    sums = rows.rows.select(F.posexplode(x).alias("k", "x")).groupBy("k").agg(F.sum(F.col("x").cast("decimal(20,0)")).alias("s"))
    total = [int(r["s"]) for r in sorted(sums.collect(), key=lambda r: r["k"])]  # one value per dimension
    whole = F.array(*[F.lit(s if abs(s) < 1 << 62 else None).cast("long") for s in total])
    means = F.array(*[F.lit(s / n) for s in total])
    # n * x - S in whole numbers, so centring loses nothing; null only where that is beyond a long
    lifted = F.zip_with(x, whole, lambda v, s: F.try_subtract(F.try_multiply(v, F.lit(n)), s))
    centred = F.transform(F.arrays_zip(x.alias("x"), lifted.alias("t"), means.alias("m")),
                          lambda z: F.coalesce(z["t"].cast("double") / n, z["x"].cast("double") - z["m"]))

    values, axes = np.linalg.eigh(scatter(rows, centred, dims) / n)
    values, axes = values[::-1], axes[:, ::-1]
    trace = float(values.sum())
    kept = [i for i in range(min(components, dims)) if values[i] > LEAST_SHARE * trace > 0]
    if not kept:
        return spark.createDataFrame([], OUT)
    weights = axes[:, kept] / np.sqrt(values[kept])
    k = len(kept)
    white = Numbered(projected(rows, centred, weights).withColumnRenamed("row", "of"), "whiten-projected", panel_rows)
    mean = white.rows.select(F.posexplode("entries").alias("k", "x")).groupBy("k").agg(F.avg("x").alias("m")).collect()
    mean = [r["m"] for r in sorted(mean, key=lambda r: r["k"])]
    level = F.zip_with("entries", F.array(*map(F.lit, mean)), lambda a, b: a - b)
    error = float(np.abs(scatter(white, level, k) / n - np.eye(k)).max())
    deviation = F.aggregate(lifted, F.lit(0).cast("long"), lambda a, t: F.try_add(a, F.try_multiply(t, t)))
    named = rows.rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("row").alias("of"), deviation.alias("deviation"))
    out = named.join(white.rows.drop("row"), "of")
    return out.select("vec_id", "deviation", F.posexplode("entries").alias("k", "whitened")).select(
        "vec_id", (F.col("k") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(F.array(*map(F.lit, (values[kept] / trace).tolist())), F.col("k")).alias("explained"), F.lit(error).alias("identity_error"))
