"""S9/L5 exactly: JSON files of N lines each over the whole result, in read order.

Rows are sorted in ranges over all tasks and written once; the ranges' row counts, added up,
give every row its number and so its file. One task writes a file, and no task sees more
than its files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.session import scratch_path

# The low bits of monotonically_increasing_id number the rows of a partition.
ROW_BITS = 33
MASK = (1 << ROW_BITS) - 1


def numbered(df: DataFrame, order: list[str], column: str, tasks: int | None = None) -> DataFrame:
    """``df`` with ``column``, its rows' numbers from 0 in the order of ``order``.

    The rows are written once, range-partitioned and sorted; what the driver adds up is one count for
    each range. Rows that are equal in ``order`` are numbered in any order, within one range.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "sorted-rows")
    ranged = df.repartitionByRange(tasks, *order) if tasks else df.repartitionByRange(*order)
    ranged = ranged.sortWithinPartitions(*order).withColumn(column, F.monotonically_increasing_id())
    ranged.write.parquet(path)
    held = spark.read.schema(ranged.schema).parquet(path)
    part = F.shiftright(column, ROW_BITS).cast("int")
    counts = sorted((r["part"], r["n"]) for r in held.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    starts, before = [], 0
    for p, n in counts:
        starts.append((p, before))
        before += n
    offsets = F.broadcast(spark.createDataFrame(starts, "part int, before long"))  # one row per range
    row = F.col("before") + F.col(column).bitwiseAND(MASK)
    return held.join(offsets, F.shiftright(held[column], ROW_BITS).cast("int") == offsets["part"]).select(
        *df.columns, row.alias(column))


def write_json_exact(df: DataFrame, path: str, lines: int, order: list[str], tasks: int | None = None) -> int:
    """JSON lines under ``path``/file=K: file K holds rows K * ``lines`` and on in the order of ``order``, every
    file but the last exactly ``lines`` of them, in order. Returns the number of files."""
    rows = numbered(df, order, "row", tasks).withColumn("file", (F.col("row") / lines).cast("long"))
    # a file's lines meet in one task; the writer keeps their order
    out = rows.repartition("file").sortWithinPartitions("file", "row").drop("row")
    out.write.partitionBy("file").json(path)
    last = rows.agg(F.max("file")).first()[0]
    return 0 if last is None else last + 1
