"""Sinks (S8-S11, L4, L5, A1 on the write path).

Row counts are taken with ``DataFrame.observe`` while the data is written, so a write
plus its count is one pass over the input (the reference runs ``show``, ``count`` and
the write as three separate jobs over an uncached plan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gridspark.schema import LONG_SCHEMA


def _observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict | None = None,
    num_partitions: int = 8,
    batch_size: int = 1000,
    mode: str = "append",
) -> int:
    """Append to a SQL table with at most ``num_partitions`` connections and batched
    inserts; returns the number of rows written.

    ``numPartitions`` makes Spark coalesce to that many tasks without an exchange, so
    everything since the last one runs in them too. To keep file reads and the like wide,
    put an exchange before the last narrow steps (``slabs.repartition(n)`` before the
    unpivot): then only what follows it runs in the writer tasks.
    """
    out, obs = _observed(df, "jdbc_write")
    (
        out.write.mode(mode)
        .option("numPartitions", num_partitions)
        .option("batchsize", batch_size)
        .jdbc(url, table, properties=dict(properties or {}))
    )
    return int(obs.get.get("rows", 0))


def jdbc_table_ddl() -> str:
    """``createTableColumnTypes`` for the long table (time and forecast correctly named)."""
    return ", ".join(f"{f.name} {'VARCHAR(1024)' if f.dataType.typeName() == 'string' else 'DOUBLE'}"
                     for f in LONG_SCHEMA.fields)


def write_json(df: DataFrame, path: str, max_records_per_file: int = 100_000, mode: str = "append") -> int:
    """JSON lines, a new file after every ``max_records_per_file`` rows of a task;
    returns the number of rows written."""
    out, obs = _observed(df, "json_write")
    out.write.mode(mode).option("maxRecordsPerFile", max_records_per_file).json(path)
    return int(obs.get.get("rows", 0))


def read_long_json(spark, path: str) -> DataFrame:
    """Read long rows written by ``write_json`` back with the declared schema (no inference)."""
    return spark.read.schema(LONG_SCHEMA).json(path)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """L4: the first ``n`` rows (what ``show`` prints)."""
    return df.limit(n)


def console(df: DataFrame, n: int = 20, truncate: bool = False) -> None:
    """Schema and the first rows on the driver's console."""
    df.printSchema()
    df.show(n, truncate=truncate)
