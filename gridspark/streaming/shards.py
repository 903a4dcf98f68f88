"""Keyed state of many keys in one value.

A stateful processor is called once for each of its groups and batch, and every read and write of state is an exchange
with the JVM. Grouping by a ``shard`` of the keys and holding a shard's keys as one packed table bounds both by ``SHARDS``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

SHARDS = 512
PARTITIONS = "spark.sql.shuffle.partitions"


def shard(*fields: str) -> Column:
    return F.pmod(F.xxhash64(*fields), F.lit(SHARDS)).cast("int").alias("shard")


@contextmanager
def state_partitions(spark: SparkSession) -> Iterator[None]:
    """A stream started inside has at most two state partitions for each core (16 at least): each costs a Python worker
    call and a state commit in every batch, also in those without rows."""
    before = spark.conf.get(PARTITIONS)
    spark.conf.set(PARTITIONS, str(min(int(before), max(16, 2 * spark.sparkContext.defaultParallelism))))
    try:
        yield
    finally:
        spark.conf.set(PARTITIONS, before)


def pack(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, preserve_index=False).replace_schema_metadata(None)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack(value: tuple | None, columns: list[str]) -> pd.DataFrame:
    """The table in a one-field state ``value``; without one, no rows of ``columns``."""
    if value is None:
        return pd.DataFrame(columns=columns)
    with pa.ipc.open_stream(pa.py_buffer(bytes(value[0]))) as stream:
        return stream.read_all().to_pandas()
