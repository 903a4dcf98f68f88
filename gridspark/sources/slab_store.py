"""A stored ``grid_slabs`` table laid out for pruning.

Slabs are written as Parquet, partitioned by ``measure_name`` and ``file_bucket`` (a hash
of the file id) and sorted by ``file_name`` within. Both are join keys in ``plans.ingest``,
so dynamic partition pruning reads only the folders of measures and buckets that the
messages name, whatever their number; a filter on the measure prunes statically.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridspark.schema import SLAB_COLUMNS

# Files in one folder of a measure, and the least and largest number of a measure's folders.
FILES_PER_BUCKET = 64
LEAST_BUCKETS, MOST_BUCKETS = 64, 1 << 16
# Under the store's path, left alone by readers of the slabs: the number of buckets.
LAYOUT = "_layout"


def file_bucket(column: str, buckets: Column | int) -> Column:
    """The bucket of a file id."""
    return F.pmod(F.xxhash64(column), F.lit(buckets).cast("long") if isinstance(buckets, int) else buckets).cast("int")


def bucket_count(slabs: DataFrame) -> int:
    """A power of two for about ``FILES_PER_BUCKET`` of the slabs' files in each bucket."""
    files = slabs.agg(F.approx_count_distinct("file_name").alias("n")).first()["n"]
    n = LEAST_BUCKETS
    while n < MOST_BUCKETS and n * FILES_PER_BUCKET < files:
        n *= 2
    return n


def store_slabs(slabs: DataFrame, path: str, mode: str = "errorifexists", partitions: int | None = None, buckets: int | None = None) -> None:
    """Write slabs for later ingests. ``partitions`` fixes the number of shuffle partitions;
    by default AQE sizes them from the data. ``buckets`` fixes the number of a measure's folders; by default it
    follows the number of files (``bucket_count``), and rows appended later keep the store's number."""
    spark = slabs.sparkSession
    keys = ["measure_name", "file_bucket", "file_name"]
    held = layout(spark, path) if mode == "append" else None
    n = held or buckets or bucket_count(slabs)
    rows = slabs.select(*SLAB_COLUMNS).withColumn("file_bucket", file_bucket("file_name", n))
    ordered = rows.repartitionByRange(partitions, *keys) if partitions else rows.repartitionByRange(*keys)
    ordered.sortWithinPartitions(*keys, "r", "level", "y").write.mode(mode).partitionBy("measure_name", "file_bucket").parquet(path)
    if held is None:
        spark.range(1).select(F.lit(n).alias("buckets")).write.mode("overwrite").json(f"{path.rstrip('/')}/{LAYOUT}")


def layout(spark: SparkSession, path: str) -> int | None:
    """The number of buckets of a store; None where there is none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{LAYOUT}")
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return None
    return spark.read.schema("buckets int").json(where.toString()).first()["buckets"]


def read_slab_store(spark: SparkSession, path: str) -> DataFrame:
    """The stored slabs with their ``file_bucket`` and the store's number of them, a constant, ``file_buckets``."""
    n = layout(spark, path) or LEAST_BUCKETS
    return spark.read.parquet(path).select(*SLAB_COLUMNS, "file_bucket", F.lit(n).cast("long").alias("file_buckets"))
