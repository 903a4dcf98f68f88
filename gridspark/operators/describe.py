"""Grid metadata listing on slabs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def describe_slabs(slabs: DataFrame) -> DataFrame:
    """Per (file, measure): realization, level, y and x lengths, and the scalar times.

    A hash aggregate with map-side partial aggregation, so a file holding most of the
    slabs is reduced on every mapper before the shuffle.
    """
    return slabs.groupBy("file_name", "measure_name").agg(
        (F.max("r") + 1).alias("n_r"),
        (F.max("level") + 1).alias("n_level"),
        (F.max("y") + 1).alias("n_y"),
        F.max(F.size("vals")).alias("n_x"),
        F.max("time").alias("time"),
        F.min("forecast").alias("forecast"),
    )
