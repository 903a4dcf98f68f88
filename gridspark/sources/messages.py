"""Notification sources, batch (S1, S2); the stream form is in ``gridspark.streaming``.

The queue is re-aimed as files of message bodies (one JSON envelope per line) read
through Spark's file systems, so a poll is a bounded read of what has arrived.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridspark.functions.messages import accepted, parse_notifications
from gridspark.operators.match import cap


def read_bodies(spark: SparkSession, location: str) -> DataFrame:
    """Message bodies (``body STRING``) of every file under ``location``."""
    return spark.read.text(location).withColumnRenamed("value", "body")


def read_notifications(spark: SparkSession, location: str, n: int | None = None, keep_rejects: bool = False) -> DataFrame:
    """Parsed messages; ``n`` bounds the batch to the first ``n`` in arrival order
    (L2). With ``keep_rejects`` the ``reject_reason`` column is kept and bad messages
    stay in the result."""
    parsed = parse_notifications(read_bodies(spark, location))
    out = parsed if keep_rejects else accepted(parsed)
    return cap(out, n) if n is not None else out


def read_one_notification(spark: SparkSession, location: str) -> DataFrame:
    """The earliest message, or an empty result when nothing has arrived."""
    return read_notifications(spark, location, 1)
