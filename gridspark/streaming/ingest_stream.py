"""Notification stream -> micro-batch ingest (ST1-ST5, D5).

The queue is a folder of message files read with the file stream source; each
micro-batch (ST4) matches its messages, reads the announced grids and appends the long
rows to the sink in one job. The checkpoint records which files were consumed, which is
the acknowledgement (ST5): a restart resumes after the last committed batch and never
re-ingests a consumed message. Sinks receive ``(rows, batch_id)`` and should be
idempotent per batch id (``parquet_sink`` overwrites that batch's folder), which makes
the whole path exactly-once under task and driver retries.

A message whose object cannot be read is not lost: ``process`` may return its rejects too,
which go to a dead-letter sink inside the same batch, and ``retry_rejects`` runs them again. A store
that does not answer fails the batch, which is then not committed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridspark.functions.messages import accepted, parse_notifications
from gridspark.sinks.snapshot import SnapshotStore
from gridspark.sinks.writers import write_jdbc

Sink = Callable[[DataFrame, int], None]


def notification_stream(spark: SparkSession, inbox: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """ST1/L2: message bodies (one per line) from files arriving in ``inbox``."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(inbox).withColumnRenamed("value", "body")


def event_time():
    """A message's creation time; NULL when it is no ISO time (fractions are accepted)."""
    return F.try_to_timestamp("created_time", F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSS]'Z'"))


def untimed(bodies: DataFrame) -> DataFrame:
    """Usable messages that the dedupe cannot place in time: its rejects."""
    return accepted(parse_notifications(bodies)).filter(event_time().isNull())


def parsed_stream(bodies: DataFrame, dedupe_delay: str | None = None) -> DataFrame:
    """Usable notifications; what cannot be used is left out here, and kept with its reason by
    ``outcomes.start_routed``. ``dedupe_delay`` (e.g. ``"1 hour"``) drops a message whose
    (bucket, key) already arrived within that event-time delay (D5, opt-in; the
    reference appends every redelivery); messages without a readable time are left
    out then, see ``untimed``; ``versions.versioned`` judges those too."""
    n = accepted(parse_notifications(bodies))
    if dedupe_delay:
        n = (
            n.withColumn("event_time", event_time())
            .filter("event_time IS NOT NULL")
            .withWatermark("event_time", dedupe_delay)
            .dropDuplicatesWithinWatermark(["bucket", "key"])
            .drop("event_time")
        )
    return n


def parquet_sink(path: str) -> Sink:
    """Idempotent per batch: each batch owns ``path/batch_id=N``; a replayed batch
    overwrites its own folder."""

    def sink(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")

    return sink


def json_sink(path: str, max_records_per_file: int = 100_000) -> Sink:
    """Idempotent per batch, like ``parquet_sink``: JSON lines under ``path/batch_id=N``."""

    def sink(rows: DataFrame, batch_id: int) -> None:
        (rows.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
         .json(f"{path.rstrip('/')}/batch_id={batch_id}"))

    return sink


def console_sink(n: int = 20) -> Sink:
    """S10 for streams: the first rows of every micro-batch on the driver's console."""

    def sink(rows: DataFrame, batch_id: int) -> None:
        print(f"-- batch {batch_id}")
        rows.show(n, truncate=False)

    return sink


def jdbc_sink(url: str, table: str, properties: dict | None = None, num_partitions: int = 8) -> Sink:
    """At-least-once JDBC append with a ``batch_id`` column, so a replayed batch can be
    found and removed by its id."""

    def sink(rows: DataFrame, batch_id: int) -> None:
        write_jdbc(rows.withColumn("batch_id", F.lit(batch_id)), url, table, properties, num_partitions)

    return sink


def start_ingest(
    notifications: DataFrame,
    process: Callable[[DataFrame], DataFrame | tuple[DataFrame, DataFrame]],
    sink: Sink | SnapshotStore,
    checkpoint: str,
    trigger: str = "availableNow",
    interval: str = "10 seconds",
    query_name: str | None = None,
    dead_letters: Sink | None = None,
    wanted: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """ST1-ST4: run ``process`` (matched messages -> long rows) on every micro-batch.

    ``trigger`` is ``"availableNow"`` (drain what is there, then stop) or
    ``"processingTime"`` (poll every ``interval``, ST2). Batches in which nothing is
    ``wanted`` (by default: no message; e.g. ``match.is_wanted``) are skipped (ST3). A
    ``process`` that returns (rows, rejects) needs a ``dead_letters`` sink, or a ``SnapshotStore`` as ``sink``:
    its tables ``rows`` and ``dead`` get both in one commit, and a replayed batch that is there already is skipped.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        store = sink if isinstance(sink, SnapshotStore) else None
        if store and store.committed(batch_id) or (wanted(batch) if wanted else batch).isEmpty():
            return
        done = process(batch)
        if store:
            store.write(batch_id, dict(zip(("rows", "dead"), done if isinstance(done, tuple) else (done,))))
        elif isinstance(done, tuple):
            rows, rejects = done
            if dead_letters is None:
                raise ValueError("process returns rejects: a dead-letter sink is needed")
            dead_letters(rejects, batch_id)
            sink(rows, batch_id)
        else:
            sink(done, batch_id)

    w = notifications.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if trigger == "availableNow" else w.trigger(processingTime=interval)
    return w.start()


def retry_rejects(spark: SparkSession, dead_letter_path: str, process: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
                  sink: Sink, still_dead: Sink, attempt: int) -> None:
    """Run all dead letters written by ``parquet_sink(dead_letter_path)`` again: the rows of
    those that can be read now go to ``sink``, the rest to ``still_dead``, both under the batch
    id ``attempt``. Give ``sink`` and ``still_dead`` folders of their own for each attempt."""
    letters = spark.read.parquet(dead_letter_path).drop("batch_id", "error")
    rows, rejects = process(letters)
    still_dead(rejects, attempt)
    sink(rows, attempt)
