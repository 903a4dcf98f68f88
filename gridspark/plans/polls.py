"""Registered queries over the message-level stream: polls, caps across polls, routed outcomes,
redeliveries, and exactly rolled files."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridspark.functions.messages import accepted, build_body, parse_notifications
from gridspark.operators import match as M
from gridspark.operators import unpivot as U
from gridspark.plans.catalog import (_NOTIF_SQL, G_R, G_X, G_Y, INGEST_PARAMS, MEASURE, PER_KEY, _cells_sql, _long_sql,
                                     _reject_bodies, compared, grid_g, register, table)
from gridspark.schema import LONG_SCHEMA
from gridspark.session import scratch_path
from gridspark.sinks.rolled import write_json_exact
from gridspark.sinks.snapshot import SnapshotStore
from gridspark.sources.tables import notification_fields
from gridspark.streaming.message_source import drained, idle, polled_messages
from gridspark.streaming.outcomes import start_routed
from gridspark.streaming.versions import start_versioned, use_state_store

# Messages in one poll, polls of a backlog taken in one micro-batch, files of the inbox (at least) and messages
# in one of them (at most), and the matched messages after which polling ends.
POLL = 1000
BACKLOG = 5000
INBOX_FILES = 3
FILE_MESSAGES = 250_000
POLL_CAP = 2500

# The five fields of each event's message, with the event's number.
_NUMBERED_SQL = _NOTIF_SQL.replace("FROM events", ", event_id FROM events")
_FIELDS = "bucket, name, key, created_time, forecast_reference_time"
_POLLED_SQL = f"SELECT {_FIELDS}, (row_number() OVER (ORDER BY event_id) - 1) // {POLL} AS poll FROM ({_NUMBERED_SQL}) n"
_WANTED = ", ".join(f"'{p[0]}'" for p in INGEST_PARAMS)


def write_inbox(events, bodies: F.Column, path: str) -> None:
    """The events' messages in the order of their numbers, as files whose names sort in that order."""
    files = max(INBOX_FILES, -(-events.count() // FILE_MESSAGES))
    events.repartitionByRange(files, "event_id").sortWithinPartitions("event_id").select(bodies.alias("value")).write.text(path)


def run_polls(spark, base: str, store: SnapshotStore, **source) -> None:
    """Drain the inbox under ``base`` in polls; a poll's messages and their outcomes appear in one commit, with those of
    the other polls of its micro-batch."""
    bodies = polled_messages(spark, f"{base}/inbox", POLL, file_order="name", polls=BACKLOG, **source)
    drained(start_routed(bodies, lambda s: M.params_frame(s, INGEST_PARAMS), store, f"{base}/checkpoint", keep=("poll",)))


def _polled(spark, sf_dir, name, **source):
    base = scratch_path(spark, name)
    events = table(spark, sf_dir, "events")
    write_inbox(events, build_body(*notification_fields(events, PER_KEY, "g_")), f"{base}/inbox")
    store = SnapshotStore(spark, f"{base}/store")
    run_polls(spark, base, store, **source)
    return store.read("outcomes").select(*_FIELDS.split(", "), "poll")


@register("ingest_polls", _POLLED_SQL)
def ingest_polls(spark, sf_dir):
    """S1, L2, ST1: the messages of ``events`` drained in polls of ``POLL`` messages, whatever the files."""
    return _polled(spark, sf_dir, "polls")


@register("matched_cap_stream", f"""
WITH p AS ({_POLLED_SQL}),
k AS (SELECT poll, sum(count(*) FILTER (name IN ({_WANTED}))) OVER (ORDER BY poll) - count(*) FILTER (name IN ({_WANTED})) AS before
      FROM p GROUP BY poll)
SELECT p.* FROM p JOIN k ON k.poll = p.poll WHERE k.before < {POLL_CAP}""")
def matched_cap_stream(spark, sf_dir):
    """L3 across polls: polling ends after the poll in which ``POLL_CAP`` messages have matched."""
    return _polled(spark, sf_dir, "polls-capped", names=[p[0] for p in INGEST_PARAMS], matched_cap=POLL_CAP)


@register("stream_outcomes", f"""
SELECT poll, outcome, reject_reason, count(*) AS n FROM (
  SELECT (row_number() OVER (ORDER BY event_id) - 1) // {POLL} AS poll,
         CASE WHEN event_type IN ('error', 'signup', 'view') THEN 'rejected' WHEN event_type IN ({_WANTED}) THEN 'accepted' ELSE 'unmatched' END AS outcome,
         CASE event_type WHEN 'error' THEN 'no Message in envelope' WHEN 'signup' THEN 'malformed Message'
                         WHEN 'view' THEN 'missing field: key' END AS reject_reason
  FROM events) GROUP BY ALL""")
def stream_outcomes(spark, sf_dir):
    """P1, ST3: every message of every poll with its outcome, counted; nothing is consumed unseen."""
    base = scratch_path(spark, "outcomes")
    events = table(spark, sf_dir, "events")
    write_inbox(_reject_bodies(events, "event_id"), F.col("body"), f"{base}/inbox")
    store = SnapshotStore(spark, f"{base}/store")
    run_polls(spark, base, store)
    return store.read("outcomes").groupBy("poll", "outcome", "reject_reason").agg(F.count(F.lit(1)).alias("n"))


_VERSIONS_SQL = f"""
WITH p AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS k FROM ({_NUMBERED_SQL}) n),
q AS (SELECT *, k // {POLL} AS poll, row_number() OVER (PARTITION BY bucket, key, k // {POLL} ORDER BY created_time DESC, k DESC) AS place FROM p),
top AS (SELECT *, max(created_time) OVER (PARTITION BY bucket, key ORDER BY poll ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
        FROM q WHERE place = 1)
SELECT {_FIELDS}, poll, 'superseded' AS version FROM q WHERE place > 1
UNION ALL
SELECT {_FIELDS}, poll, CASE WHEN seen IS NULL OR created_time > seen THEN 'newest' WHEN created_time = seen THEN 'repeated' ELSE 'older' END
FROM top"""


@register("stream_versions", _VERSIONS_SQL)
def stream_versions(spark, sf_dir):
    """ST5: redeliveries told apart by keyed state: the newest message for each announced object, repeats and late ones."""
    base = scratch_path(spark, "versions")
    events = table(spark, sf_dir, "events")
    write_inbox(events, build_body(*notification_fields(events, PER_KEY, "g_")), f"{base}/inbox")
    store = SnapshotStore(spark, f"{base}/store")
    use_state_store(spark)
    bodies = polled_messages(spark, f"{base}/inbox", POLL, file_order="name", polls=BACKLOG)
    usable = accepted(parse_notifications(bodies, keep=("file", "line", "poll")))
    idle(start_versioned(usable, store, f"{base}/checkpoint"))
    return store.read("versions").select(*_FIELDS.split(", "), "poll", "version")


EXACT = 700


@register("sink_json_exact", f"""
SELECT {_long_sql('c', MEASURE)}, (row_number() OVER (ORDER BY c.file_name, c.r, c.y, c.x) - 1) // {EXACT} AS file
FROM ({_cells_sql(G_R, G_Y, G_X)}) c""")
def sink_json_exact(spark, sf_dir):
    """Long rows as JSON files of exactly ``EXACT`` lines in read order, read back with their file numbers."""
    path = scratch_path(spark, "json-exact")
    write_json_exact(U.to_long_indexed(grid_g(spark, sf_dir)), path, EXACT, ["file_name", "cnt"])
    schema = T.StructType([*LONG_SCHEMA.fields, T.StructField("file", T.LongType())])
    return compared(spark.read.schema(schema).json(path))
