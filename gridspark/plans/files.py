"""The flagship pipeline over the announced files themselves.

Every distinct (object, measure, axes) that matched messages announce is read once, as far as
the widest realization limit among those messages requires; the slabs then join the
matched messages exactly as in ``gridspark.plans.ingest.ingest``. A file announced by
many messages (redeliveries, or one hot object) is therefore read once, not once per
message, and its fan-out to messages is an ordinary, skew-handled join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.operators.match import arrival_order, file_name_col, match_params, object_uri_col
from gridspark.plans.ingest import copy_rows, hot_files, join_messages, salted_messages, written_messages
from gridspark.sources.catalogue import HeaderCatalogue
from gridspark.sources.gridfile import DEFAULT_BLOCK_BYTES, good_slabs, prepared, read_slabs, spread_plan

REJECT_FIELDS = ("bucket", "name", "key", "created_time", "forecast_reference_time")


def matched_objects(notifications: DataFrame, params: DataFrame, base_uri: str | None = None,
                    case_insensitive: bool = False, first: int | None = None) -> DataFrame:
    """Matched messages keyed by the read request they make (S3, J1/J2, P4): the object,
    and the axis names regardless of their case (``m_key``), beside the measure."""
    m = match_params(notifications, params, case_insensitive)
    if first is not None:
        m = m.orderBy(*arrival_order()).limit(first)
    uri = object_uri_col(base_uri)
    return m.select(
        file_name_col().alias("out_file_name"),
        uri.alias("m_path"),
        F.concat_ws("\u0001", uri, F.lower("coord_y"), F.lower("coord_x")).alias("m_key"),
        F.col("measure").alias("m_measure"),
        "coord_y",
        "coord_x",
        "r_limit",
        *REJECT_FIELDS,
    )


def requests_from_matched(m: DataFrame) -> DataFrame:
    """Distinct read requests of matched messages (``matched_objects`` rows); the slabs
    carry the request's key as their ``file_name``.

    One row per (object, measure, axes), with the limit that covers every message for it: -1
    if any message wants all realizations, else the largest limit. A partial aggregate,
    so even an object announced by a third of all messages is reduced on each mapper
    before the shuffle.
    """
    return m.groupBy(F.col("m_key").alias("file_name"), F.col("m_measure").alias("measure")).agg(
        F.min("m_path").alias("path"), F.min("coord_y").alias("coord_y"), F.min("coord_x").alias("coord_x"),
        F.when(F.min("r_limit") < 0, F.lit(-1)).otherwise(F.max("r_limit")).cast("int").alias("r_limit"),
    ).select("path", "file_name", "measure", "coord_y", "coord_x", "r_limit")


def ingest_files_and_rejects(notifications: DataFrame, params: DataFrame, base_uri: str | None = None,
                             case_insensitive: bool = False, block_bytes: int = DEFAULT_BLOCK_BYTES,
                             first: int | None = None, parallelism: int | None = None,
                             catalogue: HeaderCatalogue | None = None) -> tuple[DataFrame, DataFrame]:
    """Long rows of every matched message whose file can be read, and the messages whose
    file cannot: the message fields with ``error``.

    The matched messages and the read plan are written once; rows and rejects both come
    from them, so nothing is read twice. A file that is missing, damaged or unlike its
    parameters is found out in the header pass, which also reads the last cell needed;
    any other failure (a store that does not answer) fails the task, which Spark retries,
    and in the end the job: such messages are not acknowledged.
    Blocks of files named by more than a task's share of the messages are read in
    several copies, each joining a slice of those messages. With a ``catalogue`` only files that are new
    or changed since they were last seen are opened for their headers.
    """
    rows, rejects, _ = _ingested(notifications, params, base_uri, case_insensitive, block_bytes, first, parallelism, catalogue)
    return rows, rejects


def _ingested(notifications, params, base_uri, case_insensitive, block_bytes, first, parallelism=None,
              catalogue=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows, rejects, and the plan's requests that cannot be read (path, error)."""
    m, count = written_messages(matched_objects(notifications, params, base_uri, case_insensitive, first))
    plan, axes = prepared(requests_from_matched(m), block_bytes, catalogue=catalogue)
    hot = hot_files(m, count, parallelism)
    scanned = good_slabs(read_slabs(spread_plan(copy_rows(plan, hot, "file_name", "measure")), fail_fast=True, axes=axes))
    rows = join_messages(scanned, salted_messages(m.select("out_file_name", "m_key", "m_measure", "r_limit", "m_row"), hot))
    bad = plan.filter(F.col("error").isNotNull()).select(F.col("file_name").alias("b_key"), F.col("measure").alias("b_measure"), "error")
    rejects = m.join(bad, (m["m_key"] == bad["b_key"]) & (m["m_measure"] == bad["b_measure"])).select(*REJECT_FIELDS, "error")
    return rows, rejects, plan.filter("error IS NOT NULL").select("path", "error")


def ingest_files(notifications: DataFrame, params: DataFrame, base_uri: str | None = None,
                 case_insensitive: bool = False, block_bytes: int = DEFAULT_BLOCK_BYTES, first: int | None = None) -> DataFrame:
    """The rows of ``ingest_files_and_rejects``; when a file cannot be read the query fails
    instead of returning the rest as if whole."""
    rows, _, unread = _ingested(notifications, params, base_uri, case_insensitive, block_bytes, first)
    bad = unread.first()  # from the written plan: no message is joined for it
    if bad is not None:
        raise ValueError(f"unreadable file {bad['path']!r}: {bad['error']}")
    return rows


def ingest_one(notifications: DataFrame, name: str, measure: str, coordinates: str, base_uri: str | None = None,
               r_limit: int = -1) -> DataFrame:
    """The earliest message (S2); if its name equals ``name`` regardless of case (P2), the
    long rows of the one file it announces (S6). ``coordinates`` is ``"coordY,coordX"``."""
    from gridspark.operators.match import cap, filter_name_ci, params_frame

    coord_y, coord_x = (c.strip() for c in coordinates.split(","))
    one = filter_name_ci(cap(notifications, 1), name)
    params = params_frame(notifications.sparkSession, [(name, measure, coord_y, coord_x, r_limit)])
    return ingest_files(one, params, base_uri, case_insensitive=True)


