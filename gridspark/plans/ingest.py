"""The flagship pipeline: notifications -> matched parameters -> grid slabs -> long rows.

``ingest`` works on any ``grid_slabs`` DataFrame (stored slabs, a stand-in, or the file
scan's output); ``gridspark.plans.files.ingest_files`` is the same pipeline reading
the announced files themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gridspark.functions.messages import accepted, parse_notifications
from gridspark.operators.match import arrival_order, file_name_col, match_params
from gridspark.operators.unpivot import converted_lines, first_level, long_cells, within_limit


def matched_files(notifications: DataFrame, params: DataFrame, case_insensitive: bool = False,
                  key: Column | None = None, first: int | None = None) -> DataFrame:
    """Matched messages with the output file name (P4), the id of the grid they announce
    (``key``, by default the message key) and their extraction parameters. ``first``
    keeps only the first matched messages in arrival order (L3)."""
    m = match_params(notifications, params, case_insensitive)
    if first is not None:
        m = m.orderBy(*arrival_order()).limit(first)
    return m.select(
        file_name_col().alias("out_file_name"),
        (key if key is not None else F.col("key")).alias("m_key"),
        F.col("measure").alias("m_measure"),
        "r_limit",
    )


def written_messages(m: DataFrame) -> tuple[DataFrame, int]:
    """Matched messages written once as Parquet to the shared folder, and their count (taken
    while writing).

    Lineage is cut there, a lost executor re-reads files, and the planner knows the size
    when it chooses joins. The row number ``m_row`` differs between identical
    redeliveries and stays the same whenever the rows are read again.
    """
    from gridspark.session import scratch_path

    spark = m.sparkSession
    m = m.withColumn("m_row", F.monotonically_increasing_id())
    path, seen = scratch_path(spark, "messages"), Observation()
    m.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    # the comparison is always true; it tells the planner that this side selects
    return spark.read.schema(m.schema).parquet(path).filter("m_row >= 0"), int(seen.get["n"])


# --- hot files ------------------------------------------------------------------------------
# With the messages broadcast, every output row of a file is produced where its slab
# lines are. A file named by a large share of the messages (redeliveries, or one object
# everybody announces) would leave that work to the few tasks holding its lines, so
# such files are split into parts: their lines (or blocks) are copied once per part,
# each message joins exactly one part, and every (line, message) pair still meets once.
def hot_files(m: DataFrame, count: int, parallelism: int | None = None) -> DataFrame:
    """h_key, h_measure, copies: the files named by more than one task's fair share of the written
    messages, and how many shares they hold.

    The share is the message ``count`` divided by ``parallelism`` (default: the cluster's). Fewer than ``parallelism`` files can
    exceed it, so this frame has a proven bound and may be broadcast.
    """
    p = parallelism or m.sparkSession.sparkContext.defaultParallelism
    share = max(1, -(-count // p))
    counts = m.groupBy(F.col("m_key").alias("h_key"), F.col("m_measure").alias("h_measure")).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > share).select("h_key", "h_measure", F.ceil(F.col("n") / share).cast("int").alias("copies"))


def salted_messages(m: DataFrame, hot: DataFrame) -> DataFrame:
    """Written messages with ``m_part``: their row number's hash modulo the copies of the
    file they name (0 for other files). Identical redeliveries have different row numbers."""
    h = F.broadcast(hot)
    j = m.join(h, (m["m_key"] == h["h_key"]) & (m["m_measure"] == h["h_measure"]), "left")
    copies = F.coalesce("copies", F.lit(1)).cast("long")
    return j.select(*m.columns, F.pmod(F.xxhash64("m_row"), copies).cast("int").alias("m_part"))


def copy_rows(df: DataFrame, hot: DataFrame, key: str, measure: str) -> DataFrame:
    """Each row of a hot file repeated once for each part, with ``part`` 0..copies-1;
    other rows once with part 0."""
    h = F.broadcast(hot)
    j = df.join(h, (df[key] == h["h_key"]) & (df[measure] == h["h_measure"]), "left")
    n = F.coalesce("copies", F.lit(1))
    return j.select(*[F.col(c) for c in df.columns if c != "part"], F.explode(F.sequence(F.lit(0), n - 1)).alias("part"))


def join_messages(slabs: DataFrame, m: DataFrame) -> DataFrame:
    """Slab lines x salted messages on (file id, measure, part), the realization limit,
    and the long rows. ``slabs`` has ``part`` (``copy_rows``), ``m`` has ``m_part``.

    The planner broadcasts the messages within its size bound and shuffles both sides
    beyond it. The text rule is applied to the lines first, once, not to every copy.
    On a slab store partitioned by file bucket the bucket is part of the join, so the
    partitions that no message names are pruned at run time.
    """
    has_bucket = "file_bucket" in slabs.columns
    lines = converted_lines(first_level(slabs), "part", *(["file_bucket", "file_buckets"] if has_bucket else []))
    cond = (lines["file_name"] == m["m_key"]) & (lines["measure_name"] == m["m_measure"]) & (lines["part"] == m["m_part"])
    if has_bucket:
        from gridspark.sources.slab_store import file_bucket

        # the number of buckets is a constant of the plan, so this is a join key of the messages alone
        cond = cond & (lines["file_bucket"] == file_bucket("m_key", lines["file_buckets"]))
    j = lines.join(m, cond, "inner").filter(within_limit("r_limit")).drop("file_name", "part", "file_bucket", "file_buckets")
    return long_cells(j.withColumnRenamed("out_file_name", "file_name"))


def ingest(
    notifications: DataFrame,
    params: DataFrame,
    slabs: DataFrame,
    case_insensitive: bool = False,
    key: Column | None = None,
    first: int | None = None,
    parallelism: int | None = None,
) -> DataFrame:
    """Long rows for every matched message, read from the slabs of the file it names.

    The matched messages are written once; everything else is one lazy plan: the files
    named by more than a task's share of the messages are split into parts, slabs are
    cut down to the announced files, and the two sides meet in ``join_messages``.
    The level-0 reduction (P9) is a slab filter below the join; the realization limit
    (L1) needs each message's parameters and is applied right after it, before the
    unpivot. ``key`` maps a message to the slabs' ``file_name`` (default: the message
    key); ``first`` is the cap on matched messages (L3).
    """
    m, count = written_messages(matched_files(notifications, params, case_insensitive, key, first))
    hot = hot_files(m, count, parallelism)
    return join_messages(copy_rows(slabs, hot, "file_name", "measure_name"), salted_messages(m, hot))


def ingest_bodies(bodies: DataFrame, params: DataFrame, slabs: DataFrame, body_col: str = "body",
                  case_insensitive: bool = False) -> DataFrame:
    """``ingest`` from raw message bodies; unusable messages are skipped (see
    ``parse_notifications`` / ``rejected`` to keep them)."""
    return ingest(accepted(parse_notifications(bodies, body_col)), params, slabs, case_insensitive)
