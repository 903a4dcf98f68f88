"""Notification matching and naming."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.functions.text import basename, parse_param_string
from gridspark.schema import NOTIFICATION_FIELDS, PARAMS_SCHEMA
from gridspark.session import size_in_bytes


def params_frame(spark: SparkSession, params: Mapping[str, str] | Iterable[tuple]) -> DataFrame:
    """Extraction parameters -> ``params(name, measure, coord_y, coord_x, r_limit)``.

    Accepts the reference's map form ``{name: "measure,coordY,coordX,limit"}`` or rows
    ``(name, measure, coord_y, coord_x, r_limit)``.
    """
    if isinstance(params, Mapping):
        rows = []
        for name, text in params.items():
            m, cy, cx, lim = [s.strip() for s in text.split(",")]
            rows.append((name, m, cy, cx, int(lim)))
    else:
        rows = [tuple(r) for r in params]
    names = [r[0] for r in rows]
    if len(set(names)) < len(names):
        raise ValueError("parameter names must be unique")
    df = spark.createDataFrame(rows, PARAMS_SCHEMA)
    limit = size_in_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10m"))
    size = sum(64 + 4 * sum(len(str(v)) for v in r) for r in rows)
    return F.broadcast(df) if size <= limit else df  # rows from the driver carry no size of their own


def params_from_text(df: DataFrame, name_col: str, text_col: str, strict: bool = True) -> DataFrame:
    """F12 on a table of ``(name, "measure,coordY,coordX,limit")`` strings."""
    p = parse_param_string(text_col, strict=strict)
    return df.select(F.col(name_col).alias("name"), p["measure"].alias("measure"), p["coord_y"].alias("coord_y"),
                     p["coord_x"].alias("coord_x"), p["r_limit"].alias("r_limit"))


def name_equals_ci(value: str, col: str = "name") -> Column:
    """Full, case-insensitive equality (the reference's ``equalsIgnoreCase``)."""
    return F.lower(F.col(col)) == F.lower(F.lit(value))


def filter_name_ci(notifications: DataFrame, value: str) -> DataFrame:
    return notifications.filter(name_equals_ci(value))


def match_params(notifications: DataFrame, params: DataFrame, case_insensitive: bool = False) -> DataFrame:
    """J1 (exact name, the reference's map lookup) or J2 (case-insensitive).

    Inner join: unmatched messages drop out. ``params`` may have any size: it is broadcast
    within the session's size bound (``params_frame`` checks it, a table's own size is
    known to the planner), and both sides are shuffled beyond it. Names that
    are equal but for their case count once in J2 (the first in order, upper case first), so a message never
    fans out. Output: notification fields + measure, coord_y, coord_x, r_limit.
    """
    p = params.select(F.col("name").alias("p_name"), "measure", "coord_y", "coord_x", "r_limit")
    if case_insensitive:
        first = F.min(F.struct("p_name", "measure", "coord_y", "coord_x", "r_limit")).alias("p")
        p = p.groupBy(F.lower("p_name").alias("l")).agg(first).select("p.*")
        cond = F.lower(F.col("name")) == F.lower(F.col("p_name"))
    else:
        cond = F.col("name") == F.col("p_name")
    return notifications.join(p, cond, "inner").drop("p_name")


def is_wanted(notifications: DataFrame, params: DataFrame) -> DataFrame:
    """P3 alone: keep messages whose name has parameters (a semi join)."""
    return notifications.join(params.select("name"), "name", "left_semi")


def file_name_col() -> Column:
    """``name_createdTime_file``, the name under which the reference stores the file;
    of a key with folders only the last part is used (F7)."""
    return F.concat_ws("_", F.col("name"), F.col("created_time"), basename("key"))


def file_path_col(base_dir: str) -> Column:
    """P5: the stored file's path under ``base_dir``."""
    return F.concat(F.lit(base_dir.rstrip("/")), F.lit("/"), file_name_col())


def object_uri_col(base_uri: str | None = None) -> Column:
    """S3: where the announced object is read from. ``base_uri`` fixes the store
    location; by default the message's own bucket is used."""
    if base_uri is None:
        return F.concat(F.lit("s3a://"), F.col("bucket"), F.lit("/"), F.col("key"))
    return F.concat(F.lit(base_uri.rstrip("/")), F.lit("/"), F.col("key"))


def with_file_names(notifications: DataFrame, base_dir: str, base_uri: str | None = None) -> DataFrame:
    return notifications.select(
        *NOTIFICATION_FIELDS,
        file_name_col().alias("file_name"),
        file_path_col(base_dir).alias("file_path"),
        object_uri_col(base_uri).alias("object_uri"),
        basename(object_uri_col(base_uri)).alias("object_name"),
    )


def arrival_order() -> list[Column]:
    """Deterministic processing order for capped batches: arrival time, then the rest."""
    return [F.col("created_time"), F.col("key"), F.col("name"), F.col("bucket"), F.col("forecast_reference_time")]


def cap(notifications: DataFrame, n: int) -> DataFrame:
    """L2/L3: the first ``n`` messages of a bounded batch in arrival order
    (a top-k, planned as TakeOrderedAndProject: per-partition top-n, then a merge)."""
    return notifications.orderBy(*arrival_order()).limit(n)


def matched_cap(notifications: DataFrame, params: DataFrame, n: int, case_insensitive: bool = False) -> DataFrame:
    """L3: the first ``n`` messages in arrival order that match a parameter set; messages
    that match none do not count."""
    return match_params(notifications, params, case_insensitive).orderBy(*arrival_order()).limit(n)


def matched_count(notifications: DataFrame, params: DataFrame, case_insensitive: bool = False) -> DataFrame:
    """A2: number of messages that matched a parameter set."""
    return match_params(notifications, params, case_insensitive).agg(F.count(F.lit(1)).alias("n_matched"))
