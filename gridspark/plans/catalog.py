"""Registered queries over the provided tables, each paired with an equivalent SQL text.

Every query reads whole tables (``orders``, ``events``, ...) through the stand-ins of
``gridspark.sources.tables`` and runs the engine's operators on them. The SQL next to
each query computes the same result straight from the flat tables, without arrays, so
the two paths are independent.

Measure values are compared at float32: the engine keeps the value as the JVM prints
the float (``414368.12``), while other engines print some floats differently
(``414368.125``); both denote the same float32, so the compared column is
``CAST(CAST(measure_value AS FLOAT) AS DOUBLE)`` on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.functions.text import widened
from gridspark.operators import match as M
from gridspark.operators import unpivot as U
from gridspark.functions.messages import accepted, build_body, parse_notifications
from gridspark.plans.ingest import ingest
from gridspark.schema import NOTIFICATION_FIELDS
from gridspark.session import size_shuffles
from gridspark.sources.tables import notification_fields, notifications_from_events, orders_grid

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    size_shuffles(spark, path)
    return spark.read.parquet(path)


# --- fixed fixture parameters -------------------------------------------------------
# Grid G: 2 realizations x 25 y x 100 x cells per file. Flagship grid: 2 x 5 x 15, and
# 100 consecutive events announce one flagship file, so both sides have the same number
# of keys at every scale factor.
G_R, G_Y, G_X = 2, 25, 100
I_R, I_Y, I_X = 2, 5, 15
PER_KEY = 100
MEASURE = "o_totalprice"
# The extraction parameters of the flagship (name -> measure, y and x
# coordinate variable names, realization limit).
INGEST_PARAMS = [
    ("click", MEASURE, "projection_y_coordinate", "projection_x_coordinate", 1),
    ("purchase", MEASURE, "projection_y_coordinate", "projection_x_coordinate", -1),
]


def compared(long_df: DataFrame) -> DataFrame:
    return long_df.withColumn("measure_value", widened("measure_value"))


def grid_g(spark, sf_dir, four_d=False, value=MEASURE, measure=None):
    return orders_grid(table(spark, sf_dir, "orders"), G_R, G_Y, G_X, "g_", value, measure, four_d)


def notifications(spark, sf_dir, escape_names=False):
    bodies = notifications_from_events(table(spark, sf_dir, "events"), PER_KEY, "g_", escape_names)
    return accepted(parse_notifications(bodies))


# --- SQL fragments --------------------------------------------------------------------
def _cells_sql(r: int, y: int, x: int, value: str = "o_totalprice") -> str:
    per_file, per_r = r * y * x, y * x
    return f"""
SELECT 'g_' || CAST(o_orderkey // {per_file} AS VARCHAR) || '.nc' AS file_name,
       CAST((o_orderkey % {per_file}) // {per_r} AS INTEGER) AS r,
       CAST((o_orderkey % {per_r}) // {x} AS INTEGER) AS y,
       CAST(o_orderkey % {x} AS INTEGER) AS x,
       CAST(CAST({value} AS FLOAT) AS DOUBLE) AS v,
       CAST(max(epoch_ms(o_orderdate) // 1000) OVER (PARTITION BY o_orderkey // {per_file}) AS DOUBLE) AS t_max,
       CAST(min(epoch_ms(o_orderdate) // 1000) OVER (PARTITION BY o_orderkey // {per_file}) AS DOUBLE) AS t_min
FROM orders"""


def _long_sql(cells_alias: str, measure: str, file_name: str | None = None) -> str:
    c = cells_alias
    return f"""{file_name or c + '.file_name'} AS file_name,
       CAST({c}.y * 2000 AS DOUBLE) AS y_coord,
       CAST({c}.x * 2000 AS DOUBLE) AS x_coord,
       {c}.t_min AS forecast,
       {c}.t_max AS time,
       '{measure}' AS measure_name,
       {c}.v AS measure_value"""


_ISO = "%Y-%m-%dT%H:%M:%SZ"
_NOTIF_SQL = f"""
SELECT 'b' || CAST(user_id AS VARCHAR) AS bucket,
       event_type AS name,
       'g_' || CAST(event_id // {PER_KEY} AS VARCHAR) || '.nc' AS key,
       strftime(ts, '{_ISO}') AS created_time,
       strftime(date_trunc('day', ts), '{_ISO}') AS forecast_reference_time
FROM events"""

_PARAMS_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"('{n}', '{m}', '{cy}', '{cx}', {lim})" for n, m, cy, cx, lim in INGEST_PARAMS
) + ") AS p(name, measure, coord_y, coord_x, r_limit)"


# --- grid operators ---------------------------------------------------------------------
@register(
    "grid_unpivot",
    f"SELECT {_long_sql('c', MEASURE)} FROM ({_cells_sql(G_R, G_Y, G_X)}) c",
)
def grid_unpivot(spark, sf_dir):
    """Every cell of every file as a long row."""
    return compared(U.to_long(grid_g(spark, sf_dir)))


# --- flagship ---------------------------------------------------------------------------
INGEST_SQL = f"""
WITH n AS ({_NOTIF_SQL}),
p AS ({_PARAMS_SQL}),
c AS ({_cells_sql(I_R, I_Y, I_X)})
SELECT {_long_sql('c', MEASURE, "n.name || '_' || n.created_time || '_' || n.key")}
FROM n JOIN p ON n.name = p.name
       JOIN c ON c.file_name = n.key AND p.measure = '{MEASURE}'
WHERE p.r_limit < 0 OR c.r < p.r_limit"""


def ingest_grid(spark, sf_dir):
    return orders_grid(table(spark, sf_dir, "orders"), I_R, I_Y, I_X, "g_", MEASURE)


@register("ingest", INGEST_SQL)
def ingest_query(spark, sf_dir):
    """Flagship: message bodies -> matched parameters -> announced grids -> long rows."""
    params = M.params_frame(spark, INGEST_PARAMS)
    return compared(ingest(notifications(spark, sf_dir), params, ingest_grid(spark, sf_dir)))


# --- notifications --------------------------------------------------------------------
@register("notify_parse", _NOTIF_SQL)
def notify_parse(spark, sf_dir):
    """Envelope -> message -> five fields."""
    return notifications(spark, sf_dir)


@register("notify_escape_strip", _NOTIF_SQL)
def notify_escape_strip(spark, sf_dir):
    """names carry a backslash, which the message JSON escapes as a pair; stripping
    the pairs restores the plain names."""
    return notifications(spark, sf_dir, escape_names=True)


@register("notify_filter_ci", f"SELECT * FROM ({_NOTIF_SQL}) n WHERE lower(n.name) = 'click'")
def notify_filter_ci(spark, sf_dir):
    """Full, case-insensitive name equality against ``'CLICK'``."""
    return M.filter_name_ci(notifications(spark, sf_dir), "CLICK")


_MATCH_COLS = "n.bucket, n.name, n.key, n.created_time, n.forecast_reference_time, p.measure, p.coord_y, p.coord_x, p.r_limit"


@register("notify_param_join", f"""
WITH n AS ({_NOTIF_SQL}), p AS ({_PARAMS_SQL})
SELECT {_MATCH_COLS} FROM n JOIN p ON n.name = p.name""")
def notify_param_join(spark, sf_dir):
    """Exact-name lookup of the extraction parameters."""
    return M.match_params(notifications(spark, sf_dir), M.params_frame(spark, INGEST_PARAMS))


# The same parameters with names in other letter cases.
CI_PARAMS = [("CLICK",) + INGEST_PARAMS[0][1:], ("Purchase",) + INGEST_PARAMS[1][1:]]
_CI_PARAMS_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"('{n}', '{m}', '{cy}', '{cx}', {lim})" for n, m, cy, cx, lim in CI_PARAMS
) + ") AS p(name, measure, coord_y, coord_x, r_limit)"


@register("notify_param_join_ci", f"""
WITH n AS ({_NOTIF_SQL}), p AS ({_CI_PARAMS_SQL})
SELECT {_MATCH_COLS} FROM n JOIN p ON lower(n.name) = lower(p.name)""")
def notify_param_join_ci(spark, sf_dir):
    """Case-insensitive parameter lookup."""
    return M.match_params(notifications(spark, sf_dir), M.params_frame(spark, CI_PARAMS), case_insensitive=True)


BASE_DIR = "/data/grids"


@register("file_name_path", f"""
SELECT n.*, n.name || '_' || n.created_time || '_' || n.key AS file_name,
       '{BASE_DIR}/' || n.name || '_' || n.created_time || '_' || n.key AS file_path,
       's3a://' || n.bucket || '/' || n.key AS object_uri,
       n.key AS object_name
FROM ({_NOTIF_SQL}) n""")
def file_name_path(spark, sf_dir):
    """Stored file name, its path, the object URI and its base name."""
    return M.with_file_names(notifications(spark, sf_dir), BASE_DIR)


CAP = 5


@register("notify_cap", f"""
SELECT * FROM ({_NOTIF_SQL}) n
ORDER BY created_time, key, name, bucket, forecast_reference_time LIMIT {CAP}""")
def notify_cap(spark, sf_dir):
    """L2, L3: the first messages of the batch in arrival order."""
    return M.cap(notifications(spark, sf_dir), CAP)


@register("matched_count", f"""
WITH n AS ({_NOTIF_SQL}), p AS ({_PARAMS_SQL})
SELECT count(*) AS n_matched FROM n JOIN p ON n.name = p.name""")
def matched_count_query(spark, sf_dir):
    """A2: how many messages matched a parameter set."""
    return M.matched_count(notifications(spark, sf_dir), M.params_frame(spark, INGEST_PARAMS))


@register("params_parse", """
SELECT n_name AS name, lower(n_name) AS measure, 'projection_y_coordinate' AS coord_y,
       'projection_x_coordinate' AS coord_x, n_regionkey - 1 AS r_limit
FROM nation""")
def params_parse(spark, sf_dir):
    """``"measure,coordY,coordX,limit"`` strings -> typed parameter rows."""
    nation = table(spark, sf_dir, "nation")
    text = F.concat_ws(",", F.lower("n_name"), F.lit("projection_y_coordinate"),
                       F.lit("projection_x_coordinate"), (F.col("n_regionkey") - 1).cast("string"))
    return M.params_from_text(nation.select("n_name", text.alias("p")), "n_name", "p")


# Realization limits given to files in turn (1, all, beyond size, none).
FILE_LIMITS = (1, -1, 9, 0)


@register("grid_limit", f"""
SELECT {_long_sql('c', MEASURE)} FROM (
  SELECT *, CASE CAST(regexp_extract(file_name, 'g_([0-9]+)', 1) AS BIGINT) % {len(FILE_LIMITS)}
    {' '.join(f'WHEN {i} THEN {v}' for i, v in enumerate(FILE_LIMITS))} END AS r_limit
  FROM ({_cells_sql(G_R, G_Y, G_X)})) c
WHERE c.r_limit < 0 OR c.r < c.r_limit""")
def grid_limit(spark, sf_dir):
    """L1: per-file realization limits 1, -1 (all), 9 (beyond size) and 0."""
    slabs = grid_g(spark, sf_dir)
    file_no = F.regexp_extract("file_name", r"g_([0-9]+)", 1).cast("long")
    limits = F.array(*[F.lit(v) for v in FILE_LIMITS])
    slabs = slabs.withColumn("r_limit", F.element_at(limits, (file_no % len(FILE_LIMITS) + 1).cast("int")))
    return compared(U.to_long(slabs.filter(U.within_limit("r_limit"))))


@register("grid_rank4", f"SELECT {_long_sql('c', MEASURE)} FROM ({_cells_sql(G_R, G_Y, G_X)}) c WHERE c.y % 2 = 0")
def grid_rank4(spark, sf_dir):
    """A 4-D measure reduced to its level-0 slabs."""
    return compared(U.to_long(U.first_level(grid_g(spark, sf_dir, four_d=True))))


@register("grid_indexed", f"""
SELECT {_long_sql('c', MEASURE)}, c.r, c.y, c.x, CAST((c.r * {G_Y} + c.y) * {G_X} + c.x AS BIGINT) AS cnt
FROM ({_cells_sql(G_R, G_Y, G_X)}) c""")
def grid_indexed(spark, sf_dir):
    """The long rows with their realization, y, x and running cell number."""
    return compared(U.to_long_indexed(grid_g(spark, sf_dir)))


@register("grid_wide", f"""
SELECT CAST(CAST(c.y * 2000 AS FLOAT) AS VARCHAR) AS y_coord,
       CAST(CAST(c.x * 2000 AS FLOAT) AS VARCHAR) AS x_coord,
       CAST(CAST(c.t_max AS BIGINT) AS VARCHAR) AS time,
       CAST(CAST(c.t_min AS BIGINT) AS VARCHAR) AS forecast,
       c.v AS {MEASURE}
FROM ({_cells_sql(G_R, G_Y, G_X)}) c""")
def grid_wide(spark, sf_dir):
    """Wide cells as text, the measure name as the column name (the value is
    compared at float32, see the module notes)."""
    w = U.wide_from_slabs(grid_g(spark, sf_dir), MEASURE)
    return w.withColumn(MEASURE, widened(MEASURE))


SECOND = "o_custkey"


@register("grid_union", f"""
SELECT {_long_sql('c', MEASURE)} FROM ({_cells_sql(G_R, G_Y, G_X)}) c
UNION ALL
SELECT {_long_sql('c', SECOND)} FROM ({_cells_sql(G_R, G_Y, G_X, SECOND)}) c""")
def grid_union(spark, sf_dir):
    """Two measures' grids in one long row set, duplicates kept."""
    a = grid_g(spark, sf_dir)
    b = grid_g(spark, sf_dir, value=SECOND)
    return compared(U.to_long(a.unionByName(b)))


@register("grid_describe", f"""
SELECT c.file_name, '{MEASURE}' AS measure_name, max(c.r) + 1 AS n_r, 1 AS n_level, max(c.y) + 1 AS n_y,
       max(c.x) + 1 AS n_x, CAST(max(c.t_max) AS BIGINT) AS time, CAST(min(c.t_min) AS BIGINT) AS forecast
FROM ({_cells_sql(G_R, G_Y, G_X)}) c GROUP BY c.file_name""")
def grid_describe(spark, sf_dir):
    """S7 on slabs: the dimension lengths and scalars of every file."""
    from gridspark.operators.describe import describe_slabs

    return describe_slabs(grid_g(spark, sf_dir))


@register("grid_count", f"""
SELECT c.file_name, count(*) AS n_rows FROM ({_cells_sql(G_R, G_Y, G_X)}) c GROUP BY c.file_name""")
def grid_count(spark, sf_dir):
    """A1: long-row count per file, computed from the slabs without unpivoting."""
    return U.cell_count(grid_g(spark, sf_dir))


PREVIEW = 20


@register("grid_preview", f"""
SELECT {_long_sql('c', MEASURE)}, c.r, c.y, c.x, CAST((c.r * {G_Y} + c.y) * {G_X} + c.x AS BIGINT) AS cnt
FROM ({_cells_sql(G_R, G_Y, G_X)}) c ORDER BY file_name, cnt LIMIT {PREVIEW}""")
def grid_preview(spark, sf_dir):
    """The first cells in read order (a top-k, not a full sort)."""
    return compared(U.to_long_indexed(grid_g(spark, sf_dir)).orderBy("file_name", "cnt").limit(PREVIEW))


@register("row_text_decode", """
SELECT s_name AS file_name, CAST(s_suppkey AS DOUBLE) AS y_coord, CAST(s_nationkey AS DOUBLE) AS x_coord,
       CAST(s_suppkey AS DOUBLE) / 4 AS forecast, s_acctbal AS time, 's_acctbal' AS measure_name,
       s_acctbal AS measure_value
FROM supplier""")
def row_text_decode(spark, sf_dir):
    """typed rows -> comma-joined text -> typed rows again."""
    from gridspark.functions.text import decode_long_row, join_fields

    s = table(spark, sf_dir, "supplier")
    text = join_fields(
        F.col("s_name"),
        F.col("s_suppkey").cast("double"),
        F.col("s_nationkey").cast("double"),
        F.col("s_acctbal"),
        F.col("s_suppkey").cast("double") / 4,
        F.lit("s_acctbal"),
        F.col("s_acctbal"),
    )
    return s.select(text.alias("row")).select(*decode_long_row("row"))


def _reject_bodies(events: DataFrame, *keep: str) -> DataFrame:
    """Message bodies where some event types arrive damaged: no envelope field, cut
    inner JSON, or a missing ``key``; with the columns ``keep``."""
    f = notification_fields(events, PER_KEY, "g_")
    inner = F.to_json(F.struct(*[c.alias(n) for c, n in zip(f, NOTIFICATION_FIELDS)]))
    no_key = F.to_json(F.struct(*[c.alias(n) for c, n in zip(f, NOTIFICATION_FIELDS) if n != "key"]))
    et = F.col("event_type")
    body = (
        F.when(et == "error", F.to_json(F.struct(inner.alias("Msg"))))
        .when(et == "signup", F.to_json(F.struct(F.expr("substring(m, 1, length(m) - 1)").alias("Message"))))
        .when(et == "view", F.to_json(F.struct(no_key.alias("Message"))))
        .otherwise(build_body(*f))
    )
    return events.withColumn("m", inner).select(*keep, body.alias("body"))


@register("notify_rejects", """
SELECT CASE event_type WHEN 'error' THEN 'no Message in envelope'
                       WHEN 'signup' THEN 'malformed Message'
                       WHEN 'view' THEN 'missing field: key' END AS reject_reason,
       count(*) AS n
FROM events GROUP BY 1""")
def notify_rejects(spark, sf_dir):
    """P1 rejects: damaged messages are kept aside with a reason instead of failing."""
    parsed = parse_notifications(_reject_bodies(table(spark, sf_dir, "events")))
    return parsed.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


# --- grid files ------------------------------------------------------------------------------
Y_NAME, X_NAME = "projection_y_coordinate", "projection_x_coordinate"


def g_files(spark, sf_dir, base=None, **kw):
    """G written as classic NetCDF files into a new folder under the shared folder."""
    from gridspark.session import scratch_path
    from gridspark.sources.tables import write_orders_grid_files

    return write_orders_grid_files(table(spark, sf_dir, "orders"), base or scratch_path(spark, "orders-grid"),
                                   G_R, G_Y, G_X, "g_", MEASURE, **kw)


def _scan_long(requests):
    from gridspark.sources.gridfile import good_slabs, scan_grid

    return compared(U.to_long(good_slabs(scan_grid(requests))))


@register("grid_file_scan", ORACLE["grid_unpivot"])
def grid_file_scan(spark, sf_dir):
    """S4, S5, P6, P7, UD1: classic files (CDF-5, int64 times) read slab-block by block."""
    from gridspark.sources.gridfile import requests_for_files

    return _scan_long(requests_for_files(g_files(spark, sf_dir), MEASURE, Y_NAME, X_NAME, -1))


@register("grid_file_scan_content", ORACLE["grid_unpivot"])
def grid_file_scan_content(spark, sf_dir):
    """S4 content mode: files read whole through Spark's binaryFile source."""
    from gridspark.sources.gridfile import good_slabs, scan_contents

    from gridspark.session import scratch_path

    base = scratch_path(spark, "orders-grid")
    g_files(spark, sf_dir, base=base)
    binary = spark.read.format("binaryFile").option("pathGlobFilter", "*.nc").load(f"{base}/files")
    return compared(U.to_long(good_slabs(scan_contents(binary, MEASURE, Y_NAME, X_NAME, -1))))


@register("grid_file_rank4", ORACLE["grid_unpivot"])
def grid_file_rank4(spark, sf_dir):
    """P9 on files: a 4-D measure (realization, height, y, x) read at height index 0."""
    from gridspark.sources.gridfile import requests_for_files

    return _scan_long(requests_for_files(g_files(spark, sf_dir, four_d=True), MEASURE, Y_NAME, X_NAME, -1))


@register("grid_file_record", ORACLE["grid_unpivot"])
def grid_file_record(spark, sf_dir):
    """Files with the realization as the record (unlimited) dimension, CDF-2 layout and
    double-typed times: record-strided reads."""
    from gridspark.sources.gridfile import requests_for_files

    files = g_files(spark, sf_dir, version=2, record_realization=True)
    return _scan_long(requests_for_files(files, MEASURE, Y_NAME, X_NAME, -1))


@register("grid_file_limit", ORACLE["grid_limit"])
def grid_file_limit(spark, sf_dir):
    """L1 on files: the limit bounds the slab plan, so skipped realizations are never read."""
    from gridspark.sources.gridfile import requests_for_files

    req = requests_for_files(g_files(spark, sf_dir), MEASURE, Y_NAME, X_NAME, -1)
    file_no = F.regexp_extract("file_name", r"g_([0-9]+)", 1).cast("long")
    limits = F.array(*[F.lit(v) for v in FILE_LIMITS])
    req = req.withColumn("r_limit", F.element_at(limits, (file_no % len(FILE_LIMITS) + 1).cast("int")))
    return _scan_long(req)


def _describe_sql() -> str:
    per_file = G_R * G_Y * G_X
    f = f"""(SELECT 'g_' || CAST(o_orderkey // {per_file} AS VARCHAR) || '.nc' AS file_name,
                max((o_orderkey % {per_file}) // {G_Y * G_X}) + 1 AS nr, count(*) AS n FROM orders GROUP BY 1)"""
    ny = f"CASE WHEN nr > 1 THEN {G_Y} ELSE n // {G_X} END"
    rows = [
        ("dimension", "'realization'", "NULL", "NULL", "CAST(nr AS VARCHAR)"),
        ("dimension", f"'{Y_NAME}'", "NULL", "NULL", f"CAST({ny} AS VARCHAR)"),
        ("dimension", f"'{X_NAME}'", "NULL", "NULL", f"'{G_X}'"),
        ("variable", "'realization'", "'int'", "'realization'", "CAST(nr AS VARCHAR)"),
        ("variable", f"'{Y_NAME}'", "'float'", f"'{Y_NAME}'", f"CAST({ny} AS VARCHAR)"),
        ("variable", f"'{X_NAME}'", "'float'", f"'{X_NAME}'", f"'{G_X}'"),
        ("variable", "'time'", "'int64'", "''", "''"),
        ("variable", "'forecast_reference_time'", "'int64'", "''", "''"),
        ("variable", f"'{MEASURE}'", "'float'", f"'realization,{Y_NAME},{X_NAME}'",
         f"CAST(nr AS VARCHAR) || ',' || CAST({ny} AS VARCHAR) || ',{G_X}'"),
    ]
    return "\nUNION ALL\n".join(
        f"SELECT file_name, '{k}' AS kind, {n} AS name, {t} AS type, {d} AS dims, {s} AS shape, false AS is_record FROM {f}"
        for k, n, t, d, s in rows
    )


@register("grid_file_describe", _describe_sql())
def grid_file_describe(spark, sf_dir):
    """Dimensions and variables of every file, from header-only reads."""
    from gridspark.functions.text import basename
    from gridspark.sources.gridfile import describe_files

    d = describe_files(g_files(spark, sf_dir))
    return d.select(
        basename("path").alias("file_name"), "kind", "name", "type",
        F.array_join("dims", ",").alias("dims"),
        F.array_join(F.col("shape").cast("array<string>"), ",").alias("shape"),
        "is_record",
    )


@register("ingest_files", INGEST_SQL)
def ingest_files_query(spark, sf_dir):
    """Flagship on files: messages -> parameters -> announced NetCDF objects read by
    ranged slab reads -> long rows."""
    from gridspark.plans.files import ingest_files
    from gridspark.session import scratch_path
    from gridspark.sources.tables import write_orders_grid_files

    base = scratch_path(spark, "ingest-grid")
    write_orders_grid_files(table(spark, sf_dir, "orders"), base, I_R, I_Y, I_X, "g_", MEASURE)
    params = M.params_frame(spark, INGEST_PARAMS)
    return compared(ingest_files(notifications(spark, sf_dir), params, base_uri=f"{base}/files"))


# --- sinks ---------------------------------------------------------------------------------------
ROLL = 1000


@register("sink_json_roundtrip", ORACLE["grid_unpivot"])
def sink_json_roundtrip(spark, sf_dir):
    """Long rows written as JSON lines rolled every 1,000 rows, read back."""
    from gridspark.session import scratch_path
    from gridspark.sinks.writers import read_long_json, write_json

    path = scratch_path(spark, "json-long")
    write_json(U.to_long(grid_g(spark, sf_dir)), path, max_records_per_file=ROLL)
    return compared(read_long_json(spark, path))


@register("sink_json_wide", ORACLE["grid_wide"])
def sink_json_wide(spark, sf_dir):
    """The reference's JSON cell objects (all values text), read back."""
    from pyspark.sql import types as T

    from gridspark.session import scratch_path
    from gridspark.sinks.writers import write_json

    path = scratch_path(spark, "json-wide")
    write_json(U.wide_from_slabs(grid_g(spark, sf_dir), MEASURE), path, max_records_per_file=ROLL)
    cols = ["y_coord", "x_coord", "time", "forecast", MEASURE]
    back = spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in cols])).json(path)
    return back.withColumn(MEASURE, widened(MEASURE))


# --- streaming -------------------------------------------------------------------------------------
STREAM_FILES = 8
FILES_PER_TRIGGER = 2


def _run_stream(spark, sf_dir, base, process):
    """Write the message bodies of ``events`` as ``STREAM_FILES`` inbox files, drain them
    with an availableNow stream, and return what the sink wrote."""
    from pyspark.sql import types as T

    from gridspark.schema import LONG_SCHEMA
    from gridspark.streaming.ingest_stream import notification_stream, parquet_sink, parsed_stream, start_ingest

    events = table(spark, sf_dir, "events")
    inbox, out = f"{base}/inbox", f"{base}/out"
    bodies = events.repartitionByRange(STREAM_FILES, "event_id").select(
        build_body(*notification_fields(events, PER_KEY, "g_")).alias("value"))
    bodies.write.text(inbox)
    stream = parsed_stream(notification_stream(spark, inbox, FILES_PER_TRIGGER))

    def wanted(batch):
        return M.is_wanted(batch, M.params_frame(batch.sparkSession, INGEST_PARAMS))

    q = start_ingest(stream, process, parquet_sink(out), f"{base}/checkpoint", dead_letters=parquet_sink(f"{base}/dead"), wanted=wanted)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.schema(T.StructType([*LONG_SCHEMA.fields, T.StructField("batch_id", T.LongType())])).parquet(out).drop("batch_id")


@register("ingest_stream", INGEST_SQL)
def ingest_stream_query(spark, sf_dir):
    """ST1-ST5: the flagship as a checkpointed file-source stream (availableNow), slabs
    from a stored slab table; equals the batch result."""
    from gridspark.session import scratch_path
    from gridspark.sources.slab_store import read_slab_store, store_slabs

    base = scratch_path(spark, "ingest-stream")
    slab_path = f"{base}/slabs"
    store_slabs(ingest_grid(spark, sf_dir), slab_path)

    def process(batch):
        s = batch.sparkSession
        return ingest(batch, M.params_frame(s, INGEST_PARAMS), read_slab_store(s, slab_path))

    return compared(_run_stream(spark, sf_dir, base, process))


@register("ingest_stream_files", INGEST_SQL)
def ingest_stream_files(spark, sf_dir):
    """ST1-ST5 over NetCDF objects: each micro-batch reads only the files it announces."""
    from gridspark.plans.files import ingest_files_and_rejects
    from gridspark.session import scratch_path
    from gridspark.sources.tables import write_orders_grid_files

    base = scratch_path(spark, "ingest-stream-files")
    write_orders_grid_files(table(spark, sf_dir, "orders"), f"{base}/grid", I_R, I_Y, I_X, "g_", MEASURE)

    def process(batch):
        s = batch.sparkSession
        return ingest_files_and_rejects(batch, M.params_frame(s, INGEST_PARAMS), base_uri=f"{base}/grid/files")

    return compared(_run_stream(spark, sf_dir, base, process))


# --- a hot object ------------------------------------------------------------------------------------
# Fixed value: every third event announces this one object, so a third of all messages
# name the same file.
HOT_KEY = "g_0.nc"

_HOT_NOTIF_SQL = _NOTIF_SQL.replace(
    f"'g_' || CAST(event_id // {PER_KEY} AS VARCHAR) || '.nc' AS key",
    f"CASE WHEN event_id % 3 = 0 THEN '{HOT_KEY}' ELSE 'g_' || CAST(event_id // {PER_KEY} AS VARCHAR) || '.nc' END AS key",
)
INGEST_HOT_SQL = INGEST_SQL.replace(_NOTIF_SQL, _HOT_NOTIF_SQL)


def hot_notifications(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    f = notification_fields(events, PER_KEY, "g_")
    f[2] = F.when(F.col("event_id") % 3 == 0, F.lit(HOT_KEY)).otherwise(f[2])
    return accepted(parse_notifications(events.select(build_body(*f).alias("body"))))


@register("ingest_hot_key", INGEST_HOT_SQL)
def ingest_hot_key(spark, sf_dir):
    """The file flagship when one object is announced by a third of all messages: it is
    read once, and its fan-out to messages is the size-checked join."""
    from gridspark.plans.files import ingest_files
    from gridspark.session import scratch_path
    from gridspark.sources.tables import write_orders_grid_files

    base = scratch_path(spark, "ingest-hot")
    write_orders_grid_files(table(spark, sf_dir, "orders"), base, I_R, I_Y, I_X, "g_", MEASURE)
    params = M.params_frame(spark, INGEST_PARAMS)
    return compared(ingest_files(hot_notifications(spark, sf_dir), params, base_uri=f"{base}/files"))


# --- identical redeliveries --------------------------------------------------------------------------
# The message that every third event delivers again, byte for byte.
AGAIN = ("b0", "click", HOT_KEY, "2024-01-01T00:00:00Z", "2024-01-01T00:00:00Z")
_AGAIN_SQL = "SELECT " + ", ".join(
    f"CASE WHEN event_id % 3 = 0 THEN '{v}' ELSE {expr} END AS {name}" for v, (expr, name) in zip(AGAIN, [
        ("'b' || CAST(user_id AS VARCHAR)", "bucket"), ("event_type", "name"),
        (f"'g_' || CAST(event_id // {PER_KEY} AS VARCHAR) || '.nc'", "key"), (f"strftime(ts, '{_ISO}')", "created_time"),
        (f"strftime(date_trunc('day', ts), '{_ISO}')", "forecast_reference_time")])) + " FROM events"


def redelivered_notifications(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    f = [F.when(F.col("event_id") % 3 == 0, F.lit(v)).otherwise(c) for v, c in zip(AGAIN, notification_fields(events, PER_KEY, "g_"))]
    return accepted(parse_notifications(events.select(build_body(*f).alias("body"))))


@register("ingest_redelivered", INGEST_SQL.replace(_NOTIF_SQL, _AGAIN_SQL))
def ingest_redelivered(spark, sf_dir):
    """The flagship when a third of all messages are byte-identical: they are split by row."""
    return compared(ingest(redelivered_notifications(spark, sf_dir), M.params_frame(spark, INGEST_PARAMS), ingest_grid(spark, sf_dir)))


# --- files: rejects, axes, folders, one message ----------------------------------------------------------
def _ingest_files_base(spark, sf_dir, name):
    from gridspark.session import scratch_path
    from gridspark.sources.tables import write_orders_grid_files

    base = scratch_path(spark, name)
    write_orders_grid_files(table(spark, sf_dir, "orders"), base, I_R, I_Y, I_X, "g_", MEASURE)
    return base


LOST = 10


@register("ingest_files_rejects", f"""
WITH n AS ({_NOTIF_SQL.replace("SELECT 'b'", "SELECT event_id, 'b'")}), p AS ({_PARAMS_SQL})
SELECT n.bucket, n.name, 'lost_' || n.key AS key, n.created_time, n.forecast_reference_time, 'FileNotFoundError' AS error
FROM n JOIN p ON n.name = p.name WHERE n.event_id % {LOST} = 0""")
def ingest_files_rejects(spark, sf_dir):
    """UD4: the messages whose object does not exist, given back with the reason."""
    from gridspark.plans.files import ingest_files_and_rejects

    base = _ingest_files_base(spark, sf_dir, "ingest-rejects")
    events = table(spark, sf_dir, "events")
    f = notification_fields(events, PER_KEY, "g_")
    f[2] = F.when(F.col("event_id") % LOST == 0, F.concat(F.lit("lost_"), f[2])).otherwise(f[2])
    n = accepted(parse_notifications(events.select(build_body(*f).alias("body"))))
    _, rejects = ingest_files_and_rejects(n, M.params_frame(spark, INGEST_PARAMS), base_uri=f"{base}/files")
    return rejects.withColumn("error", F.substring_index("error", ":", 1))


# Parameters for one measure whose axis names differ in case, and one whose axis is wrong.
AXES_PARAMS = [INGEST_PARAMS[0], ("purchase", MEASURE, Y_NAME.upper(), X_NAME.title(), -1), ("view", MEASURE, "latitude", X_NAME, -1)]


@register("ingest_files_axes", INGEST_SQL)
def ingest_files_axes(spark, sf_dir):
    """P7 in the ingest: axes equal but for their case make one request; messages with a
    wrong axis get no rows."""
    from gridspark.plans.files import ingest_files_and_rejects

    base = _ingest_files_base(spark, sf_dir, "ingest-axes")
    rows, _ = ingest_files_and_rejects(notifications(spark, sf_dir), M.params_frame(spark, AXES_PARAMS), base_uri=f"{base}/files")
    return compared(rows)


@register("ingest_nested_keys", INGEST_SQL)
def ingest_nested_keys(spark, sf_dir):
    """Keys with folders; the stored name has the last part only."""
    from gridspark.plans.files import ingest_files

    base = _ingest_files_base(spark, sf_dir, "ingest-nested")
    n = notifications(spark, sf_dir).withColumn("key", F.concat(F.lit("files/"), F.col("key")))
    return compared(ingest_files(n, M.params_frame(spark, INGEST_PARAMS), base_uri=base))


_FIRST_SQL = "ORDER BY created_time, key, name, bucket, forecast_reference_time LIMIT 1"


@register("ingest_one_file", f"""
WITH n AS (SELECT * FROM ({_NOTIF_SQL}) n WHERE lower(n.name) = 'purchase' {_FIRST_SQL}),
c AS ({_cells_sql(I_R, I_Y, I_X)})
SELECT {_long_sql('c', MEASURE, "n.name || '_' || n.created_time || '_' || n.key")}
FROM n JOIN c ON c.file_name = n.key""")
def ingest_one_file(spark, sf_dir):
    """One message, its name compared regardless of case, one file."""
    from gridspark.plans.files import ingest_one

    base = _ingest_files_base(spark, sf_dir, "ingest-one")
    n = M.filter_name_ci(notifications(spark, sf_dir), "purchase")
    return compared(ingest_one(n, "PURCHASE", MEASURE, f"{Y_NAME},{X_NAME}", base_uri=f"{base}/files"))


@register("notify_one", f"SELECT * FROM ({_NOTIF_SQL}) n {_FIRST_SQL}")
def notify_one(spark, sf_dir):
    """The earliest message."""
    return M.cap(notifications(spark, sf_dir), 1)


MATCHED_CAP = 9


@register("matched_cap", f"""
WITH n AS ({_NOTIF_SQL}), p AS ({_PARAMS_SQL})
SELECT {_MATCH_COLS} FROM n JOIN p ON n.name = p.name
ORDER BY n.created_time, n.key, n.name, n.bucket, n.forecast_reference_time LIMIT {MATCHED_CAP}""")
def matched_cap(spark, sf_dir):
    """L3: the first matched messages; unmatched ones do not count."""
    return M.matched_cap(notifications(spark, sf_dir), M.params_frame(spark, INGEST_PARAMS), MATCHED_CAP)


@register("grid_realization", f"SELECT {_long_sql('c', MEASURE)} FROM ({_cells_sql(G_R, G_Y, G_X)}) c WHERE c.r = 1")
def grid_realization(spark, sf_dir):
    """One realization's slab of every file."""
    return compared(U.to_long(U.realization_slab(grid_g(spark, sf_dir), 1)))


# The long table's columns and types as the schema string names them.
_FIELDS = [("file_name", "string"), ("y_coord", "double"), ("x_coord", "double"), ("forecast", "double"), ("time", "double"),
           ("measure_name", "string"), ("measure_value", "double")]


@register("schema_fields", f"WITH l AS (SELECT {_long_sql('c', MEASURE)} FROM ({_cells_sql(G_R, G_Y, G_X)}) c) " + " UNION ALL ".join(
    f"SELECT {k} AS position, '{n}' AS name, '{t}' AS type, count({n}) AS n_values FROM l" for k, (n, t) in enumerate(_FIELDS)))
def schema_fields(spark, sf_dir):
    """The fields of the schema string, checked against the long rows of every
    file, with how many rows have a value in each."""
    from gridspark.schema import REFERENCE_SCHEMA_STRING, parse_schema_string

    rows = U.to_long(grid_g(spark, sf_dir))
    fields = parse_schema_string(REFERENCE_SCHEMA_STRING).fields
    same = [rows.schema[f.name].dataType == f.dataType for f in fields]
    counts = rows.agg(*[F.count(f.name).alias(f.name) for f in fields])
    each = F.array(*[F.struct(F.lit(k).alias("position"), F.lit(f.name).alias("name"),
                              F.lit(f.dataType.simpleString() if ok else "other").alias("type"), F.col(f.name).alias("n_values"))
                     for k, (f, ok) in enumerate(zip(fields, same))])
    return counts.select(F.explode(each).alias("e")).select("e.*")


# Fixed value: added to every cell, so that values need more than float32's 24 bits.
BEYOND_FLOAT = 16777216


@register("grid_file_double", f"""
SELECT c.file_name, CAST(c.y * 2000 AS DOUBLE) AS y_coord, CAST(c.x * 2000 AS DOUBLE) AS x_coord, c.t_min AS forecast, c.t_max AS time,
       '{SECOND}' AS measure_name, CAST(CAST(c.v AS BIGINT) + {BEYOND_FLOAT} AS DOUBLE) AS measure_value
FROM ({_cells_sql(G_R, G_Y, G_X, SECOND)}) c""")
def grid_file_double(spark, sf_dir):
    """A double measure keeps the digits that float32 would drop."""
    from gridspark.session import scratch_path
    from gridspark.sources.gridfile import good_slabs, requests_for_files, scan_grid
    from gridspark.sources.tables import write_orders_grid_files

    files = write_orders_grid_files(table(spark, sf_dir, "orders"), scratch_path(spark, "double-grid"), G_R, G_Y, G_X, "g_", SECOND,
                                    add=BEYOND_FLOAT)
    return U.to_long(good_slabs(scan_grid(requests_for_files(files, SECOND, Y_NAME, X_NAME, -1))))
