"""Registered queries over stored knowledge of grid files: the header catalogue, block statistics,
listings made by tasks, and files that appear late."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridspark.functions.messages import build_body
from gridspark.operators import match as M
from gridspark.operators import unpivot as U
from gridspark.plans.catalog import (G_R, G_X, G_Y, I_R, I_X, I_Y, INGEST_PARAMS, INGEST_SQL, MEASURE, ORACLE, PER_KEY, X_NAME, Y_NAME,
                                     _cells_sql, _describe_sql, _long_sql, compared, g_files, register, table)
from gridspark.plans.files import ingest_files_and_rejects
from gridspark.plans.polls import BACKLOG, POLL, write_inbox
from gridspark.session import scratch_path
from gridspark.sinks.snapshot import SnapshotStore
from gridspark.sources.block_stats import BlockStats, Wanted
from gridspark.sources.catalogue import HeaderCatalogue
from gridspark.sources.gridfile import good_slabs, requests_for_files, scan_grid
from gridspark.sources.listing import list_tree
from gridspark.sources.tables import notification_fields, write_orders_grid_files
from gridspark.streaming.message_source import drained, idle, polled_messages
from gridspark.streaming.outcomes import start_routed
from gridspark.streaming.retries import start_retries, write_failed
from gridspark.streaming.versions import use_state_store


@register("grid_file_catalogue", f"""
SELECT {_long_sql('c', MEASURE)}, n.files AS opened_first, CAST(0 AS BIGINT) AS opened_again
FROM ({_cells_sql(G_R, G_Y, G_X)}) c, (SELECT count(DISTINCT file_name) AS files FROM ({_cells_sql(G_R, G_Y, G_X)}) d) n""")
def grid_file_catalogue(spark, sf_dir):
    """A second scan resolves its requests from stored headers and opens no file for them."""
    requests = requests_for_files(g_files(spark, sf_dir), MEASURE, Y_NAME, X_NAME, -1)
    catalogue = HeaderCatalogue(spark, scratch_path(spark, "catalogue"))
    catalogue.resolve(requests)
    first = catalogue.opened
    slabs = good_slabs(scan_grid(requests, catalogue=catalogue))
    return compared(U.to_long(slabs)).withColumns({"opened_first": F.lit(first).cast("long"), "opened_again": F.lit(catalogue.opened).cast("long")})


@register("grid_catalogue_describe", _describe_sql())
def grid_catalogue_describe(spark, sf_dir):
    """Dimensions and variables of every file from the stored headers."""
    from gridspark.functions.text import basename

    catalogue = HeaderCatalogue(spark, scratch_path(spark, "catalogue"))
    found = catalogue.describe(g_files(spark, sf_dir).select("path"))
    return found.select(basename("path").alias("file_name"), "kind", "name", "type", F.array_join("dims", ",").alias("dims"),
                        F.array_join(F.transform("shape", lambda n: n.cast("string")), ",").alias("shape"), "is_record")


# A block holds this many bytes of values: five lines of a grid.
BOX_BLOCK = 4 * 5 * G_X
BOX = Wanted(y=(16000.0, 30000.0), x=(None, 99000.0), value=(100000.0, None))


@register("grid_box", f"""
SELECT * FROM (SELECT {_long_sql('c', MEASURE)} FROM ({_cells_sql(G_R, G_Y, G_X)}) c)
WHERE y_coord BETWEEN {BOX.y[0]} AND {BOX.y[1]} AND x_coord <= {BOX.x[1]} AND measure_value >= {BOX.value[0]}""")
def grid_box(spark, sf_dir):
    """The cells of a box and a range of values; blocks that cannot hold one are not read."""
    requests = requests_for_files(g_files(spark, sf_dir), MEASURE, Y_NAME, X_NAME, -1)
    stats = BlockStats(spark, scratch_path(spark, "block-stats"), HeaderCatalogue(spark, scratch_path(spark, "catalogue")))
    stats.update(requests, BOX_BLOCK)
    return compared(stats.search(requests, BOX, BOX_BLOCK))


@register("grid_file_tree", ORACLE["grid_unpivot"])
def grid_file_tree(spark, sf_dir):
    """Every file below a folder, listed by tasks level by level, scanned."""
    base = scratch_path(spark, "tree")
    g_files(spark, sf_dir, f"{base}/year/month")
    files = list_tree(spark, base)
    return compared(U.to_long(good_slabs(scan_grid(requests_for_files(files, MEASURE, Y_NAME, X_NAME, -1)))))


@register("ingest_retries", INGEST_SQL)
def ingest_retries(spark, sf_dir):
    """UD4: the flagship over polled messages when half of the files appear only after their messages: the messages
    that could not be read are offered again, and each is read once."""
    base = scratch_path(spark, "retries")
    events, orders = table(spark, sf_dir, "events"), table(spark, sf_dir, "orders")
    per_file = I_R * I_Y * I_X
    early = F.expr(f"(o_orderkey div {per_file}) % 2 = 0")
    write_orders_grid_files(orders.filter(early), f"{base}/early", I_R, I_Y, I_X, "g_", MEASURE)
    write_inbox(events, build_body(*notification_fields(events, PER_KEY, "g_")), f"{base}/inbox")
    where = {"grid": f"{base}/early/files"}

    def process(messages):
        return ingest_files_and_rejects(messages, M.params_frame(messages.sparkSession, INGEST_PARAMS), base_uri=where["grid"])

    first, again = (SnapshotStore(spark, f"{base}/{n}") for n in ("first", "again"))
    bodies = polled_messages(spark, f"{base}/inbox", 10 * POLL, file_order="name", polls=BACKLOG // 10)
    drained(start_routed(bodies, lambda s: M.params_frame(s, INGEST_PARAMS), first, f"{base}/checkpoint", process))

    write_failed(first.read("dead"), f"{base}/failed", 1)
    write_orders_grid_files(orders.filter(~early), f"{base}/late", I_R, I_Y, I_X, "g_", MEASURE)
    where["grid"] = f"{base}/late/files"
    use_state_store(spark)
    idle(start_retries(spark, f"{base}/failed", process, again, f"{base}/checkpoint-again", tries=2, delay="5 seconds"), rounds=8)
    rows = first.read("rows").unionByName(again.read("rows"))
    return compared(rows.drop("batch_id"))
