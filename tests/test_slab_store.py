"""Stored slab tables: the measures and file buckets that no message names are pruned at
run time, results unchanged."""

from pyspark.sql import functions as F

from gridspark.operators import match as M
from gridspark.plans import catalog as C
from gridspark.plans.ingest import ingest
from gridspark.sources import slab_store
from gridspark.sources.slab_store import read_slab_store, store_slabs
from gridspark.sources.tables import orders_grid

SF = "/root/testdata/sf0.001"


def test_store_prunes_measures(spark, scratch):
    orders = C.table(spark, SF, "orders")
    a = orders_grid(orders, C.I_R, C.I_Y, C.I_X, "g_", C.MEASURE)
    b = orders_grid(orders, C.I_R, C.I_Y, C.I_X, "g_", "o_custkey")
    store_slabs(a.unionByName(b), scratch)
    stored = read_slab_store(spark, scratch)
    params = M.params_frame(spark, C.INGEST_PARAMS)
    df = ingest(C.notifications(spark, SF), params, stored)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "file_bucket" in plan.split("dynamicpruning")[0].rsplit("PartitionFilters", 1)[1]
    direct = ingest(C.notifications(spark, SF), params, a)
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, direct.collect()))


def test_buckets_follow_the_number_of_files(spark, scratch):
    orders = C.table(spark, SF, "orders")
    grid = orders_grid(orders, C.I_R, C.I_Y, C.I_X, "g_", C.MEASURE)
    assert slab_store.bucket_count(grid) == slab_store.LEAST_BUCKETS
    store_slabs(grid, scratch, buckets=7)
    stored = read_slab_store(spark, scratch)
    assert {r.file_bucket for r in stored.select("file_bucket").distinct().collect()} <= set(range(7))
    df = ingest(C.notifications(spark, SF), M.params_frame(spark, C.INGEST_PARAMS), stored)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "file_bucket" in plan.split("dynamicpruning")[0].rsplit("PartitionFilters", 1)[1]
    want = ingest(C.notifications(spark, SF), M.params_frame(spark, C.INGEST_PARAMS), grid)
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, want.collect()))
    store_slabs(grid.withColumn("file_name", F.concat(F.lit("new_"), "file_name")), scratch, mode="append")
    again = read_slab_store(spark, scratch)
    assert again.select("file_buckets").first()[0] == 7 and again.count() == 2 * stored.count()
