"""Header catalogue, shared axes, block statistics and listings by tasks."""

import os

import numpy as np
from pyspark.sql import functions as F

from gridspark.operators.unpivot import to_long
from gridspark.sources import gridfile as G
from gridspark.sources.block_stats import BlockStats, Wanted
from gridspark.sources.catalogue import HeaderCatalogue
from gridspark.sources.listing import list_tree
from gridspark.sources.ncwrite import grid_file_bytes

Y, X = "projection_y_coordinate", "projection_x_coordinate"


def write(folder, name, shift=0.0, shape=(2, 6, 5), x=None):
    os.makedirs(folder, exist_ok=True)
    v = np.arange(np.prod(shape), dtype=np.float32).reshape(shape) + shift
    x = np.arange(float(shape[2])) if x is None else x
    with open(f"{folder}/{name}", "wb") as f:
        f.write(grid_file_bytes("snow", v, np.arange(float(shape[1])) * 10, x, 7, 3))


def local(path):
    return path.replace("file:", "")


def requests(spark, *paths, limit=-1):
    return G.requests_for_files(spark.createDataFrame([(p,) for p in paths], "path string"), "snow", Y, X, limit)


def rows(df):
    return sorted(map(tuple, df.collect()))


def long_rows(spark, reqs, **kw):
    return rows(to_long(G.good_slabs(G.scan_grid(reqs, **kw))))


def test_unchanged_files_are_not_opened_again(spark, scratch):
    base = local(scratch)
    for k in range(4):
        write(f"{base}/in", f"{k}.nc", k * 100)
    with open(f"{base}/in/bad.nc", "wb") as f:
        f.write(b"no grid")
    paths = [f"{base}/in/{n}.nc" for n in (0, 1, 2, 3, "bad", "missing")]
    catalogue = HeaderCatalogue(spark, f"{base}/catalogue")
    reqs = requests(spark, *paths)
    plain = G.scan_grid(reqs)
    got = G.scan_grid(reqs, catalogue=catalogue)
    assert catalogue.opened == 5
    assert rows(to_long(G.good_slabs(got))) == rows(to_long(G.good_slabs(plain)))
    errors = [sorted((r.file_name, r.error.split(":")[0]) for r in G.scan_rejects(x).collect()) for x in (got, plain)]
    assert errors[0] == errors[1] == [("bad.nc", "FormatError"), ("missing.nc", "FileNotFoundError")]
    # a new process with the same catalogue opens nothing; a changed and a new file are opened
    again = HeaderCatalogue(spark, f"{base}/catalogue")
    assert long_rows(spark, reqs, catalogue=again) == rows(to_long(G.good_slabs(plain))) and again.opened == 0
    write(f"{base}/in", "1.nc", 5000, (3, 2, 4))
    write(f"{base}/in", "missing.nc", 1)
    assert long_rows(spark, reqs, catalogue=again) == long_rows(spark, reqs) and again.opened == 2


def test_catalogue_judges_requests_like_the_files_do(spark, scratch):
    """Limits, wrong axes, missing measures and a file cut short, from the stored header alone."""
    base = local(scratch)
    write(f"{base}/in", "a.nc")
    write(f"{base}/in", "cut.nc")
    data = open(f"{base}/in/cut.nc", "rb").read()
    with open(f"{base}/in/cut.nc", "wb") as f:
        f.write(data[:-8])
    catalogue = HeaderCatalogue(spark, f"{base}/catalogue")
    asked = [(f"{base}/in/{n}", n, m, cy, X, lim) for n, m, cy, lim in (
        ("a.nc", "snow", Y, 1), ("a.nc", "snow", Y, -1), ("a.nc", "SNOW", Y.upper(), 9), ("a.nc", "rain", Y, 1),
        ("a.nc", "snow", "height", 1), ("cut.nc", "snow", Y, 1), ("cut.nc", "snow", Y, 2))]
    reqs = spark.createDataFrame(asked, "path string, file_name string, measure string, coord_y string, coord_x string, r_limit int")

    def judged(df):
        return sorted(((r.file_name, r.measure, r.coord_y, r.r_count, r.time, r.x_axis, r.error and r.error.split(":")[0]) for r in df.collect()), key=repr)

    assert judged(catalogue.resolve(reqs)) == judged(G.resolve(reqs))
    described = rows(G.describe_files(spark.createDataFrame([(f"{base}/in/a.nc",)], "path string")).drop("error"))
    assert rows(catalogue.describe(reqs.filter("file_name = 'a.nc'")).drop("error")) == described and catalogue.opened == 0


def test_shared_axes_are_not_repeated(spark, scratch):
    base = local(scratch)
    for k in range(3):
        write(f"{base}/in", f"{k}.nc", k, (1, 40, 100), np.arange(100.0) + (k == 2) * 7)
    reqs = requests(spark, *(f"{base}/in/{k}.nc" for k in range(3)))
    plan, axes = G.prepared(reqs)
    assert axes.count() == 2 and "x_coords" not in plan.columns
    for name, read in (("shared", plan.drop("x_coords").mapInArrow(G._reader(True, 1 << 20, True), G.READ_SCHEMA)),
                       ("own", plan.mapInArrow(G._reader(True, 1 << 20, False), G.READ_SCHEMA))):
        read.coalesce(1).write.option("compression", "none").option("parquet.enable.dictionary", "false").parquet(f"{base}/{name}")
    size = {n: sum(os.path.getsize(f"{base}/{n}/{f}") for f in os.listdir(f"{base}/{n}")) for n in ("shared", "own")}
    assert size["shared"] < 0.62 * size["own"]
    with_axes = G.good_slabs(G.read_slabs(plan, axes=axes))
    assert rows(to_long(with_axes)) == rows(to_long(G.good_slabs(G.read_slabs(plan))))
    physical = with_axes._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in physical and "SortMergeJoin" not in physical  # only the axes are shuffled, to find the distinct ones


def test_axes_beyond_the_bound_travel_with_their_lines(spark, scratch):
    base = local(scratch)
    write(f"{base}/in", "a.nc")
    reqs = requests(spark, f"{base}/in/a.nc")
    want = long_rows(spark, reqs)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16")
    try:
        assert G.prepared(reqs)[1] is None and long_rows(spark, reqs) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


SEARCHES = [Wanted(y=(15.0, 30.0)), Wanted(x=(3.5, None)), Wanted(value=(55.0, 130.0)), Wanted(y=(None, 5.0), x=(9.0, None)),
            Wanted(), Wanted(y=(1000.0, None))]


def test_a_search_reads_only_blocks_that_can_match(spark, scratch):
    base = local(scratch)
    for k in range(3):
        write(f"{base}/in", f"{k}.nc", k * 50, x=np.arange(5.0) + 4 * k)
    reqs = requests(spark, *(f"{base}/in/{k}.nc" for k in range(3)))
    stats = BlockStats(spark, f"{base}/stats", HeaderCatalogue(spark, f"{base}/catalogue"))
    block = 2 * 5 * 4  # two lines
    every = to_long(G.good_slabs(G.scan_grid(reqs, block))).cache()
    assert rows(stats.search(reqs, SEARCHES[0], block)) == rows(every.filter(SEARCHES[0].cells()))
    assert stats.read == stats.planned == 18  # nothing is known yet
    assert stats.update(reqs, block) == 18 and stats.update(reqs, block) == 0
    for wanted in SEARCHES:
        assert rows(stats.search(reqs, wanted, block)) == rows(every.filter(wanted.cells())) and stats.planned == 18
        assert stats.read == sum(holds(wanted, k, r, y) for k in range(3) for r in range(2) for y in (0, 2, 4))


def holds(wanted, k, r, y):
    """Whether the ranges of file k's block at (r, y) overlap the wanted ones."""
    values = (r * 30 + y * 5 + 50 * k, r * 30 + y * 5 + 9 + 50 * k)
    spans = ((y * 10, y * 10 + 10), (4 * k, 4 * k + 4), values)
    return all((lo is None or b >= lo) and (hi is None or a <= hi) for (a, b), (lo, hi) in zip(spans, (wanted.y, wanted.x, wanted.value)))


def test_a_changed_file_loses_its_statistics(spark, scratch):
    base = local(scratch)
    write(f"{base}/in", "a.nc")
    reqs = requests(spark, f"{base}/in/a.nc")
    stats = BlockStats(spark, f"{base}/stats", HeaderCatalogue(spark, f"{base}/catalogue"))
    stats.update(reqs)
    wanted = Wanted(value=(1000.0, None))
    assert stats.search(reqs, wanted).count() == 0 and stats.read == 0
    write(f"{base}/in", "a.nc", 2000, (2, 6, 6))
    assert stats.search(reqs, wanted).count() == 72 and stats.read == 2


def test_listing_by_tasks_equals_the_driver_listing(spark, scratch):
    base = local(scratch)
    for k, folder in enumerate(("", "a", "a/b", "a/b/c/d", "e e/f%20", "g")):
        for n in ("x.nc", "y.nc", "z.txt", ".hidden.nc")[: 2 + k % 3]:
            os.makedirs(f"{base}/t/{folder}", exist_ok=True)
            with open(f"{base}/t/{folder}/{n}", "w") as f:
                f.write("x" * (k + 1))
    os.makedirs(f"{base}/t/_skipped")
    os.makedirs(f"{base}/t/empty/deep")
    with open(f"{base}/t/_skipped/x.nc", "w") as f:
        f.write("x")

    def found(df):
        from urllib.parse import unquote

        return sorted((unquote(r.path).removeprefix("file:").replace("//", "/"), r.length) for r in df.select("path", "length").collect())

    got = found(list_tree(spark, f"{base}/t"))
    assert got == sorted((os.path.join(d, n), os.path.getsize(os.path.join(d, n)))
                         for d, _, names in os.walk(f"{base}/t") for n in names if n.endswith(".nc") and n[0] != "." and "/_" not in d)
    plain = G.list_files(spark, f"{base}/t")
    assert len(got) == plain.filter(~F.col("path").contains("/_") & ~F.col("path").contains("/.hidden")).count()
    assert list_tree(spark, f"{base}/t/empty").count() == 0
