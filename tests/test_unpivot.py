"""Slab operators (P8-P15, L1, A1, S7) on hand-made slabs."""

import math

from pyspark.sql import functions as F

from gridspark.operators import unpivot as U
from gridspark.operators.describe import describe_slabs
from gridspark.schema import LONG_COLUMNS, SLAB_SCHEMA


def slabs(spark, rows):
    return spark.createDataFrame(rows, SLAB_SCHEMA)


def grid_rows(r_len=3, y_len=2, x_len=3, level=0, file="f.nc", m="m"):
    out = []
    for r in range(r_len):
        for y in range(y_len):
            vals = [float(r * 100 + y * 10 + x) + 0.1 for x in range(x_len)]
            out.append((file, m, r, level, y, y_len, float(y), [float(x) * 0.5 for x in range(x_len)], 7, 3, vals))
    return out


def test_long_rows_in_row_major_order_with_scalars(spark):
    out = U.to_long_indexed(slabs(spark, grid_rows())).orderBy("cnt").collect()
    assert len(out) == 18
    assert [r["cnt"] for r in out] == list(range(18))
    first = out[4]
    assert (first["r"], first["y"], first["x"]) == (0, 1, 1)
    assert first["measure_value"] == 11.1 and first["x_coord"] == 0.5 and first["y_coord"] == 1.0
    assert first["time"] == 7.0 and first["forecast"] == 3.0
    assert tuple(U.to_long(slabs(spark, grid_rows())).columns) == LONG_COLUMNS


def test_realization_limits(spark):
    s = slabs(spark, grid_rows()).withColumn("lim", F.lit(0))
    def n(lim):
        return U.to_long(s.withColumn("lim", F.lit(lim)).filter(U.within_limit("lim"))).count()
    assert n(-1) == 18 and n(0) == 0 and n(1) == 6 and n(9) == 18


def test_rank4_level_zero(spark):
    rows = grid_rows(level=0) + grid_rows(level=1)
    assert U.to_long(U.first_level(slabs(spark, rows))).count() == 18
    assert U.to_long(U.realization_slab(slabs(spark, rows), 2)).count() == 12


def test_nan_cells_and_short_axis(spark):
    rows = [("f", "m", 0, 0, 0, 1, 0.0, [1.0], 0, 0, [float("nan"), 2.0])]
    out = U.to_long(slabs(spark, rows)).orderBy("x_coord").collect()
    assert len(out) == 2
    vals = sorted(out, key=lambda r: (r["x_coord"] is not None, r["x_coord"]))
    assert vals[0]["x_coord"] is None  # coordinate axis shorter than the line
    assert any(math.isnan(r["measure_value"]) for r in out)


def test_one_by_one_grid(spark):
    rows = [("f", "m", 0, 0, 0, 1, 5.0, [6.0], 1, 2, [3.5])]
    r = U.to_long(slabs(spark, rows)).first()
    assert (r["y_coord"], r["x_coord"], r["measure_value"]) == (5.0, 6.0, 3.5)


def test_counts_without_unpivot(spark):
    s = slabs(spark, grid_rows() + grid_rows(file="g.nc", r_len=1))
    counts = {r["file_name"]: r["n_rows"] for r in U.cell_count(s).collect()}
    assert counts == {"f.nc": 18, "g.nc": 6}
    assert U.to_long(s).count() == 24


def test_wide_and_json(spark):
    s = slabs(spark, [("f", "air", 0, 0, 0, 1, 2000.0, [0.0], 1563552000, 1563537600, [101325.1])])
    w = U.wide_from_slabs(s, "air")
    assert w.first().asDict() == {"y_coord": "2000.0", "x_coord": "0.0", "time": "1563552000",
                                  "forecast": "1563537600", "air": "101325.1"}
    assert U.to_wide(U.to_long(s), "air").first().asDict() == w.first().asDict()
    j = U.cell_json(w, "air").first()["value"]
    assert j == '{"y_coord":"2000.0","x_coord":"0.0","time":"1563552000","forecast":"1563537600","air":"101325.1"}'


def test_describe(spark):
    d = describe_slabs(slabs(spark, grid_rows(r_len=2, y_len=4, x_len=5))).first()
    assert (d["n_r"], d["n_level"], d["n_y"], d["n_x"], d["time"], d["forecast"]) == (2, 1, 4, 5, 7, 3)


def test_unpivot_has_no_shuffle(spark):
    plan = U.to_long(slabs(spark, grid_rows()))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" in plan
