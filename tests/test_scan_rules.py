"""Rules of the file scan: what a request may read, how the header pass is spread, and a
file whose bytes are written out by hand from the format specification."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridspark.operators.unpivot import to_long
from gridspark.sources import netcdf as nc
from gridspark.sources.gridfile import REQUEST_COLUMNS, good_slabs, resolve, scan_grid, scan_rejects
from gridspark.sources.ncwrite import encode, grid_file_bytes

YN, XN = "projection_y_coordinate", "projection_x_coordinate"


def request(spark, path, measure="m", y=YN, x=XN):
    return spark.createDataFrame([(path, os.path.basename(path), measure, y, x, -1)], "path string, file_name string, measure string, "
                                 "coord_y string, coord_x string, r_limit int").select(*REQUEST_COLUMNS)


def put(folder, name, data):
    path = os.path.join(str(folder), name)
    with open(path, "wb") as f:
        f.write(data)
    return path


# Classic format, version 1, as its specification lays it out: every number big-endian,
# names and values padded to four bytes.
BY_HAND = b"".join([
    b"CDF\x01", b"\x00\x00\x00\x00",                                   # magic, no records
    b"\x00\x00\x00\x0a", b"\x00\x00\x00\x03",                          # three dimensions
    b"\x00\x00\x00\x01", b"r\x00\x00\x00", b"\x00\x00\x00\x01",        # r = 1
    b"\x00\x00\x00\x01", b"y\x00\x00\x00", b"\x00\x00\x00\x01",        # y = 1
    b"\x00\x00\x00\x01", b"x\x00\x00\x00", b"\x00\x00\x00\x02",        # x = 2
    b"\x00" * 8,                                                       # no global attributes
    b"\x00\x00\x00\x0b", b"\x00\x00\x00\x05",                          # five variables
    b"\x00\x00\x00\x01", b"y\x00\x00\x00", b"\x00\x00\x00\x01", b"\x00\x00\x00\x01", b"\x00" * 8,
    b"\x00\x00\x00\x05", b"\x00\x00\x00\x04", b"\x00\x00\x01\x0c",     # y(y): float, 4 bytes at 268
    b"\x00\x00\x00\x01", b"x\x00\x00\x00", b"\x00\x00\x00\x01", b"\x00\x00\x00\x02", b"\x00" * 8,
    b"\x00\x00\x00\x05", b"\x00\x00\x00\x08", b"\x00\x00\x01\x10",     # x(x): float, 8 bytes at 272
    b"\x00\x00\x00\x04", b"time", b"\x00\x00\x00\x00", b"\x00" * 8,
    b"\x00\x00\x00\x04", b"\x00\x00\x00\x04", b"\x00\x00\x01\x18",     # time: int scalar at 280
    b"\x00\x00\x00\x17", b"forecast_reference_time\x00", b"\x00\x00\x00\x00", b"\x00" * 8,
    b"\x00\x00\x00\x04", b"\x00\x00\x00\x04", b"\x00\x00\x01\x1c",     # forecast_reference_time: int scalar at 284
    b"\x00\x00\x00\x01", b"m\x00\x00\x00", b"\x00\x00\x00\x03", b"\x00\x00\x00\x00\x00\x00\x00\x01\x00\x00\x00\x02", b"\x00" * 8,
    b"\x00\x00\x00\x05", b"\x00\x00\x00\x08", b"\x00\x00\x01\x20",     # m(r, y, x): float, 8 bytes at 288
    b"\x40\x40\x00\x00",                                               # y: 3.0
    b"\x3f\x80\x00\x00", b"\x40\x00\x00\x00",                          # x: 1.0, 2.0
    b"\x00\x00\x00\x07", b"\xff\xff\xff\xfe",                          # time 7, forecast -2
    b"\x3f\xc0\x00\x00", b"\xc2\xc8\x00\x00",                          # m: 1.5, -100.0
])


def test_file_written_by_hand(spark, tmp_path):
    assert len(BY_HAND) == 296
    h = nc.read_header(nc.BytesReader(BY_HAND))
    assert h.dims == [("r", 1), ("y", 1), ("x", 2)] and list(h.variables) == ["y", "x", "time", "forecast_reference_time", "m"]
    path = put(tmp_path, "hand.nc", BY_HAND)
    rows = to_long(good_slabs(scan_grid(request(spark, path, y="y", x="X")))).orderBy("x_coord").collect()
    assert [tuple(r) for r in rows] == [("hand.nc", 3.0, 1.0, -2.0, 7.0, "m", 1.5), ("hand.nc", 3.0, 2.0, -2.0, 7.0, "m", -100.0)]


def grid(values, times=(np.asarray(5, np.int64), []), attrs=None):
    dims = [("realization", values.shape[0]), (YN, values.shape[1]), (XN, values.shape[2]), ("time", 2)]
    return encode(dims, [(YN, [YN], np.arange(values.shape[1], dtype=np.float32)), (XN, [XN], np.arange(values.shape[2], dtype=np.float32)),
                         ("time", times[1], times[0]), ("forecast_reference_time", [], np.asarray(1, np.int64)),
                         ("m", ["realization", YN, XN], values)], 5)


@pytest.mark.parametrize("data,reason", [
    (grid(np.zeros((1, 2, 2), np.float32), (np.array([100, 200], np.int64), ["time"])), "a scalar is expected"),
    (grid(np.zeros((1, 2, 2), np.float32), (np.asarray(1.5), [])), "whole seconds are expected"),
    (grid(np.zeros((1, 2, 2), np.float32))[:-3], "read past end of file"),
    (b"not a grid", "not a classic-format"),
])
def test_requests_that_cannot_be_read_as_asked_are_rejected(spark, tmp_path, data, reason):
    scanned = scan_grid(request(spark, put(tmp_path, "a.nc", data)))
    assert good_slabs(scanned).count() == 0
    assert reason in scan_rejects(scanned).first()["error"]


def test_other_failures_are_not_taken_for_rejects(spark, tmp_path):
    """A store that does not answer must fail the task, so that Spark tries again."""
    with pytest.raises(Exception, match="nosuchscheme"):
        scan_grid(request(spark, "nosuchscheme://store/a.nc")).collect()


@pytest.mark.parametrize("values", [np.array([[[16777217.0, 0.1]]]), np.array([[[16777217, -5]]], np.int32)])
def test_measures_of_other_types_keep_their_digits(spark, tmp_path, values):
    rows = to_long(good_slabs(scan_grid(request(spark, put(tmp_path, "d.nc", grid(values)))))).orderBy("x_coord").collect()
    assert [r["measure_value"] for r in rows] == [float(v) for v in values.ravel()]


def test_keys_with_spaces_and_escapes(spark, tmp_path):
    data = grid_file_bytes("m", np.ones((1, 1, 1), np.float32), np.zeros(1), np.zeros(1), 1, 1)
    path = put(tmp_path, "a b%20c.nc", data)
    assert good_slabs(scan_grid(request(spark, path))).count() == 1
    assert good_slabs(scan_grid(request(spark, "file:" + path.replace("%", "%25").replace(" ", "%20")))).count() == 1


def test_each_header_is_read_once(spark, tmp_path, monkeypatch):
    """The read pass works from the plan: with the headers gone from the files after the
    header pass, the same cells are read."""
    from gridspark.sources.gridfile import materialize_plan, plan_slabs, read_slabs, spread_plan

    path = put(tmp_path, "e.nc", grid(np.arange(12, dtype=np.float32).reshape(2, 2, 3)))
    plan = materialize_plan(plan_slabs(resolve(request(spark, path), 12)))
    size = nc.read_header(nc.open_reader(path)).header_size
    assert size > 0
    with open(path, "r+b") as f:
        f.write(b"\0" * min(size, 32))
    rows = to_long(good_slabs(read_slabs(spread_plan(plan)))).collect()
    assert sorted(r["measure_value"] for r in rows) == list(range(12))


def test_header_pass_is_spread_over_the_cluster(spark):
    """1,000 small requests in one partition: at least as many tasks as cores get some."""
    reqs = spark.range(0, 1000, 1, 1).select(F.format_string("/nowhere/%d.nc", "id").alias("path"), F.lit("f").alias("file_name"),
                                             F.lit("m").alias("measure"), F.lit("y").alias("coord_y"), F.lit("x").alias("coord_x"),
                                             F.lit(-1).alias("r_limit"))
    parts = resolve(reqs).select(F.spark_partition_id().alias("p"), "error").groupBy("p").count().collect()
    assert len(parts) >= spark.sparkContext.defaultParallelism and sum(r["count"] for r in parts) == 1000
