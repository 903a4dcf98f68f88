"""Batch sources and dump entry points."""

import json
import os

import numpy as np

from gridspark.plans.dump import read_list, read_list_and_dump, read_one, requests_from_strings
from gridspark.sinks.writers import write_json
from gridspark.sources.messages import read_notifications, read_one_notification
from gridspark.sources.ncwrite import grid_file_bytes

YN, XN = "projection_y_coordinate", "projection_x_coordinate"


def msg(t, key="k.nc"):
    inner = {"bucket": "b", "name": "snow", "key": key, "created_time": t, "forecast_reference_time": t}
    return json.dumps({"Message": json.dumps(inner)})


def test_batch_and_single_sources(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "a.txt").write_text("\n".join([msg("2019-01-01T00:00:03Z"), msg("2019-01-01T00:00:01Z"), "bad"]) + "\n")
    (inbox / "b.txt").write_text(msg("2019-01-01T00:00:02Z") + "\n")
    assert read_notifications(spark, str(inbox)).count() == 3
    assert read_notifications(spark, str(inbox), keep_rejects=True).count() == 4
    assert [r["created_time"] for r in read_notifications(spark, str(inbox), 2).collect()] == [
        "2019-01-01T00:00:01Z", "2019-01-01T00:00:02Z"]
    assert read_one_notification(spark, str(inbox)).first()["created_time"] == "2019-01-01T00:00:01Z"
    empty = tmp_path / "empty"
    empty.mkdir()
    assert read_one_notification(spark, str(empty)).count() == 0


def make(tmp_path, name="air.nc", r=2):
    v = np.arange(r * 3 * 4, dtype=np.float32).reshape(r, 3, 4) + 0.5
    p = os.path.join(str(tmp_path), name)
    with open(p, "wb") as f:
        f.write(grid_file_bytes("air", v, np.arange(3.0), np.arange(4.0), 9, 8))
    return p


def test_parameter_strings(spark, tmp_path):
    p = make(tmp_path)
    req = requests_from_strings(spark, [f"{p},air,{YN},{XN},1"]).first()
    assert (req["file_name"], req["measure"], req["r_limit"]) == ("air.nc", "air", 1)
    assert read_one(spark, p, "air", f"{YN},{XN}", 1).count() == 12
    assert read_one(spark, p, "air", f"{YN},{XN}", -1).count() == 24
    # the same file twice: both copies are kept (union all)
    assert read_list(spark, [f"{p},air,{YN},{XN},1"] * 2).count() == 24


def test_read_list_and_dump(spark, tmp_path, scratch, capsys):
    p = make(tmp_path)
    out = scratch.replace("file:", "")
    n = read_list_and_dump(spark, [f"{p},air,{YN},{XN},-1"], lambda df: write_json(df, out), show=True)
    assert n == 24
    printed = capsys.readouterr().out
    assert "measure_value: double" in printed and "air.nc" in printed


def test_measure_to_json_and_console(spark, tmp_path, scratch, capsys):
    import glob

    from gridspark.plans.dump import measure_to_console, measure_to_json

    p = make(tmp_path)
    out = scratch.replace("file:", "")
    assert measure_to_json(spark, p, "air", f"{YN},{XN}", 1, out, max_records_per_file=5) == 12
    files = glob.glob(os.path.join(out, "*.json"))
    lines = [json.loads(x) for f in files for x in open(f)]
    assert len(lines) == 12 and max(sum(1 for _ in open(f)) for f in files) <= 5
    assert set(lines[0]) == {"y_coord", "x_coord", "time", "forecast", "air"}
    assert all(isinstance(v, str) for v in lines[0].values())
    rows = measure_to_console(spark, p, "air", f"{YN},{XN}", -1, n=3)
    assert rows.count() == 24 and "cnt" in capsys.readouterr().out


def test_stream_json_and_console_sinks(spark, scratch, capsys):
    from gridspark.operators.unpivot import to_long
    from gridspark.streaming.ingest_stream import console_sink, json_sink

    rows = to_long(spark.createDataFrame(
        [("f", "m", 0, 0, 0, 1, 0.0, [1.0, 2.0], 3, 4, [5.0, 6.0])],
        "file_name string, measure_name string, r int, level int, y int, y_len int, y_coord float, "
        "x_coords array<float>, time bigint, forecast bigint, vals array<float>"))
    json_sink(scratch)(rows, 7)
    json_sink(scratch)(rows, 7)  # a replayed batch overwrites itself
    assert spark.read.json(scratch).count() == 2
    console_sink(5)(rows, 7)
    assert "-- batch 7" in capsys.readouterr().out


def test_ingest_from_raw_bodies(spark):
    from gridspark.operators.match import params_frame
    from gridspark.plans.ingest import ingest_bodies
    from gridspark.schema import SLAB_SCHEMA

    slabs = spark.createDataFrame([("k.nc", "snow", 0, 0, 0, 1, 0.0, [0.0, 1.0], 5, 4, [1.5, 2.5])], SLAB_SCHEMA)
    bodies = spark.createDataFrame([(msg("2019-01-01T00:00:01Z"),), ("garbage",)], "body string")
    params = params_frame(spark, [("snow", "snow", YN, XN, -1)])
    rows = ingest_bodies(bodies, params, slabs).collect()
    assert sorted(r["measure_value"] for r in rows) == [1.5, 2.5]
    assert rows[0]["file_name"] == "snow_2019-01-01T00:00:01Z_k.nc"
