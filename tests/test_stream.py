"""Streaming ingest (ST1-ST5, D5): stream equals batch, restarts add nothing."""

import json
import os

import numpy as np

from gridspark.functions.messages import accepted, parse_notifications
from gridspark.operators.match import params_frame
from gridspark.plans.files import ingest_files
from gridspark.sources.ncwrite import grid_file_bytes
from gridspark.streaming.ingest_stream import notification_stream, parquet_sink, parsed_stream, start_ingest

YN, XN = "projection_y_coordinate", "projection_x_coordinate"
PARAMS = [("snow", "snow", YN, XN, -1), ("rain", "rain", YN, XN, 1)]


def msg(name, key, t="2019-07-19T16:18:22Z", bucket="b"):
    inner = {"bucket": bucket, "name": name, "key": key, "created_time": t, "forecast_reference_time": t}
    return json.dumps({"Message": json.dumps(inner)})


def drop(inbox, fname, lines):
    os.makedirs(inbox, exist_ok=True)
    with open(os.path.join(inbox, fname), "w") as f:
        f.write("\n".join(lines) + "\n")


def make_store(folder):
    os.makedirs(folder, exist_ok=True)
    for i, name in enumerate(["snow", "rain", "snow"]):
        v = np.full((2, 3, 4), i + 1, dtype=np.float32)
        with open(os.path.join(folder, f"k{i}.nc"), "wb") as f:
            f.write(grid_file_bytes(name, v, np.arange(3.0), np.arange(4.0), 10 + i, i))


def run(spark, inbox, out, ckpt, store, dedupe=None):
    def process(batch):
        return ingest_files(batch, params_frame(batch.sparkSession, PARAMS), base_uri=store)

    q = start_ingest(parsed_stream(notification_stream(spark, inbox, 1), dedupe), process, parquet_sink(out), ckpt)
    q.awaitTermination()
    assert q.exception() is None
    return spark.read.parquet(out)


def test_stream_equals_batch_and_restart_adds_nothing(spark, scratch):
    store, inbox, out, ckpt = (f"{scratch}/{n}" for n in ("store", "inbox", "out", "ckpt"))
    make_store(store)
    drop(inbox, "a.txt", [msg("snow", "k0.nc"), msg("other", "k0.nc")])
    drop(inbox, "b.txt", [msg("rain", "k1.nc"), "garbage"])
    drop(inbox, "c.txt", [msg("snow", "k2.nc")])
    got = run(spark, inbox, out, ckpt, store)
    bodies = spark.read.text(inbox).withColumnRenamed("value", "body")
    batch = ingest_files(accepted(parse_notifications(bodies)), params_frame(spark, PARAMS), base_uri=store)
    assert got.count() == 24 + 12 + 24
    assert sorted(map(tuple, got.drop("batch_id").collect())) == sorted(map(tuple, batch.collect()))
    assert got.select("batch_id").distinct().count() == 3
    # restart on the same checkpoint: nothing new
    assert run(spark, inbox, out, ckpt, store).count() == 60
    # a new file arrives: only it is ingested
    drop(inbox, "d.txt", [msg("rain", "k1.nc", t="2019-07-19T17:00:00Z")])
    assert run(spark, inbox, out, ckpt, store).count() == 72


def test_empty_batches_write_nothing(spark, scratch):
    inbox, out, ckpt = f"{scratch}/inbox", f"{scratch}/out", f"{scratch}/ckpt"
    drop(inbox, "a.txt", ["garbage", '{"Message": "{}"}'])  # nothing usable arrives
    q = start_ingest(parsed_stream(notification_stream(spark, inbox)),
                     lambda b: ingest_files(b, params_frame(b.sparkSession, PARAMS)), parquet_sink(out), ckpt)
    q.awaitTermination()
    assert not os.path.exists(out)


def test_optional_dedupe(spark, scratch):
    store, inbox = f"{scratch}/store", f"{scratch}/inbox"
    make_store(store)
    drop(inbox, "a.txt", [msg("snow", "k0.nc"), msg("snow", "k0.nc", t="2019-07-19T16:19:00Z")])
    got = run(spark, inbox, f"{scratch}/out", f"{scratch}/ckpt", store, dedupe="1 hour")
    assert got.count() == 24


def test_processing_time_trigger_polls_new_files(spark, scratch):
    store, inbox, out = f"{scratch}/store", f"{scratch}/inbox", f"{scratch}/out"
    make_store(store)
    drop(inbox, "a.txt", [msg("snow", "k0.nc")])

    def process(batch):
        return ingest_files(batch, params_frame(batch.sparkSession, PARAMS), base_uri=store)

    q = start_ingest(parsed_stream(notification_stream(spark, inbox)), process, parquet_sink(out),
                     f"{scratch}/ckpt", trigger="processingTime", interval="1 second")
    try:
        q.processAllAvailable()
        assert spark.read.parquet(out).count() == 24
        drop(inbox, "b.txt", [msg("rain", "k1.nc")])
        q.processAllAvailable()
        assert spark.read.parquet(out).count() == 36
    finally:
        q.stop()


def test_ingest_returns_unreadable_messages(spark, scratch):
    import pytest

    from gridspark.plans.files import ingest_files_and_rejects

    store, inbox = f"{scratch}/store", f"{scratch}/inbox"
    make_store(store)
    with open(f"{store}/cut.nc", "wb") as f:
        f.write(open(f"{store}/k0.nc", "rb").read()[:-8])
    drop(inbox, "a.txt", [msg("snow", "k0.nc"), msg("snow", "missing.nc"), msg("rain", "k1.nc"), msg("snow", "cut.nc"), msg("snow", "missing.nc")])
    n = accepted(parse_notifications(spark.read.text(inbox).withColumnRenamed("value", "body")))
    rows, rejects = ingest_files_and_rejects(n, params_frame(spark, PARAMS), base_uri=store)
    assert rows.count() == 24 + 12
    got = sorted((r["key"], r["error"].split(":")[0]) for r in rejects.collect())
    assert got == [("cut.nc", "FormatError"), ("missing.nc", "FileNotFoundError"), ("missing.nc", "FileNotFoundError")]
    with pytest.raises(ValueError, match="unreadable file"):
        ingest_files(n, params_frame(spark, PARAMS), base_uri=store)


def test_a_late_object_is_read_after_a_restart(spark, scratch):
    from gridspark.plans.files import ingest_files_and_rejects
    from gridspark.streaming.ingest_stream import retry_rejects

    store, inbox, out, dead = (f"{scratch}/{n}" for n in ("store", "inbox", "out", "dead"))
    make_store(store)
    late = open(f"{store}/k2.nc", "rb").read()
    os.remove(f"{store}/k2.nc")
    drop(inbox, "a.txt", [msg("snow", "k0.nc"), msg("snow", "k2.nc")])

    def process(batch):
        return ingest_files_and_rejects(batch, params_frame(batch.sparkSession, PARAMS), base_uri=store)

    def drain():
        q = start_ingest(parsed_stream(notification_stream(spark, inbox)), process, parquet_sink(out), f"{scratch}/ckpt",
                         dead_letters=parquet_sink(dead))
        q.awaitTermination()
        assert q.exception() is None

    drain()
    assert spark.read.parquet(out).count() == 24
    assert [r["key"] for r in spark.read.parquet(dead).collect()] == ["k2.nc"]
    with open(f"{store}/k2.nc", "wb") as f:
        f.write(late)
    drain()  # the restart has nothing new
    retry_rejects(spark, dead, process, parquet_sink(f"{scratch}/again"), parquet_sink(f"{scratch}/dead2"), 0)
    assert spark.read.parquet(f"{scratch}/again").count() == 24
    assert spark.read.schema("key string").parquet(f"{scratch}/dead2").count() == 0


def test_batches_without_wanted_messages_write_nothing(spark, scratch):
    from gridspark.operators.match import is_wanted

    inbox, out = f"{scratch}/inbox", f"{scratch}/out"
    drop(inbox, "a.txt", [msg("other", "k0.nc"), msg("else", "k1.nc")])
    q = start_ingest(parsed_stream(notification_stream(spark, inbox)),
                     lambda b: ingest_files(b, params_frame(b.sparkSession, PARAMS)), parquet_sink(out), f"{scratch}/ckpt",
                     wanted=lambda b: is_wanted(b, params_frame(b.sparkSession, PARAMS)))
    q.awaitTermination()
    assert q.exception() is None and not os.path.exists(out)


def test_dedupe_takes_any_created_time(spark, scratch):
    from gridspark.streaming.ingest_stream import untimed

    store, inbox = f"{scratch}/store", f"{scratch}/inbox"
    make_store(store)
    drop(inbox, "a.txt", [msg("snow", "k0.nc", t="2019-07-19T16:18:22.123Z"), msg("snow", "k2.nc", t="yesterday")])
    got = run(spark, inbox, f"{scratch}/out", f"{scratch}/ckpt", store, dedupe="1 hour")
    assert got.count() == 24
    bodies = spark.read.text(inbox).withColumnRenamed("value", "body")
    assert [r["key"] for r in untimed(bodies).collect()] == ["k2.nc"]


def test_rows_and_dead_letters_in_one_commit(spark, scratch):
    from gridspark.plans.files import ingest_files_and_rejects
    from gridspark.sinks.snapshot import SnapshotStore

    grid, inbox = f"{scratch}/store", f"{scratch}/inbox"
    make_store(grid)
    drop(inbox, "a.txt", [msg("snow", "k0.nc"), msg("snow", "gone.nc")])
    store = SnapshotStore(spark, f"{scratch}/out")

    def process(batch):
        return ingest_files_and_rejects(batch, params_frame(batch.sparkSession, PARAMS), base_uri=grid)

    for _ in range(2):  # the second run finds nothing new
        q = start_ingest(parsed_stream(notification_stream(spark, inbox)), process, store, f"{scratch}/ckpt")
        q.awaitTermination()
        assert q.exception() is None
    assert store.read("rows").count() == 24 and [r.key for r in store.read("dead").collect()] == ["gone.nc"]
