"""Message-level polls, caps across polls, outcomes, snapshot commits and exact rolling."""

import glob
import json
import os
import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridspark.operators.match import params_frame
from gridspark.plans.files import ingest_files_and_rejects
from gridspark.plans.polls import run_polls
from gridspark.schema import NOTIFICATION_FIELDS
from gridspark.sinks.rolled import numbered, write_json_exact
from gridspark.sinks.snapshot import SnapshotStore
from gridspark.functions.messages import accepted, parse_notifications
from gridspark.streaming.message_source import DONE, MessageReader, drained, idle, polled_messages
from gridspark.streaming.outcomes import routed, start_routed
from gridspark.streaming.retries import RetryLater, start_retries, write_failed
from gridspark.streaming.versions import start_versioned, use_state_store
from tests.test_stream import PARAMS, drop, make_store, msg


def local(path):
    return path.replace("file:", "")


def params(spark):
    return params_frame(spark, PARAMS)


def polls(store):
    rows = store.read("outcomes").select("batch_id", "file", "line", "outcome").collect()
    return sorted(map(tuple, rows))


def run(spark, base, n, process=None, **source):
    store = SnapshotStore(spark, f"{base}/out")
    bodies = polled_messages(spark, f"{base}/inbox", n, file_order="name", **source)
    drained(start_routed(bodies, params, store, f"{base}/checkpoint", process, keep=("file", "line")))
    return store


def test_reader_deals_out_messages(scratch):
    inbox = f"{local(scratch)}/inbox"
    drop(inbox, "a", [msg("snow", f"k{i}") for i in range(7)])
    drop(inbox, "b", [msg("rain", "k"), "", "garbage"])
    with open(f"{inbox}/c", "w") as f:
        f.write(msg("snow", "last"))  # no line end
    r = MessageReader(inbox, 5, ["snow"], None, True)
    offsets = [r.initialOffset()]
    for _ in range(4):
        offsets.append(r.latestOffset())
    assert offsets[-1] == offsets[-2] and offsets[-1]["matched"] == 8
    got = []
    for a, b in zip(offsets, offsets[1:]):
        lines = [(x["file"], x["line"], x["body"]) for p in r.partitions(a, b) for batch in r.read(p) for x in batch.to_pylist()]
        got.append(len(lines))
        r.commit(b)
        assert all(body == ([msg("snow", f"k{line}")] if f == "a" else [[msg("rain", "k"), "", "garbage"][line]] if f == "b" else [msg("snow", "last")])[0]
                   for f, line, body in lines)
    assert got == [5, 5, 1, 0] and not glob.glob(f"{inbox}/[a-c]") and len(os.listdir(f"{inbox}/{DONE}")) == 3
    # a reader that starts again goes on from the planned offset
    drop(inbox, "d", [msg("snow", "d")] * 2)
    again = MessageReader(inbox, 5, ["snow"], None, True)
    assert again.partitions(offsets[-1], offsets[-1]) == []
    nxt = again.latestOffset()
    assert [p[0] for p in json.loads(nxt["pieces"])] == ["d"] and nxt["matched"] == 10


def test_reader_does_not_deal_out_a_finished_file_twice(scratch):
    """A file whose acknowledgement was lost is still known from the last offset."""
    inbox = f"{local(scratch)}/inbox"
    drop(inbox, "a", [msg("snow", "k")] * 3)
    r = MessageReader(inbox, 5, None, None, False)
    first = r.latestOffset()
    again = MessageReader(inbox, 5, None, None, False)
    again.partitions(first, first)
    assert again.latestOffset() == first


def test_polls_across_files_and_restart(spark, scratch):
    base = local(scratch)
    drop(f"{base}/inbox", "a", [msg("snow", f"k{i}.nc") for i in range(4)])
    drop(f"{base}/inbox", "b", [msg("other", "x"), "garbage", msg("rain", "y")])
    got = polls(run(spark, base, 5))
    assert [p for p, *_ in got] == [0] * 5 + [1] * 2
    assert [o for *_, o in got] == ["accepted"] * 4 + ["unmatched", "rejected", "accepted"]
    assert polls(run(spark, base, 5)) == got  # nothing new
    drop(f"{base}/inbox", "c", [msg("snow", "z")] * 6)
    more = polls(run(spark, base, 5))
    assert more[: len(got)] == got and [(p, f) for p, f, *_ in more[len(got):]] == [(2, "c")] * 5 + [(3, "c")]


def test_cap_across_polls_holds_after_a_restart(spark, scratch):
    base = local(scratch)
    drop(f"{base}/inbox", "a", [msg("snow" if i % 2 else "other", f"k{i}") for i in range(40)])
    source = {"names": [p[0] for p in PARAMS], "matched_cap": 4}
    got = polls(run(spark, base, 5, **source))
    assert len(got) == 10 and sum(o == "accepted" for *_, o in got) == 5  # the poll that meets the cap is whole
    assert polls(run(spark, base, 5, **source)) == got
    assert len(open(f"{base}/inbox/a").read().split()) > 0  # unread messages stay


def dealt(reader):
    """(file, line, body, poll) of all messages in the order they are dealt out, and the number of batches."""
    out, at, n = [], reader.initialOffset(), 0
    while (end := reader.latestOffset()) != at:
        out += [tuple(x.values()) for p in reader.partitions(at, end) for batch in reader.read(p) for x in batch.to_pylist()]
        reader.commit(end)
        at, n = end, n + 1
    return out, n


@pytest.mark.parametrize("piece", [1, 50, 1000, 1 << 20])
def test_a_backlog_is_dealt_out_in_few_batches(scratch, monkeypatch, piece):
    monkeypatch.setattr("gridspark.streaming.message_source.PIECE_BYTES", piece)
    files = {"a": ["x" * (i * 37 % 90) for i in range(23)], "b": [""], "c": ["", "", "y"], "d": ["last" * 30]}
    want = [(f, k, x) for f, lines in files.items() for k, x in enumerate(lines)]
    got = {}
    for polls in (1, 3, 100):
        inbox = f"{local(scratch)}/{polls}"
        for f, lines in files.items():
            drop(inbox, f, lines)
        with open(f"{inbox}/d", "w") as f:
            f.write(files["d"][0])  # no line end
        rows, got[polls] = dealt(MessageReader(inbox, 5, None, None, True, polls))
        assert [r[:3] for r in rows] == want and [r[3] for r in rows] == [k // 5 for k in range(len(want))]
    assert got[1] >= 6 and got[3] <= 3 and got[100] == 1


def test_polls_of_one_batch_keep_their_numbers_and_their_cap(spark, scratch):
    base = local(scratch)
    drop(f"{base}/inbox", "a", [msg("snow" if i % 2 else "other", f"k{i}") for i in range(40)])
    source = {"names": [p[0] for p in PARAMS], "matched_cap": 9, "polls": 50}

    def polled():
        store = SnapshotStore(spark, f"{base}/out")
        bodies = polled_messages(spark, f"{base}/inbox", 5, file_order="name", **source)
        drained(start_routed(bodies, params, store, f"{base}/checkpoint", keep=("line", "poll")))
        return sorted(map(tuple, store.read("outcomes").select("batch_id", "poll", "line").collect()))

    assert polled() == [(0, k // 5, k) for k in range(20)]  # the fourth poll meets the cap: 2, 5, 7, 10
    source["matched_cap"] = 14
    assert polled() == [(int(k > 19), k // 5, k) for k in range(30)]  # after a restart the polls count on


def test_a_backlog_of_polls_is_counted_poll_by_poll_in_one_commit(spark, scratch):
    base = local(scratch)
    bodies = [msg("click", "k") if i < 1500 else "garbage" for i in range(3500)]
    for k in range(2):
        drop(f"{base}/inbox", f"{k}", bodies[k * 1750: (k + 1) * 1750])
    store = SnapshotStore(spark, f"{base}/out")
    run_polls(spark, base, store)
    got = {(r.poll, r.outcome): r["count"] for r in store.read("outcomes").groupBy("poll", "outcome").count().collect()}
    assert got == {(0, "accepted"): 1000, (1, "accepted"): 500, (1, "rejected"): 500, (2, "rejected"): 1000, (3, "rejected"): 500}
    assert len(store.manifests()) == 1


def test_rows_and_dead_letters_of_a_poll_appear_together(spark, scratch):
    base = local(scratch)
    make_store(f"{base}/grid")
    drop(f"{base}/inbox", "a", [msg("snow", "k0.nc"), msg("snow", "missing.nc"), msg("rain", "k1.nc"), msg("other", "k0.nc")])

    def process(accepted):
        return ingest_files_and_rejects(accepted, params(accepted.sparkSession), base_uri=f"{base}/grid")

    store = run(spark, base, 2, process)
    assert sorted(map(tuple, store.read("rows").groupBy("batch_id").count().collect())) == [(0, 24), (1, 12)]
    assert [(r.batch_id, r.key) for r in store.read("dead").collect()] == [(0, "missing.nc")]
    tags = {r.outcome: r["count"] for r in store.read("outcomes").groupBy("outcome").count().collect()}
    assert tags == {"accepted": 3, "unmatched": 1}


def test_snapshot_shows_all_tables_of_a_batch_or_none(spark, scratch):
    store = SnapshotStore(spark, local(scratch))
    good = spark.range(5)
    bad = spark.range(1).select(F.raise_error(F.lit("lost")).alias("x"))
    with pytest.raises(Exception, match="lost"):
        store.write(0, {"rows": good, "dead": bad})
    with pytest.raises(LookupError):
        store.read("rows")
    assert store.write(0, {"rows": good, "dead": good.filter("id < 2")})
    assert not store.write(0, {"rows": good, "dead": good})  # a replay
    assert store.write(1, {"rows": good.filter("id > 9"), "dead": good})
    assert (store.read("rows").count(), store.read("dead").count()) == (5, 7)
    assert sorted(r.batch_id for r in store.read("dead").collect()) == [0, 0] + [1] * 5
    # the failed attempt left the rows it had staged and the folder it was writing
    assert store.vacuum() == 2 and store.read("dead").count() == 7


def test_a_lost_race_to_publish_changes_nothing(spark, scratch):
    one, two = (SnapshotStore(spark, local(scratch)) for _ in range(2))
    assert one.write(3, {"rows": spark.range(3)})
    assert not two._publish(3, {"batch_id": 3, "frames": {}}) and two.read("rows").count() == 3


def versions(spark, base, n):
    use_state_store(spark)
    store = SnapshotStore(spark, f"{base}/out")
    usable = accepted(parse_notifications(polled_messages(spark, f"{base}/inbox", n, file_order="name"), keep=("file", "line")))
    idle(start_versioned(usable, store, f"{base}/checkpoint"))
    return [(r.batch_id, r.file, r.line, r.version) for r in store.read("versions").orderBy("file", "line").collect()]


def test_every_redelivery_has_a_defined_version(spark, scratch):
    base = local(scratch)
    day = "2019-07-19T{:02}:00:00Z".format
    drop(f"{base}/inbox", "a", [msg("snow", "k", day(5)), msg("snow", "k", day(7)), msg("snow", "j", "no time"), "garbage"])
    drop(f"{base}/inbox", "b", [msg("snow", "k", day(7)), msg("snow", "j", "none"), msg("snow", "i", day(1)), msg("snow", "i", day(1))])
    drop(f"{base}/inbox", "c", [msg("snow", "k", day(6)), msg("snow", "j", day(1)), msg("snow", "k", day(9), bucket="other"), msg("snow", "i", "x")])
    want = [(0, "a", 0, "superseded"), (0, "a", 1, "newest"), (0, "a", 2, "newest"),
            (1, "b", 0, "repeated"), (1, "b", 1, "repeated"), (1, "b", 2, "superseded"), (1, "b", 3, "newest"),
            (2, "c", 0, "older"), (2, "c", 1, "newest"), (2, "c", 2, "newest"), (2, "c", 3, "older")]
    assert versions(spark, base, 4) == want
    drop(f"{base}/inbox", "d", [msg("snow", "k", day(7)), msg("snow", "k", day(8), bucket="b2"), msg("snow", "j", day(2))])
    more = versions(spark, base, 4)  # after a restart the state is still there
    assert more[: len(want)] == want and [v for *_, v in more[len(want):]] == ["repeated", "newest", "newest"]


def test_versions_of_several_polls_in_one_batch(spark, scratch):
    base, rng = local(scratch), random.Random(4)
    sent = [(rng.choice("kji"), rng.choice(["2019-07-19T0%d:00:00Z" % rng.randrange(6), "no time"])) for _ in range(100)]
    drop(f"{base}/inbox", "a", [msg("snow", *m) for m in sent])
    seen, want = {}, []
    for lo in range(0, 100, 7):
        poll = range(lo, min(lo + 7, 100))
        for k in poll:
            place = max((i for i in poll if sent[i][0] == sent[k][0]), key=lambda i: (sent[i][1][0] == "2", sent[i][1], i))
            if place != k:
                want.append((lo // 7, k, "superseded"))
                continue
            new, old = (sent[k][1][0] == "2", sent[k][1]), seen.get(sent[k][0])
            want.append((lo // 7, k, "newest" if old is None or new > old else "repeated" if new == old else "older"))
            seen[sent[k][0]] = max(new, old or new)
    use_state_store(spark)
    store = SnapshotStore(spark, f"{base}/out")
    bodies = polled_messages(spark, f"{base}/inbox", 7, file_order="name", polls=6)
    idle(start_versioned(accepted(parse_notifications(bodies, keep=("file", "line", "poll"))), store, f"{base}/checkpoint"))
    rows = store.read("versions").select("poll", "line", "version", "batch_id").collect()
    assert sorted((r[0], r[1], r[2]) for r in rows) == sorted(want)
    assert all(r.batch_id == r.poll // 6 for r in rows)


class Handle:
    """One state value and the timers of a stateful processor, without a stream."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0

    def getValueState(self, *_, **__):
        return self

    def registerTimer(self, time):
        self.timers.add(time)

    def exists(self):
        self.calls += 1
        return self.value is not None

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def clear(self):
        self.calls += 1
        self.value = None

    def getCurrentProcessingTimeInMs(self):
        return self.now

    def getExpiryTimeInMs(self):
        return self.now


def test_many_waiting_messages_are_one_state(spark):
    handle, waits = Handle(), RetryLater(3, 100)
    waits.init(handle)

    def fail(now, *failures):
        handle.now = now
        frame = pd.DataFrame([["b", "snow", k, "t", "f", e, a, 0] for k, e, a in failures], columns=[*NOTIFICATION_FIELDS, "error", "attempt", "shard"])
        return [tuple(r) for out in waits.handleInputRows((0,), iter([frame]), handle) for r in out[["key", "error", "attempt", "action"]].values]

    def fire(now):
        handle.now = now
        return [tuple(r) for out in waits.handleExpiredTimer((0,), handle, handle) for r in out[["key", "error", "attempt", "action"]].values]

    assert fail(1000, *((f"k{i}", "gone", 1) for i in range(500)), ("k7", "gone", 1)) == []
    assert handle.calls <= 3 and handle.timers == {1100}
    assert fail(1050, ("k1", "still", 1), ("late", "gone", 2), ("k2", "gone", 3)) == [("k2", "gone", 3, "given up")]
    assert handle.timers == {1100, 1250}
    assert sorted(fire(1100)) == sorted([(f"k{i}", "gone", 1, "retry") for i in range(500) if i not in (1, 2)] + [("k1", "still", 1, "retry")])
    assert fire(1250) == [("late", "gone", 2, "retry")] and handle.value is None


def test_a_file_that_appears_late_is_read_once(spark, scratch):
    base = local(scratch)
    make_store(f"{base}/grid")
    use_state_store(spark)
    late = open(f"{base}/grid/k1.nc", "rb").read()
    os.replace(f"{base}/grid/k1.nc", f"{base}/late.nc")

    def process(messages):
        return ingest_files_and_rejects(messages, params(messages.sparkSession), base_uri=f"{base}/grid")

    bodies = spark.createDataFrame([(msg("rain", "k1.nc"),), (msg("rain", "k1.nc"),), (msg("snow", "never.nc"),), (msg("snow", "k0.nc"),)], "body string")
    rows, rejects = process(accepted(parse_notifications(bodies)))
    assert rows.count() == 24
    write_failed(rejects, f"{base}/failed", 1)
    with open(f"{base}/grid/k1.nc", "wb") as f:
        f.write(late)
    store = SnapshotStore(spark, f"{base}/out")
    q = start_retries(spark, f"{base}/failed", process, store, f"{base}/checkpoint", tries=3, delay="2 seconds", interval="500 milliseconds")
    try:
        end = time.monotonic() + 120
        while time.monotonic() < end and not [m for m in store.manifests() if m["frames"]["given_up"]["rows"]]:
            assert q.exception() is None
            time.sleep(0.5)
    finally:
        q.stop()
    assert [(r["file_name"][:5], r["count"]) for r in store.read("rows").groupBy("file_name").count().collect()] == [("rain_", 12)]
    assert [(r.key, r.attempt) for r in store.read("given_up").collect()] == [("never.nc", 3)]


def test_routed_counts_add_up(spark):
    bodies = spark.createDataFrame([(msg("snow", "k"),), (msg("none", "k"),), ("{",), (None,), (msg("rain", "k"),)], "body string")
    got = routed(bodies, params(spark)).groupBy("outcome").count()
    assert {r[0]: r[1] for r in got.collect()} == {"accepted": 2, "unmatched": 1, "rejected": 2}
    assert routed(bodies.filter("false"), params(spark)).count() == 0


@pytest.mark.parametrize("rows,tasks", [(0, 3), (1, 3), (250, 7), (300, 4)])
def test_files_of_exactly_n_lines(spark, scratch, rows, tasks):
    df = spark.range(rows).select(F.pmod(F.xxhash64("id"), F.lit(10_007)).alias("a"), "id").repartition(5)
    path = local(scratch)
    n = write_json_exact(df, path, 100, ["a", "id"], tasks)
    files = sorted(glob.glob(f"{path}/file=*"))
    got = [[json.loads(x) for f in sorted(glob.glob(f"{d}/*.json")) for x in open(f)] for d in sorted(files, key=lambda d: int(d.rsplit("=")[-1]))]
    assert n == len(files) == -(-rows // 100) and all(len(glob.glob(f"{d}/*.json")) == 1 for d in files)
    assert [len(x) for x in got] == [100] * (rows // 100) + ([rows % 100] if rows % 100 else [])
    assert [(x["a"], x["id"]) for g in got for x in g] == sorted((r.a, r.id) for r in df.collect())


def test_numbers_without_gaps(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    got = [(r.row, r.k, r.id) for r in numbered(df, ["k", "id"], "row", 6).orderBy("row").collect()]
    assert got == [(i, k, v) for i, (k, v) in enumerate(sorted((v % 7, v) for v in range(1000)))]
