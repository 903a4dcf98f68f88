"""ST5, D5: redeliveries told apart by state for each announced object.

For every (bucket, key) the state holds the creation time of the newest version seen; it
expires when the key is silent for long enough. The state lies in ``SHARDS`` values of many keys each, so a batch
costs a call and a read and write of state for each shard, not for each key. Within one poll only a key's newest
message counts, also when a batch holds several polls. Every message gets a defined ``version``:

- ``newest``: newer than all the polls before held for the key, or the key's first; these are read
- ``repeated``: as new as what was seen (a redelivery)
- ``older``: it arrived late, after a newer version
- ``superseded``: its own poll holds a newer message (or a later one as new) for the key

Messages without a readable time are older than any with one and equal to one another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from gridspark.schema import NOTIFICATION_FIELDS
from gridspark.sinks.snapshot import SnapshotStore
from gridspark.streaming.shards import pack, shard, state_partitions, unpack

VERSIONED = ("file string, line long, bucket string, name string, key string, created_time string, "
             "forecast_reference_time string, poll long, version string")
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Before any readable time: messages without one.
UNTIMED = -(1 << 62)
# Before anything: nothing was seen.
UNSEEN = -(1 << 63)
OBJECT = ["bucket", "key"]


class NewestVersion(StatefulProcessor):
    """State of a shard: bucket, key, stamp of the newest version and the time it arrived."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", "known binary", ttlDurationMs=self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        batch = pd.concat(list(rows), ignore_index=True)
        known = unpack(self.newest.get() if self.newest.exists() else None, [*OBJECT, "stamp", "arrived"])
        known = known[known["arrived"].astype("int64") > now - self.keep_ms]
        order = batch.sort_values([*OBJECT, "poll", "stamp", "file", "line"])
        last = order[~order.duplicated([*OBJECT, "poll"], keep="last")]  # a key's newest message of each poll, polls in order
        before = last[OBJECT].merge(known, "left", OBJECT)["stamp"].fillna(UNSEEN).to_numpy(np.int64) if len(known) else UNSEEN
        seen = last.assign(top=last.groupby(OBJECT)["stamp"].cummax()).groupby(OBJECT)["top"].shift(1, fill_value=UNSEEN)
        seen = np.maximum(seen.to_numpy(np.int64), before)
        stamp = last["stamp"].to_numpy(np.int64)
        version = pd.Series("superseded", index=batch.index)
        version[last.index] = np.select([stamp > seen, stamp == seen], ["newest", "repeated"], "older")
        grown = last.loc[stamp > seen, [*OBJECT, "stamp"]].assign(arrived=now)
        if len(grown):
            self.newest.update((pack(pd.concat([known, grown]).drop_duplicates(OBJECT, keep="last")),))
        yield batch.drop(columns=["stamp", "shard"], errors="ignore").assign(version=version)

    def close(self) -> None:
        pass


def versioned(messages: DataFrame, keep: str = "7 days") -> DataFrame:
    """A stream of parsed messages (file, line, the message fields, and ``poll`` where a batch holds several) with their
    ``version``; a key's state is forgotten when ``keep`` has passed since its newest version arrived.

    Uses the RocksDB state store; call ``use_state_store`` on the session before the query starts.
    """
    from gridspark.streaming.ingest_stream import event_time

    stamp = F.coalesce(F.unix_millis(event_time()), F.lit(UNTIMED))
    poll = F.col("poll") if "poll" in messages.columns else F.lit(None)
    given = messages.select("file", "line", *NOTIFICATION_FIELDS, poll.cast("long").alias("poll"), stamp.alias("stamp"), shard(*OBJECT))
    millis = int(pd.Timedelta(keep).total_seconds() * 1000)
    return given.groupBy("shard").transformWithStateInPandas(
        statefulProcessor=NewestVersion(millis), outputStructType=VERSIONED, outputMode="Append", timeMode="ProcessingTime")


def start_versioned(messages: DataFrame, store: SnapshotStore, checkpoint: str, keep: str = "7 days",
                    interval: str = "0 seconds") -> StreamingQuery:
    """Run ``versioned`` and commit every poll's messages with their ``version`` to table ``versions`` of ``store``."""
    def each(batch: DataFrame, batch_id: int) -> None:
        if not store.write(batch_id, {"versions": batch}):
            batch.write.format("noop").mode("overwrite").save()  # a replay: the state must be run through all the same

    with state_partitions(messages.sparkSession):
        return (versioned(messages, keep).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
                .trigger(processingTime=interval).start())


def use_state_store(spark: SparkSession) -> None:
    """Streams started from now on keep their state in RocksDB, as keyed state with expiry needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
