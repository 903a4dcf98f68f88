"""P1, P3, ST3: every message of a poll with its outcome, from one parse.

``accepted`` messages have parameters, ``unmatched`` ones have none, ``rejected`` ones cannot
be used. They are written in one pass, in folders by outcome, and committed together
with the rows they led to.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridspark.functions.messages import parse_notifications
from gridspark.schema import NOTIFICATION_FIELDS
from gridspark.sinks.snapshot import SnapshotStore

ACCEPTED, REJECTED, UNMATCHED = "accepted", "rejected", "unmatched"


def routed(bodies: DataFrame, params: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The message fields, ``reject_reason`` and ``outcome`` of every row of ``bodies`` (body), one row for each;
    ``keep`` carries columns through. The parameter names are joined within the planner's size bound."""
    names = params.select(F.col("name").alias("p_name")).distinct()
    parsed = parse_notifications(bodies, keep=("body", *keep))
    usable = F.col("reject_reason").isNull()
    out = parsed.join(names, usable & (F.col("name") == F.col("p_name")), "left")
    outcome = F.when(~usable, REJECTED).when(F.col("p_name").isNull(), UNMATCHED).otherwise(ACCEPTED)
    return out.select(*keep, "body", *NOTIFICATION_FIELDS, "reject_reason", outcome.alias("outcome"))


def start_routed(bodies: DataFrame, params: Callable, store: SnapshotStore, checkpoint: str,
                 process: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None,
                 keep: tuple[str, ...] = (), interval: str = "0 seconds") -> StreamingQuery:
    """Run every poll of ``bodies``: its messages go to table ``outcomes`` of ``store`` (in folders by outcome). With
    ``process`` (accepted messages -> rows, messages whose file cannot be read), the results go to tables ``rows`` and
    ``dead`` in the same commit, so a poll's messages, rows and dead letters appear together, once.

    ``params(spark)`` gives the parameters. A replayed poll that is committed already is skipped.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        if store.committed(batch_id):
            return
        spark = batch.sparkSession
        outcomes = routed(batch, params(spark), keep)
        frames = {"outcomes": outcomes}
        if process is not None:
            fields = outcomes.filter(F.col("outcome") == ACCEPTED).select(*NOTIFICATION_FIELDS)
            if not fields.isEmpty():
                frames["rows"], frames["dead"] = process(fields)
        store.write(batch_id, frames, {"outcomes": ["outcome"]})

    return (bodies.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
            .trigger(processingTime=interval).start())
