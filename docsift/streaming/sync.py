"""Continuous index sync from a stream of changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docsift.operators.changes import latest_per_key
from docsift.plans.index import Index, apply_changes


def without_resends(changes: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """Drop changes sent again within `delay`; state is kept for that long only."""
    timed = changes.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return timed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def continuous_sync(
    index: Index,
    changes: DataFrame,
    order: list[str],
    checkpoint: str,
    stream: str = "sync",
    once: bool = False,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Apply a stream of `(primary key, op, columns, order columns)` to the index.

    The newest change of a key by the order columns wins, within a micro-batch and
    over batches: a late one is passed over. The batch number is committed with the
    index version, so a batch that is replayed after a failure changes nothing.
    """
    key = index.info["primary_key"]

    def commit(batch: DataFrame, number: int) -> None:
        apply_changes(index, latest_per_key(batch, key, order), stream, number, order)

    writer = changes.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**trigger).start()
