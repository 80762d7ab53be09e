"""Pushed feature rows as a stream: history grows, latest values follow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tillwatch.plans.feature_store.online import LatestTable


def push_stream(stream: DataFrame, latest: LatestTable, history_path: str | None, checkpoint: str,
                name: str = "push", available_now: bool = True) -> StreamingQuery:
    """Append each batch to the history and push its newest rows per key.

    Newest is decided when values are read, by event time and created time, so the order of
    arrival does not matter; a batch that runs again replaces its own rows in both places.
    """
    def take(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if history_path is not None:
                batch.write.mode("overwrite").parquet(f"{history_path}/{name}={batch_id}")
            latest.push(batch, f"{name}-{batch_id}")
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    query = (writer.trigger(availableNow=True) if available_now else writer).start()
    if available_now:
        query.awaitTermination()
    return query
