"""Arriving transactions: read, validate, de-duplicate, count, score, decide."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillwatch.functions.decisions import decide
from tillwatch.functions.predicates import reject_reason


def file_stream(spark: SparkSession, folder: str, schema: T.StructType | str, pattern: str | None = None,
                files_per_batch: int | None = None, fmt: str = "parquet") -> DataFrame:
    """A folder as a stream of files."""
    reader = spark.readStream.format(fmt).schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


#: State lies in RocksDB beside the JVM heap, within a bound for each executor; a commit uploads what has changed.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "500",
}
#: Without the number of state rows in the progress, a write needs no look-up.
UNCOUNTED = {"spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}


@contextmanager
def durable_state(spark: SparkSession, conf: dict[str, str] | None = None) -> Iterator[None]:
    """Streams started inside keep their state by ``STATE_CONF``; the session's own settings win.

    A stream takes its settings when it starts, and one that goes on from a checkpoint keeps the state store it
    began with, so the session is given back as it was.
    """
    chosen = {k: v for k, v in {**STATE_CONF, **(conf or {})}.items() if not _is_set(spark, k)}
    for name, value in chosen.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in chosen:
            spark.conf.unset(name)


def _is_set(spark: SparkSession, name: str) -> bool:
    return spark._jsparkSession.sessionState().conf().contains(name)


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", closing: bool = True,
                  conf: dict[str, str] | None = None) -> StreamingQuery:
    """Write everything that has arrived to a Parquet folder and stop.

    ``closing``: a last batch without rows moves the watermark on, which closes windows and gives up waiting. A
    stream that writes each row as it comes, or as its partner comes, needs none: its old state goes in the next run.
    ``conf``: more settings of the stream.
    """
    with durable_state(stream.sparkSession, {"spark.sql.streaming.noDataMicroBatches.enabled": str(closing).lower(), **(conf or {})}):
        query = (stream.writeStream.format("parquet").outputMode(mode)
                 .option("path", path).option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    return query


def validate_stream(stream: DataFrame) -> DataFrame:
    """Every row with its ``reject_reason``; NULL = good. Stateless."""
    return stream.withColumn("reject_reason", reject_reason())


def write_split(stream: DataFrame, good: str, rejected: str, checkpoint: str) -> StreamingQuery:
    """Good and rejected rows to two folders, one read of the stream; a repeated batch replaces itself."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            ok = F.col("reject_reason").isNull()
            batch.filter(ok).drop("reject_reason").write.mode("overwrite").parquet(f"{good}/batch={batch_id}")
            batch.filter(~ok).write.mode("overwrite").parquet(f"{rejected}/batch={batch_id}")
        finally:
            batch.unpersist()

    query = (validate_stream(stream).writeStream.foreachBatch(write)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def dedupe_stream(stream: DataFrame, time: str, delay: str, key: str = "transaction_id",
                  lanes: int = 1) -> DataFrame:
    """One row per id among re-deliveries that arrive within ``delay`` of event time.

    ``lanes`` above 1 first removes copies within that many lanes per id, for intakes where copies
    of one id fill much of a batch: the last step then sees at most one row per id and lane. It
    costs a second state store.
    """
    timed = stream.withWatermark(time, delay)
    if lanes > 1:
        timed = (timed.withColumn("_lane", F.pmod(F.spark_partition_id(), F.lit(lanes)))
                 .dropDuplicatesWithinWatermark([key, "_lane"]).drop("_lane"))
    return timed.dropDuplicatesWithinWatermark([key])


def frequency_windows(stream: DataFrame, time: str, delay: str, size: str, slide: str | None = None,
                      key: str = "customer_id", amount: str = "tx_amount") -> DataFrame:
    """Rows and mean amount per key and tumbling or sliding window; late rows are dropped.

    Rows are added up per task before the state store sees them, so a busy key costs one row per
    task and window.
    """
    return (stream.withWatermark(time, delay)
            .groupBy(F.window(time, size, slide) if slide else F.window(time, size), key)
            .agg(F.count(F.lit(1)).alias("tx_count"), F.avg(amount).alias("avg_amount"))
            .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                    key, "tx_count", "avg_amount"))


def enrich_stream(stream: DataFrame, features: DataFrame, keys: list[str]) -> DataFrame:
    """Arriving rows with their prepared features; an unknown key gets NULLs.

    ``features`` is a stored table with one row per key. Spark measures it and broadcasts it only below
    its own size limit; beyond it the join shuffles.
    """
    return stream.join(features, keys, "left")


def serve_batches(stream: DataFrame, serve: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Write ``serve(batch)`` of every micro-batch that has arrived to a folder of its own, and stop.

    ``serve`` is called for each batch anew, so it sees tables as they are then (the latest values of a
    look-up), and counts and reads only what the batch's keys need. A repeated batch replaces its rows.
    """
    def take(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            serve(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        finally:
            batch.unpersist()

    with durable_state(stream.sparkSession):
        query = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    return query


def score_and_decide(stream: DataFrame, scorer: Callable[[DataFrame], DataFrame], review_at: float,
                     decline_at: float, decline_rule: Column | None = None,
                     review_rule: Column | None = None) -> DataFrame:
    """Add ``score`` by ``scorer`` (a model or an expression) and ``decision``."""
    return scorer(stream).withColumn(
        "decision", decide(F.col("score"), review_at, decline_at, decline_rule, review_rule))
