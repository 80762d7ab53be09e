"""The streaming jobs over the event table, run to the end of what has arrived."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.catalog import batch
from tillwatch.catalog.features import FIELDS, stamp, stamp_sql
from tillwatch.catalog.inputs import (
    EVENT_DDL,
    as_transactions,
    driver_rows,
    events,
    scored,
    steady,
    steady_sql,
    with_parts,
)
from tillwatch.catalog.registry import query
from tillwatch.functions.amounts import above_mean
from tillwatch.operators.entity_features import ENTITY_COLUMNS
from tillwatch.plans import training
from tillwatch.plans.feature_store.online import LatestTable
from tillwatch.schema import TRANSACTION_COLUMNS
from tillwatch.session import scratch_path
from tillwatch.sources.paths import is_folder
from tillwatch.streaming import monitoring, pipeline, push

TX = ", ".join(TRANSACTION_COLUMNS)
DELAY = "1 hour"
TOTAL = "customer_total"


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    table = f"{folder}/events.parquet"
    if is_folder(spark, table):
        return pipeline.file_stream(spark, table, EVENT_DDL)
    return pipeline.file_stream(spark, folder, EVENT_DDL, pattern="events.parquet")


def transaction_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Dirty transactions with an event time that watermarks accept."""
    return as_transactions(event_stream(spark, folder)).withColumn("ts", F.col("ts").cast("timestamp"))


def written(spark: SparkSession, stream: DataFrame, name: str, closing: bool = True) -> DataFrame:
    path = scratch_path(spark, name)
    pipeline.run_available(stream, f"{path}/out", f"{path}/checkpoint", closing=closing, conf=pipeline.UNCOUNTED)
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


# ----- validate, de-duplicate -----

@query(with_parts(f"""SELECT reason, count(*) AS rows FROM (SELECT CASE
  WHEN {batch.BAD_DATE} THEN 'bad_date' WHEN tx_fraud IS NULL OR tx_fraud NOT IN (0, 1) THEN 'bad_label'
  WHEN customer_id < 0 THEN 'bad_customer' WHEN terminal_id < 0 THEN 'bad_terminal'
  WHEN tx_amount IS NULL THEN 'missing_amount' WHEN tx_amount <= 0 THEN 'nonpositive_amount' ELSE 'good' END AS reason
  FROM tx_raw) GROUP BY 1""", "tx_raw"))
def stream_validate(spark, folder):
    """Good rows and rejects in separate folders."""
    root = scratch_path(spark, "validated")
    pipeline.write_split(transaction_stream(spark, folder), f"{root}/good", f"{root}/rejected", f"{root}/checkpoint")
    good = spark.read.parquet(f"{root}/good").select(F.lit("good").alias("reason"))
    bad = spark.read.parquet(f"{root}/rejected").select(F.col("reject_reason").alias("reason"))
    return good.unionByName(bad).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


@query(with_parts(f"SELECT DISTINCT {TX} FROM tx_raw", "tx_raw"))
def stream_dedupe(spark, folder):
    rows = pipeline.dedupe_stream(transaction_stream(spark, folder), "ts", DELAY)
    return written(spark, rows, "deduped", closing=False).select(*TRANSACTION_COLUMNS)


# ----- windows -----

CLOSED = "(SELECT max(ts) - INTERVAL 1 HOUR FROM tx_timed)"


def _windows_sql(size: str, slides: int, slide: str) -> str:
    starts = f"unnest(range({slides}))" if slides > 1 else "0"
    return f"""SELECT {stamp_sql('window_start')}, {stamp_sql('window_end')}, customer_id, count(*) AS tx_count,
  {steady_sql('avg(tx_amount)', 5)} AS avg_amount FROM (SELECT *, window_start + INTERVAL {size} AS window_end FROM (
  SELECT *, time_bucket(INTERVAL {slide}, ts) - INTERVAL {slide} * i AS window_start FROM (
  SELECT *, {starts} AS i FROM tx_timed))) WHERE window_end <= {CLOSED} GROUP BY window_start, window_end, customer_id"""


def _windows(spark: SparkSession, folder: str, size: str, slide: str | None) -> DataFrame:
    rows = pipeline.frequency_windows(transaction_stream(spark, folder), "ts", DELAY, size, slide)
    return written(spark, rows, "windows").select(
        stamp("window_start"), stamp("window_end"), "customer_id", "tx_count",
        steady(F.col("avg_amount"), 5).alias("avg_amount"))


@query(with_parts(_windows_sql("1 HOUR", 1, "1 HOUR"), "tx_timed"))
def stream_tx_frequency(spark, folder):
    """Tumbling hours; only windows that the watermark has closed."""
    return _windows(spark, folder, "1 hour", None)


@query(with_parts(_windows_sql("1 HOUR", 4, "15 MINUTE"), "tx_timed"))
def stream_tx_frequency_sliding(spark, folder):
    return _windows(spark, folder, "1 hour", "15 minutes")


@query(with_parts(f"""SELECT {stamp_sql('window_start')}, customer_id, count(*) AS tx_count FROM (
  SELECT customer_id, time_bucket(INTERVAL 1 HOUR, ts) AS window_start FROM tx_timed
  WHERE NOT (transaction_id % 13 = 0 AND ts < TIMESTAMP '2024-01-03 00:00:00'))
  WHERE window_start + INTERVAL 1 HOUR <= {CLOSED} GROUP BY window_start, customer_id""", "tx_timed"))
def stream_late_data(spark, folder):
    """Events arrive in three deliveries; rows of the first days that come with the last one are too late."""
    root = scratch_path(spark, "late")
    rows = as_transactions(events(spark, folder)).withColumn("ts", F.col("ts").cast("timestamp"))
    late = F.expr("transaction_id % 13 = 0 AND ts < TIMESTAMP'2024-01-03 00:00:00'")
    third = F.when(late, 2).when(F.col("tx_time_days") < 10, 0).when(F.col("tx_time_days") < 20, 1).otherwise(2)
    for delivery in range(3):
        rows.filter(third == delivery).write.mode("append").parquet(f"{root}/in")
        stream = pipeline.file_stream(spark, f"{root}/in", rows.schema)
        windows = pipeline.frequency_windows(stream, "ts", DELAY, "1 hour")
        pipeline.run_available(windows, f"{root}/out", f"{root}/checkpoint")
    return (spark.read.schema(windows.schema).parquet(f"{root}/out")
            .select(stamp("window_start"), "customer_id", "tx_count"))


# ----- enrich, score, decide -----

def served(spark: SparkSession, stream: DataFrame, serve, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    pipeline.serve_batches(stream, serve, f"{path}/out", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/out").drop("batch")


def customer_values(spark: SparkSession, folder: str) -> LatestTable:
    """Latest sum, mean and number of amounts per customer, pushed from the stored histories."""
    mean, count = ENTITY_COLUMNS["customer_id"]
    totals = batch.entity_histories(spark, folder).of["customer_id"].totals(mean, count, TOTAL)
    rows = totals.withColumn("event_timestamp", F.timestamp_seconds(F.col("last_day") * batch.DAY)).drop("last_day")
    latest = LatestTable(spark, scratch_path(spark, "customer-values"), rows.schema, ["customer_id"], "event_timestamp", None)
    latest.push(rows, "totals")
    latest.materialize(spark.createDataFrame([], rows.schema), datetime(2024, 2, 15))
    return latest


@query(with_parts("""SELECT transaction_id, customer_id, customer_tx_count, score,
  CASE WHEN score >= CAST(0.7 AS DOUBLE) OR coalesce(tx_amount > 3 * avg_customer_amount, false) THEN 'decline'
  WHEN score >= CAST(0.4 AS DOUBLE) THEN 'manual_review' ELSE 'approve' END AS decision
  FROM tx_scored LEFT JOIN (SELECT customer_id, avg(tx_amount) AS avg_customer_amount,
  count(tx_amount) AS customer_tx_count FROM tx_clean GROUP BY 1) USING (customer_id)""", "tx_scored", "tx_clean"))
def stream_enrich_score_decide(spark, folder):
    """Each micro-batch looks its customers up in the latest table, then a fixed score, thresholds and one rule.

    The rule is counted in decimals: an amount of just three times the mean is not above it, in whatever order
    the mean was added up.
    """
    latest = customer_values(spark, folder)
    stream = transaction_stream(spark, folder)

    def serve(rows: DataFrame) -> DataFrame:
        enriched = latest.lookup(rows, [*ENTITY_COLUMNS["customer_id"], TOTAL])
        decided = pipeline.score_and_decide(enriched, scored, 0.4, 0.7, decline_rule=above_mean(
            F.col("tx_amount"), 3, F.col(TOTAL), F.col("customer_tx_count")))
        return decided.select("transaction_id", "customer_id", "customer_tx_count", "score", "decision")

    return served(spark, stream, serve, "decided")


def _past_sql(key: str, mean: str, count: str) -> str:
    return f"""(SELECT {key}, moment, total / nullif(n, 0) AS {mean}, n AS {count} FROM (SELECT {key}, tx_time_seconds AS moment,
  sum(sum(tx_amount)) OVER w AS total, CAST(sum(count(tx_amount)) OVER w AS BIGINT) AS n FROM tx_clean GROUP BY {key}, tx_time_seconds
  WINDOW w AS (PARTITION BY {key} ORDER BY tx_time_seconds)))"""


@query(with_parts(f"""SELECT transaction_id, coalesce(customer_tx_count, 0) AS customer_tx_count, coalesce(terminal_tx_count, 0) AS terminal_tx_count,
  {', '.join(f"{steady_sql(c, 5)} AS {c}" for c in batch.MEANS)}, is_scored, true AS decided, NOT is_scored AS reviewed_unscored
  FROM (SELECT s.*, c.*, t.*, tx_amount IS NOT NULL AND avg_customer_amount IS NOT NULL AND avg_terminal_amount IS NOT NULL AS is_scored
  FROM tx_timed s ASOF LEFT JOIN {_past_sql('customer_id', *ENTITY_COLUMNS['customer_id'])} c
  ON s.customer_id = c.customer_id AND s.tx_time_seconds > c.moment
  ASOF LEFT JOIN {_past_sql('terminal_id', *ENTITY_COLUMNS['terminal_id'])} t
  ON s.terminal_id = t.terminal_id AND s.tx_time_seconds > t.moment)""", "tx_timed", "tx_clean"))
def stream_model_decisions(spark, folder):
    """A trained pipeline scores the stream on the features it was trained on, looked up in the stored histories.

    Every arriving row gets a decision, a row without score a review.
    """
    trained = training.train_and_compare(batch.clean_table(spark, folder).filter(batch.EARLY), training.TrainingOptions(trees=5, depth=4))
    histories = batch.entity_histories(spark, folder)

    def serve(rows: DataFrame) -> DataFrame:
        return pipeline.score_and_decide(histories.features(rows), lambda df: training.score(df, trained.pipeline), 0.3, 0.6).select(
            "transaction_id", *batch.COUNTS, *batch.MEANS, "score", "decision")

    # The columns that features, score and decision need: a batch is kept while it is served.
    arriving = transaction_stream(spark, folder).select("transaction_id", "customer_id", "terminal_id", "tx_amount", "tx_time_seconds", "tx_time_days")
    out = served(spark, arriving, serve, "model-decided")
    known = F.col("score").isNotNull()
    return out.select("transaction_id", *batch.COUNTS, *[steady(F.col(c), 5).alias(c) for c in batch.MEANS], known.alias("is_scored"),
                      F.col("decision").isin("approve", "manual_review", "decline").alias("decided"),
                      (~known & (F.col("decision") == "manual_review")).alias("reviewed_unscored"))


# ----- monitoring -----

MONITOR_SQL = f"""SELECT {stamp_sql('window_start')}, {stamp_sql('window_end')}, volume, tp, fp, tn, fn,
  CAST(fn AS DOUBLE) / nullif(fn + tp, 0) AS fnr, CAST(fp AS DOUBLE) / nullif(fp + tn, 0) AS fpr,
  fn * CAST(100 AS DOUBLE) + fp * CAST(5 AS DOUBLE) AS loss FROM (SELECT window_start,
  window_start + INTERVAL 6 HOUR AS window_end, count(*) AS volume,
  count(*) FILTER (score >= CAST(0.4 AS DOUBLE) AND tx_fraud = 1) AS tp,
  count(*) FILTER (score >= CAST(0.4 AS DOUBLE) AND tx_fraud = 0) AS fp,
  count(*) FILTER (NOT score >= CAST(0.4 AS DOUBLE) AND tx_fraud = 0) AS tn,
  count(*) FILTER (NOT score >= CAST(0.4 AS DOUBLE) AND tx_fraud = 1) AS fn
  FROM (SELECT *, time_bucket(INTERVAL 6 HOUR, ts) AS window_start FROM tx_scored)
  GROUP BY window_start) WHERE window_end <= (SELECT max(ts) - INTERVAL 1 HOUR FROM tx_scored)"""


def _monitoring(spark: SparkSession, folder: str) -> DataFrame:
    rows = scored(transaction_stream(spark, folder))
    windows = monitoring.monitoring_windows(rows, "ts", "6 hours", 0.4, 100.0, 5.0, delay=DELAY, label="tx_fraud")
    return written(spark, windows, "monitoring")


@query(with_parts(MONITOR_SQL, "tx_scored"))
def stream_monitoring(spark, folder):
    return _monitoring(spark, folder).withColumns({
        "window_start": stamp("window_start"), "window_end": stamp("window_end")})


@query(with_parts(f"""SELECT window_start, volume, fnr, fpr, concat_ws(',', CASE WHEN fnr > CAST(0.5 AS DOUBLE)
  THEN 'fnr' END, CASE WHEN fpr > CAST(0.1 AS DOUBLE) THEN 'fpr' END) AS alert FROM ({MONITOR_SQL})
  WHERE fnr > CAST(0.5 AS DOUBLE) OR fpr > CAST(0.1 AS DOUBLE)""", "tx_scored"))
def stream_alerts(spark, folder):
    found = monitoring.alerts(_monitoring(spark, folder), 0.5, 0.1)
    return found.select(stamp("window_start"), "volume", "fnr", "fpr", "alert")


@query(with_parts("""SELECT DISTINCT transaction_id, score, tx_fraud AS label FROM tx_scored
  WHERE tx_fraud IN (0, 1)""", "tx_scored"))
def stream_late_labels(spark, folder):
    """Scores meet labels that arrive up to a day later."""
    scores = scored(transaction_stream(spark, folder)).select("transaction_id", "ts", "score")
    labels = (transaction_stream(spark, folder).filter("tx_fraud IN (0, 1)")
              .select("transaction_id", F.col("tx_fraud").alias("label"),
                      F.expr("ts + make_dt_interval(0, 0, CAST(transaction_id % 1200 AS INT), 0)").alias("label_ts")))
    joined = monitoring.join_late_labels(scores, labels, "transaction_id", "ts", "label_ts", DELAY, DELAY, "1 DAY")
    return written(spark, joined.select("transaction_id", "score", "label"), "late-labels", closing=False)


LATE_SQL = MONITOR_SQL.replace("FROM tx_scored)\n", "FROM (SELECT DISTINCT transaction_id, ts, score, tx_fraud FROM tx_scored))\n").replace(
    "INTERVAL 1 HOUR FROM tx_scored)", "INTERVAL 3 DAY FROM tx_scored)")


@query(with_parts(f"SELECT *, concat_ws(',', CASE WHEN fnr > CAST(0.5 AS DOUBLE) THEN 'fnr' END, CASE WHEN fpr > CAST(0.1 AS DOUBLE) "
                  f"THEN 'fpr' END) AS alert FROM ({LATE_SQL}) WHERE fnr > CAST(0.5 AS DOUBLE) OR fpr > CAST(0.1 AS DOUBLE)", "tx_scored"))
def stream_monitoring_late_labels(spark, folder):
    """Scores wait for their labels, then windows over all scores, then alerts: one stream.

    The last three days are left out: their windows are still open.
    """
    stream = transaction_stream(spark, folder)
    scores = scored(stream).select("transaction_id", "ts", "score")
    labels = (stream.filter("tx_fraud IN (0, 1)")
              .select("transaction_id", F.col("tx_fraud").alias("label"),
                      F.expr("ts + make_dt_interval(0, 0, CAST(transaction_id % 1200 AS INT), 0)").alias("label_ts")))
    windows = monitoring.monitor_late_labels(scores, labels, "transaction_id", "ts", "label_ts", DELAY, DELAY, "1 DAY",
                                             "6 hours", 0.4, 100.0, 5.0)
    found = written(spark, monitoring.alerts(windows, 0.5, 0.1), "late-monitoring")
    last = events(spark, folder).agg((F.max(F.col("ts").cast("timestamp")) - F.expr("INTERVAL 3 DAY")).alias("last")).scalar()
    return found.filter(F.col("window_end") <= last).withColumns({
        "window_start": stamp("window_start"), "window_end": stamp("window_end")})


# ----- pushed features -----

@query(with_parts("SELECT driver_id, arg_max(conv_rate, event_timestamp) AS conv_rate, "
                  "arg_max(acc_rate, event_timestamp) AS acc_rate, "
                  "arg_max(avg_daily_trips, event_timestamp) AS avg_daily_trips, "
                  "strftime(max(event_timestamp), '%Y-%m-%d %H:%M:%S.%f') AS event_timestamp FROM (SELECT user_id AS driver_id, "
                  "ts AS event_timestamp, value / 500 AS conv_rate, (event_id % 100) / CAST(100 AS DOUBLE) AS acc_rate, "
                  "event_id % 1000 AS avg_daily_trips FROM events) GROUP BY driver_id"))
def stream_push_ingest(spark, folder):
    """Every event is pushed: history grows, the newest row per driver is served."""
    root = scratch_path(spark, "push")
    stream = driver_rows(event_stream(spark, folder))
    latest = LatestTable(spark, f"{root}/latest", stream.schema, ["driver_id"], "event_timestamp", "created")
    push.push_stream(stream, latest, f"{root}/history", f"{root}/checkpoint")
    latest.materialize(spark.createDataFrame([], stream.schema), datetime(2024, 2, 15))
    return latest.read().select("driver_id", *FIELDS, stamp("event_timestamp"))
