"""Transactions, feature rows and runs derived from the given tables, in Spark and in SQL.

The dirt in the transactions depends on the id alone, so both engines see the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_DDL = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING")


def events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def steady(column: Column, digits: int = 6) -> Column:
    """Rounded for comparison between engines.

    A mean of cents over 32 rows ends exactly on a rounding boundary, where the summation order
    would decide the last digit. A shift by a thousandth of that digit moves such values off it.
    """
    return F.round(column + F.lit(0.001 * 10.0 ** -digits), digits)


def as_transactions(rows: DataFrame) -> DataFrame:
    """Events as dirty transactions with exact copies; works on a stream. Keeps ``ts``."""
    return rows.selectExpr(
        "event_id AS transaction_id",
        "CASE WHEN event_id % 101 = 0 THEN 'not-a-date' ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END AS tx_datetime",
        "CASE WHEN event_id % 83 = 0 THEN CAST(-1 AS BIGINT) ELSE user_id END AS customer_id",
        "CAST(get_json_object(props, '$.k') AS BIGINT) % 50 AS terminal_id",
        "CASE WHEN event_id % 97 = 0 THEN -value WHEN event_id % 73 = 0 THEN NULL ELSE value END AS tx_amount",
        "CAST(timestampdiff(SECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts) AS BIGINT) AS tx_time_seconds",
        "datediff(CAST(ts AS DATE), DATE'2024-01-01') AS tx_time_days",
        "CAST(CASE WHEN event_id % 79 = 0 THEN 2 WHEN event_id % 71 = 0 THEN NULL "
        "WHEN value > 120 THEN 1 ELSE 0 END AS INT) AS tx_fraud",
        "CAST(CASE WHEN value > 120 THEN 1 ELSE 0 END AS INT) AS tx_fraud_scenario",
        "ts",
        "explode(sequence(1, IF(event_id % 89 = 0, 2, 1))) AS copy_number").drop("copy_number")


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return as_transactions(events(spark, folder)).drop("ts")


def order_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """A larger clean-looking table: order lines, with ids that repeat for different rows."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).selectExpr(
        "l_orderkey * 8 + l_linenumber AS transaction_id",
        "date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss') AS tx_datetime",
        "o_custkey AS customer_id",
        "l_suppkey AS terminal_id",
        "l_extendedprice AS tx_amount",
        "CAST(datediff(CAST(l_shipdate AS DATE), DATE'1992-01-01') AS BIGINT) * 86400 AS tx_time_seconds",
        "datediff(CAST(l_shipdate AS DATE), DATE'1992-01-01') AS tx_time_days",
        "IF(l_returnflag = 'R', 1, 0) AS tx_fraud",
        "IF(l_returnflag = 'R', 1, 0) AS tx_fraud_scenario")


def scored(rows: DataFrame) -> DataFrame:
    """Fixed scores that any engine can compute: amount plus noise, and noise with less amount."""
    amount = "least(floor(coalesce(tx_amount, 0)), 499)"
    noise = "(transaction_id * 7919) % 1000"
    return rows.withColumns({
        "score": F.expr(f"CAST(2 * {amount} + {noise} AS DOUBLE) / CAST(2000 AS DOUBLE)"),
        "baseline_score": F.expr(f"CAST({amount} + 2 * ({noise}) AS DOUBLE) / CAST(2500 AS DOUBLE)")})


def labelled_scores(spark: SparkSession, folder: str) -> DataFrame:
    rows = transactions(spark, folder).filter("tx_fraud IN (0, 1)")
    return scored(rows).select("transaction_id", F.col("tx_fraud").alias("label"), "score", "baseline_score")


def driver_rows(rows: DataFrame) -> DataFrame:
    """Events as driver statistics."""
    return rows.selectExpr(
        "user_id AS driver_id", "ts AS event_timestamp", "ts AS created",
        "value / 500 AS conv_rate", "(event_id % 100) / CAST(100 AS DOUBLE) AS acc_rate",
        "event_id % 1000 AS avg_daily_trips")


def driver_stats(spark: SparkSession, folder: str) -> DataFrame:
    return driver_rows(events(spark, folder).filter("event_type <> 'purchase'"))


def driver_spine(spark: SparkSession, folder: str) -> DataFrame:
    return events(spark, folder).filter("event_type = 'purchase'").selectExpr(
        "event_id", "user_id AS driver_id", "ts AS event_timestamp", "event_id % 5 AS label",
        "event_id % 7 AS val_to_add", "event_id % 11 AS val_to_add_2")


def online_requests(spark: SparkSession, folder: str) -> DataFrame:
    """One request per customer key; many keys have no driver row."""
    return spark.read.parquet(f"{folder}/customer.parquet").selectExpr(
        "c_custkey AS driver_id", "CAST(c_nationkey AS BIGINT) AS val_to_add",
        "CAST(c_custkey % 13 AS BIGINT) AS val_to_add_2")


def runs(spark: SparkSession, folder: str) -> DataFrame:
    return events(spark, folder).selectExpr(
        "concat('run-', event_id) AS run_id", "event_type AS experiment",
        "CASE event_id % 5 WHEN 0 THEN 'RUNNING' WHEN 1 THEN 'FAILED' ELSE 'FINISHED' END AS status",
        "value / 500 AS best_auc",
        "IF(event_id % 2 = 0, 'logistic_regression', 'random_forest') AS best_model")


def model_versions(spark: SparkSession, folder: str) -> DataFrame:
    return events(spark, folder).filter("event_id % 11 <> 0").selectExpr(
        "'fraud-detector' AS name", "CAST(event_id + 1 AS INT) AS version", "concat('run-', event_id) AS run_id",
        "CASE event_id % 7 WHEN 0 THEN 'Production' WHEN 1 THEN 'Archived' WHEN 2 THEN 'Staging' "
        "ELSE 'None' END AS current_stage")


def run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Long metric rows, text values: two or three per run."""
    base = events(spark, folder)
    return base.selectExpr(
        "concat('run-', event_id) AS run_id",
        "explode(array(named_struct('metric', 'lr_auc', 'value', CAST(event_id % 1000 AS STRING)), "
        "named_struct('metric', 'rf_auc', 'value', CAST(event_id % 777 AS STRING)), "
        "named_struct('metric', 'best_model', 'value', event_type))) AS m").select("m.metric", "m.value", "run_id")


# ----- the same in SQL for the comparison engine -----

CTE = {
    "tx_events": "tx_events AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)",
    "tx_once": """tx_once AS (SELECT event_id AS transaction_id,
  CASE WHEN event_id % 101 = 0 THEN 'not-a-date' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS tx_datetime,
  CASE WHEN event_id % 83 = 0 THEN CAST(-1 AS BIGINT) ELSE user_id END AS customer_id,
  k % 50 AS terminal_id,
  CASE WHEN event_id % 97 = 0 THEN -value WHEN event_id % 73 = 0 THEN NULL ELSE value END AS tx_amount,
  CAST(epoch_us(ts) // 1000000 - 1704067200 AS BIGINT) AS tx_time_seconds,
  CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INT) AS tx_time_days,
  CAST(CASE WHEN event_id % 79 = 0 THEN 2 WHEN event_id % 71 = 0 THEN NULL
            WHEN value > 120 THEN 1 ELSE 0 END AS INT) AS tx_fraud,
  CAST(CASE WHEN value > 120 THEN 1 ELSE 0 END AS INT) AS tx_fraud_scenario, ts FROM tx_events)""",
    "tx_timed": "tx_timed AS (SELECT * FROM tx_once UNION ALL SELECT * FROM tx_once WHERE transaction_id % 89 = 0)",
    "tx_raw": "tx_raw AS (SELECT * EXCLUDE (ts) FROM tx_timed)",
    "tx_stats": """tx_stats AS (SELECT q1, q3, median, q1 - CAST(1.5 AS DOUBLE) * (q3 - q1) AS lower,
  q3 + CAST(1.5 AS DOUBLE) * (q3 - q1) AS upper FROM (SELECT quantile_disc(tx_amount, 0.25) AS q1,
  quantile_disc(tx_amount, 0.75) AS q3, quantile_disc(tx_amount, 0.5) AS median FROM tx_raw))""",
    "tx_kept": """tx_kept AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id
  ORDER BY tx_time_seconds) AS rn FROM tx_raw WHERE TRY_CAST(tx_datetime AS TIMESTAMP) IS NOT NULL
  AND tx_fraud IN (0, 1) AND customer_id >= 0 AND terminal_id >= 0) WHERE rn = 1)""",
    "tx_clean": """tx_clean AS (SELECT * REPLACE (CASE WHEN tx_amount <= 0 THEN median WHEN tx_amount < lower THEN lower
  WHEN tx_amount > upper THEN upper ELSE tx_amount END AS tx_amount)
  FROM (SELECT k.*, s.median, s.lower, s.upper FROM tx_kept k, tx_stats s))""",
    "tx_big": """tx_big AS (SELECT l_orderkey * 8 + l_linenumber AS transaction_id,
  strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS tx_datetime, o_custkey AS customer_id, l_suppkey AS terminal_id,
  l_extendedprice AS tx_amount,
  CAST(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) * 86400 AS tx_time_seconds,
  CAST(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS INT) AS tx_time_days,
  CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS INT) AS tx_fraud,
  CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS INT) AS tx_fraud_scenario
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "tx_scored": """tx_scored AS (SELECT *,
  CAST(2 * least(floor(coalesce(tx_amount, 0)), 499) + (transaction_id * 7919) % 1000 AS DOUBLE)
    / CAST(2000 AS DOUBLE) AS score,
  CAST(least(floor(coalesce(tx_amount, 0)), 499) + 2 * ((transaction_id * 7919) % 1000) AS DOUBLE)
    / CAST(2500 AS DOUBLE) AS baseline_score FROM tx_timed)""",
    "labelled": "labelled AS (SELECT transaction_id, tx_fraud AS label, score, baseline_score FROM tx_scored "
                "WHERE tx_fraud IN (0, 1))",
    "driver_stats": """driver_stats AS (SELECT event_id, user_id AS driver_id, ts AS event_timestamp, ts AS created,
  value / 500 AS conv_rate, (event_id % 100) / CAST(100 AS DOUBLE) AS acc_rate,
  event_id % 1000 AS avg_daily_trips FROM events WHERE event_type <> 'purchase')""",
    "driver_spine": """driver_spine AS (SELECT event_id, user_id AS driver_id, ts AS event_timestamp,
  event_id % 5 AS label, event_id % 7 AS val_to_add, event_id % 11 AS val_to_add_2
  FROM events WHERE event_type = 'purchase')""",
    "driver_pit": """driver_pit AS (SELECT s.*, f.event_timestamp AS f_ts,
  CASE WHEN f.event_timestamp >= s.event_timestamp - INTERVAL 1 DAY THEN f.conv_rate END AS conv_rate,
  CASE WHEN f.event_timestamp >= s.event_timestamp - INTERVAL 1 DAY THEN f.acc_rate END AS acc_rate,
  CASE WHEN f.event_timestamp >= s.event_timestamp - INTERVAL 1 DAY THEN f.avg_daily_trips END AS avg_daily_trips
  FROM driver_spine s ASOF LEFT JOIN driver_stats f
  ON s.driver_id = f.driver_id AND s.event_timestamp >= f.event_timestamp)""",
    "driver_f32": """driver_f32 AS (SELECT * REPLACE (CAST(CAST(conv_rate AS FLOAT) AS DOUBLE) AS conv_rate,
  CAST(CAST(acc_rate AS FLOAT) AS DOUBLE) AS acc_rate) FROM driver_pit)""",
    "requests": """requests AS (SELECT c_custkey AS driver_id, CAST(c_nationkey AS BIGINT) AS val_to_add,
  CAST(c_custkey % 13 AS BIGINT) AS val_to_add_2 FROM customer)""",
    "runs": """runs AS (SELECT concat('run-', event_id) AS run_id, event_type AS experiment,
  CASE event_id % 5 WHEN 0 THEN 'RUNNING' WHEN 1 THEN 'FAILED' ELSE 'FINISHED' END AS status,
  value / 500 AS best_auc,
  CASE WHEN event_id % 2 = 0 THEN 'logistic_regression' ELSE 'random_forest' END AS best_model FROM events)""",
    "versions": """versions AS (SELECT 'fraud-detector' AS name, CAST(event_id + 1 AS INT) AS version,
  concat('run-', event_id) AS run_id, CASE event_id % 7 WHEN 0 THEN 'Production' WHEN 1 THEN 'Archived'
  WHEN 2 THEN 'Staging' ELSE 'None' END AS current_stage FROM events WHERE event_id % 11 <> 0)""",
}

# what each part reads, in the order it must come
NEEDS = {
    "tx_once": ["tx_events"], "tx_timed": ["tx_once"], "tx_raw": ["tx_timed"], "tx_stats": ["tx_raw"],
    "tx_kept": ["tx_raw"], "tx_clean": ["tx_kept", "tx_stats"], "tx_scored": ["tx_timed"],
    "labelled": ["tx_scored"], "driver_pit": ["driver_spine", "driver_stats"], "driver_f32": ["driver_pit"],
}


def with_parts(query: str, *parts: str) -> str:
    """``query`` under a WITH clause of the named parts and all they need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for part in parts:
        add(part)
    return ("WITH " + ",\n".join(CTE[name] for name in ordered) + "\n" if ordered else "") + query


def steady_sql(expression: str, digits: int = 6) -> str:
    return f"round({expression} + CAST({0.001 * 10.0 ** -digits!r} AS DOUBLE), {digits})"
