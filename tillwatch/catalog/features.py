"""Feature store, run history and promotion."""

from __future__ import annotations

from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.catalog.inputs import (
    driver_rows,
    driver_spine,
    driver_stats,
    events,
    labelled_scores,
    model_versions,
    online_requests,
    runs,
    steady,
    steady_sql,
    with_parts,
)
from tillwatch.catalog.registry import query
from tillwatch.operators.asof import point_in_time_join as join_asof
from tillwatch.operators.evaluation import curve_areas, score_curve
from tillwatch.operators.latest import latest_per_entity as newest
from tillwatch.operators.skew import HotKeys
from tillwatch.plans import tracking
from tillwatch.plans.feature_store import (Entity, FeatureSource, FeatureStore, FeatureView, Field, RequestSource,
                                             on_demand)
from tillwatch.plans.feature_store.driver import ONE_DAY, driver_definitions
from tillwatch.plans.feature_store.store import sorted_listing
from tillwatch.session import scratch_path
from tillwatch.sources.transactions import preview

FIELDS = ["conv_rate", "acc_rate", "avg_daily_trips"]


def stamp(column: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(column)


def stamp_sql(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') AS {column}"


def driver_store(spark: SparkSession, folder: str, root: str | None = None, path: str | None = None) -> FeatureStore:
    source = FeatureSource("driver_hourly_stats_source", path=path, created_field="created",
                           table=None if path else (lambda s: driver_stats(s, folder)))
    return FeatureStore(spark, driver_definitions(source, log_path=f"{root}/served" if root else None), root)


# ----- point in time -----

PIT_SQL = with_parts(f"SELECT event_id, driver_id, {stamp_sql('event_timestamp')}, label, conv_rate, acc_rate, "
                     "avg_daily_trips FROM driver_pit", "driver_pit")


@query(PIT_SQL)
def point_in_time_join(spark, folder):
    out = join_asof(driver_spine(spark, folder), driver_stats(spark, folder), ["driver_id"], "event_timestamp",
                    "event_timestamp", FIELDS, "created", ONE_DAY)
    return out.select("event_id", "driver_id", stamp("event_timestamp"), "label", *FIELDS)


@query(PIT_SQL)
def point_in_time_join_text_spine(spark, folder):
    """The spine's times as ISO text with a 'T', the features' as text with a blank: points in time all the same."""
    spine = driver_spine(spark, folder).withColumn("event_timestamp", F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    stats = driver_stats(spark, folder).withColumn("event_timestamp", F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    out = join_asof(spine, stats, ["driver_id"], "event_timestamp", "event_timestamp", FIELDS, "created", ONE_DAY)
    return out.select("event_id", "driver_id", F.translate("event_timestamp", "T", " ").alias("event_timestamp"), "label", *FIELDS)


@query(PIT_SQL)
def point_in_time_join_hot_keys(spark, folder):
    """Every driver with more than ten rows goes through moments and time buckets."""
    out = join_asof(driver_spine(spark, folder), driver_stats(spark, folder), ["driver_id"], "event_timestamp",
                    "event_timestamp", FIELDS, "created", ONE_DAY, HotKeys(10, 100_000), "hour")
    return out.select("event_id", "driver_id", stamp("event_timestamp"), "label", *FIELDS)


@query(with_parts("""SELECT event_id, driver_id, CAST(day AS VARCHAR) AS day,
  CASE WHEN f_ts >= day - INTERVAL 1 DAY THEN conv_rate END AS conv_rate FROM (SELECT s.event_id, s.driver_id,
  CAST(s.event_timestamp AS DATE) AS day, f.event_timestamp AS f_ts, f.conv_rate FROM driver_spine s ASOF LEFT JOIN driver_stats f
  ON s.driver_id = f.driver_id AND CAST(CAST(s.event_timestamp AS DATE) AS TIMESTAMP) >= f.event_timestamp)""",
                  "driver_spine", "driver_stats"))
def point_in_time_join_date_spine(spark, folder):
    """A date asks for what was known when the day began, not for rows of that day."""
    spine = driver_spine(spark, folder).select("event_id", F.col("driver_id").cast("int").alias("driver_id"),
                                               F.to_date("event_timestamp").alias("day"))
    out = join_asof(spine, driver_stats(spark, folder), ["driver_id"], "day", "event_timestamp", ["conv_rate"], "created", ONE_DAY)
    return out.select("event_id", F.col("driver_id").cast("bigint").alias("driver_id"), F.col("day").cast("string").alias("day"), "conv_rate")


def _widened(df: DataFrame) -> DataFrame:
    """32-bit features as doubles, long decimals steadied."""
    out = df
    for name, kind in df.dtypes:
        if kind == "float":
            out = out.withColumn(name, F.col(name).cast("double"))
    for name in ("combined_rating", "performance_score", "realtime_efficiency"):
        if name in df.columns:
            out = out.withColumn(name, steady(F.col(name)))
    return out.drop("event_timestamp")


SPINE_SQL = "event_id, driver_id, label, val_to_add, val_to_add_2"
SUMS_SQL = "conv_rate + val_to_add AS conv_rate_plus_val1, conv_rate + val_to_add_2 AS conv_rate_plus_val2"
ALL_SQL = "conv_rate, acc_rate, avg_daily_trips"
RATING = "(conv_rate * CAST(0.6 AS DOUBLE) + acc_rate * CAST(0.4 AS DOUBLE))"
RATED_SQL = (f"{steady_sql(RATING)} AS combined_rating, "
             f"{steady_sql(f'{RATING} * ln(1 + avg_daily_trips)')} AS performance_score")
REALTIME_SQL = f"acc_rate - conv_rate AS acceptance_gap, {steady_sql('avg_daily_trips * acc_rate')} AS realtime_efficiency"


def _historical(features, sql: str, name: str):
    @query(with_parts(f"SELECT {SPINE_SQL}, {sql} FROM driver_f32", "driver_f32"), name=name)
    def run(spark, folder):
        store = driver_store(spark, folder)
        chosen = store.get_feature_service(features) if isinstance(features, str) else features
        return _widened(store.get_historical_features(driver_spine(spark, folder), chosen))


_historical("driver_activity_v1", f"conv_rate, {SUMS_SQL}", "historical_features_v1")
_historical("driver_activity_v2", f"{ALL_SQL}, {SUMS_SQL}", "historical_features_v2")
_historical("driver_activity_v3", f"{ALL_SQL}, {SUMS_SQL}", "historical_features_v3")
_historical("driver_activity_v4", f"{ALL_SQL}, {RATED_SQL}", "historical_features_v4")
_historical(["driver_quality_fv:conv_rate", "driver_quality_fv:acc_rate", "driver_activity_fv:avg_daily_trips",
             "driver_realtime_metrics:acceptance_gap", "driver_realtime_metrics:realtime_efficiency"],
            f"{ALL_SQL}, {REALTIME_SQL}", "realtime_metrics")
_historical(["driver_performance_metrics:combined_rating", "driver_performance_metrics:performance_score"],
            RATED_SQL, "performance_metrics")
_historical(["driver_quality_fv:conv_rate", "driver_activity_fv:avg_daily_trips", "driver_hourly_stats:acc_rate"],
            "conv_rate, avg_daily_trips, acc_rate", "multi_view_join")


@query(with_parts("""SELECT s.event_id, CAST(CAST(f.conv_rate AS FLOAT) AS DOUBLE) AS conv_rate, CAST(CAST(o.o_totalprice AS FLOAT) AS DOUBLE) AS last_price
  FROM driver_spine s ASOF LEFT JOIN driver_stats f ON s.driver_id = f.driver_id AND s.event_timestamp >= f.event_timestamp
  ASOF LEFT JOIN (SELECT user_id AS o_driver, ts AS o_ts, value AS o_totalprice FROM events WHERE event_type = 'click') o
  ON s.driver_id = o.o_driver AND s.event_timestamp >= o.o_ts + INTERVAL 1 HOUR""", "driver_spine", "driver_stats"))
def multi_source_join(spark, folder):
    """Views on two different tables with the same key: one window carries both."""
    driver = Entity("driver", ("driver_id",))
    late = FeatureSource("clicks", timestamp_field="seen", table=lambda s: events(s, folder).filter("event_type = 'click'").selectExpr(
        "user_id AS driver_id", "ts + INTERVAL 1 HOUR AS seen", "value AS last_price"))
    stats = FeatureSource("stats", created_field="created", table=lambda s: driver_stats(s, folder))
    views = [FeatureView("rates", (driver,), (Field("conv_rate", "Float32"),), stats),
             FeatureView("prices", (driver,), (Field("last_price", "Float32"),), late)]
    out = FeatureStore(spark, views).get_historical_features(driver_spine(spark, folder), ["rates:conv_rate", "prices:last_price"])
    return _widened(out).select("event_id", "conv_rate", "last_price")


@query(with_parts(f"SELECT {SPINE_SQL}, {RATED_SQL} FROM driver_f32", "driver_f32"))
def performance_metrics_pandas(spark, folder):
    """The same features by a user's pandas function, batch by batch."""
    base = driver_store(spark, folder)
    hourly = base.get_feature_view("driver_hourly_stats")

    @on_demand(sources=[hourly], schema=[Field("combined_rating", "Float64"), Field("performance_score", "Float64")])
    def rated_in_pandas(inputs: pd.DataFrame) -> pd.DataFrame:
        rating = 0.6 * inputs["conv_rate"].astype("float64") + 0.4 * inputs["acc_rate"].astype("float64")
        return pd.DataFrame({"combined_rating": rating,
                             "performance_score": rating * np.log1p(inputs["avg_daily_trips"])})

    store = FeatureStore(spark, [hourly, rated_in_pandas])
    return _widened(store.get_historical_features(
        driver_spine(spark, folder), ["rated_in_pandas:combined_rating", "rated_in_pandas:performance_score"]))


@query(with_parts(f"SELECT {SPINE_SQL}, conv_rate, CAST(acc_rate AS DOUBLE) AS acc_rate FROM (SELECT s.*, "
                  "CAST(CAST(f.conv_rate AS FLOAT) AS DOUBLE) AS conv_rate, CAST(f.acc_rate AS FLOAT) AS acc_rate "
                  "FROM driver_spine s LEFT JOIN (SELECT driver_id, arg_max(conv_rate, event_timestamp) AS conv_rate, "
                  "arg_max(acc_rate, event_timestamp) AS acc_rate FROM driver_stats "
                  "WHERE event_timestamp <= TIMESTAMP '2024-01-20 00:00:00' GROUP BY 1 "
                  "HAVING max(event_timestamp) >= TIMESTAMP '2024-01-19 00:00:00') f USING (driver_id))",
                  "driver_spine", "driver_stats"))
def historical_for_scoring(spark, folder):
    """Every spine row asked at one moment; older than a day means no value."""
    store = driver_store(spark, folder)
    out = store.features_for_scoring(driver_spine(spark, folder),
                                     ["driver_hourly_stats:conv_rate", "driver_hourly_stats:acc_rate"],
                                     datetime(2024, 1, 20))
    return _widened(out)


@query(with_parts(f"SELECT {SPINE_SQL}, {ALL_SQL}, {SUMS_SQL} FROM driver_f32 ORDER BY event_id LIMIT 5", "driver_f32"))
def head_of_training_frame(spark, folder):
    store = driver_store(spark, folder)
    out = store.get_historical_features(driver_spine(spark, folder), store.get_feature_service("driver_activity_v2"))
    return preview(_widened(out).orderBy("event_id"))


# ----- latest values -----

LATEST_SQL = """SELECT driver_id, arg_max(conv_rate, event_timestamp) AS conv_rate,
  arg_max(acc_rate, event_timestamp) AS acc_rate, arg_max(avg_daily_trips, event_timestamp) AS avg_daily_trips,
  max(event_timestamp) AS event_timestamp FROM {table} {where} GROUP BY driver_id"""


@query(with_parts(f"SELECT driver_id, {ALL_SQL}, {stamp_sql('event_timestamp')} FROM ("
                  + LATEST_SQL.format(table="driver_stats", where="") + ")", "driver_stats"))
def latest_per_entity(spark, folder):
    out = newest(driver_stats(spark, folder), ["driver_id"], "event_timestamp", "created")
    return out.select("driver_id", *FIELDS, stamp("event_timestamp"))


def _online_sql(values: str, table: str = "driver_stats", where: str = "") -> str:
    return (f"SELECT driver_id, val_to_add, val_to_add_2, {values} FROM (SELECT r.*, "
            "CAST(CAST(l.conv_rate AS FLOAT) AS DOUBLE) AS conv_rate, "
            "CAST(CAST(l.acc_rate AS FLOAT) AS DOUBLE) AS acc_rate, l.avg_daily_trips FROM requests r LEFT JOIN ("
            + LATEST_SQL.format(table=table, where=where) + ") l USING (driver_id))")


@query(with_parts(_online_sql(f"{ALL_SQL}, {SUMS_SQL}"), "driver_stats", "requests"))
def online_features(spark, folder):
    """Two incremental loads into the latest table, then a lookup through a service."""
    store = driver_store(spark, folder, scratch_path(spark, "store"))
    store.materialize_incremental(datetime(2024, 1, 15))
    store.materialize_incremental(datetime(2024, 2, 15))
    out = store.get_online_features(online_requests(spark, folder), store.get_feature_service("driver_activity_v2"))
    return _widened(out)


PUSHED = "(SELECT * FROM driver_stats UNION ALL SELECT event_id, user_id, ts, ts, value / 500, " \
         "(event_id % 100) / CAST(100 AS DOUBLE), event_id % 1000 FROM events WHERE event_type = 'purchase')"


@query(with_parts(_online_sql(f"{ALL_SQL}, {SUMS_SQL}", table=PUSHED), "driver_stats", "requests"))
def online_after_push(spark, folder):
    """History is materialised, the remaining events are pushed, the fresh view shows the newer of both."""
    root = scratch_path(spark, "store")
    driver_stats(spark, folder).write.parquet(f"{root}/history")
    store = driver_store(spark, folder, root, path=f"{root}/history")
    store.materialize_incremental(datetime(2024, 2, 15))
    store.push("driver_stats_push_source", driver_rows(events(spark, folder).filter("event_type = 'purchase'")))
    out = store.get_online_features(online_requests(spark, folder), store.get_feature_service("driver_activity_v3"))
    return _widened(out)


@query(with_parts("SELECT event_id AS n FROM driver_stats LIMIT 0", "driver_stats")
       .replace("SELECT event_id AS n FROM driver_stats LIMIT 0",
                "SELECT driver_id, conv_rate, acc_rate, avg_daily_trips FROM " + PUSHED))
def append_offline(spark, folder):
    """Pushed rows end up in the batch table next to its own rows."""
    root = scratch_path(spark, "store")
    driver_stats(spark, folder).write.parquet(f"{root}/history")
    store = driver_store(spark, folder, root, path=f"{root}/history")
    store.push("driver_stats_push_source", driver_rows(events(spark, folder).filter("event_type = 'purchase'")),
               online=False)
    return store.push_sources["driver_stats_push_source"].batch.read(spark).select("driver_id", *FIELDS)


@query(with_parts("SELECT driver_id, conv_rate, acc_rate, avg_daily_trips FROM " + PUSHED, "driver_stats"))
def push_repeated(spark, folder):
    """The same push twice, as after a retry: its rows count once."""
    root = scratch_path(spark, "store")
    driver_stats(spark, folder).write.parquet(f"{root}/history")
    store = driver_store(spark, folder, root, path=f"{root}/history")
    for _ in range(2):
        store.push("driver_stats_push_source", driver_rows(events(spark, folder).filter("event_type = 'purchase'")), push_id="same")
    return store.push_sources["driver_stats_push_source"].batch.read(spark).select("driver_id", *FIELDS)


@query(with_parts("""SELECT r.driver_id, r.val_to_add AS avg_daily_trips, a.acc_rate AS by_driver, b.conv_rate AS by_trips
  FROM requests r LEFT JOIN (SELECT driver_id, arg_max(acc_rate, event_timestamp) AS acc_rate FROM driver_stats GROUP BY 1) a
  USING (driver_id) LEFT JOIN (SELECT avg_daily_trips, arg_max(conv_rate, event_timestamp) AS conv_rate FROM driver_stats
  GROUP BY 1) b ON b.avg_daily_trips = r.val_to_add""", "driver_stats", "requests"))
def online_two_entities(spark, folder):
    """Two views of one source with different keys: each has latest values of its own."""
    source = FeatureSource("stats", created_field="created", table=lambda s: driver_stats(s, folder))
    views = [FeatureView("of_driver", (Entity("driver", ("driver_id",)),), (Field("acc_rate", "Float64"),), source),
             FeatureView("of_trips", (Entity("trips", ("avg_daily_trips",)),), (Field("conv_rate", "Float64"),), source)]
    store = FeatureStore(spark, views, scratch_path(spark, "store"))
    store.materialize_incremental(datetime(2024, 2, 15))
    asked = online_requests(spark, folder).select("driver_id", F.col("val_to_add").alias("avg_daily_trips"))
    out = store.get_online_features(asked, ["of_driver:acc_rate", "of_trips:conv_rate"])
    return out.withColumnsRenamed({"acc_rate": "by_driver", "conv_rate": "by_trips"})


@query("""SELECT CASE WHEN event_id % 3 <> 0 THEN event_id + 9007199254740993 END AS big_id, user_id AS driver_id,
  CASE WHEN event_id % 3 <> 0 THEN value * 2 END AS twice FROM events""")
def pandas_view_large_ids(spark, folder):
    """Columns that are no inputs do not pass through pandas: ids above 2^53 with NULLs stay exact."""
    request = RequestSource("amount", (Field("value", "Float64"),))

    @on_demand(sources=[request], schema=[Field("twice", "Float64")])
    def doubled(inputs: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"twice": inputs["value"] * 2})

    rows = events(spark, folder).selectExpr("IF(event_id % 3 <> 0, event_id + 9007199254740993, NULL) AS big_id",
                                            "user_id AS driver_id", "IF(event_id % 3 <> 0, value, NULL) AS value")
    return FeatureStore(spark, [doubled]).get_historical_features(rows, ["doubled:twice"], timestamp="driver_id").drop("value")


@query(with_parts(f"""SELECT name, true AS one_day, 'driver' AS entity, rows, {stamp_sql('first_event')}, {stamp_sql('last_event')}, age_seconds
  FROM (SELECT count(*) AS rows, min(event_timestamp) AS first_event, max(event_timestamp) AS last_event,
  CAST(epoch_us(TIMESTAMP '2024-03-01 00:00:00') // 1000000 - epoch_us(max(event_timestamp)) // 1000000 AS BIGINT) AS age_seconds FROM driver_stats),
  (VALUES ('driver_activity_fv'), ('driver_hourly_stats'), ('driver_hourly_stats_fresh'), ('driver_quality_fv')) t(name)""", "driver_stats"))
def describe_views(spark, folder):
    """Each view with the rows, time range and age of its source."""
    rows = driver_store(spark, folder).describe(datetime(2024, 3, 1))
    return rows.select("name", (F.col("ttl_seconds") == 86_400).alias("one_day"), F.col("entities")[0].alias("entity"),
                       "rows", stamp("first_event"), stamp("last_event"), "age_seconds")


@query(with_parts("""SELECT run_id, best_auc, CAST(row_number() OVER (ORDER BY run_id) AS INTEGER) AS version, 'None' AS stage
  FROM runs WHERE status = 'FINISHED'""", "runs"))
def run_log_and_versions(spark, folder):
    """All runs are logged, the finished ones registered in two batches of ids, then read back."""
    tracker = tracking.Tracker(spark, scratch_path(spark, "tracking"))
    values = [F.create_map(F.lit("best_auc"), F.col("best_auc").cast("string")).alias("metrics"),
              F.create_map(F.lit("seed"), F.lit("42")).alias("params")]
    tracker.log_runs(runs(spark, folder).select("*", *values))
    finished = tracker.runs().filter("status = 'FINISHED'")
    for batch in (F.col("run_id") < "run-5", F.col("run_id") >= "run-5"):
        tracker.register_versions("fraud-detector", finished.filter(batch))
    return tracker.runs().join(tracker.versions(), "run_id").select(
        "run_id", "best_auc", "version", F.col("current_stage").alias("stage"))


@query(with_parts("""SELECT driver_id, u.feature, u.value FROM (SELECT driver_id,
  [{'feature': 'avg_daily_trips', 'value': CAST(avg_daily_trips AS VARCHAR)},
   {'feature': 'val_to_add', 'value': CAST(val_to_add AS VARCHAR)},
   {'feature': 'val_to_add_2', 'value': CAST(val_to_add_2 AS VARCHAR)}] AS us FROM ("""
                  + _online_sql("avg_daily_trips") + ")) t, unnest(t.us) AS x(u)", "driver_stats", "requests"))
def sorted_feature_listing(spark, folder):
    store = driver_store(spark, folder)
    latest = newest(driver_stats(spark, folder), ["driver_id"], "event_timestamp", "created")
    out = store.get_online_features(online_requests(spark, folder), ["driver_activity_fv:avg_daily_trips"],
                                    tables={"driver_hourly_stats_source": latest})
    return sorted_listing(out, ["driver_id"])


@query(with_parts(f"SELECT {SPINE_SQL}, conv_rate, {SUMS_SQL}, 'driver_activity_v1' AS service, "
                  "'2024-02-01 00:00:00.000000' AS served_at FROM driver_f32", "driver_f32"))
def feature_log(spark, folder):
    """Served features of a service, logged and read back."""
    store = driver_store(spark, folder, scratch_path(spark, "store"))
    service = store.get_feature_service("driver_activity_v1")
    served = store.get_historical_features(driver_spine(spark, folder), service)
    store.log_served(served, service.name, datetime(2024, 2, 1))
    return _widened(spark.read.parquet(service.log_path).withColumn("served_at", stamp("served_at")))


# ----- runs and versions -----

BEST_SQL = ("SELECT * FROM runs WHERE status = 'FINISHED' AND experiment = 'purchase' "
            "ORDER BY best_auc DESC, run_id LIMIT 20")


@query(with_parts(BEST_SQL, "runs"))
def best_runs(spark, folder):
    return tracking.best_runs(runs(spark, folder), "purchase")


VERSION_SQL = f"""SELECT v.* FROM (SELECT run_id FROM ({BEST_SQL}) ORDER BY best_auc DESC, run_id LIMIT 1) b
  JOIN versions v USING (run_id) WHERE v.name = 'fraud-detector' ORDER BY v.version DESC LIMIT 1"""


@query(with_parts(VERSION_SQL, "runs", "versions"))
def run_to_version(spark, folder):
    return tracking.run_version(tracking.best_runs(runs(spark, folder), "purchase"),
                                model_versions(spark, folder), "fraud-detector")


@query(with_parts(f"""SELECT name, version, run_id, CASE WHEN version = chosen THEN 'Production'
  WHEN chosen IS NOT NULL AND current_stage = 'Production' THEN 'Archived' ELSE current_stage END AS current_stage
  FROM (SELECT *, (SELECT version FROM ({VERSION_SQL}) WHERE current_stage <> 'Production') AS chosen FROM versions)""",
                  "runs", "versions"))
def promote(spark, folder):
    return tracking.promote(runs(spark, folder), model_versions(spark, folder), "purchase", "fraud-detector")


AUC = """SELECT (sum(r) FILTER (label = 1) - CAST(count(*) FILTER (label = 1) AS DOUBLE)
  * (count(*) FILTER (label = 1) + 1) / 2) / (CAST(count(*) FILTER (label = 1) AS DOUBLE)
  * count(*) FILTER (label = 0)) FROM (SELECT label, rank() OVER (ORDER BY {s})
  + (count(*) OVER (PARTITION BY {s}) - 1) / CAST(2 AS DOUBLE) AS r FROM labelled)"""


@query(with_parts(f"""SELECT model, {steady_sql('auc', 8)} AS auc FROM (SELECT 'logistic_regression' AS model,
  ({AUC.format(s='baseline_score')}) AS auc, 0 AS rank UNION ALL SELECT 'random_forest', ({AUC.format(s='score')}), 1)
  ORDER BY auc DESC, rank LIMIT 1""", "labelled"))
def best_model_of_two(spark, folder):
    """Two fixed scores stand for the two models."""
    rows = labelled_scores(spark, folder)
    parts = [curve_areas(score_curve(rows.select(F.col(c).alias("score"), "label")))
             .select(F.lit(i).alias("rank"), F.lit(n).alias("model"), F.col("roc_auc").alias("auc"), "pr_auc")
             for i, (n, c) in enumerate([("logistic_regression", "baseline_score"), ("random_forest", "score")])]
    best = tracking.best_of_models(parts[0].unionByName(parts[1]))
    return best.select("model", steady(F.col("auc"), 8).alias("auc"))
