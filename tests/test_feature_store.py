"""Definitions, retrieval, latest values, push."""

from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillwatch.operators.latest import latest_per_entity
from tillwatch.operators.skew import HotKeys
from tillwatch.plans.feature_store import (
    Entity,
    FeatureSource,
    FeatureStore,
    FeatureView,
    Field,
    OnDemandView,
    PushSource,
    RequestSource,
    on_demand,
)
from tillwatch.plans.feature_store.driver import driver_definitions
from tillwatch.plans.feature_store.online import LatestTable
from tillwatch.plans.feature_store.store import sorted_listing

STATS_DDL = ("driver_id BIGINT, event_timestamp TIMESTAMP, created TIMESTAMP, conv_rate FLOAT, acc_rate FLOAT, "
             "avg_daily_trips BIGINT")
T0 = datetime(2023, 10, 2)


def _hours(n):
    return T0 + timedelta(hours=n)


ROWS = [(61, _hours(8), _hours(8), 0.5, 0.25, 10), (61, _hours(10), _hours(10), 0.75, 0.5, 20),
        (62, _hours(7), _hours(7), 0.125, 1.0, 7), (63, _hours(-20), _hours(-20), 0.5, 0.5, 1)]


@pytest.fixture
def store(spark, tmp_path):
    path = str(tmp_path / "stats")
    spark.createDataFrame(ROWS, STATS_DDL).write.parquet(path)
    source = FeatureSource("driver_hourly_stats_source", path, created_field="created")
    return FeatureStore(spark, driver_definitions(source, str(tmp_path / "served")), str(tmp_path / "online"))


@pytest.fixture
def spine(spark):
    rows = [(61, _hours(11.25), 4, 3, 41), (62, _hours(9), 9, 5, 17), (63, _hours(18), 0, 8, 2)]
    return spark.createDataFrame(rows, "driver_id BIGINT, event_timestamp TIMESTAMP, stars BIGINT, "
                                       "val_to_add BIGINT, val_to_add_2 BIGINT")


def _requests(spark):
    return spark.createDataFrame([(61, 500, 900), (62, 11, 13), (7, 1, 1)],
                                 "driver_id BIGINT, val_to_add BIGINT, val_to_add_2 BIGINT")


def _by_driver(df):
    return {r["driver_id"]: r.asDict() for r in df.collect()}


def test_historical(store, spine):
    out = store.get_historical_features(spine, [
        "driver_hourly_stats:conv_rate", "driver_hourly_stats:acc_rate", "driver_hourly_stats:avg_daily_trips",
        "transformed_conv_rate:conv_rate_plus_val1", "transformed_conv_rate:conv_rate_plus_val2"])
    kinds = dict(out.dtypes)
    assert kinds["conv_rate"] == "float" and kinds["conv_rate_plus_val1"] == "double"
    assert kinds["avg_daily_trips"] == "bigint"
    rows = _by_driver(out)
    assert rows[61]["conv_rate"] == 0.75 and rows[61]["conv_rate_plus_val2"] == 41.75
    assert rows[62]["stars"] == 9 and rows[62]["conv_rate_plus_val1"] == 5.125
    assert rows[63]["conv_rate"] is None and rows[63]["conv_rate_plus_val1"] is None  # older than a day


def test_services(store, spine):
    columns = {}
    for n in (1, 2, 3, 4):
        out = store.get_historical_features(spine, store.get_feature_service(f"driver_activity_v{n}"))
        columns[n] = [c for c in out.columns if c not in spine.columns]
    sums = ["conv_rate_plus_val1", "conv_rate_plus_val2"]
    stats = ["conv_rate", "acc_rate", "avg_daily_trips"]
    assert columns == {1: ["conv_rate", *sums], 2: [*stats, *sums], 3: [*stats, *sums],
                       4: [*stats, "combined_rating", "performance_score"]}


def test_extra_spine_columns_and_scoring(store, spine):
    wide = spine.withColumn("request_multiplier", F.lit(1.1))
    out = store.features_for_scoring(wide, ["driver_quality_fv:conv_rate"], _hours(11))
    rows = _by_driver(out)
    assert rows[62]["conv_rate"] == 0.125 and rows[63]["conv_rate"] is None
    assert {r["event_timestamp"] for r in rows.values()} == {_hours(11)}
    assert rows[61]["request_multiplier"] == 1.1


def test_views_of_one_source_share_a_join(store, spine):
    def windows(references):
        plan = store.get_historical_features(spine, references)._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("Window [last")

    one = windows(["driver_quality_fv:conv_rate"])
    assert one > 0
    assert windows(["driver_quality_fv:conv_rate", "driver_activity_fv:avg_daily_trips",
                    "driver_hourly_stats:acc_rate"]) == one


def test_names_must_be_unique(store, spine):
    twice = ["driver_hourly_stats:conv_rate", "driver_quality_fv:conv_rate"]
    with pytest.raises(ValueError):
        store.get_historical_features(spine, twice)
    out = store.get_historical_features(spine, twice, full_names=True)
    assert {"driver_hourly_stats__conv_rate", "driver_quality_fv__conv_rate"} <= set(out.columns)
    with pytest.raises(KeyError):
        store.get_historical_features(spine, ["driver_hourly_stats:trips_per_week"])
    with pytest.raises(ValueError):
        store.get_historical_features(spine.drop("val_to_add"), ["transformed_conv_rate:conv_rate_plus_val1"])


def test_pandas_hook_equals_columns(spark, store, spine):
    hourly = store.get_feature_view("driver_hourly_stats")

    @on_demand(sources=[hourly], schema=[Field("busy", "Int64"), Field("spread", "Float64")])
    def pandas_view(inputs: pd.DataFrame) -> pd.DataFrame:
        gap = inputs["acc_rate"].astype("float64") - inputs["conv_rate"].astype("float64")
        return pd.DataFrame({"busy": (inputs["avg_daily_trips"] > 15).astype("int64"), "spread": gap.abs()})

    assert isinstance(pandas_view, OnDemandView)
    both = FeatureStore(spark, [*store.views.values(), pandas_view])
    wide = spine.withColumn("big", F.when(F.col("driver_id") != 62, F.lit(9007199254740993)))
    rows = _by_driver(both.get_historical_features(wide, ["pandas_view:busy", "pandas_view:spread"]))
    assert [rows[k]["busy"] for k in (61, 62)] == [1, 0]
    assert [rows[k]["spread"] for k in (61, 62)] == [0.25, 0.875]
    # what is no input does not pass through pandas
    assert [rows[k]["big"] for k in (61, 62, 63)] == [9007199254740993, None, 9007199254740993]


def test_online_before_and_after_push(spark, store):
    store.materialize_incremental(_hours(12))
    asked = ["driver_hourly_stats:acc_rate", "transformed_conv_rate:conv_rate_plus_val1"]
    rows = _by_driver(store.get_online_features(_requests(spark), asked))
    assert rows[61]["acc_rate"] == 0.5 and rows[61]["conv_rate_plus_val1"] == 500.75
    assert rows[7]["acc_rate"] is None
    v3 = store.get_feature_service("driver_activity_v3")
    event = spark.createDataFrame([(61, _hours(13), _hours(13), 1.0, 1.0, 44)], STATS_DDL)
    late = spark.createDataFrame([(62, _hours(1), _hours(14), 0.0, 0.0, 0)], STATS_DDL)
    store.push("driver_stats_push_source", event, push_id="a")
    store.push("driver_stats_push_source", late, push_id="b")
    rows = _by_driver(store.get_online_features(_requests(spark), v3))
    assert rows[61]["avg_daily_trips"] == 44 and rows[61]["conv_rate_plus_val2"] == 901.0
    assert rows[62]["conv_rate"] == 0.125  # the late row does not win
    # the plain view has not been pushed to; the batch table has both rows
    assert _by_driver(store.get_online_features(_requests(spark), asked))[61]["acc_rate"] == 0.5
    assert store.get_feature_view("driver_hourly_stats").source.read(spark).count() == len(ROWS) + 2
    # pushed rows survive the next snapshots
    for hours in (20, 30):
        store.materialize_incremental(_hours(hours))
        assert _by_driver(store.get_online_features(_requests(spark), v3))[61]["avg_daily_trips"] == 44
    assert _by_driver(store.get_online_features(_requests(spark), asked))[61]["acc_rate"] == 1.0


def test_a_push_outlives_materialise_runs(spark, tmp_path):
    """A push that began before two runs and ends after them is neither lost nor folded twice."""
    rows = [(1, _hours(1), _hours(1), 0.5, 0.5, 1)]
    latest = LatestTable(spark, str(tmp_path / "t"), spark.createDataFrame([], STATS_DDL).schema, ["driver_id"],
                         "event_timestamp", "created")
    history = spark.createDataFrame(rows, STATS_DDL)
    latest.push(spark.createDataFrame([(2, _hours(2), _hours(2), 1.0, 1.0, 2)], STATS_DDL), "first")
    latest.push(spark.createDataFrame([(3, _hours(3), _hours(3), 1.0, 1.0, 3)], STATS_DDL), "slow")
    done = tmp_path / "t" / "pushed" / "push_id=slow" / "_SUCCESS"
    done.unlink()  # still being written
    latest.materialize(history, _hours(5))
    latest.materialize(history, _hours(6))
    assert sorted(r["driver_id"] for r in latest.read().collect()) == [1, 2]
    done.touch()
    assert sorted(r["driver_id"] for r in latest.read().collect()) == [1, 2, 3]
    for hour in (7, 8, 9):
        latest.materialize(history, _hours(hour))
        assert sorted(r["driver_id"] for r in latest.read().collect()) == [1, 2, 3]
    assert not (tmp_path / "t" / "pushed" / "push_id=first").exists()


def test_views_with_other_keys_have_tables_of_their_own(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.createDataFrame([(1, 10, _hours(1), 5.0), (2, 10, _hours(2), 6.0)], "c BIGINT, t BIGINT, at TIMESTAMP, v DOUBLE").write.parquet(path)
    source = PushSource("pushed", FeatureSource("rows", path, "at"))
    views = [FeatureView(f"by_{k}", (Entity(k, (k,)),), (Field("v", "Float64"),), source) for k in ("c", "t")]
    store = FeatureStore(spark, [*views, source], str(tmp_path / "online"))
    assert set(store.materialize_incremental(_hours(5)).values()) == {1}
    asked = spark.createDataFrame([(1, 10), (2, 11)], "c BIGINT, t BIGINT")

    def values():
        return [tuple(r) for r in store.get_online_features(asked, ["by_c:v", "by_t:v"], full_names=True).orderBy("c").collect()]

    assert values() == [(1, 10, 5.0, 6.0), (2, 11, 6.0, None)]
    new = spark.createDataFrame([(1, 11, _hours(6), 7.0)], "c BIGINT, t BIGINT, at TIMESTAMP, v DOUBLE")
    for _ in range(2):
        store.push("pushed", new, push_id="p")
    assert values() == [(1, 10, 7.0, 6.0), (2, 11, 6.0, 7.0)]
    assert source.batch.read(spark).count() == 3


def test_incremental_equals_rebuild(spark, tmp_path):
    rows = [(k, _hours(h), _hours(h), h / 10, 0.5, h) for k in (1, 2, 3) for h in range(k, 30, k + 1)]
    source = FeatureSource("s", created_field="created", table=lambda s: s.createDataFrame(rows, STATS_DDL))
    view = FeatureView("v", (Entity("driver", ("driver_id",)),), (Field("avg_daily_trips", "Int64"),), source)
    step = FeatureStore(spark, [view], str(tmp_path / "step"))
    for h in (5, 11, 12, 40):
        step.materialize_incremental(_hours(h))
    once = FeatureStore(spark, [view], str(tmp_path / "once"))
    once.materialize_incremental(_hours(40))
    a, b = (_by_driver(s.latest_table(view).read()) for s in (step, once))
    assert a == b and len(a) == 3


def test_max_age(spark, store):
    store.materialize_incremental(_hours(12))
    rows = _by_driver(store.get_online_features(_requests(spark), ["driver_quality_fv:conv_rate"], now=_hours(12),
                                                max_age=timedelta(hours=3)))
    assert rows[61]["conv_rate"] == 0.75 and rows[62]["conv_rate"] is None


def test_latest_ties(spark):
    df = spark.createDataFrame([(1, T0, _hours(1), 5.0, 0.0, 1), (1, T0, _hours(2), 6.0, 0.0, 1),
                                (1, T0, None, 9.0, 0.0, 1), (None, T0, T0, 1.0, 1.0, 1)], STATS_DDL)
    assert [r["conv_rate"] for r in latest_per_entity(df, ["driver_id"], "event_timestamp", "created").collect()] == [6.0]


def test_describe_log_listing(spark, store, spine):
    rows = {r["name"]: r for r in store.describe().collect()}
    assert set(rows) == {"driver_hourly_stats", "driver_hourly_stats_fresh", "driver_quality_fv", "driver_activity_fv"}
    assert rows["driver_quality_fv"]["features"] == ["conv_rate", "acc_rate"]
    assert rows["driver_quality_fv"]["ttl_seconds"] == 86_400 and rows["driver_quality_fv"]["entities"] == ["driver"]
    known = store.describe(_hours(30)).filter("name = 'driver_quality_fv'").first()
    times = [r[1] for r in ROWS]
    assert (known["rows"], known["first_event"], known["last_event"]) == (len(ROWS), min(times), max(times))
    assert known["age_seconds"] == (_hours(30) - max(times)).total_seconds()
    service = store.get_feature_service("driver_activity_v1")
    served = store.get_historical_features(spine, service)
    for _ in range(2):
        store.log_served(served, service.name, _hours(12))
    logged = spark.read.parquet(service.log_path)
    assert logged.count() == 6 and {"served_at", "service"} <= set(logged.columns)
    listing = sorted_listing(served.select("driver_id", "val_to_add", "conv_rate").filter("driver_id = 61"), ["driver_id"])
    assert [(r["feature"], r["value"]) for r in listing.collect()] == [("conv_rate", "0.75"), ("val_to_add", "3")]


def test_hot_driver(spark, store, spine):
    plain = _by_driver(store.get_historical_features(spine, store.get_feature_service("driver_activity_v2")))
    store.hot_keys = HotKeys(1, 1_000_000)
    assert _by_driver(store.get_historical_features(spine, store.get_feature_service("driver_activity_v2"))) == plain


def test_definitions_are_checked(spark):
    source = FeatureSource("s", "x")
    view = FeatureView("v", (Entity("e", ("k",)),), (Field("f", "Int64"),), source)
    with pytest.raises(ValueError):
        FeatureStore(spark, [view, view])
    with pytest.raises(KeyError):
        view[["g"]]
    assert PushSource("p", source).batch is source
    with pytest.raises(ValueError):
        RequestSource("r", (Field("z", "Int64"),)).check(spark.range(1))
