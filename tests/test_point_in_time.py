"""The as-of join against hand cases and a plain loop, with and without split keys."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillwatch.operators.asof import AsofTable, asof_carry_all, point_in_time_join
from tillwatch.operators.skew import HotKeys

DAY = timedelta(days=1)
NOON = datetime(2024, 3, 10, 12)
FEATURE_DDL = "k BIGINT, event_ts TIMESTAMP, created TIMESTAMP, v BIGINT"
SPINE_DDL = "id BIGINT, k BIGINT, ts TIMESTAMP"
SPLITS = [HotKeys(), HotKeys(rows_per_task=1, max_keys=1_000_000)]

HAND = [
    ([(1, NOON - timedelta(hours=1), None, 1), (1, NOON - timedelta(minutes=30), None, 2)], 2),
    ([(1, NOON, None, 3)], 3),
    ([(1, NOON + timedelta(minutes=1), None, 4)], None),
    ([(1, NOON - DAY, None, 5)], 5),
    ([(1, NOON - DAY - timedelta(seconds=1), None, 6)], None),
    ([(1, NOON - timedelta(hours=1), NOON - timedelta(hours=3), 7),
      (1, NOON - timedelta(hours=1), NOON - timedelta(hours=2), 8)], 8),
    ([(1, NOON - timedelta(hours=1), None, 1), (1, NOON - timedelta(minutes=30), None, None)], None),
    ([(2, NOON, None, 9)], None),
]


@pytest.mark.parametrize("hot", SPLITS)
def test_hand_cases(spark, hot):
    # one key per case, so that all cases run in one job
    features, spine, expected = [], [], {}
    for i, (rows, want) in enumerate(HAND):
        features += [(k + 10 * i, *rest) for k, *rest in rows]
        spine.append((i, 1 + 10 * i, NOON))
        expected[i] = want
    out = point_in_time_join(spark.createDataFrame(spine, SPINE_DDL), spark.createDataFrame(features, FEATURE_DDL),
                             ["k"], "ts", "event_ts", ["v"], "created", DAY, hot)
    assert {r["id"]: r["v"] for r in out.collect()} == expected


def test_equal_spine_rows_stay(spark):
    spine = spark.createDataFrame([(1, 1, NOON), (1, 1, NOON)], SPINE_DDL)
    features = spark.createDataFrame([(1, NOON, None, 5)], FEATURE_DDL)
    out = point_in_time_join(spine, features, ["k"], "ts", "event_ts", ["v"], "created", DAY)
    assert [r["v"] for r in out.collect()] == [5, 5]


def _loop(spine, features, ttl):
    out = {}
    for i, k, ts in spine:
        best = None
        for fk, event, created, v in features:
            if fk == k and k is not None and event <= ts and (ttl is None or event >= ts - ttl):
                order = (event, created or datetime.min)
                if best is None or order > best[0]:
                    best = (order, v)
        out[i] = best[1] if best else None
    return out


def _random_tables(seed):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)

    def key():
        return rng.choice([1, 1, 1, 2, 3, 4, None])  # one hot key

    features = []
    for n in range(500):
        event = start + timedelta(minutes=15 * rng.randrange(400))
        created = None if rng.random() < 0.2 else event + timedelta(seconds=n)
        features.append((key(), event, created, rng.choice([None, n])))
    # a created time makes every tie decidable: keep one NULL-created row per (key, event)
    seen, unique = set(), []
    for row in features:
        if row[2] is None and (row[0], row[1]) in seen:
            continue
        if row[2] is None:
            seen.add((row[0], row[1]))
        unique.append(row)
    spine = [(i, key(), start + timedelta(minutes=5 * rng.randrange(1300))) for i in range(300)]
    return spine, unique


@pytest.mark.parametrize("hot", [HotKeys(), HotKeys(20, 1_000_000), HotKeys(1, 1_000_000)])
@pytest.mark.parametrize("ttl", [DAY, timedelta(hours=2), None])
def test_against_loop(spark, hot, ttl):
    spine, features = _random_tables(7)
    out = point_in_time_join(spark.createDataFrame(spine, SPINE_DDL), spark.createDataFrame(features, FEATURE_DDL),
                             ["k"], "ts", "event_ts", ["v"], "created", ttl, hot)
    assert {r["id"]: r["v"] for r in out.collect()} == _loop(spine, features, ttl)


def test_full_ties_are_decided_the_same_way(spark):
    features = spark.createDataFrame([(1, NOON, NOON, n) for n in range(20)], FEATURE_DDL)
    spine = spark.createDataFrame([(1, 1, NOON)], SPINE_DDL)
    got = set()
    for hot in SPLITS:
        for parts in (1, 7):
            got.add(point_in_time_join(spine, features.repartition(parts), ["k"], "ts", "event_ts", ["v"],
                                       "created", DAY, hot).first()["v"])
    assert len(got) == 1


def test_date_spine_does_not_see_its_own_day(spark):
    """Both sides are compared in the finer type; the spine comes back as it was."""
    spine = spark.createDataFrame([("7", datetime(2024, 1, 2).date())], "k STRING, day DATE")
    rows = spark.createDataFrame([(7, datetime(2024, 1, 1), 1.0), (7, datetime(2024, 1, 2, 15), 9.0)], "k BIGINT, at TIMESTAMP, v DOUBLE")
    for hot in SPLITS:
        out = point_in_time_join(spine, rows, ["k"], "day", "at", ["v"], hot_keys=hot)
        assert out.columns == ["k", "day", "v"] and [tuple(r) for r in out.collect()] == [("7", datetime(2024, 1, 2).date(), 1.0)]


def test_rows_out_of_reach_stay_out_of_the_shuffle(spark):
    spine = spark.createDataFrame([(1, datetime(2024, 1, 10))], "k BIGINT, at TIMESTAMP")
    rows = spark.createDataFrame([(1, datetime(2024, 1, d), float(d)) for d in range(1, 20)], "k BIGINT, ts TIMESTAMP, v DOUBLE")
    out = point_in_time_join(spine, rows, ["k"], "at", "ts", ["v"], ttl=timedelta(days=2))
    assert out.first()["v"] == 10.0
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan


@pytest.mark.parametrize("spine_text, feature_text", [(True, False), (False, True), (True, True)])
@pytest.mark.parametrize("hot", SPLITS)
def test_text_times_are_points_in_time(spark, spine_text, feature_text, hot):
    """'T' sorts after a blank: as text, the first row would see the evening of its own day."""
    spine = spark.createDataFrame([(1, "2024-01-02T00:00:00"), (1, "2024-01-02T23:30:00"), (1, None)], "k BIGINT, at STRING")
    features = spark.createDataFrame([(1, "2024-01-01 22:00:00", 1), (1, "2024-01-02 23:00:00", 2)], "k BIGINT, at STRING, v INT")
    if not spine_text:
        spine = spine.withColumn("at", F.col("at").cast("timestamp"))
    if not feature_text:
        features = features.withColumn("at", F.col("at").cast("timestamp"))
    out = point_in_time_join(spine, features, ["k"], "at", "at", ["v"], ttl=timedelta(hours=3), hot_keys=hot)
    assert out.schema["at"] == spine.schema["at"]
    assert [r["v"] for r in out.orderBy(F.col("at").asc_nulls_first()).collect()] == [None, 1, 2]


def test_text_that_is_no_time_is_an_error(spark):
    spine = spark.createDataFrame([(1, "soon")], "k BIGINT, at STRING")
    features = spark.createDataFrame([(1, datetime(2024, 1, 1), 1)], "k BIGINT, at TIMESTAMP, v INT")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        point_in_time_join(spine, features, ["k"], "at", "at", ["v"]).collect()


@pytest.mark.parametrize("hot", SPLITS)
def test_several_tables_at_once_equal_one_after_the_other(spark, hot):
    rnd = random.Random(4)

    def moment():
        return rnd.choice([None, *[NOON + timedelta(minutes=rnd.randrange(600)) for _ in range(9)]])

    spine = spark.createDataFrame([(i, rnd.choice([1, 2, None]), moment()) for i in range(60)], SPINE_DDL)
    first = spark.createDataFrame([(rnd.choice([1, 2, None]), moment(), moment(), i) for i in range(60)], FEATURE_DDL)
    second = spark.createDataFrame([(rnd.choice([1, 2]), None if (t := moment()) is None else str(t), rnd.choice([None, i])) for i in range(60)],
                                   "k INT, at STRING, w BIGINT")
    both = asof_carry_all(spine, [AsofTable(first, "event_ts", "created", ["v"]), AsofTable(second, "at", None, ["w"])], ["k"], "ts", hot)
    got = {r["id"]: (r["_carried_0"] and r["_carried_0"]["v"], r["_carried_1"] and r["_carried_1"]["w"]) for r in both.collect()}
    one = {r["id"]: r["v"] for r in point_in_time_join(spine, first, ["k"], "ts", "event_ts", ["v"], "created").collect()}
    two = {r["id"]: r["w"] for r in point_in_time_join(spine, second, ["k"], "ts", "at", ["w"]).collect()}
    assert got == {i: (one[i], two[i]) for i in one} and len(got) == 60 and both.columns[:3] == ["id", "k", "ts"]
