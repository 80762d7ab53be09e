"""Recent-past features against a plain loop, for every way the work can be split."""

import random

import pytest

from tillwatch.operators import history
from tillwatch.operators.entity_features import customer_terminal_features
from tillwatch.operators.history import past_only_features, tx_frequency, with_earlier_amounts
from tillwatch.operators.skew import HotKeys

DDL = "id BIGINT, k BIGINT, t BIGINT, a DOUBLE"
FRAMES = {"short": 7, "long": 50}


def _rows(n=400, seed=3):
    rng = random.Random(seed)
    return [(i, rng.choice([1, 1, 1, 2, 3, None]), rng.choice([None] + list(range(-60, 200)) * 3),
             rng.choice([None, round(rng.uniform(-5, 90), 2)])) for i in range(n)]


def _mean(values):
    return sum(values) / len(values) if values else None


WAYS = [(HotKeys(), 2_000), (HotKeys(), 0), (HotKeys(5, 1_000_000), 80), (HotKeys(1, 1_000_000), 0)]


@pytest.mark.parametrize("hot,sliding", WAYS)
def test_past_only(spark, hot, sliding):
    rows = _rows()
    df = spark.createDataFrame(rows, DDL)
    out = past_only_features(df, df, "k", FRAMES, "c", hot, "t", "a", sliding).collect()
    assert len(out) == len(rows)
    for r in out:
        for name, length in FRAMES.items():
            if r["t"] is None:
                assert r[f"c_tx_count_{name}"] is None
                continue
            past = [a for _, k, t, a in rows if k == r["k"] and t is not None and a is not None
                    and r["t"] - length <= t <= r["t"] - 1]
            assert r[f"c_tx_count_{name}"] == len(past)
            assert r[f"c_avg_amount_{name}"] == pytest.approx(_mean(past))


@pytest.mark.parametrize("hot,sliding", WAYS)
def test_frequency_counts_own_second(spark, hot, sliding):
    rows = _rows(seed=4)
    df = spark.createDataFrame(rows, DDL)
    for r in tx_frequency(df, df, "k", FRAMES, "c", hot, "t", "a", sliding).collect():
        for name, length in FRAMES.items():
            want = None if r["t"] is None else sum(
                1 for _, k, t, _ in rows if k == r["k"] and t is not None and r["t"] - length <= t <= r["t"])
            assert r[f"c_tx_last_{name}"] == want


@pytest.mark.parametrize("hot", [HotKeys(), HotKeys(10, 1_000_000)])
def test_entity_features_equal_windows(spark, hot):
    _equal_windows(spark, hot)


# scattered hot keys; a window as no key is hot; a small table of keys whose size Spark would not broadcast by itself
@pytest.mark.parametrize("hot,joins,moves", [(HotKeys(10, 1_000_000, small_keys=1), 2, True),
                                             (HotKeys(280, 1_000_000, small_keys=1), 0, True), (HotKeys(10, 1_000_000), 2, False)])
def test_rows_stay_where_keys_are_few(spark, hot, joins, moves):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _equal_windows(spark, hot)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert ("Exchange hashpartitioning" in plan) == moves
    assert plan.count("BroadcastHashJoin") == joins


def _equal_windows(spark, hot):
    rng = random.Random(5)
    rows = [(i, rng.choice([1, 1, 2, None]), rng.choice([7, 7, 8, None]), rng.choice([None, float(rng.randrange(-3, 50))]))
            for i in range(300)]
    df = spark.createDataFrame(rows, "id BIGINT, customer_id BIGINT, terminal_id BIGINT, tx_amount DOUBLE")
    made = customer_terminal_features(df, hot)
    one = made.orderBy("id").collect()
    two = customer_terminal_features(df, as_window=True).orderBy("id").collect()
    assert len(one) == 300
    for a, b in zip(one, two):
        assert a.asDict() == pytest.approx(b.asDict())
    return made._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("bucket", [7, 1000])
def test_all_earlier_amounts(spark, bucket):
    rows = _rows(seed=6)
    got = with_earlier_amounts(spark.createDataFrame(rows, DDL), "k", "mean", "n", "t", "a", bucket).collect()
    assert len(got) == len(rows)
    for r in got:
        past = [] if r["t"] is None or r["k"] is None else [
            a for _, k, t, a in rows if k == r["k"] and t is not None and a is not None and t < r["t"]]
        assert r["n"] == len(past) and r["mean"] == pytest.approx(_mean(past))


@pytest.mark.parametrize("sliding", [0, 10 ** 6])
def test_tasks_grow_with_the_rows(spark, tmp_path, monkeypatch, sliding):
    """Beyond the rows of a task there are more tasks than Spark's own number, with the same results."""
    path = str(tmp_path / "rows")
    spark.range(4000).selectExpr("id", "id % 37 AS customer_id", "id * 50 AS tx_time_seconds", "CAST(id % 91 AS DOUBLE) AS tx_amount").write.parquet(path)
    rows = spark.read.parquet(path)

    def made():
        return past_only_features(rows, rows, "customer_id", {"a": 4000, "b": 90_000}, "c", sliding_rows=sliding)

    few = sorted(tuple(r) for r in made().collect())
    monkeypatch.setattr(history, "ROWS_PER_PART", 100)
    assert "REPARTITION_BY_NUM" in made()._jdf.queryExecution().toString()
    assert sorted(tuple(r) for r in made().collect()) == few
