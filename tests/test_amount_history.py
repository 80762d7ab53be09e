"""Stored running amounts: any order of loads gives what one pass over all earlier rows gives."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillwatch.functions.amounts import above_mean
from tillwatch.operators.skew import HotKeys
from tillwatch.plans import amount_history, training
from tillwatch.plans.amount_history import DAY, AmountHistory, EntityHistories

DDL = "id BIGINT, k BIGINT, t BIGINT, a DOUBLE"


def _made(seed=1, n=400):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice([1, 1, 1, 2, 3, None]), rnd.choice([None, *[rnd.randrange(-2 * DAY, 6 * DAY) for _ in range(20)], 5, 5, DAY - 1, DAY]),
             rnd.choice([None, rnd.randrange(1, 100) / 4])) for i in range(n)]
    return rows + [(9000 + i, 7, 3 * DAY + 5, 1.0) for i in range(50)]


def _plain(rows, asked):
    out = {}
    for i, k, t, _ in asked:
        past = [a for _, key, at, a in rows if a is not None and None not in (k, t, at) and key == k and at < t]
        out[i] = (round(sum(past) / len(past), 9) if past else None, len(past))
    return out


def _got(history, frame, **options):
    found = history.attach(frame, "mean", "count", **options)
    assert found.columns == ["id", "k", "t", "a", "mean", "count"]
    rows = found.collect()
    assert len(rows) == frame.count()
    return {r["id"]: (None if r["mean"] is None else round(r["mean"], 9), r["count"]) for r in rows}


@pytest.mark.parametrize("cut", ["time", "mixed"])
def test_loads_equal_one_pass(spark, tmp_path, cut):
    rows = _made()
    loads = [[r for r in rows if (r[2] or 0) < 2 * DAY], [r for r in rows if (r[2] or 0) >= 2 * DAY]]
    if cut == "mixed":  # every load has rows of all days, late ones too
        loads = [rows[i::3] for i in range(3)]
    history, known = AmountHistory(spark, str(tmp_path), "k", "t", "a", parts=4), []
    for number, load in enumerate(loads):
        frame = spark.createDataFrame(load, DDL)
        history.extend(frame, f"load-{number}")
        known += load
        assert _got(history, frame) == _plain(known, load)
    everything = spark.createDataFrame(rows, DDL)
    history.extend(spark.createDataFrame(loads[0], DDL), "load-0")  # a load that runs again
    assert _got(history, everything) == _plain(rows, rows)
    assert _got(history, everything, hot_keys=HotKeys(1, 1_000_000)) == _plain(rows, rows)


def test_rows_that_are_in_no_load(spark, tmp_path):
    history = AmountHistory(spark, str(tmp_path), "k", "t", "a", parts=4)
    new = [(1, 1, 10 * DAY, 5.0), (2, 99, 5, 1.0), (3, None, 5, 1.0), (4, 1, None, 1.0), (5, 1, -9 * DAY, 1.0)]
    frame = spark.createDataFrame(new, DDL)
    assert _got(history, frame) == {i: (None, 0) for i in range(1, 6)}  # nothing stored yet
    rows = _made(2)
    history.extend(spark.createDataFrame(rows, DDL), "all")
    assert _got(history, frame) == _plain(rows, new)
    history.extend(spark.createDataFrame([], DDL), "empty")
    assert _got(history, frame.limit(0)) == {}


def test_a_look_up_reads_its_days_and_parts(spark, tmp_path):
    history = AmountHistory(spark, str(tmp_path), "k", "t", "a", parts=16)
    history.extend(spark.range(3000).selectExpr("id", "id % 200 AS k", f"id * 500 AS t", "1.5D AS a"), "all")
    asked = spark.createDataFrame([(1, 5, 3 * DAY + 7, 1.0), (2, 6, 9 * DAY, 1.0)], DDL)
    found = history.attach(asked, "mean", "count")
    read = {str(Path(f).parent).split(str(tmp_path))[1] for f in found.inputFiles()}
    assert {p.split("/")[2] for p in read if "/moments/" in p} <= {"day=3", "day=9"}
    assert len({p for p in read if "/days/" in p}) <= 2
    assert {r["id"]: r["count"] for r in found.collect()} == {1: 3, 2: 8}


def test_a_load_rewrites_only_its_parts(spark, tmp_path):
    history = AmountHistory(spark, str(tmp_path), "k", "t", "a", parts=16)
    history.extend(spark.range(3000).selectExpr("id", "id % 200 AS k", "id * 500 AS t", "1.5D AS a"), "all")
    before = history.days.head().runs
    history.extend(spark.createDataFrame([(1, 5, 20 * DAY, 1.0), (2, 6, 20 * DAY, 1.0)], DDL), "two")
    after = history.days.head().runs
    assert 1 <= len([p for p in after if after[p] != before[p]]) <= 2 and len(before) == 16


def test_features_are_those_of_training(spark, folder, tmp_path):
    from tillwatch.catalog import batch

    clean = batch.clean_table(spark, folder)
    histories = EntityHistories(spark, str(tmp_path), parts=8)
    early = F.col("tx_time_days") < 15
    histories.extend(clean.filter(early), "early")
    histories.extend(clean.filter(~early), "late")
    columns = ["transaction_id", "avg_customer_amount", "customer_tx_count", "avg_terminal_amount", "terminal_tx_count", "customer_amount_ratio"]
    ours, theirs = histories.features(clean).select(columns).collect(), training.past_features(clean).select(columns).collect()
    plain = {r[0]: [None if v is None else round(v, 6) for v in r[1:]] for r in theirs}
    assert {r[0]: [None if v is None else round(v, 6) for v in r[1:]] for r in ours} == plain


def test_sums_and_limits_do_not_depend_on_the_order(spark, tmp_path):
    """Ten times 0.1 are 1 whatever is added first, and three times their mean is not less than 0.3."""
    rows = spark.createDataFrame([(1, i, 0.1) for i in range(10)] + [(2, 5, float("nan")), (2, 6, 1e300), (3, 7, None)],
                                 "customer_id LONG, tx_time_seconds LONG, tx_amount DOUBLE").coalesce(1)
    history = AmountHistory(spark, str(tmp_path), "customer_id", parts=2)
    history.extend(rows, "all")
    found = {r["customer_id"]: r for r in history.totals("mean", "n").withColumns({
        "above": above_mean(F.lit(0.3), 3, F.col("total"), F.col("n")),
        "beyond": above_mean(F.lit(0.300001), 3, F.col("total"), F.col("n"))}).collect()}
    assert (found[1]["total"], found[1]["mean"], found[1]["n"], found[1]["above"], found[1]["beyond"]) == (1.0, 0.1, 10, False, True)
    assert found[2]["total"] != found[2]["total"] and found[2]["n"] == 2 and found[2]["above"] is False
    assert found[3]["n"] == 0 and found[3]["above"] is None


def test_many_pairs_and_many_tasks(spark, tmp_path, monkeypatch):
    """Moments that are not cut to what is asked, and more tasks than one: the same features."""
    monkeypatch.setattr(amount_history, "FEW_PAIRS", 0)
    monkeypatch.setattr(amount_history, "ASKING_ROWS", 50)
    rows = _made(3)
    history = AmountHistory(spark, str(tmp_path), "k", "t", "a", parts=4)
    history.extend(spark.createDataFrame(rows, DDL), "all")
    asked = [r for r in rows if r[1] != 1]  # days that are stored for other keys too
    found = history.attach(spark.createDataFrame(asked, DDL), "mean", "count")
    assert "hashpartitioning(_h_key" in found._jdf.queryExecution().executedPlan().toString()
    assert {r["id"]: (r["mean"] and round(r["mean"], 9), r["count"]) for r in found.collect()} == _plain(rows, asked)


def test_features_do_not_repeat_the_look_up_before(spark, folder, tmp_path):
    """Each entity asks in the rows themselves: the first look-up stands once in the plan, and no row is joined."""
    from tillwatch.catalog import batch

    clean = batch.clean_table(spark, folder)
    histories = EntityHistories(spark, str(tmp_path), parts=4)
    histories.extend(clean, "all")
    found = histories.features(clean)
    plan = found._jdf.queryExecution().analyzed().toString()
    assert plan.count("Relation [transaction_id") <= 5  # the rows once, and the keys and days of each entity twice
    assert "LeftOuter" not in plan


def test_a_load_leaves_the_other_keys_of_its_days(spark, tmp_path):
    history = AmountHistory(spark, str(tmp_path), "k", "t", "a", parts=16)
    history.extend(spark.range(3000).selectExpr("id", "id % 200 AS k", "id * 500 AS t", "1.5D AS a"), "all")
    before = history.days.head().runs
    history.extend(spark.createDataFrame([(1, 5, 3 * DAY + 7, 1.0), (2, 6, 3 * DAY + 9, 1.0)], DDL), "two")
    after = history.days.head().runs
    assert 1 <= len([p for p in after if after[p] != before[p]]) <= 2
    sums = {r["k"]: (r["total"], r["n"]) for r in history.totals("mean", "n").collect()}
    assert sums[5] == sums[6] == (23.5, 16) and sums[7] == (22.5, 15)
