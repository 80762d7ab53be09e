"""Sketches per day: periods, loads in any order, replays, missing values."""

import random

import pytest

from tillwatch.plans.amount_sketches import RANK_ERROR, AmountSketches

DDL = "tx_time_days INT, tx_amount DOUBLE"


def _rows(n=60_000):
    rnd = random.Random(8)
    return [(rnd.choice([0, 0, 0, 1, 2, 5]), rnd.choice([None, float("nan"), *[rnd.lognormvariate(2, 1) for _ in range(18)]])) for _ in range(n)]


def _rank_error(values, found, share):
    below, upto = sum(v < found for v in values) / len(values), sum(v <= found for v in values) / len(values)
    return max(0.0, below - share, share - upto)


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    rows, sketches = _rows(), AmountSketches(spark, str(tmp_path_factory.mktemp("sketches") / "s"))
    for load in (2, 0, 1, 0):  # any order, one of them twice
        sketches.extend(spark.createDataFrame(rows[load::3], DDL), f"load-{load}")
    return rows, sketches


@pytest.mark.parametrize("first, last", [(None, None), (0, 0), (1, 2), (2, 9)])
def test_fences_of_a_period(made, first, last):
    rows, sketches = made
    known = [v for d, v in rows if v is not None and v == v and (first is None or d >= first) and (last is None or d <= last)]
    got = sketches.stats(first, last).first()
    for name, share in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        assert _rank_error(known, got[name], share) <= RANK_ERROR
    assert got["lower"] == pytest.approx(got["q1"] - 1.5 * (got["q3"] - got["q1"]))
    for r in sketches.distribution([1.0, 10.0, 50.0], first, last).collect():
        assert abs(r["share"] - sum(v <= r["bound"] for v in known) / len(known)) <= RANK_ERROR and r["n"] == len(known)


def test_only_the_days_are_read(made):
    rows, sketches = made
    files = sketches._period(1, 2).inputFiles()
    assert {f.split("/")[-3] for f in files} == {"day=1", "day=2"} and len(files) == 6
    missing = sum(1 for d, v in rows if d in (1, 2) and (v is None or v != v))
    assert sketches.distribution([1.0], 1, 2).first()["nulls"] == missing


def test_no_values(spark, made, tmp_path):
    assert made[1].stats(100, 200).first()["median"] is None
    empty = AmountSketches(spark, str(tmp_path / "e"))
    assert empty.stats().collect()[0]["q1"] is None
    empty.extend(spark.createDataFrame([(1, None), (None, 5.0)], DDL), "a")
    assert empty.stats().first()["q1"] is None and empty.distribution([1.0]).first()["nulls"] == 1
