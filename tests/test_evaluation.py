"""Curve measures, thresholds, quantiles and decisions against plain loops."""

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tillwatch.functions.decisions import decide
from tillwatch.operators import evaluation as E
from tillwatch.operators.ordered import running_totals
from tillwatch.operators.quantiles import exact_quantiles
from tillwatch.operators.sampling import sample_by_key, sample_fraction, split_by_key
from tillwatch.plans.training import evaluate_curve, evaluate_labels


def _scored(n=300, seed=1, levels=25):
    rng = random.Random(seed)
    return [(rng.randrange(levels) / levels, int(rng.random() < 0.3)) for _ in range(n)]


def _df(spark, rows):
    return spark.createDataFrame(rows, "score DOUBLE, label INT")


@pytest.mark.parametrize("buckets", [None, 2, 40])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, buckets, descending):
    rng = random.Random(2)
    rows = [(rng.choice([None, 1.0, 1.0, rng.randrange(50) / 7]), 1) for _ in range(500)]
    df = spark.createDataFrame(rows, "x DOUBLE, n BIGINT")
    got = {r["x"]: (r["n"], r["cum_n"], r["all_n"]) for r in running_totals(df, "x", ["n"], descending, buckets).collect()}
    known = [x for x, _ in rows if x is not None]
    assert set(got) == set(known)
    for x, (n, cum, all_n) in got.items():
        assert n == known.count(x) and all_n == len(known)
        assert cum == sum(1 for y in known if (y >= x if descending else y <= x))


@pytest.mark.parametrize("values", [[5.0], [3.0] * 50, [float(i % 7) for i in range(100)], [1.0, float("inf"), -2.0]])
def test_exact_quantiles(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x DOUBLE")
    got = exact_quantiles(df, "x", {"a": 0.25, "b": 0.5, "c": 0.75, "d": 1.0}).first()
    ordered = sorted(values)
    for name, q in zip("abcd", (0.25, 0.5, 0.75, 1.0)):
        want = ordered[max(0, -(-int(q * 4) * len(values) // 4) - 1)]
        assert got[name] == want


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x DOUBLE")
    assert exact_quantiles(df, "x", {"a": 0.5}).first()["a"] is None


def test_quantiles_keep_the_type(spark):
    df = spark.createDataFrame([(9007199254740993,), (9007199254740992,), (None,)], "x BIGINT")
    got = exact_quantiles(df, "x", {"half": 0.5, "all": 1.0}).first()
    assert (got["half"], got["all"]) == (9007199254740992, 9007199254740993)


def test_areas(spark):
    rows = _scored()
    got = E.curve_areas(E.score_curve(_df(spark, rows))).first()
    pos = [s for s, y in rows if y]
    neg = [s for s, y in rows if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert got["roc_auc"] == pytest.approx(wins / (len(pos) * len(neg)))
    doubles = _df(spark, rows).withColumn("label", F.col("label").cast("double"))
    by = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert got["roc_auc"] == pytest.approx(by.evaluate(doubles))
    assert got["pr_auc"] == pytest.approx(by.setMetricName("areaUnderPR").evaluate(doubles))
    vectors = doubles.withColumn("probability", array_to_vector(F.array(1 - F.col("score"), F.col("score"))))
    assert evaluate_curve(vectors, "label") == pytest.approx({"auc": got["roc_auc"], "pr_auc": got["pr_auc"]})


@pytest.mark.parametrize("limits", [(None, None), (0.6, 0.5), (0.0, 0.0)])
def test_threshold(spark, limits):
    rows = _scored(seed=9)
    max_fnr, max_fpr = limits
    p, n = sum(y for _, y in rows), sum(1 - y for _, y in rows)
    best = None
    for t in sorted({s for s, _ in rows}, reverse=True):
        fn = sum(1 for s, y in rows if y and s < t)
        fp = sum(1 for s, y in rows if not y and s >= t)
        if (max_fnr is None or fn / p <= max_fnr) and (max_fpr is None or fp / n <= max_fpr):
            if best is None or 10 * fn + 3 * fp < best[0]:
                best = (10 * fn + 3 * fp, t)
    got = E.tune_threshold(E.score_curve(_df(spark, rows)), 10, 3, max_fnr, max_fpr).first()
    assert (got["loss"], got["threshold"]) == (best or (None, None))


def test_rates_with_one_class(spark):
    got = E.with_error_rates(E.confusion_matrix(_df(spark, [(0.9, 1), (0.1, 1)]), 0.5)).first()
    assert got["fnr"] == 0.5 and got["fpr"] is None


def test_loss_reduction(spark):
    df = spark.createDataFrame([(0.9, 0.1, 1), (0.8, 0.9, 0), (0.1, 0.1, 0)], "score DOUBLE, base DOUBLE, label INT")
    got = E.loss_vs_baseline(df, "score", "base", 0.85, 0.5, 100, 10).first()
    assert (got["loss"], got["baseline_loss"], got["reduction"], got["target_met"]) == (0.0, 110.0, 1.0, True)


def test_label_measures_equal_the_evaluator(spark):
    rows = _df(spark, _scored(seed=4)).select((F.col("score") > 0.4).cast("double").alias("prediction"),
                                              F.col("label").cast("double").alias("label"))
    got = evaluate_labels(rows, "label")
    by = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    for ours, theirs in {"precision": "weightedPrecision", "recall": "weightedRecall", "f1": "f1"}.items():
        assert got[ours] == pytest.approx(by.setMetricName(theirs).evaluate(rows))
    assert got["recall"] == pytest.approx(by.setMetricName("accuracy").evaluate(rows))


def test_decisions(spark):
    df = spark.createDataFrame([(0.9, 1), (0.5, 1), (0.1, 1), (0.1, 99), (None, 1)], "score DOUBLE, amount INT")
    got = [r[0] for r in df.select(decide(F.col("score"), 0.4, 0.8, decline_rule=F.col("amount") > 50)).collect()]
    assert got == ["decline", "manual_review", "approve", "decline", "manual_review"]


def test_split_is_stable(spark):
    df = spark.range(5_000).withColumnRenamed("id", "transaction_id")
    train, test = split_by_key(df)
    again, _ = split_by_key(df.repartition(7))
    assert train.exceptAll(again).isEmpty() and again.exceptAll(train).isEmpty()
    assert train.count() + test.count() == 5_000 and abs(train.count() / 5_000 - 0.8) < 0.03
    assert abs(sample_by_key(df, "transaction_id", 0.1).count() / 5_000 - 0.1) < 0.02
    assert sample_by_key(df, "transaction_id", 1.0).count() == 5_000
    assert sample_fraction(df, 0.0).count() == 5_000 and 0 < sample_fraction(df, 0.1).count() < 1_000
