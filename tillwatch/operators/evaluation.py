"""Costs, error rates, curve areas and thresholds of a scored table.

Every curve measure comes from counts per distinct score and running totals over the score order,
so no step needs the whole table in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.operators.ordered import running_totals


def confusion_columns(score: Column, label: Column, threshold: float) -> dict[str, Column]:
    """Aggregates of the four outcomes; fraud is called at ``score >= threshold``."""
    called = score >= threshold
    return {"tp": F.count_if(called & (label == 1)), "fp": F.count_if(called & (label == 0)),
            "tn": F.count_if(~called & (label == 0)), "fn": F.count_if(~called & (label == 1))}


def confusion_matrix(df: DataFrame, threshold: float, score: str = "score", label: str = "label",
                     by: list | None = None) -> DataFrame:
    measures = confusion_columns(F.col(score), F.col(label), threshold)
    return df.groupBy(*(by or [])).agg(*[c.alias(n) for n, c in measures.items()])


def with_error_rates(confusion: DataFrame) -> DataFrame:
    """``fnr`` = missed share of fraud, ``fpr`` = wrongly called share of normal rows."""
    return confusion.withColumns({
        "fnr": F.try_divide(F.col("fn"), F.col("fn") + F.col("tp")),
        "fpr": F.try_divide(F.col("fp"), F.col("fp") + F.col("tn"))})


def with_limits(rates: DataFrame, max_fnr: float, max_fpr: float) -> DataFrame:
    return rates.withColumn("within_limits", (F.col("fnr") <= max_fnr) & (F.col("fpr") <= max_fpr))


def with_expected_loss(confusion: DataFrame, cost_fn: float, cost_fp: float) -> DataFrame:
    return confusion.withColumn("loss", F.col("fn") * F.lit(float(cost_fn)) + F.col("fp") * F.lit(float(cost_fp)))


def loss_vs_baseline(df: DataFrame, score: str, baseline_score: str, threshold: float, baseline_threshold: float,
                     cost_fn: float, cost_fp: float, label: str = "label", target: float = 0.30) -> DataFrame:
    """Loss of a model and of its baseline on the same rows, in one pass, and the reduction."""
    new = confusion_columns(F.col(score), F.col(label), threshold)
    old = confusion_columns(F.col(baseline_score), F.col(label), baseline_threshold)
    losses = df.agg(
        (new["fn"] * F.lit(float(cost_fn)) + new["fp"] * F.lit(float(cost_fp))).alias("loss"),
        (old["fn"] * F.lit(float(cost_fn)) + old["fp"] * F.lit(float(cost_fp))).alias("baseline_loss"))
    reduction = F.try_divide(F.col("baseline_loss") - F.col("loss"), F.col("baseline_loss"))
    return losses.withColumn("reduction", reduction).withColumn("target_met", F.col("reduction") >= target)


def score_curve(df: DataFrame, score: str = "score", label: str = "label", buckets: int | None = None) -> DataFrame:
    """Per distinct score, highest first: its frauds and normals, and the totals down to it."""
    known = df.filter(F.col(label).isin(0, 1)).select(
        score, (F.col(label) == 1).cast("bigint").alias("pos"), (F.col(label) == 0).cast("bigint").alias("neg"))
    return running_totals(known, score, ["pos", "neg"], descending=True, buckets=buckets)


def curve_areas(curve: DataFrame) -> DataFrame:
    """``roc_auc`` and ``pr_auc`` (trapezoids between distinct scores) in one aggregate."""
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    tp, fp = F.col("cum_pos").cast("double"), F.col("cum_neg").cast("double")
    tp0, fp0 = tp - pos, fp - neg
    precision = tp / (tp + fp)
    # the curve starts level: before the highest score, precision is that score's own
    precision0 = F.coalesce(F.try_divide(tp0, tp0 + fp0), precision)
    all_pos, all_neg = F.max("all_pos").cast("double"), F.max("all_neg").cast("double")
    return curve.agg(
        F.try_divide(F.sum(neg * (tp0 + pos / F.lit(2.0))), all_pos * all_neg).alias("roc_auc"),
        F.try_divide(F.sum(pos * (precision + precision0) / F.lit(2.0)), all_pos).alias("pr_auc"))


def weighted_prf(confusion: DataFrame) -> DataFrame:
    """Precision, recall and F1 weighted by true class size; weighted recall is accuracy."""
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    zero = F.lit(0.0)
    p1, p0 = F.coalesce(F.try_divide(tp, tp + fp), zero), F.coalesce(F.try_divide(tn, tn + fn), zero)
    r1, r0 = F.coalesce(F.try_divide(tp, tp + fn), zero), F.coalesce(F.try_divide(tn, tn + fp), zero)
    f1 = F.coalesce(F.try_divide(F.lit(2.0) * p1 * r1, p1 + r1), zero)
    f0 = F.coalesce(F.try_divide(F.lit(2.0) * p0 * r0, p0 + r0), zero)
    w1, w0 = F.try_divide(tp + fn, n), F.try_divide(tn + fp, n)
    return confusion.select((w1 * p1 + w0 * p0).alias("precision"), (w1 * r1 + w0 * r0).alias("recall"),
                            (w1 * f1 + w0 * f0).alias("f1"))


def tune_threshold(curve: DataFrame, cost_fn: float, cost_fp: float,
                   max_fnr: float | None = None, max_fpr: float | None = None) -> DataFrame:
    """The score with the least expected loss among those within the limits; ties: the highest.

    Calling fraud at ``score >= s`` catches the totals down to ``s``, so one pass over the curve
    rates every threshold. No threshold within the limits gives one row of NULLs.
    """
    fn, fp = F.col("all_pos") - F.col("cum_pos"), F.col("cum_neg")
    rated = curve.select(
        F.col("score").alias("threshold"), F.col("cum_pos").alias("tp"), fp.alias("fp"),
        (F.col("all_neg") - F.col("cum_neg")).alias("tn"), fn.alias("fn"),
        F.try_divide(fn, F.col("all_pos")).alias("fnr"), F.try_divide(fp, F.col("all_neg")).alias("fpr"),
        (fn * F.lit(float(cost_fn)) + fp * F.lit(float(cost_fp))).alias("loss"))
    if max_fnr is not None:
        rated = rated.filter(F.col("fnr") <= max_fnr)
    if max_fpr is not None:
        rated = rated.filter(F.col("fpr") <= max_fpr)
    best = rated.agg(F.min_by(F.struct(*rated.columns), F.struct("loss", -F.col("threshold"))).alias("best"))
    return best.select("best.*")
