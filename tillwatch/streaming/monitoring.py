"""Loss, error rates and volume per window, and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.operators.evaluation import confusion_columns, with_error_rates, with_expected_loss
from tillwatch.streaming.pipeline import dedupe_stream


def join_late_labels(scores: DataFrame, labels: DataFrame, key: str, score_time: str, label_time: str,
                     score_delay: str, label_delay: str, max_wait: str, how: str = "inner") -> DataFrame:
    """Scores with the labels that arrive up to ``max_wait`` later; both sides are streams.

    Both are reduced to one row per key first: re-delivered copies on both sides would pair up. With ``how``
    "leftOuter" a score whose label did not come in time is kept, with NULL, once the wait is over.
    """
    left = dedupe_stream(scores, score_time, score_delay, key)
    right = dedupe_stream(labels, label_time, label_delay, key).withColumnRenamed(key, "_label_key")
    on = ((F.col(key) == F.col("_label_key")) & (F.col(label_time) >= F.col(score_time))
          & (F.col(label_time) <= F.col(score_time) + F.expr(f"INTERVAL {max_wait}")))
    return left.join(right, on, how).drop("_label_key")


def monitor_late_labels(scores: DataFrame, labels: DataFrame, key: str, score_time: str, label_time: str,
                        score_delay: str, label_delay: str, max_wait: str, size: str, threshold: float,
                        cost_fn: float, cost_fp: float) -> DataFrame:
    """Windows over all scores, labelled or not, as one stream: late labels, then windows.

    A window is closed when the wait for its labels is over. Feed the result to ``alerts``.
    """
    joined = join_late_labels(scores, labels, key, score_time, label_time, score_delay, label_delay, max_wait, "leftOuter")
    rows = joined.select(score_time, "score", "label")
    return monitoring_windows(rows, score_time, size, threshold, cost_fn, cost_fp)


def monitoring_windows(rows: DataFrame, time: str, size: str, threshold: float, cost_fn: float, cost_fp: float,
                       delay: str | None = None, score: str = "score", label: str = "label") -> DataFrame:
    """Per tumbling window: rows, outcomes, FNR, FPR and expected loss."""
    timed = rows.withWatermark(time, delay) if delay else rows
    measures = confusion_columns(F.col(score), F.col(label), threshold)
    counted = (timed.groupBy(F.window(time, size))
               .agg(F.count(F.lit(1)).alias("volume"), *[c.alias(n) for n, c in measures.items()])
               .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                       "volume", *measures))
    return with_expected_loss(with_error_rates(counted), cost_fn, cost_fp)


def alerts(windows: DataFrame, max_fnr: float, max_fpr: float) -> DataFrame:
    """Windows beyond a limit, with the limit they break."""
    high_fnr, high_fpr = F.col("fnr") > max_fnr, F.col("fpr") > max_fpr
    return (windows.filter(high_fnr | high_fpr)
            .withColumn("alert", F.concat_ws(",", F.when(high_fnr, "fnr"), F.when(high_fpr, "fpr"))))
