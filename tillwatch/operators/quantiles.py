"""Quartiles, median and IQR fences as one-row DataFrames."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.functions.amounts import lower_fence, upper_fence
from tillwatch.operators.ordered import running_totals

QUARTILE_ACCURACY = 10_000
MEDIAN_ERROR = 0.01


def approx_quartiles(df: DataFrame, column: str = "tx_amount", accuracy: int = QUARTILE_ACCURACY) -> DataFrame:
    both = df.agg(F.percentile_approx(column, [0.25, 0.75], accuracy).alias("q"))
    return both.select(F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"))


def approx_median(df: DataFrame, column: str = "tx_amount", relative_error: float = MEDIAN_ERROR) -> DataFrame:
    return df.agg(F.percentile_approx(column, 0.5, round(1 / relative_error)).alias("median"))


def exact_quantiles(df: DataFrame, column: str, named: dict[str, float]) -> DataFrame:
    """Smallest value whose running count reaches the share, per named share (``percentile_disc``).

    ``percentile_disc`` itself keeps every distinct value in one aggregation buffer; here the
    values stay spread over the cluster and only one row per share is left at the end.
    """
    part = {name: Fraction(str(share)) for name, share in named.items()}
    counted = running_totals(df.select(column, F.lit(1).cast("bigint").alias("n")), column, ["n"])
    return counted.agg(*[
        F.min(F.when(F.col("cum_n") * F.lit(p.denominator) >= F.col("all_n") * F.lit(p.numerator), F.col(column))).alias(name)
        for name, p in part.items()])


def with_fences(stats: DataFrame) -> DataFrame:
    q1, q3 = F.col("q1"), F.col("q3")
    return stats.withColumns({"lower": lower_fence(q1, q3), "upper": upper_fence(q1, q3)})


def amount_stats(df: DataFrame, column: str = "tx_amount", exact: bool = False) -> DataFrame:
    """One row ``q1, q3, median, lower, upper`` over all rows, later-removed ones included.

    The approximate form takes one pass and small mergeable sketches, and stays inside the plan.
    """
    if exact:
        return with_fences(exact_quantiles(df, column, {"q1": 0.25, "q3": 0.75, "median": 0.5}))
    sketched = df.agg(F.percentile_approx(column, [0.25, 0.75], QUARTILE_ACCURACY).alias("q"),
                      F.percentile_approx(column, 0.5, round(1 / MEDIAN_ERROR)).alias("median"))
    return with_fences(sketched.select(F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"), "median"))


def amount_stats_by_tree(df: DataFrame, column: str = "tx_amount") -> DataFrame:
    """The approximate numbers for a scan of very many tasks, as a one-row table of known values.

    ``percentile_approx`` merges the sketches of all tasks in one last task; ``approxQuantile``
    merges them in a tree of tasks. It runs at once, and three numbers come back.
    """
    q1, median, q3 = df.approxQuantile(column, [0.25, 0.5, 0.75], 1 / QUARTILE_ACCURACY) or (None, None, None)
    known = df.sparkSession.createDataFrame([(q1, q3, median)], "q1 DOUBLE, q3 DOUBLE, median DOUBLE")
    return with_fences(known)
