"""Data-quality profile: one scan for all numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.functions import predicates as P

_CHECKS: dict[str, object] = {
    "bad_dates": P.is_bad_date,
    "nonpositive_amounts": P.is_nonpositive_amount,
    "invalid_labels": P.label_out_of_domain,
    "null_labels": lambda: F.col("tx_fraud").isNull(),
}


def null_profile(df: DataFrame) -> DataFrame:
    """NULLs per column in one row."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def _checks() -> dict[str, Column]:
    return {name: build() for name, build in _CHECKS.items()}


def quality_profile(df: DataFrame) -> DataFrame:
    """Rows and failed checks; no shuffle of rows."""
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  *[F.count_if(check).alias(name) for name, check in _checks().items()])


def duplicate_ids(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Ids that occur more than once, with their number of rows."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def load_report(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """``quality_profile`` plus the number of duplicated ids, still in one scan.

    The checks ride along in the per-id aggregate that the duplicate count needs anyway.
    """
    names = ["row_count", *_CHECKS]
    per_id = df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"),
                                 *[F.count_if(check).alias(name) for name, check in _checks().items()])
    return per_id.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names],
                      F.count_if(F.col("row_count") > 1).alias("duplicated_ids"))


def class_balance(df: DataFrame, label: str = "tx_fraud") -> DataFrame:
    """Rows and share per label value."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("share", F.col("rows") / total)


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """Rows per equal-width bin; bin 0 is below ``low``, ``bins + 1`` is at or above ``high``."""
    binned = df.filter(F.col(column).isNotNull()).select(
        F.width_bucket(F.col(column), F.lit(low), F.lit(high), F.lit(bins)).alias("bin"))
    return binned.groupBy("bin").agg(F.count(F.lit(1)).alias("rows"))


def column_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, NULLs, min, max, mean and sample deviation per column, one row each."""
    parts = [F.struct(F.lit(c).alias("column"),
                      F.count(c).alias("known"),
                      F.count_if(F.col(c).isNull()).alias("nulls"),
                      F.min(c).cast("double").alias("min"),
                      F.max(c).cast("double").alias("max"),
                      F.avg(c).alias("mean"),
                      F.stddev_samp(c).alias("std")) for c in columns]
    return df.agg(F.array(*parts).alias("_rows")).select(F.inline("_rows"))
