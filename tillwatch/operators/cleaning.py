"""The cleaner: filter, one row per id, impute and cap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwatch.functions.amounts import impute_and_cap
from tillwatch.functions.predicates import is_keepable
from tillwatch.operators.quantiles import amount_stats


def dedupe_first(df: DataFrame, key: str = "transaction_id", order: list[Column] | None = None) -> DataFrame:
    """The earliest row of every id.

    ``row_number() = 1`` lets Spark cut each map task's output to one row per id before the
    shuffle, so an id with a third of all rows costs one row per task. The order ends with all
    columns: rows that still tie are equal.
    """
    by = order or [F.col("tx_time_seconds").asc_nulls_last()]
    rest = [F.col(c) for c in df.columns if c != key]
    window = Window.partitionBy(key).orderBy(*by, *rest)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def dedupe_any(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Any one row of every id."""
    return df.dropDuplicates([key])


def clean(raw: DataFrame, stats: DataFrame | None = None, handle_null: str = "keep",
          keep_first: bool = True) -> DataFrame:
    """Clean transactions with the raw schema.

    ``stats`` is a one-row frame with ``median, lower, upper`` (default: sketches over ``raw``);
    it enters as a scalar subquery, so nothing is collected and nothing is cross joined.
    ``handle_null``: ``keep`` leaves a NULL amount, ``impute`` sets the median, ``drop`` removes the row.
    """
    if handle_null not in ("keep", "impute", "drop"):
        raise ValueError(f"handle_null: {handle_null}")
    if stats is None:
        stats = amount_stats(raw)
    fences = stats.select(F.struct("median", "lower", "upper")).scalar()
    kept = raw.filter(is_keepable())
    amount = F.col("tx_amount")
    if handle_null == "drop":
        kept = kept.filter(amount.isNotNull())
    single = dedupe_first(kept) if keep_first else dedupe_any(kept)
    capped = impute_and_cap(amount, fences["median"], fences["lower"], fences["upper"])
    if handle_null == "impute":
        capped = F.coalesce(capped, fences["median"])
    return single.withColumn("tx_amount", capped)
