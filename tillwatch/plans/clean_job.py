"""Cleaning as a job: one profile pass, one sketch pass, one write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillwatch.operators.cleaning import clean
from tillwatch.operators.quality import load_report
from tillwatch.operators.quantiles import amount_stats, amount_stats_by_tree
from tillwatch.sources.transactions import read_transactions_csv, write_clean


def run_cleaning(spark: SparkSession, source: str | DataFrame, output: str, exact: bool = False,
                 handle_null: str = "keep", comment: str | None = "#", partitions: int | None = None) -> dict:
    """Clean ``source`` (path glob or frame) into ``output``; returns the report numbers."""
    raw = source if isinstance(source, DataFrame) else read_transactions_csv(spark, source, comment, partitions)
    report = load_report(raw).first().asDict()
    fences = (amount_stats(raw, exact=True) if exact else amount_stats_by_tree(raw)).first().asDict()
    fixed = spark.createDataFrame([fences], "q1 DOUBLE, q3 DOUBLE, median DOUBLE, lower DOUBLE, upper DOUBLE")
    written = write_clean(clean(raw, fixed, handle_null), output)
    return {**report, **fences, "clean_rows": written}
