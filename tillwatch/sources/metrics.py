"""Run metrics as a long table of text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def metrics_frame(spark: SparkSession, metrics: dict[str, object], run_id: str) -> DataFrame:
    """One row per metric, all values as text, plus the constant run id."""
    rows = [(name, str(value)) for name, value in metrics.items()]
    return spark.createDataFrame(rows, "metric STRING, value STRING").withColumn("run_id", F.lit(run_id))


def export_metrics(metrics: DataFrame, path: str) -> None:
    """Append as one CSV part with header: a dozen rows per run."""
    metrics.coalesce(1).write.mode("append").option("header", "true").csv(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.option("header", "true")
            .schema("metric STRING, value STRING, run_id STRING").csv(path))


def metrics_pivot(metrics: DataFrame, names: list[str]) -> DataFrame:
    """One row per run with a column per named metric; a missing metric is NULL."""
    return metrics.groupBy("run_id").pivot("metric", names).agg(F.first("value", ignorenulls=True))
