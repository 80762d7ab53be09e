"""Quantile sketches per day, kept as a table and extended load by load.

Fences, medians and shares of any run of days come from the days' sketches: the rows are read once,
when they are loaded, and a period costs one small row per day and load of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.operators.quantiles import with_fences
from tillwatch.sources.paths import folders

SKETCH_DDL = "n BIGINT, nulls BIGINT, sketch BINARY, day INT, load STRING"
#: Size of a sketch; a rank is off by this share of the rows at most (with the usual 99 % certainty, and less mostly).
K, RANK_ERROR = 4096, 0.005


class AmountSketches:
    """Sketches of one number column by whole-number day."""

    def __init__(self, spark: SparkSession, root: str, value: str = "tx_amount", day: str = "tx_time_days", k: int = K):
        self.spark, self.root, self.value, self.day, self.k = spark, root.rstrip("/"), value, day, k

    def extend(self, rows: DataFrame, load: str) -> None:
        """Add the rows of a load; the same load again replaces itself. Rows without day are left out; NULL and
        NaN values are counted as missing. Each task sends one sketch per day."""
        value = F.col(self.value).cast("double")
        value = F.when(~F.isnan(value), value)
        made = (rows.filter(F.col(self.day).isNotNull()).groupBy(F.col(self.day).cast("int").alias("day"))
                .agg(F.count(value).alias("n"), F.count_if(value.isNull()).alias("nulls"),
                     F.kll_sketch_agg_double(value, F.lit(self.k)).alias("sketch"))
                .withColumn("load", F.lit(load)))
        made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "load").parquet(self.root)

    def _period(self, first: int | None, last: int | None) -> DataFrame:
        """Stored rows of the days ``first`` to ``last``: only their folders are read."""
        days = [int(name.split("=")[1]) for name in folders(self.spark, self.root) if name.startswith("day=")]
        paths = [f"{self.root}/day={d}" for d in sorted(days) if (first is None or d >= first) and (last is None or d <= last)]
        if not paths:
            return self.spark.createDataFrame([], SKETCH_DDL)
        return self.spark.read.schema(SKETCH_DDL).option("basePath", self.root).parquet(*paths)

    def _merged(self, first: int | None, last: int | None) -> DataFrame:
        """One row ``n, nulls, sketch``; no sketch where the period has no values."""
        rows = self._period(first, last)
        some = F.when(F.col("n") > 0, F.col("sketch"))
        return rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("nulls"), F.lit(0)).alias("nulls"),
                        F.count(some).alias("held"), F.kll_merge_agg_double(some).alias("sketch")).select(
            "n", "nulls", F.when(F.col("held") > 0, F.col("sketch")).alias("sketch"))

    def stats(self, first: int | None = None, last: int | None = None) -> DataFrame:
        """One row ``q1, q3, median, lower, upper`` of a period, as ``quantiles.amount_stats`` gives them of rows."""
        def at(share: float):
            return F.when(F.col("sketch").isNotNull(), F.kll_sketch_get_quantile_double("sketch", F.lit(share)))

        return with_fences(self._merged(first, last).select(at(0.25).alias("q1"), at(0.75).alias("q3"), at(0.5).alias("median")))

    def distribution(self, bounds: list[float], first: int | None = None, last: int | None = None) -> DataFrame:
        """One row per bound: ``bound``, share of the period's values up to it, values and missing values."""
        def up_to(bound: float):
            share = F.when(F.col("sketch").isNotNull(), F.kll_sketch_get_rank_double("sketch", F.lit(bound)))
            return F.struct(F.lit(bound).alias("bound"), share.alias("share"), "n", "nulls")

        return self._merged(first, last).select(F.inline(F.array(*[up_to(float(b)) for b in bounds])))
