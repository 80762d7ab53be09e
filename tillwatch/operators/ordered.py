"""Running totals and ranks over one global order, without one global task."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwatch.session import scratch_path

#: Ranges and groups whose first ranks may be broadcast; above, they are joined by a shuffle.
BROADCAST_RANGES = 100_000


def running_totals(df: DataFrame, order: str, totals: list[str],
                   descending: bool = False, buckets: int | None = None) -> DataFrame:
    """Totals per distinct ``order`` value, with ``cum_*`` (inclusive) and ``all_*`` columns.

    Equal values are added up first, so a value that fills the table is one row afterwards. The
    values are then cut into buckets of about equal size at approximate quantiles, each bucket is
    summed on its own, and the totals of the earlier buckets (one row per bucket, hence a bounded
    broadcast) are added. Cut points only steer the balance: the result is exact for any cut.
    Values keep their type; only the cut points are doubles. NULL values are left out; NaN sorts last.
    """
    spark = df.sparkSession
    n = max(2, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
    values = (df.filter(F.col(order).isNotNull()).groupBy(order)
              .agg(*[F.sum(c).alias(c) for c in totals]).withColumn("_place", F.col(order).cast("double")))
    cuts = df.select(F.col(order).cast("double").alias(order)).approxQuantile(
        order, [i / n for i in range(1, n)], 1.0 / (4 * n))
    inner = sorted({c for c in cuts if math.isfinite(c)}) or [0.0]
    bucketed = Bucketizer(splits=[-math.inf, *inner, math.inf], inputCol="_place",
                          outputCol="_bucket", handleInvalid="keep").transform(values)

    def direction(name: str):
        return F.col(name).desc() if descending else F.col(name).asc()

    before = Window.orderBy(direction("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(direction("_bucket")).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = (bucketed.groupBy("_bucket").agg(*[F.sum(c).alias(c) for c in totals])
               .select(F.col("_bucket").alias("_offset_bucket"),
                       *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_before_{c}") for c in totals],
                       *[F.sum(c).over(everything).alias(f"all_{c}") for c in totals]))
    inside = (Window.partitionBy("_bucket").orderBy(direction(order))
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (bucketed.withColumns({f"_inside_{c}": F.sum(c).over(inside) for c in totals})
            .join(F.broadcast(offsets), F.col("_bucket") == F.col("_offset_bucket"))
            .select(order, *totals,
                    *[(F.col(f"_before_{c}") + F.col(f"_inside_{c}")).alias(f"cum_{c}") for c in totals],
                    *[f"all_{c}" for c in totals]))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranked(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Add ``_rank`` (from 0) within ``group`` and ``_n``, the rows of the group, at any size of a group.

    Rows are sorted in ranges over all groups, so a large group fills many tasks; only the first row and the
    row count of each range and group are added up. NULL is a group and sorts first. Rows equal in ``group`` and
    ``order`` may stand in several ranges. ``rows`` is a stored table: finding the ranges reads it once more.
    """
    placed = (rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*group, *order, "_tie")
              .sortWithinPartitions(*group, *order, "_tie").drop("_tie").withColumn("_at", F.monotonically_increasing_id()))
    placed = _stored(placed.withColumn("_range", F.shiftright("_at", 33)), "ranges")
    spans = _stored(placed.groupBy(*group, "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_size")), "spans")
    everything = Window.partitionBy(*group)
    earlier = everything.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = spans.select(*[F.col(c).alias(f"_g_{c}") for c in group], F.col("_range").alias("_g_range"), "_first",
                          F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"),
                          F.sum("_size").over(everything).alias("_n"))
    if spans.count() <= BROADCAST_RANGES:
        starts = F.broadcast(starts)
    same = F.col("_range") == F.col("_g_range")
    for c in group:
        same &= F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    return placed.join(starts, same).select(*rows.columns, (F.col("_before") + F.col("_at") - F.col("_first")).alias("_rank"), "_n")
