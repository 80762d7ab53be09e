"""Point-in-time join: the newest feature row at or before each spine row.

Feature rows of one or more tables and spine rows are tagged, united and carried forward by one window: one
shuffle, one sort, work linear in the rows whatever the time-to-live.

Keys with too many rows for a task go another way. Their rows are first reduced to one per moment
(newest feature row, or the number of spine rows), then cut into time buckets; each bucket starts
with the newest feature row of all earlier buckets. So a bucket is never larger than the moments
it has, even when every spine row asks for the same one. The spine rows then look their moment up.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import timedelta
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.operators.skew import DEFAULT_HOT_KEYS, HotKeys, lookup_counted, mark_hot

CARRY, FEATURE, SPINE = -1, 0, 1


def _feature_rows(spine: DataFrame, features: DataFrame, keys: list[str], spine_ts: str, feature_ts: str,
                  created: str | None, fields: list[str]) -> DataFrame:
    """``keys, _ts, _created, _tie, _row`` in the spine's key and time types, which must be wide enough."""
    time_type = spine.schema[spine_ts].dataType
    known = features.filter(F.col(feature_ts).isNotNull())
    for name in keys:
        known = known.filter(F.col(name).isNotNull())
    return known.select(
        *[F.col(k).cast(spine.schema[k].dataType).alias(k) for k in keys],
        F.col(feature_ts).cast(time_type).alias("_ts"),
        (F.col(created) if created else F.lit(None).cast("timestamp")).alias("_created"),
        F.xxhash64(*[F.col(c) for c in fields]).alias("_tie"),
        F.struct(F.col(feature_ts).cast(time_type).alias("event_ts"), *[F.col(c) for c in fields]).alias("_row"))


def _newest(*before: str) -> Column:
    """Order among feature rows: time, newest ``created``, lowest hash."""
    return F.struct(*before, "_created", (-F.col("_tie").cast("decimal(20,0)")).alias("_low"))


def _carry_in_window(spine: DataFrame, tables: list[DataFrame], keys: list[str], spine_ts: str) -> DataFrame:
    """One window per key over the united rows of all tables: adds ``_carried_0``, ``_carried_1``, ..."""
    payload = F.struct(*[F.col(c) for c in spine.columns])
    tagged = spine.select(*keys, F.col(spine_ts).alias("_ts"), F.lit(SPINE).alias("_side"), payload.alias("_spine"))
    for i, rows in enumerate(tables):
        tagged = tagged.unionByName(rows.withColumnRenamed("_row", f"_row_{i}").withColumn("_side", F.lit(FEATURE)),
                                    allowMissingColumns=True)
    so_far = (Window.partitionBy(*keys)
              .orderBy(F.col("_ts").asc_nulls_first(), "_side", F.col("_created").asc_nulls_first(),
                       F.col("_tie").desc())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carried = [f"_carried_{i}" for i in range(len(tables))]
    return (tagged.withColumns({c: F.last(f"_row_{i}", ignorenulls=True).over(so_far) for i, c in enumerate(carried)})
            .filter(F.col("_side") == SPINE).select("_spine.*", *carried))


def _carry_in_buckets(spine: DataFrame, rows: DataFrame, keys: list[str], spine_ts: str, bucket: str,
                      limit: float) -> DataFrame:
    """The same for hot keys: moments, time buckets, and a look-up per spine row."""
    row_type = rows.schema["_row"].dataType
    moments = spine.groupBy(*keys, F.col(spine_ts).alias("_ts")).agg(F.count(F.lit(1)).alias("_rows"))
    tagged = (rows.groupBy(*keys, "_ts").agg(F.max_by("_row", _newest()).alias("_row"))
              .withColumns({"_side": F.lit(FEATURE), "_rows": F.lit(0).cast("bigint")})
              .unionByName(moments.withColumns({"_side": F.lit(SPINE), "_row": F.lit(None).cast(row_type)}))
              .withColumn("_bucket", F.date_trunc(bucket, F.col("_ts"))))
    per_bucket = tagged.groupBy(*keys, "_bucket").agg(
        F.max_by("_row", F.when(F.col("_side") == FEATURE, F.col("_ts"))).alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried_in = (per_bucket.withColumn("_row", F.last("_last", ignorenulls=True).over(earlier))
                  .filter(F.col("_row").isNotNull())
                  .select(*keys, F.lit(None).cast(spine.schema[spine_ts].dataType).alias("_ts"), "_row",
                          F.lit(CARRY).alias("_side"), F.lit(0).cast("bigint").alias("_rows"), "_bucket"))
    so_far = (Window.partitionBy(*keys, "_bucket").orderBy(F.col("_ts").asc_nulls_first(), "_side")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    answered = (tagged.unionByName(carried_in)
                .withColumn("_carried", F.last("_row", ignorenulls=True).over(so_far))
                .filter(F.col("_side") == SPINE)
                .select(*keys, F.col("_ts").alias(spine_ts), "_rows", "_carried"))
    return lookup_counted(spine, answered, [*keys, spine_ts], limit)


def _wider(spark, one: T.DataType, other: T.DataType) -> T.DataType:
    """The type that holds values of both; text with anything else is text."""
    if one == other:
        return one
    if T.StringType() in (one, other):
        return T.StringType()
    none = spark.range(0)
    return none.select(F.lit(None).cast(one)).union(none.select(F.lit(None).cast(other))).schema[0].dataType


def _time_type(spark, one: T.DataType, other: T.DataType) -> T.DataType:
    """The type in which two times are compared. Text is read as points in time (session time where it names no
    zone), never compared as text: forms differ, and 'T' sorts after a blank. Text that is no time is an error."""
    if T.StringType() not in (one, other):
        return _wider(spark, one, other)
    kinds = {kind for kind in (one, other) if kind != T.StringType()}
    return T.TimestampNTZType() if T.TimestampNTZType() in kinds else T.TimestampType()


def _in_reach(features: DataFrame, spine: DataFrame, spine_ts: str, feature_ts: str, ttl: timedelta | None) -> DataFrame:
    """Feature rows that some spine row may still see: not after the last one, not ``ttl`` before the first."""
    bounds = spine.agg(F.min(spine_ts).alias("first"), F.max(spine_ts).alias("last"))
    kept = F.col(feature_ts) <= bounds.select("last").scalar()
    if ttl is not None:
        kept = kept & (F.col(feature_ts) >= bounds.select("first").scalar() - F.lit(ttl))
    return features.filter(kept)


@dataclass(frozen=True)
class AsofTable:
    """Feature rows to carry: time column, tie-breaking created column, fields, and the age up to which they matter."""

    rows: DataFrame
    ts: str
    created: str | None
    fields: list[str]
    ttl: timedelta | None = None


def asof_carry_all(spine: DataFrame, tables: list[AsofTable], keys: list[str], spine_ts: str,
                   hot_keys: HotKeys = DEFAULT_HOT_KEYS, bucket: str = "minute") -> DataFrame:
    """All spine rows and columns plus ``_carried_0``, ``_carried_1``, ...: struct of ``event_ts`` and the table's
    fields, or NULL.

    All tables are carried by one window: one shuffle and one sort, whatever their number. The newest row of a
    table wins even where its fields are NULL. Equal times match. Ties: newest created time, then lowest row
    hash. ``bucket`` is the ``date_trunc`` unit for hot keys. Keys and times of different types are compared in
    the type that holds all, times given as text as points in time; spine columns stay as they are. Rows older than
    a table's ``ttl`` at the first spine row may be left out.
    """
    spark = spine.sparkSession
    wide = {name: reduce(partial(_wider, spark), [t.rows.schema[name].dataType for t in tables], spine.schema[name].dataType)
            for name in keys}
    wide[spine_ts] = reduce(partial(_time_type, spark), [t.rows.schema[t.ts].dataType for t in tables], spine.schema[spine_ts].dataType)
    tables = [replace(t, rows=t.rows.withColumn(t.ts, F.col(t.ts).cast(wide[spine_ts])))
              if t.rows.schema[t.ts].dataType == T.StringType() else t for t in tables]
    change = {n: t for n, t in wide.items() if spine.schema[n].dataType != t}
    if change:
        inner = {n: f"_wide_{n}" for n in change}
        widened = spine.withColumns({inner[n]: F.col(n).cast(t) for n, t in change.items()})
        renamed = [replace(t, rows=t.rows.withColumnsRenamed({n: inner[n] for n in keys if n in change})) for t in tables]
        carried = asof_carry_all(widened, renamed, [inner.get(k, k) for k in keys], inner.get(spine_ts, spine_ts), hot_keys, bucket)
        return carried.select(*spine.columns, *[f"_carried_{i}" for i in range(len(tables))])
    rows = [_feature_rows(spine, _in_reach(t.rows, spine, spine_ts, t.ts, t.ttl), keys, spine_ts, t.ts, t.created, t.fields)
            for t in tables]
    found = hot_keys.find([*rows, spine], keys, within=[*[t.rows for t in tables], spine])
    if found is None:
        return _carry_in_window(spine, rows, keys, spine_ts)
    hot, limit = found
    marked, marked_rows = mark_hot(spine, hot, keys), [mark_hot(r, hot, keys) for r in rows]
    light = _carry_in_window(marked.filter(~F.col("_hot")).drop("_hot"),
                             [r.filter(~F.col("_hot")).drop("_hot") for r in marked_rows], keys, spine_ts)
    heavy = marked.filter("_hot").drop("_hot")
    for i, r in enumerate(marked_rows):
        heavy = (_carry_in_buckets(heavy, r.filter("_hot").drop("_hot"), keys, spine_ts, bucket, limit)
                 .withColumnRenamed("_carried", f"_carried_{i}"))
    return light.unionByName(heavy)


def asof_carry(spine: DataFrame, features: DataFrame, keys: list[str], spine_ts: str, feature_ts: str,
               created: str | None, fields: list[str], hot_keys: HotKeys = DEFAULT_HOT_KEYS,
               bucket: str = "minute", ttl: timedelta | None = None) -> DataFrame:
    """``asof_carry_all`` for one table; the struct is ``_carried``."""
    table = AsofTable(features, feature_ts, created, fields, ttl)
    return asof_carry_all(spine, [table], keys, spine_ts, hot_keys, bucket).withColumnRenamed("_carried_0", "_carried")


def within_ttl(carried: Column, spine_ts: Column, ttl: timedelta | None) -> Column:
    """The carried row is fresh enough; the limit itself still counts."""
    found = carried.isNotNull()
    if ttl is None:
        return found
    return found & (carried["event_ts"].cast("timestamp") >= spine_ts.cast("timestamp") - F.lit(ttl))


def point_in_time_join(spine: DataFrame, features: DataFrame, keys: list[str], spine_ts: str, feature_ts: str,
                       fields: list[str], created: str | None = None, ttl: timedelta | None = None,
                       hot_keys: HotKeys = DEFAULT_HOT_KEYS, bucket: str = "minute") -> DataFrame:
    """Left as-of join; a spine row without a fresh match keeps NULL features."""
    carried = asof_carry(spine, features, keys, spine_ts, feature_ts, created, fields, hot_keys, bucket, ttl)
    fresh = within_ttl(F.col("_carried"), F.col(spine_ts), ttl)
    return carried.select(*spine.columns,
                          *[F.when(fresh, F.col("_carried")[c]).alias(c) for c in fields])
