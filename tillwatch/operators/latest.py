"""Newest row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def instant(value, like: T.DataType) -> Column:
    """A point in time as a literal of a column's type; text and naive values are session time."""
    return F.lit(str(value)).cast("timestamp").cast(like)


def between(df: DataFrame, event_ts: str, start=None, end=None) -> DataFrame:
    """Rows with an event time in ``(start, end]``; a missing side is open."""
    kind = df.schema[event_ts].dataType
    rows = df
    if start is not None:
        rows = rows.filter(F.col(event_ts) > instant(start, kind))
    if end is not None:
        rows = rows.filter(F.col(event_ts) <= instant(end, kind))
    return rows


def latest_per_entity(df: DataFrame, keys: list[str], event_ts: str, created: str | None = None) -> DataFrame:
    """Newest row per key by (event time, created, lowest row hash); rows without key are left out.

    Like the first-row form, each map task keeps one row per key before the shuffle.
    """
    rows = df
    for name in keys:
        rows = rows.filter(F.col(name).isNotNull())
    order = [F.col(event_ts).desc_nulls_last()]
    if created:
        order.append(F.col(created).desc_nulls_last())
    order.append(F.xxhash64(*[F.col(c) for c in df.columns]).asc())
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
