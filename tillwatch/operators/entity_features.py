"""Mean and count of amounts per customer and per terminal, attached to every row."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwatch.functions.amounts import safe_ratio
from tillwatch.operators.skew import DEFAULT_HOT_KEYS, HotKeys, lookup_counted, plain_lookup
from tillwatch.session import scratch_path

# key column -> (mean column, count column)
ENTITY_COLUMNS = {
    "customer_id": ("avg_customer_amount", "customer_tx_count"),
    "terminal_id": ("avg_terminal_amount", "terminal_tx_count"),
}


def amount_by_entity(df: DataFrame, key: str) -> DataFrame:
    """One row per key: mean amount, number of known amounts, number of rows."""
    mean, count = ENTITY_COLUMNS[key]
    return df.groupBy(key).agg(F.avg("tx_amount").alias(mean), F.count("tx_amount").alias(count),
                               F.count(F.lit(1)).alias("_rows"))


def attach_by_entity(rows: DataFrame, history: DataFrame, key: str,
                     hot_keys: HotKeys = DEFAULT_HOT_KEYS) -> DataFrame:
    """``avg/count over (partition by key)`` of ``history``, attached to ``rows``: the rows of ``history``, possibly
    with more columns.

    Where a key could be hot, amounts are added up per key once and stored, combined before the shuffle. A small
    table of keys is then broadcast: no row moves, however many a key has. With more keys, a window shuffles and sorts
    the rows once; if one of them is hot, its rows are scattered and all meet their sums in a join.
    """
    limit = hot_keys.limit(history)
    if limit is not None:
        path = scratch_path(history.sparkSession, f"by-{key}")
        known = amount_by_entity(history, key)
        known.write.parquet(path)
        known = history.sparkSession.read.schema(known.schema).parquet(path)
        if known.count() <= hot_keys.small_keys:
            return plain_lookup(rows, known.drop("_rows"), [key], small=True)
        if not known.filter(F.col("_rows") > limit).isEmpty():
            return lookup_counted(rows, known, [key], limit)
    return _attach_by_window(rows, key)


def _attach_by_window(rows: DataFrame, key: str) -> DataFrame:
    mean, count = ENTITY_COLUMNS[key]
    whole = Window.partitionBy(key)
    return rows.withColumns({mean: F.avg("tx_amount").over(whole), count: F.count("tx_amount").over(whole)})


def customer_terminal_features(df: DataFrame, hot_keys: HotKeys = DEFAULT_HOT_KEYS,
                               as_window: bool = False) -> DataFrame:
    """The five derived columns of the training frame, over all rows of ``df``.

    Keys are counted first, see ``attach_by_entity``; both aggregates read ``df`` itself, not the already joined
    frame. ``as_window`` gives a window per key without counting.
    """
    out = df
    for key in ENTITY_COLUMNS:
        out = _attach_by_window(out, key) if as_window else attach_by_entity(out, df, key, hot_keys)
    return out.withColumn("customer_amount_ratio",
                          safe_ratio(F.col("tx_amount"), F.col("avg_customer_amount")))
