"""Hot keys: find them, and spread their rows over many tasks.

A key is hot when it holds more rows than one task should take. The number of hot keys has a
fixed bound whatever the table size (a key needs more than 1/``max_keys`` of all rows), so what
belongs to the hot keys, one row each, may be broadcast.

Rows are counted, not estimated: a small compressed file can hold any number of rows of one key. The
count of a stored table comes from its file footers. Only a table with more rows than one task takes
has its keys counted, and only if a key turns out to be hot is the other plan taken.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.session import scratch_path


@dataclass(frozen=True)
class HotKeys:
    """``rows_per_task``: what one task takes; ``max_keys``: bound of the hot keys; ``small_keys``: a stored
    table of at most that many keys, one short row each, is broadcast whole."""

    rows_per_task: int = 1_000_000
    max_keys: int = 100_000
    small_keys: int = 1_000_000

    def limit(self, *tables: DataFrame) -> float | None:
        """Rows above which a key of the tables together is hot; None when none can be."""
        return self.limit_of(sum(t.count() for t in tables))

    def limit_of(self, total: int) -> float | None:
        """``limit`` of tables whose rows are counted already."""
        return float(max(self.rows_per_task, total / self.max_keys)) if total > self.rows_per_task else None

    def find(self, tables: list[DataFrame], keys: list[str],
             within: list[DataFrame] | None = None) -> tuple[DataFrame, float] | None:
        """The hot keys of the tables together, as a stored table, and the limit; None when there are none.

        Reads the key columns only and adds up before the shuffle. ``within``: tables that hold at least these
        rows and are cheaper to count.
        """
        limit = self.limit(*(within or tables))
        if limit is None:
            return None
        rows = reduce(DataFrame.unionByName, [t.select(*keys) for t in tables])
        hot = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > limit).select(*keys)
        path = scratch_path(hot.sparkSession, "hot-keys")
        hot.write.parquet(path)
        hot = hot.sparkSession.read.schema(hot.schema).parquet(path)
        return None if hot.isEmpty() else (hot, limit)


DEFAULT_HOT_KEYS = HotKeys()


def _match(keys: list[str], prefix: str) -> Column:
    """NULL-safe: a NULL key is a group of its own, as in a window."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in df.columns])


def mark_hot(df: DataFrame, hot: DataFrame, keys: list[str], flag: str = "_hot") -> DataFrame:
    """Add a flag for rows whose key is in the bounded table ``hot``."""
    small = F.broadcast(_prefixed(hot.select(*keys), "_h_").withColumn(flag, F.lit(True)))
    return (df.join(small, _match(keys, "_h_"), "left").drop(*[f"_h_{k}" for k in keys])
            .withColumn(flag, F.coalesce(F.col(flag), F.lit(False))))


def plain_lookup(fact: DataFrame, dim: DataFrame, keys: list[str], small: bool = False) -> DataFrame:
    """Left join to a table with one row per key, NULL-safe. ``small``: the table is broadcast, so no row moves."""
    right = _prefixed(dim, "_r_")
    return (fact.join(F.broadcast(right) if small else right, _match(keys, "_r_"), "left")
            .select(*fact.columns, *[F.col(f"_r_{c}").alias(c) for c in dim.columns if c not in keys]))


def lookup_join(fact: DataFrame, rest: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """Left join to tables with one row per key: ``hot`` (bounded) by broadcast, ``rest`` by shuffle.

    Rows of hot keys get their values from the broadcast and pass the shuffle scattered by
    content, so no task gets a whole hot key. The scatter depends on the row and the partition it
    comes from, never on row order: a retried task repeats it. ``hot`` must have a row for every
    hot key, with NULL values where the key is unknown.
    """
    values = [c for c in rest.columns if c not in keys]
    small = F.broadcast(_prefixed(hot.select(*keys, *values), "_h_").withColumn("_hot", F.lit(True)))
    content = F.pmod(F.xxhash64(*[F.col(c) for c in fact.columns]), F.lit(1 << 30))
    marked = (fact.join(small, _match(keys, "_h_"), "left").drop(*[f"_h_{k}" for k in keys])
              .withColumn("_scatter", F.when(F.col("_hot"), F.lit(1) + content + F.spark_partition_id())
                          .otherwise(F.lit(0).cast("bigint"))))
    # Always 0, but not as a literal: Spark would fold that into a filter and shuffle by key alone.
    zero = F.pmod(F.xxhash64(*[F.col(f"_r_{k}") for k in keys]), F.lit(1).cast("bigint"))
    large = _prefixed(rest, "_r_").withColumn("_r_scatter", zero)
    joined = marked.join(large, _match(keys, "_r_") & (F.col("_scatter") == F.col("_r_scatter")), "left")
    return joined.select(*fact.columns, *[
        F.when(F.col("_hot"), F.col(f"_h_{c}")).otherwise(F.col(f"_r_{c}")).alias(c) for c in values])


def lookup_counted(fact: DataFrame, dim: DataFrame, keys: list[str], limit: float | None,
                   rows: str = "_rows") -> DataFrame:
    """``lookup_join`` where ``dim`` already knows the rows of each key (column ``rows``).

    Both parts filter the same aggregate, so Spark runs it once and reuses its exchange.
    """
    values = [c for c in dim.columns if c != rows]
    if limit is None:
        return plain_lookup(fact, dim.select(values), keys)
    return lookup_join(fact, dim.filter(F.col(rows) <= limit).select(values),
                       dim.filter(F.col(rows) > limit).select(values), keys)


def lookup_any(fact: DataFrame, dim: DataFrame, keys: list[str], hot_keys: HotKeys) -> DataFrame:
    """``lookup_join`` to a stored table with one row per key."""
    found = hot_keys.find([fact], keys)
    if found is None:
        return plain_lookup(fact, dim, keys)
    hot, _ = found
    known = plain_lookup(hot, dim.join(F.broadcast(_prefixed(hot, "_s_")), _match(keys, "_s_"), "left_semi"), keys)
    return lookup_join(fact, dim, known, keys)
