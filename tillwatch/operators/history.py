"""Counts and means over the recent past of a customer or terminal.

Spark recomputes a sliding range frame for every row: cheap while a key has few rows, quadratic
when it has many, and always the whole key in one task. So where all keys have few rows, they use
the sliding frame, and otherwise running sums: time is cut into buckets as long as the frame,
a frame is then the end of one bucket plus the start of the next, and both are running sums,
linear in the rows. A key is spread over its time buckets, and its rows are first added up
per second, so one bucket never has more rows than the frame has seconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwatch.operators.skew import DEFAULT_HOT_KEYS, HotKeys, lookup_join, plain_lookup

# Above about this many rows of a key, running sums cost less than recomputed frames; both give the same.
SLIDING_ROWS = 2_000
#: Rows of a task: beyond that many in each of Spark's shuffle partitions, there are more partitions.
ROWS_PER_PART = 500_000


def _dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` by its keys in as many parts as ``rows`` need; as Spark deals it where its own number is enough."""
    parts = -(-rows // ROWS_PER_PART)
    return df.repartition(parts, *keys) if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def recent_activity(df: DataFrame, key: str, frames: dict[str, int], last: int = -1,
                    time: str = "tx_time_seconds", amount: str = "tx_amount") -> DataFrame:
    """Per (``_who``, ``_at``), the key in a struct and a second: rows, known amounts and their sum in
    ``[t - frame, t + last]``.

    ``last`` is -1 (the past only) or 0 (up to and including the row's own second). ``df`` is a stored table,
    whose rows are counted; the number of tasks grows with them.
    """
    if last not in (-1, 0):
        raise ValueError("last must be -1 or 0")
    if min(frames.values()) < 1:
        raise ValueError("frames are whole seconds, at least 1")
    seconds = (df.filter(F.col(time).isNotNull())
               .groupBy(F.struct(key).alias("_who"), F.col(time).alias("_at"))
               .agg(F.count(F.lit(1)).alias("_n"),
                    F.count(amount).alias("_known"),
                    F.coalesce(F.sum(amount), F.lit(0.0)).alias("_sum")))
    lengths = F.array(*[F.lit(s).cast("bigint") for s in frames.values()])
    per_frame = seconds.withColumn("_frame", F.explode(lengths))
    placed = per_frame.withColumn("_bucket", F.expr("(_at - pmod(_at, _frame)) div _frame"))
    measures = ["_n", "_known", "_sum"]
    n = df.count() * 2 * len(frames)
    # The row itself, and a marker where its frame starts: always in the bucket before.
    entries = placed.select("_who", "_at", "_frame", F.explode(F.array(
        F.struct(F.col("_bucket").alias("bucket"), F.col("_at").alias("pos"), F.lit(False).alias("start"),
                 *[F.col(m).alias(m) for m in measures]),
        F.struct((F.col("_bucket") - 1).alias("bucket"), (F.col("_at") - F.col("_frame")).alias("pos"),
                 F.lit(True).alias("start"),
                 F.lit(0).cast("bigint").alias("_n"), F.lit(0).cast("bigint").alias("_known"),
                 F.lit(0.0).alias("_sum")))).alias("e")).select("_who", "_at", "_frame", "e.*")
    entries = _dealt(entries, n, "_who", "_frame", "bucket")
    block = Window.partitionBy("_who", "_frame", "bucket")
    up_to = block.orderBy("pos").rangeBetween(Window.unboundedPreceding, last)
    onwards = block.orderBy(F.col("pos").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    halves = entries.select("_who", "_at", "_frame", *[
        F.when(F.col("start"), F.sum(m).over(onwards)).otherwise(F.sum(m).over(up_to)).alias(m)
        for m in measures])
    return _dealt(halves, n, "_who", "_at").groupBy("_who", "_at").agg(*[
        F.coalesce(F.sum(F.when(F.col("_frame") == length, F.col(m))), F.lit(0)).alias(f"{m}_{name}")
        for name, length in frames.items() for m in measures])


def _at_its_second(rows: DataFrame, summed: DataFrame, key: str, time: str, hot_seconds: DataFrame | None) -> DataFrame:
    """Left join of rows to ``summed``, one row per (``_who``, ``_at``).

    ``_who`` is the key in a struct: a NULL key equals itself there, and the join keeps the partitioning of the sums.
    Seconds in ``hot_seconds`` (bounded) take their sums from a broadcast and pass the shuffle scattered.
    """
    keyed = rows.withColumn("_who", F.struct(key))
    values = [c for c in summed.columns if c not in ("_who", "_at")]
    if hot_seconds is None:
        right = summed.select(F.col("_who").alias("_r_who"), "_at", *values)
        return keyed.join(right, (F.col("_who") == F.col("_r_who")) & (F.col(time) == F.col("_at")), "left").drop("_who", "_r_who", "_at")
    left, names = keyed.withColumn("_at", F.col(time)), ["_who", "_at"]
    hot = plain_lookup(hot_seconds, summed.join(F.broadcast(hot_seconds), names, "left_semi"), names)
    return lookup_join(left, summed, hot, names).drop(*names)


def _over_frames(rows: DataFrame, history: DataFrame, key: str, frames: dict[str, int], last: int, time: str,
                 amount: str, measures: dict[str, tuple[str, Column, Column]], hot_keys: HotKeys,
                 sliding_rows: int) -> DataFrame:
    """Attach measures, each given as frame name, aggregate to slide, the same from ``recent_activity``.

    The rows of the fullest key are counted first, from the key column alone. Without a busy key, and so without a
    hot one, everything is one window: one shuffle and one sort. With one, every key goes by running sums: three
    shuffles of narrow rows, one per second, and one of the rows themselves to meet their second.
    """
    fullest = history.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).agg(F.max("_rows")).first()[0] or 0
    if fullest <= sliding_rows:
        by_time = Window.partitionBy(key).orderBy(time)
        return _dealt(rows, history.count(), key).withColumns({
            name: F.when(F.col(time).isNotNull(), aggregate.over(by_time.rangeBetween(-frames[frame], last)))
            for name, (frame, aggregate, _) in measures.items()})
    limit = hot_keys.limit(history)
    found = None
    if limit is not None and fullest > limit:  # only a hot key can have a hot second
        found = hot_keys.find([history.select(F.struct(key).alias("_who"), F.col(time).alias("_at"))], ["_who", "_at"],
                              within=[history])
    summed = recent_activity(history, key, frames, last, time, amount).select(
        "_who", "_at", *[value.alias(name) for name, (_, _, value) in measures.items()])
    return _at_its_second(rows, summed, key, time, found and found[0])


def past_only_features(rows: DataFrame, history: DataFrame, key: str, frames: dict[str, int], prefix: str,
                       hot_keys: HotKeys = DEFAULT_HOT_KEYS, time: str = "tx_time_seconds",
                       amount: str = "tx_amount", sliding_rows: int = SLIDING_ROWS) -> DataFrame:
    """Count and mean of the key's earlier amounts per frame; never the row itself or a later row.

    Transactions of the same second are not the past of each other. ``rows`` are the rows of
    ``history``, possibly with more columns; ``history`` is read several times, so pass a table.
    """
    measures = {}
    for name in frames:
        measures[f"{prefix}_tx_count_{name}"] = (name, F.count(amount), F.col(f"_known_{name}"))
        measures[f"{prefix}_avg_amount_{name}"] = (
            name, F.avg(amount), F.try_divide(F.col(f"_sum_{name}"), F.col(f"_known_{name}")))
    return _over_frames(rows, history, key, frames, -1, time, amount, measures, hot_keys, sliding_rows)


def tx_frequency(rows: DataFrame, history: DataFrame, key: str, frames: dict[str, int], prefix: str,
                 hot_keys: HotKeys = DEFAULT_HOT_KEYS, time: str = "tx_time_seconds",
                 amount: str = "tx_amount", sliding_rows: int = SLIDING_ROWS) -> DataFrame:
    """Transactions of the key in the last N seconds, the row's own second included."""
    measures = {f"{prefix}_tx_last_{name}": (name, F.count(F.lit(1)), F.col(f"_n_{name}")) for name in frames}
    return _over_frames(rows, history, key, frames, 0, time, amount, measures, hot_keys, sliding_rows)


def with_earlier_amounts(rows: DataFrame, key: str, mean: str, count: str, time: str = "tx_time_seconds",
                         amount: str = "tx_amount", bucket: int = 86_400) -> DataFrame:
    """Add mean and number of all known amounts of the key before the row's own second.

    Running sums within a bucket of time, plus the sums of the buckets before it: no task holds more than
    one bucket of a key. Without a key or time there is no past: NULL and 0.
    """
    place = F.expr(f"({time} - pmod({time}, {bucket})) div {bucket}")
    placed = rows.withColumn("_bucket", place)
    per_bucket = (placed.filter(F.col(key).isNotNull() & F.col("_bucket").isNotNull())
                  .groupBy(F.col(key).alias("_key"), F.col("_bucket").alias("_at"))
                  .agg(F.sum(amount).alias("_sum"), F.count(amount).alias("_n")))
    earlier = Window.partitionBy("_key").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    before = per_bucket.select("_key", "_at", F.sum("_sum").over(earlier).alias("_sum0"), F.sum("_n").over(earlier).alias("_n0"))
    so_far = Window.partitionBy(key, "_bucket").orderBy(time).rangeBetween(Window.unboundedPreceding, -1)
    here = placed.withColumns({"_sum1": F.sum(amount).over(so_far), "_n1": F.count(amount).over(so_far)})
    joined = here.join(before, (F.col(key) == F.col("_key")) & (F.col("_bucket") == F.col("_at")), "left")
    known = F.col("_key").isNotNull()
    n = F.when(known, F.coalesce("_n0", F.lit(0)) + F.coalesce("_n1", F.lit(0))).otherwise(F.lit(0)).cast("bigint")
    total = F.coalesce("_sum0", F.lit(0.0)) + F.coalesce("_sum1", F.lit(0.0))
    return joined.select(*rows.columns, F.when(n > 0, total / n).alias(mean), n.alias(count))
