"""Running amounts per key and day, kept as a table and extended load by load.

A row's features are the mean and the number of its key's known amounts before its own second, the
definition that training uses (``history.with_earlier_amounts``). Batch scoring and streams look them up here
and never read the history again:

    days      key, day, sum and number of that day, and of all days before it; cut by a hash of the key
    moments   key, second, sum and number; one folder per day and load

A load rewrites the day sums of its own keys and days from the moments of those days, hence a load that is
repeated changes nothing, and rows that come late move the sums of the days after them. A look-up reads the
moments of the days it asks for and the parts that its keys fall into.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.functions.amounts import as_money, exact_sum, safe_ratio
from tillwatch.operators.entity_features import ENTITY_COLUMNS
from tillwatch.operators.skew import DEFAULT_HOT_KEYS, HotKeys, lookup_any
from tillwatch.plans.feature_store.parted import PART, PARTS, Commit, PartedTable
from tillwatch.sources.paths import folders

DAYS_DDL = "key BIGINT, day BIGINT, sum DOUBLE, n BIGINT, sum_before DOUBLE, n_before BIGINT"
MOMENTS_DDL = "key BIGINT, at BIGINT, sum DOUBLE, n BIGINT, day BIGINT, load STRING"
DAY = 86_400
#: Up to so many asked pairs of key and day, the moments are cut to them before they are shuffled.
FEW_PAIRS = 100_000
#: Asking rows of a task: their number grows with the rows, and a few tasks for each core keep the cores evenly busy.
ASKING_ROWS = 125_000


def _day(at: Column) -> Column:
    return F.floor(at / F.lit(DAY)).cast("bigint")


def _plus(a: Column, b: Column) -> Column:
    """Sum of two amounts, in decimals where both are some."""
    return F.coalesce((as_money(a) + as_money(b)).cast("double"), a + b)


class AmountHistory:
    """The history of one key column (whole numbers); times are whole seconds."""

    def __init__(self, spark: SparkSession, root: str, key: str, time: str = "tx_time_seconds",
                 amount: str = "tx_amount", parts: int = PARTS):
        self.spark, self.root, self.key, self.time, self.amount = spark, root.rstrip("/"), key, time, amount
        self.days = PartedTable(spark, f"{self.root}/days", T.StructType.fromDDL(DAYS_DDL), ["key"], parts)

    def _moments(self, days: list[int]) -> DataFrame:
        """Moments of some days: only their folders are read."""
        path = f"{self.root}/moments"
        there = set(folders(self.spark, path))
        paths = [f"{path}/day={day}" for day in days if f"day={day}" in there]
        if not paths:
            return self.spark.createDataFrame([], MOMENTS_DDL)
        return self.spark.read.schema(MOMENTS_DDL).option("basePath", path).parquet(*paths)

    def extend(self, rows: DataFrame, load: str) -> None:
        """Add the rows of a load. The same load again must hold the same rows; it replaces itself.

        Rows without key or time have no history; a NULL amount counts as none. Every step adds up before it
        shuffles; the days of a load (not its rows) pass the driver.
        """
        key, at = F.col(self.key).cast("bigint"), F.col(self.time).cast("bigint")
        moments = (rows.filter(key.isNotNull() & at.isNotNull()).groupBy(key.alias("key"), at.alias("at"))
                   .agg(F.coalesce(exact_sum(F.col(self.amount).cast("double")), F.lit(0.0)).alias("sum"), F.count(self.amount).alias("n"))
                   .withColumns({"day": _day(F.col("at")), "load": F.lit(load)}))
        (moments.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("day", "load").parquet(f"{self.root}/moments"))
        mine = self.spark.read.schema(MOMENTS_DDL).parquet(f"{self.root}/moments").filter(F.col("load") == load)
        days = sorted(r[0] for r in mine.select("day").distinct().collect())
        if not days:
            return
        # Keys of these days that the load does not name are left out after they are added up: no join.
        sums = (self._moments(days).groupBy("key", "day")
                .agg(exact_sum(F.col("sum")).alias("sum"), F.sum("n").alias("n"), F.max(F.col("load") == load).alias("mine"))
                .filter("mine").drop("mine").persist())

        def step(head: Commit) -> Commit:
            touched = self.days.parts_of(sums)
            both = (self.days.rows(head, touched).select("key", "day", F.struct(F.lit(0).alias("new"), "sum", "n").alias("of"))
                    .unionByName(sums.select("key", "day", F.struct(F.lit(1).alias("new"), "sum", "n").alias("of"))))
            # One exchange by part; the grouping, the window and the write all keep it.
            both = both.withColumn(PART, self.days.part()).repartition(PART)
            merged = both.groupBy(PART, "key", "day").agg(F.max("of").alias("of"))
            earlier = Window.partitionBy(PART, "key").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
            totals = [F.coalesce(exact_sum(F.col("of.sum"), earlier), F.lit(0.0)).alias("sum_before"),
                      F.coalesce(F.sum("of.n").over(earlier), F.lit(0)).alias("n_before")]
            out = merged.select("key", "day", "of.sum", "of.n", *totals, PART)
            return self.days.commit(head, self.days.write_dealt(self.days.typed(out, PART)), head.mark)

        try:
            self.days.change(step)
        finally:
            sums.unpersist()

    def attach(self, rows: DataFrame, mean: str, count: str, hot_keys: HotKeys = DEFAULT_HOT_KEYS,
               asked: DataFrame | None = None) -> DataFrame:
        """Add ``mean`` (NULL without past) and ``count`` of the known amounts before each row's second.

        The rows of each key and day are counted first. Where no task gets too many of them, the rows go once to the
        moments of their key and day and take the running sums along. Otherwise what is asked is reduced to one row
        per key and second, so a key that fills the table is no burden; the answers come back by a look-up that
        spreads the rows of hot keys. Rows without key or time get NULL and 0.

        ``asked``: the keys and times of ``rows``, in a frame that is cheaper to read more than once: a stored or
        persisted one. Only the look-up of hot keys evaluates ``rows`` itself more than once.
        """
        asked = rows if asked is None else asked
        key, at = F.col(self.key).cast("bigint"), F.col(self.time).cast("bigint")
        pairs = (asked.filter(key.isNotNull() & at.isNotNull()).groupBy(key.alias("key"), _day(at).alias("day"))
                 .agg(F.count(F.lit(1)).alias("_rows")))
        seen = pairs.agg(F.collect_set("day").alias("days"), F.collect_set(self.days.part()).alias("parts"), F.sum("_rows").alias("rows"),
                         F.max("_rows").alias("most"), F.count(F.lit(1)).alias("pairs")).first()
        days, parts = sorted(seen["days"]), sorted(seen["parts"])
        pairs = pairs.select("key", "day")
        before, today = self._before(pairs, self.days.rows(self.days.head(), parts)), self._moments(days)
        limit = hot_keys.limit_of(seen["rows"] or 0)
        if limit is not None and seen["most"] > limit:
            return self._looked_up(rows, before, today.join(pairs, ["key", "day"], "left_semi"), mean, count, hot_keys, asked)
        if seen["pairs"] <= FEW_PAIRS:
            today = today.join(pairs, ["key", "day"], "left_semi")
        return self._taken_along(rows, before, today, mean, count, -(-(seen["rows"] or 0) // ASKING_ROWS))

    def _taken_along(self, rows: DataFrame, before: DataFrame, today: DataFrame, mean: str, count: str, tasks: int) -> DataFrame:
        """One exchange of ``rows``, to the stored sums of their key and day, in ``tasks`` tasks if more than one."""
        key, at = F.col(self.key).cast("bigint"), F.col(self.time).cast("bigint")
        known = key.isNotNull() & at.isNotNull()
        # Rows that ask for nothing are spread by content and map partition.
        content = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(1 << 30)) + F.spark_partition_id()
        asking = rows.withColumns({
            "_h_key": key, "_h_day": _day(at), "_h_at": at, "_h_apart": F.when(known, F.lit(0).cast("bigint")).otherwise(content + 1),
            "_h_sum": F.lit(0.0), "_h_n": F.lit(0).cast("bigint"), "_h_asks": F.lit(True)})
        stored = (today.select("key", "day", "at", "sum", "n")
                  .unionByName(before.select("key", "day", (F.col("day") * DAY - 1).alias("at"), "sum", "n"))
                  .select(F.col("key").alias("_h_key"), F.col("day").alias("_h_day"), F.col("at").alias("_h_at"),
                          F.lit(0).cast("bigint").alias("_h_apart"), F.col("sum").alias("_h_sum"), F.col("n").alias("_h_n"),
                          F.lit(False).alias("_h_asks")))
        earlier = (Window.partitionBy("_h_key", "_h_day", "_h_apart").orderBy("_h_at")
                   .rangeBetween(Window.unboundedPreceding, -1))
        both = asking.unionByName(stored, allowMissingColumns=True)
        if tasks > 1:
            both = both.repartition(tasks, "_h_key", "_h_day", "_h_apart")
        both = both.withColumns({
            "_h_total": F.sum("_h_sum").over(earlier), "_h_count": F.sum("_h_n").over(earlier)})
        n = F.when(F.col("_h_apart") == 0, F.coalesce("_h_count", F.lit(0).cast("bigint"))).otherwise(F.lit(0).cast("bigint"))
        return both.filter("_h_asks").select(*rows.columns, F.when(n > 0, F.col("_h_total") / n).alias(mean), n.alias(count))

    def _looked_up(self, rows: DataFrame, before: DataFrame, today: DataFrame, mean: str, count: str, hot_keys: HotKeys,
                   asked: DataFrame) -> DataFrame:
        """One answer per key and second, found again by the rows."""
        key, at = F.col(self.key).cast("bigint"), F.col(self.time).cast("bigint")
        asked = (asked.filter(key.isNotNull() & at.isNotNull()).select(key.alias("key"), at.alias("at")).distinct()
                 .withColumn("day", _day(F.col("at"))))
        known = (today.select("key", "day", "at", "sum", "n", F.lit(False).alias("asks"))
                 .unionByName(before.select("key", "day", (F.col("day") * DAY - 1).alias("at"), "sum", "n", F.lit(False).alias("asks")))
                 .unionByName(asked.select("key", "day", "at", F.lit(0.0).alias("sum"), F.lit(0).cast("bigint").alias("n"), F.lit(True).alias("asks"))))
        earlier = Window.partitionBy("key", "day").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
        answers = (known.withColumns({"_sum": F.sum("sum").over(earlier), "_n": F.coalesce(F.sum("n").over(earlier), F.lit(0))})
                   .filter("asks").select(F.col("key").alias(self.key), F.col("at").alias(self.time),
                                          F.when(F.col("_n") > 0, F.col("_sum") / F.col("_n")).alias(mean), F.col("_n").alias(count)))
        found = lookup_any(rows, answers, [self.key, self.time], hot_keys)
        return found.withColumn(count, F.coalesce(F.col(count), F.lit(0).cast("bigint")))

    def totals(self, mean: str, count: str, total: str = "total") -> DataFrame:
        """One row per key: sum, mean and number of all stored amounts, and the last day; from the day sums alone."""
        both = _plus(F.col("sum_before"), F.col("sum"))
        last = F.max_by(F.struct(both.alias("sum"), (F.col("n_before") + F.col("n")).alias("n")), "day")
        found = self.days.rows(self.days.head()).groupBy(F.col("key").alias(self.key)).agg(last.alias("all"), F.max("day").alias("last_day"))
        return found.select(self.key, F.col("all.sum").alias(total), F.try_divide("all.sum", "all.n").alias(mean),
                            F.col("all.n").alias(count), "last_day")

    @staticmethod
    def _before(asked: DataFrame, days: DataFrame) -> DataFrame:
        """(key, day, sum, n) of all days before each asked day, whether that day is stored or not."""
        through = F.struct((F.col("sum_before") + F.col("sum")).alias("sum"), (F.col("n_before") + F.col("n")).alias("n"))
        stored = days.select("key", "day", through.alias("through"), F.lit(False).alias("asks"))
        wanted = asked.select("key", "day", F.lit(None).cast(stored.schema["through"].dataType).alias("through"), F.lit(True).alias("asks"))
        earlier = Window.partitionBy("key").orderBy("day").rangeBetween(Window.unboundedPreceding, -1)
        carried = stored.unionByName(wanted).withColumn("last", F.last("through", ignorenulls=True).over(earlier))
        return carried.filter("asks AND last IS NOT NULL").select("key", "day", "last.sum", "last.n")


class EntityHistories:
    """Histories of all entities behind the model's features."""

    def __init__(self, spark: SparkSession, root: str, parts: int = PARTS):
        self.of = {key: AmountHistory(spark, f"{root.rstrip('/')}/{key}", key, parts=parts) for key in ENTITY_COLUMNS}

    def extend(self, rows: DataFrame, load: str) -> None:
        for history in self.of.values():
            history.extend(rows, load)

    def features(self, rows: DataFrame, hot_keys: HotKeys = DEFAULT_HOT_KEYS) -> DataFrame:
        """``rows`` with the five derived columns of the training frame, as ``training.past_features`` gives them.

        ``rows`` is a stored or persisted frame: each entity reads its keys and times there, not behind the look-up
        of the entity before."""
        out = rows
        for key, (mean, count) in ENTITY_COLUMNS.items():
            out = self.of[key].attach(out, mean, count, hot_keys, asked=rows)
        return out.withColumn("customer_amount_ratio", safe_ratio(F.col("tx_amount"), F.col("avg_customer_amount")))
