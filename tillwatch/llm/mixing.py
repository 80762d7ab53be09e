"""Mix sources to target weights by Poisson replication. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import fresh, stored

#: Rates are in proportion to the rows of a source to this power; below 1 it lifts small sources.
TEMPERATURE = 0.5
#: Sources whose rates may be broadcast; above, they are joined by a shuffle.
BROADCAST_SOURCES = 10_000
SALTS = 64
_SPACE = float(16 ** 13)


def unit(*key: Column) -> Column:
    """A number in [0, 1) from a hash of the key: the same on any cluster, partitioning or engine."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *key)), 1, 13), 16, 10).cast("double") / F.lit(_SPACE)


def poisson_cdf(rate: Column) -> Column:
    """Cumulated Poisson probabilities of 0, 1, ..., up to where the rest is below what a double tells.

    Summed from logarithms, so that large rates do not underflow.
    """
    last = F.ceil(rate + F.lit(12.0) * F.sqrt(rate) + F.lit(24.0)).cast("int")
    step = F.aggregate(
        F.sequence(F.lit(1), last),
        F.struct(F.array(F.exp(-rate)).alias("cdf"), (-rate).alias("log")),
        lambda a, k: F.struct(
            F.array_append(a["cdf"], F.element_at(a["cdf"], -1) + F.exp(a["log"] + F.ln(rate) - F.ln(k.cast("double")))).alias("cdf"),
            (a["log"] + F.ln(rate) - F.ln(k.cast("double"))).alias("log")))
    return F.when(rate > 0, step["cdf"]).otherwise(F.array(F.lit(1.0)))


def source_rates(docs: DataFrame, source: str = "source", weights: dict[str, float] | None = None,
                 temperature: float = TEMPERATURE, size: float = 1.0) -> DataFrame:
    """(source, n, rate, cdf): how often each document of a source is repeated on average.

    The mix has ``size`` times as many documents as ``docs``, shared out by ``weights``, or without them by
    each source's rows to the power of ``temperature``. Sources without a weight get rate 0. A NULL source
    is a source, which ``weights`` names by None.
    """
    counts = docs.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        share = F.pow(F.col("n").cast("double"), F.lit(float(temperature)))
    else:
        share = F.lit(0.0)
        for name, weight in weights.items():
            share = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(weight))).otherwise(share)
    shared = stored(counts.withColumn("share", share), "mix-counts")
    total = shared.agg(F.sum("n").alias("all_n"), F.sum("share").alias("all_share"))
    rate = (F.col("share") / F.col("all_share")) * (F.lit(float(size)) * F.col("all_n")) / F.col("n")
    return (shared.withColumn("all_n", total.select("all_n").scalar())
            .withColumn("all_share", total.select("all_share").scalar())
            .select("source", "n", F.when(F.col("all_share") > 0, rate).otherwise(0.0).alias("rate"))
            .withColumn("cdf", poisson_cdf(F.col("rate"))))


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", weights: dict[str, float] | None = None,
        temperature: float = TEMPERATURE, size: float = 1.0, seed: int = 42,
        broadcast_sources: int = BROADCAST_SOURCES) -> DataFrame:
    """``docs`` with each row repeated by a Poisson count, in an order shuffled over all rows.

    The count inverts the Poisson distribution of the source's rate at a number hashed from ``seed`` and the
    id; copies are numbered in ``copy`` and placed by ``shuffle_key``, a hash of seed, id and copy. Both
    depend on the row only, so a repeated task makes the same rows. Rows with equal ids get equal counts;
    a digest of its other columns stands for the id of a row that has none. The number of sources is checked before their rates are broadcast;
    above ``broadcast_sources`` each source is spread over SALTS keys and joined.
    """
    rates = stored(source_rates(docs, source, weights, temperature, size), "mix-rates")
    of, rate, cdf, salt, other, copy, place = (
        fresh(docs, c) for c in ("_source", "rate", "_cdf", "_salt", "_salt_of", "copy", "shuffle_key"))
    rates = rates.select(F.col("source").alias(of), F.col("rate").alias(rate), F.col("cdf").alias(cdf))
    same = F.col(f"`{source}`").eqNullSafe(F.col(of))
    if rates.count() <= broadcast_sources:
        joined = docs.join(F.broadcast(rates), same)
    else:
        spread = rates.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = docs.withColumn(salt, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]), F.lit(SALTS)))
        joined = salted.join(spread, same & (F.col(salt) == F.col(other)))
    others = [F.col(f"`{c}`").cast("string") for c in docs.columns if c != doc_id]
    key = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.concat(F.lit("row:"), F.md5(F.concat_ws("|", *others))))
    draw = unit(F.lit(str(seed)), key)
    times = F.size(F.filter(F.col(cdf), lambda p: p <= draw))
    copies = F.when(times > 0, F.sequence(F.lit(1), times)).otherwise(F.array().cast("array<int>"))
    rows = (joined.withColumn(copy, F.explode(copies))
            .withColumn(place, F.md5(F.concat_ws(":", F.lit(str(seed)), key, F.col(copy).cast("string"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns], copy, rate, place))
    return rows.repartition(F.col(place)).sortWithinPartitions(place)
