"""Boilerplate lines by their frequency within a site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import fresh, stored

#: A line on more than this share of its host's pages is boilerplate ...
RATIO = 0.05
#: ... if it is on two pages: a share means nothing on a host of one page, which is left alone.
MIN_PAGES = 2
#: Boilerplate lines that may be broadcast (32 bytes each); above, they are joined by a shuffle.
BROADCAST_LINES = 1_000_000
SALTS = 64
_BLANKS = " \t\r"


def _key(line: Column) -> Column:
    """Digest of a line without blanks around it."""
    return F.md5(F.btrim(line, F.lit(_BLANKS)))


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, lines): digests of the lines on more than ``ratio`` of the pages of each host.

    A page counts once per line. Lines are added up before the shuffle, so a common line costs no more
    than a rare one; of the counts, only lines on ``min_pages`` pages meet the page totals. A NULL host is
    a host. Blank lines are never boilerplate.
    """
    pages = docs.select(F.col(host).alias("host"), _split(F.col(text)).alias("lines"))
    keys = F.array_distinct(F.transform(
        F.filter("lines", lambda x: F.btrim(x, F.lit(_BLANKS)) != ""), _key))
    counted = (pages.select("host", F.explode(F.array_append(keys, F.lit(""))).alias("line"))
               .groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
               .filter((F.col("n") >= min_pages) | (F.col("line") == "")))
    counted = stored(counted, "line-counts")
    totals = counted.filter("line = ''").select(F.col("host").alias("of"), F.col("n").alias("pages"))
    common = (counted.filter("line <> ''").join(totals, F.col("host").eqNullSafe(F.col("of")))
              .filter(F.col("n") > F.lit(ratio) * F.col("pages")).filter(F.col("n") >= min_pages))
    return common.groupBy("host").agg(F.sort_array(F.collect_list("line")).alias("lines"))


def drop_boilerplate(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO,
                     min_pages: int = MIN_PAGES, broadcast_lines: int = BROADCAST_LINES,
                     counts: bool = False) -> DataFrame:
    """``docs`` without the boilerplate lines of each host; with ``counts``, n_lines and n_dropped as well (with an
    underscore where there is a column of that name).

    A host has at most (lines of a page / ratio) boilerplate lines. Their number is checked before they are
    broadcast; above ``broadcast_lines`` the texts are joined with their host's lines instead, each host
    spread over SALTS keys. Every row stays: a text of boilerplate only becomes empty, a NULL text stays
    NULL. Repeated rows are pages of their own.
    """
    found = stored(boilerplate(docs, host, text, ratio, min_pages), "boilerplate")
    n = found.agg(F.coalesce(F.sum(F.size("lines")), F.lit(0))).first()[0]
    of, bad, salt, other = (fresh(docs, c) for c in ("_host", "_lines", "_salt", "_salt_of"))
    found = found.select(F.col("host").alias(of), F.col("lines").alias(bad))
    same = F.col(f"`{host}`").eqNullSafe(F.col(of))
    if n <= broadcast_lines:
        joined = docs.join(F.broadcast(found), same, "left")
    else:
        spread = found.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = docs.withColumn(salt, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]), F.lit(SALTS)))
        joined = salted.join(spread, same & (F.col(salt) == F.col(other)), "left")
    lines = _split(F.col(f"`{text}`"))
    kept = F.filter(lines, lambda x: ~F.array_contains(F.col(bad), _key(x)))
    clean = F.when(F.col(bad).isNull(), F.col(f"`{text}`")).when(
        F.col(f"`{text}`").isNotNull(), F.array_join(kept, "\n"))
    columns = [clean.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    if counts:
        columns.append(F.size(lines).cast("bigint").alias(fresh(docs, "n_lines")))
        columns.append(F.when(F.col(bad).isNull(), 0).otherwise(F.size(lines) - F.size(kept))
                       .cast("bigint").alias(fresh(docs, "n_dropped")))
    return joined.select(*columns)
