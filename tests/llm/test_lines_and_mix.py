import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillwatch.llm import lines, mixing

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, copy string, rate string, shuffle_key string, host string"


def documents():
    rows = []
    for i in range(40):
        source = "big" if i < 25 else ("small" if i < 38 else None)
        body = f"only {i}\n\n  menu \nfooter\t\r\nmenu"
        if i % 3 == 0:
            body += "\nshared third"
        rows.append((i, body, source))
    rows += [(50, None, "big"), (51, "", "big"), (None, "menu\nx", "big"), (52, "menu\nfooter", "tiny"), (1, rows[1][1], "big"), (53, "menu", "big")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", s, 1, "c", "r", "k", "h") for i, t, s in documents()], SCHEMA)


def plain_lines(rows, ratio, least):
    pages, seen = Counter(), Counter()
    for _, t, s in rows:
        pages[s] += 1
        for line in {x.strip(" \t\r") for x in (t or "").split("\n")} - {""}:
            seen[s, line] += 1
    out = []
    for i, t, s in rows:
        kept = [x for x in (t or "").split("\n")
                if not (seen[s, x.strip(" \t\r")] > ratio * pages[s] and seen[s, x.strip(" \t\r")] >= least) or not x.strip(" \t\r")]
        out.append((str(i), None if t is None else "\n".join(kept), len((t or "").split("\n")), len((t or "").split("\n")) - len(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("most", [1000, 0])
def test_lines_like_plain_loops(docs, most):
    got = lines.drop_boilerplate(docs, ratio=0.3, min_pages=5, broadcast_lines=most, counts=True)
    assert got.columns == [*docs.columns, "n_lines", "n_dropped"]
    rows = [(str(r["doc_id"]), r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()]
    want = plain_lines(documents(), 0.3, 5)
    assert sorted(rows, key=str) == want and any(r[3] for r in want) and any(r[1] == "" for r in want)


def test_small_hosts_and_names_that_clash(spark):
    rows = [(h * 10 + i, f"h{h}", f"body {h} {i}\nmenu") for h in range(5) for i in range(4)] + [(99, "alone", "menu\nx")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string").withColumn("n_lines", F.lit("mine"))
    got = lines.drop_boilerplate(docs, counts=True)
    assert got.columns == ["doc_id", "source", "text", "n_lines", "n_lines_", "n_dropped"]
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {i: t if h == "alone" else t.split("\n")[0] for i, h, t in rows}


def test_lines_of_empty_table(docs):
    assert lines.drop_boilerplate(docs.limit(0)).count() == 0


def plain_count(rate, key, seed=42):
    u = int(hashlib.md5(f"{seed}:{key}".encode()).hexdigest()[:13], 16) / 16 ** 13
    k, p = 0, math.exp(-rate)
    total = p
    while total <= u and k < 10_000:
        k += 1
        p *= rate / k
        total += p
    return k


@pytest.mark.parametrize("most", [1000, 0])
def test_mix_like_plain_loops(docs, most):
    rows = documents()
    n = Counter(s for _, _, s in rows)
    share = {s: math.sqrt(c) for s, c in n.items()}
    rate = {s: share[s] / sum(share.values()) * len(rows) * 2.0 / n[s] for s in n}
    want = Counter()
    for i, t, s in rows:
        rest = "|".join(x for x in (t, "en", s, "1", "c", "r", "k", "h") if x is not None)
        want[str(i), t, s] += plain_count(rate[s], "row:" + hashlib.md5(rest.encode()).hexdigest() if i is None else i)
    got = mixing.mix(docs, size=2.0, broadcast_sources=most)
    assert got.columns == [*docs.columns, "copy_", "rate_", "shuffle_key_"]
    assert Counter((str(r["doc_id"]), r["text"], r["source"]) for r in got.collect()) == Counter({k: v for k, v in want.items() if v})


def test_mix_weights_and_means(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 4 == 0, "a").when(F.col("id") % 4 == 1, "b").alias("source"))
    got = {r["source"]: r["count"] for r in mixing.mix(docs, weights={"a": 3.0, None: 1.0}).groupBy("source").count().collect()}
    assert set(got) == {"a", None}
    assert abs(got["a"] - 15_000) < 600 and abs(got[None] - 5_000) < 400
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mix(docs, weights={}).count() == 0


def test_poisson_table_of_large_and_small_rates(spark):
    for rate in (1e-6, 0.3, 4.0, 900.0):
        cdf = spark.range(1).select(mixing.poisson_cdf(F.lit(rate)).alias("c")).first()["c"]
        assert all(b >= a for a, b in zip(cdf, cdf[1:])) and abs(cdf[-1] - 1) < 1e-9
        mean = sum(1 - c for c in cdf)
        assert abs(mean - rate) < 1e-6 * max(1, rate)


def test_rows_without_id_count_each_for_itself(spark):
    """Their copies are neither all or none, nor in one place of the order."""
    docs = spark.range(2000).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("s").alias("source"), F.col("id").cast("string").alias("text"))
    got = mixing.mix(docs)
    counts = [r["n"] for r in got.groupBy("text").agg(F.count("*").alias("n")).collect()]
    assert abs(sum(counts) - 2000) < 250 and 1100 < len(counts) < 1400 and max(counts) > 2
    assert got.select("shuffle_key").distinct().count() == got.count()


def test_mix_is_native(docs):
    plan = mixing.mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_shuffle_breaks_the_order(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"))
    ids = [r["doc_id"] for r in mixing.mix(docs).collect()]
    assert ids != sorted(ids) and mixing.mix(docs).collect() == mixing.mix(docs.repartition(3)).collect()
