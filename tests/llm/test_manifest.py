import hashlib
import zlib
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from tillwatch.llm import manifest

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf string, _rank string, tampered string"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes, fan):
    """(last node, the steps of each leaf)"""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + fan] for i in range(0, len(nodes), fan)]
        for i, place in enumerate(at):
            run, own = runs[place // fan], place % fan
            steps[i].append(("".join(run[:own]), "".join(run[own + 1:])))
        at = [place // fan for place in at]
        nodes = [sha("".join(run)) for run in runs]
    return (nodes[0] if nodes else None), steps


def plain(rows, fan):
    def order(row):
        return ((row[2] is not None, (row[2] or "").encode()), (row[0] is not None, row[0] or 0), leaf(row))

    groups = [list(g) for _, g in groupby(sorted(rows, key=order), key=lambda r: r[2])]
    trees = [tree([leaf(r) for r in g], fan) for g in groups]
    root, outer = tree([t[0] for t in trees], fan)
    return sorted((str(row[0]), leaf(row), subroot, root, tuple(own + above))
                  for g, (subroot, inner), above in zip(groups, trees, outer) for row, own in zip(g, inner))


def documents():
    rows = [(i, f"s{i % 3}", lang, i * 7, f"text {i} é") for i in range(150) for lang in (["en", "z"][i % 2],)]
    rows += [(200 + i, None, None, None, None) for i in range(5)]
    rows += [(None, "a", "en", 1, "no id"), (None, "b", "en", 1, "no id"), (300, "s", "Ä", 2, ""), (301, "s", "", 2, "x" * 300_000)]
    return rows + [rows[3]] * 70 + [(8, "other", "en", 1, "same id")]


@pytest.mark.parametrize("fan, digits", [(2, 3), (3, 2)])
def test_equals_plain_trees(spark, fan, digits):
    rows = documents()
    docs = spark.createDataFrame([(*r, "l", "r", None) for r in rows], SCHEMA)
    got = manifest.manifest(docs, COLUMNS, fan=fan, digits=digits, carry=["leaf", "_rank"])
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "steps", "leaf_", "_rank"]
    found = [(str(r["doc_id"]), r["leaf"], r["subroot"], r["root"], tuple(map(tuple, r["steps"]))) for r in got.collect()]
    assert sorted(found) == plain(rows, fan)


def test_a_changed_leaf_does_not_fold_to_the_root(spark):
    docs = spark.createDataFrame([(*r, "l", "r", None) for r in documents()[:40]], SCHEMA)
    got = manifest.manifest(docs, COLUMNS, digits=3)
    steps = F.col("steps")
    checked = got.select("root", manifest.fold(F.col("leaf"), steps).alias("same"), manifest.fold(F.sha2("leaf", 256), steps).alias("other"),
                         manifest.proof_digest(steps).alias("proof"), "steps").collect()
    assert all(r["same"] == r["root"] != r["other"] for r in checked)
    assert all(r["proof"] == sha("".join(s["l"] + s["r"] for s in r["steps"])) for r in checked)


def test_one_row_and_none(spark):
    docs = spark.createDataFrame([(1, "s", "en", 4, "text", "l", "r", None)], SCHEMA)
    only = manifest.manifest(docs, COLUMNS, digits=2).first()
    assert only["leaf"] == only["subroot"] == only["root"] and only["steps"] == []
    assert manifest.manifest(docs.limit(0), COLUMNS, digits=2).collect() == []


def test_checksum_is_that_of_the_decimal_id(spark):
    assert spark.range(1).select(F.crc32(F.lit("12345").cast("binary"))).first()[0] == zlib.crc32(b"12345")


def test_a_large_group_is_ranked_in_many_tasks(spark):
    rows = spark.range(20_000).select((F.col("id") % 7).cast("string").alias("g"), F.lit(1).alias("same"))
    table = manifest.stored(rows.withColumn("g", F.when(F.col("g") < "5", "hot").otherwise(F.col("g"))), "test-ranked")
    got = manifest.ranked(table, ["g"], ["same"])
    assert got.groupBy("g").agg(F.countDistinct("_rank").alias("d"), F.max("_rank").alias("m"), F.max("_n").alias("n"), F.count("*").alias("c")).filter(
        "d <> c or m <> c - 1 or n <> c").isEmpty()
