"""The latest table by key parts: what is rewritten, what is read, who wins when two write."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillwatch.operators.skew import HotKeys
from tillwatch.plans.feature_store import online
from tillwatch.plans.feature_store.online import LatestTable
from tillwatch.streaming import pipeline

DDL = "k BIGINT, at TIMESTAMP, v DOUBLE"
T0 = datetime(2024, 1, 1)


def _at(hour):
    return T0 + timedelta(hours=hour)


def _rows(spark, keys, hour, v):
    return spark.createDataFrame([(k, _at(hour), v) for k in keys], DDL)


@pytest.fixture
def latest(spark, tmp_path):
    table = LatestTable(spark, str(tmp_path / "t"), spark.createDataFrame([], DDL).schema, ["k"], "at", None, parts=32)
    table.materialize(spark.range(1000).select(F.col("id").alias("k"), F.lit(_at(1)).alias("at"), F.lit(1.0).alias("v")), _at(2))
    return table


def _written(latest):
    return {p for p in Path(latest.root, "values").glob("run=*/key_part=*") if list(p.glob("*.parquet"))}


def test_a_push_of_ten_keys_rewrites_ten_parts_at_most(spark, latest):
    before = _written(latest)
    assert len(before) == 32
    latest.push(_rows(spark, range(10), 3, 2.0), "p")
    latest.materialize(spark.createDataFrame([], DDL), _at(4))
    new = _written(latest) - before
    assert {p.name for p in new} == {f"key_part={p}" for p in latest.parts_of(_rows(spark, range(10), 3, 2.0))} and len(new) <= 10
    got = {r["k"]: r["v"] for r in latest.read().collect()}
    assert got == {k: 2.0 if k < 10 else 1.0 for k in range(1000)}


def test_a_look_up_reads_only_its_parts(spark, latest):
    latest.push(_rows(spark, [5, 2000], 3, 2.0), "p")
    asked = _rows(spark, [5, 6, 2000, 3000, None], 0, 0.0).select(F.col("k").cast("int").alias("k"), F.lit("x").alias("tag")).persist()
    found = latest.lookup(asked, ["v"])
    assert sorted((r["k"] or -1, r["v"]) for r in found.collect() if r["v"]) == [(5, 2.0), (6, 1.0), (2000, 2.0)]
    assert found.count() == 5 and found.columns == ["k", "tag", "v"]
    parts = {f"key_part={p}" for p in latest.parts_of(asked)}
    read = latest.read(latest.parts_of(asked))
    assert {f.split("/")[-2] for f in read.inputFiles() if "/values/" in f} <= parts and len(parts) <= 5
    assert "PartitionFilters: [key_part" in read._jdf.queryExecution().executedPlan().toString()
    hot = latest.lookup(asked, ["v"], HotKeys(1, 1_000_000))
    assert sorted(hot.collect(), key=str) == sorted(found.collect(), key=str)


def test_of_two_writers_none_is_lost(spark, latest, monkeypatch):
    """Another run commits between this one's read and its commit: this one starts again from there."""
    other = LatestTable(spark, latest.root, latest.schema, ["k"], "at", None, parts=32)
    commit, tries = latest.table.commit, []

    def late(*args):
        tries.append(1)
        if len(tries) == 1:
            other.materialize(_rows(spark, [1, 7777], 5, 9.0), _at(6))
        return commit(*args)

    monkeypatch.setattr(latest.table, "commit", late)
    assert latest.materialize(_rows(spark, [2, 8888], 7, 8.0), _at(8)) == 3
    got = {r["k"]: r["v"] for r in latest.read().collect()}
    assert (got[1], got[7777], got[2], got[8888], len(got)) == (9.0, 9.0, 8.0, 8.0, 1002) and len(tries) == 2


def test_old_files_go_after_two_commits(spark, latest):
    for hour in (3, 4, 5, 6):
        latest.materialize(_rows(spark, range(1000), hour, float(hour)), _at(hour))
    assert len(list(Path(latest.root, "commits").iterdir())) == 2 and len(_written(latest)) == 64
    before = latest.read()
    latest.materialize(_rows(spark, range(1000), 7, 7.0), _at(7))
    assert before.agg(F.min("v"), F.max("v"), F.count("*")).first() == (6.0, 6.0, 1000)


def test_open_pushes_are_bounded(spark, latest, monkeypatch):
    monkeypatch.setattr(online, "OPEN_PUSHES", 2)
    for i in range(7):
        latest.push(_rows(spark, [i], 3 + i, 5.0), f"p{i}")
        assert len(latest._open_pushes(latest.table.head())) <= 2
    assert latest.read().filter("v = 5").count() == 7 and latest.state()[1] == _at(2)


def test_unfinished_commits_do_not_count(spark, latest):
    latest.materialize(_rows(spark, [1], 3, 3.0), _at(4))
    Path(latest.root, "commits", "version=2", "_SUCCESS").unlink()
    assert latest.state() == (1, _at(2)) and latest.read().filter("v = 3").isEmpty()


def test_parts_belong_to_the_table(spark, latest):
    with pytest.raises(ValueError):
        LatestTable(spark, latest.root, latest.schema, ["k"], "at", None, parts=8).read()


def test_a_stream_looks_up_each_batch(spark, latest, tmp_path):
    """Values pushed between two batches are seen by the second one; a repeated batch replaces its rows."""
    folder = str(tmp_path / "in")
    spark.createDataFrame([(1, 1), (None, 1), (5000, 1)], "k BIGINT, n INT").write.parquet(folder)
    stream = pipeline.file_stream(spark, folder, "k BIGINT, n INT")

    def run(checkpoint):
        pipeline.serve_batches(stream, lambda batch: latest.lookup(batch, ["v"]), str(tmp_path / "out"), str(tmp_path / checkpoint))

    run("cp")
    latest.push(_rows(spark, [1], 5, 4.0), "p")
    spark.createDataFrame([(1, 2)], "k BIGINT, n INT").write.mode("append").parquet(folder)
    run("cp")
    got = sorted((r["n"], r["k"] or 0, r["v"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(1, 0, None), (1, 1, 1.0), (1, 5000, None), (2, 1, 4.0)]
