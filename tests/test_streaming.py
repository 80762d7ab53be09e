"""Streams: late rows, re-deliveries, any order of arrival, repeated batches."""

import itertools
import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tillwatch.plans.feature_store.online import LatestTable
from tillwatch.streaming import monitoring, pipeline
from tillwatch.streaming.push import push_stream

DDL = "transaction_id BIGINT, ts TIMESTAMP, customer_id BIGINT, tx_amount DOUBLE"


def _at(hour, minute=0):
    return datetime(2024, 1, 1, hour, minute)


def _files(spark, folder, batches, ddl):
    """One Parquet file per batch, in order of modification time."""
    os.makedirs(folder, exist_ok=True)
    for i, rows in enumerate(batches):
        staging = f"{folder}-{i}"
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(staging)
        part = next(f for f in os.listdir(staging) if f.endswith(".parquet"))
        target = os.path.join(folder, f"{i:03d}.parquet")
        with open(os.path.join(staging, part), "rb") as source, open(target, "wb") as out:
            out.write(source.read())
        stamp = time.time() - 1000 + i * 10
        os.utime(target, (stamp, stamp))


def _stream(spark, folder, ddl=DDL):
    return pipeline.file_stream(spark, str(folder), ddl, files_per_batch=1)


def _run(spark, stream, tmp_path, name="q"):
    out = str(tmp_path / f"{name}-out")
    pipeline.run_available(stream, out, str(tmp_path / f"{name}-cp"))
    return spark.read.schema(stream.schema).parquet(out)


LATE = [[(1, _at(10), 1, 5.0), (2, _at(12), 1, 7.0)], [(3, _at(9), 1, 9.0), (4, _at(15), 1, 1.0)],
        [(5, _at(20), 1, 1.0), (6, _at(9), 1, 1.0), (7, _at(14, 30), 1, 1.0)]]


def test_late_rows_are_dropped(spark, tmp_path):
    _files(spark, str(tmp_path / "in"), LATE, DDL)
    out = _run(spark, pipeline.frequency_windows(_stream(spark, tmp_path / "in"), "ts", "1 hour", "1 hour"), tmp_path)
    # A batch is filtered by the watermark its predecessor started with: 3 just makes it, 6 does
    # not (its window has been closed and must not appear again), 7 is late but within the delay.
    assert sorted((r["window_start"].hour, r["tx_count"]) for r in out.collect()) == [
        (9, 1), (10, 1), (12, 1), (14, 1), (15, 1)]


@pytest.mark.parametrize("lanes", [1, 3])
def test_redelivered_rows_count_once(spark, tmp_path, lanes):
    _files(spark, str(tmp_path / "in"), [[(1, _at(10), 1, 5.0), (1, _at(10), 1, 5.0)],
                                         [(1, _at(10), 1, 5.0), (2, _at(10, 30), 1, 5.0)]], DDL)
    out = _run(spark, pipeline.dedupe_stream(_stream(spark, tmp_path / "in"), "ts", "1 hour", lanes=lanes), tmp_path)
    assert sorted(r["transaction_id"] for r in out.collect()) == [1, 2]


def test_restart_continues(spark, tmp_path):
    _files(spark, str(tmp_path / "in"), LATE[:1], DDL)
    first = _run(spark, _stream(spark, tmp_path / "in"), tmp_path)
    assert first.count() == 2
    assert _run(spark, _stream(spark, tmp_path / "in"), tmp_path).count() == 2


def test_state_survives_a_restart(spark, tmp_path):
    """A second run goes on from the checkpoint: ids and windows of the first are known, state is in RocksDB."""
    folder, out, cp = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    _files(spark, folder, [[(1, _at(10), 1, 5.0), (2, _at(10, 10), 1, 7.0)]], DDL)
    unique = pipeline.dedupe_stream(_stream(spark, folder), "ts", "2 hours")
    before = {k: spark.conf.get(k, None) for k in pipeline.STATE_CONF}
    first = pipeline.run_available(unique, out, cp).lastProgress["stateOperators"][0]
    _files(spark, str(tmp_path / "more"), [[], [(1, _at(10), 1, 5.0), (3, _at(10, 20), 1, 1.0), (3, _at(10, 20), 1, 1.0)]], DDL)
    os.replace(tmp_path / "more" / "001.parquet", tmp_path / "in" / "001.parquet")
    second = pipeline.run_available(pipeline.dedupe_stream(_stream(spark, folder), "ts", "2 hours"), out, cp)
    assert sorted(r["transaction_id"] for r in spark.read.schema(unique.schema).parquet(out).collect()) == [1, 2, 3]
    state = [p["stateOperators"][0] for p in second.recentProgress]
    assert first["numRowsTotal"] == 2 and state[-1]["numRowsTotal"] == 3
    assert sum(s["customMetrics"]["numDroppedDuplicateRows"] for s in state) == 2
    assert "rocksdbCommitFlushLatency" in state[-1]["customMetrics"]
    files = [f for _, _, names in os.walk(os.path.join(cp, "state")) for f in names]
    assert any(f.endswith(".changelog") for f in files)
    assert {k: spark.conf.get(k, None) for k in pipeline.STATE_CONF} == before


def test_own_state_store_wins(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    own = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(name, own)
    try:
        with pipeline.durable_state(spark):
            assert spark.conf.get(name) == own
        assert spark.conf.get(name) == own
    finally:
        spark.conf.unset(name)


STATS = "driver_id BIGINT, event_timestamp TIMESTAMP, created TIMESTAMP, v BIGINT"
PUSHED = [[(1, _at(10), _at(10), 1), (2, _at(9), _at(9), 2)], [(1, _at(12), _at(12), 3)],
          [(1, _at(11), _at(13), 4), (2, _at(9), _at(10), 5)]]


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[::2])
def test_push_order_does_not_matter(spark, tmp_path, order):
    _files(spark, str(tmp_path / "in"), [PUSHED[i] for i in order], STATS)
    stream = _stream(spark, tmp_path / "in", STATS)
    latest = LatestTable(spark, str(tmp_path / "latest"), stream.schema, ["driver_id"], "event_timestamp", "created")
    push_stream(stream, latest, str(tmp_path / "history"), str(tmp_path / "cp"))
    assert {r["driver_id"]: r["v"] for r in latest.read().collect()} == {1: 3, 2: 5}
    assert spark.read.parquet(str(tmp_path / "history")).count() == 5
    # the whole stream once more, as after a lost checkpoint: same folders, same result
    push_stream(stream, latest, str(tmp_path / "history"), str(tmp_path / "cp2"))
    assert spark.read.parquet(str(tmp_path / "history")).count() == 5
    assert {r["driver_id"]: r["v"] for r in latest.read().collect()} == {1: 3, 2: 5}


def test_labels_meet_scores_in_time(spark, tmp_path):
    _files(spark, str(tmp_path / "s"), [[(1, _at(10), 0.9), (2, _at(10), 0.1), (3, _at(11), 0.5)]],
           "id BIGINT, ts TIMESTAMP, score DOUBLE")
    _files(spark, str(tmp_path / "l"), [[(1, _at(12), 1), (2, _at(14), 0), (3, _at(10), 1)]],
           "id BIGINT, label_ts TIMESTAMP, label INT")
    joined = monitoring.join_late_labels(
        _stream(spark, tmp_path / "s", "id BIGINT, ts TIMESTAMP, score DOUBLE"),
        _stream(spark, tmp_path / "l", "id BIGINT, label_ts TIMESTAMP, label INT"),
        "id", "ts", "label_ts", "1 hour", "1 hour", "3 HOURS")
    out = _run(spark, joined, tmp_path)
    assert [(r["id"], r["label"]) for r in out.collect()] == [(1, 1)]  # 2 too late, 3 before its score


def test_monitoring_and_alerts(spark):
    rows = spark.createDataFrame([(_at(1), 0.9, 1), (_at(1), 0.1, 1), (_at(1), 0.9, 0), (_at(7), 0.1, 0)],
                                 "ts TIMESTAMP, score DOUBLE, label INT")
    windows = monitoring.monitoring_windows(rows, "ts", "6 hours", 0.5, 100, 5)
    got = {r["window_start"].hour: r for r in windows.collect()}
    assert (got[0]["fnr"], got[0]["fpr"], got[0]["loss"], got[0]["volume"]) == (0.5, 1.0, 105.0, 3)
    assert got[6]["fnr"] is None
    assert [r["alert"] for r in monitoring.alerts(windows, 0.4, 0.05).collect()] == ["fnr,fpr"]


def test_rejects_go_aside(spark, tmp_path):
    ddl = "transaction_id BIGINT, tx_datetime STRING, customer_id BIGINT, terminal_id BIGINT, tx_amount DOUBLE, tx_fraud INT"
    _files(spark, str(tmp_path / "in"), [[(1, "2024-01-01", 1, 1, 5.0, 0), (2, "bad", 1, 1, 5.0, 0)],
                                         [(3, "2024-01-01", -1, 1, 5.0, 0)]], ddl)
    pipeline.write_split(_stream(spark, tmp_path / "in", ddl), str(tmp_path / "good"), str(tmp_path / "bad"),
                         str(tmp_path / "cp"))
    assert [r["transaction_id"] for r in spark.read.parquet(str(tmp_path / "good")).collect()] == [1]
    assert {r["reject_reason"] for r in spark.read.parquet(str(tmp_path / "bad")).collect()} == {"bad_date", "bad_customer"}


def test_enrich_keeps_unknown_keys(spark, tmp_path):
    _files(spark, str(tmp_path / "in"), LATE[:1], DDL)
    known = spark.createDataFrame([(9, 1.0)], "customer_id BIGINT, avg_amount DOUBLE")
    out = _run(spark, pipeline.enrich_stream(_stream(spark, tmp_path / "in"), known, ["customer_id"]), tmp_path)
    assert out.filter(F.col("avg_amount").isNull()).count() == 2


def test_a_stream_that_closes_nothing_needs_no_last_batch(spark, tmp_path):
    """Neither a batch without rows nor a look-up per write; ids of the first run are still known in the second."""
    folder, out, cp = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    _files(spark, folder, [[(1, _at(10), 1, 5.0), (2, _at(12), 1, 7.0)]], DDL)

    def run():
        return pipeline.run_available(pipeline.dedupe_stream(_stream(spark, folder), "ts", "4 hours"), out, cp,
                                      closing=False, conf=pipeline.UNCOUNTED)

    assert [p["numInputRows"] for p in run().recentProgress] == [2]
    _files(spark, str(tmp_path / "more"), [[], [(2, _at(12), 1, 7.0), (3, _at(13), 1, 1.0)]], DDL)
    os.replace(tmp_path / "more" / "001.parquet", tmp_path / "in" / "001.parquet")
    again = run()
    assert [p["numInputRows"] for p in again.recentProgress] == [2] and again.lastProgress["stateOperators"][0]["numRowsTotal"] <= 0
    assert sorted(r[0] for r in spark.read.parquet(out).select("transaction_id").collect()) == [1, 2, 3]
    names = ("spark.sql.streaming.noDataMicroBatches.enabled", *pipeline.UNCOUNTED)
    assert not any(pipeline._is_set(spark, n) for n in names)
