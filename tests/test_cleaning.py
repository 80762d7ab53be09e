"""The cleaner's rules on single rows, and files."""

import math
import os

from pyspark.sql import functions as F

from tillwatch.functions.predicates import reject_reason
from tillwatch.operators.cleaning import clean, dedupe_first
from tillwatch.operators.quality import duplicate_ids, load_report, null_profile, quality_profile
from tillwatch.operators.quantiles import (
    amount_stats,
    amount_stats_by_tree,
    approx_median,
    approx_quartiles,
)
from tillwatch.plans.clean_job import run_cleaning
from tillwatch.schema import TRANSACTION_COLUMNS, TRANSACTION_DDL
from tillwatch.sources.transactions import read_transactions_csv

DATE = "2019-08-22 06:51:03"


def _tx(i, date=DATE, customer=1, terminal=1, amount=10.0, label=0, second=0):
    return (i, date, customer, terminal, amount, second, 0, label, 0)


def _frame(spark, rows):
    return spark.createDataFrame(rows, TRANSACTION_DDL)


def _stats(spark, median=5.0, lower=2.0, upper=20.0):
    return spark.createDataFrame([(median, lower, upper)], "median DOUBLE, lower DOUBLE, upper DOUBLE")


def test_amount_rules(spark):
    raw = _frame(spark, [_tx(1, amount=0.0), _tx(2, amount=-3.0), _tx(3, amount=1.0), _tx(4, amount=99.0),
                         _tx(5, amount=None), _tx(6, amount=7.0), _tx(7, amount=float("nan"))])
    got = {r["transaction_id"]: r["tx_amount"] for r in clean(raw, _stats(spark)).collect()}
    assert got == {1: 5.0, 2: 5.0, 3: 2.0, 4: 20.0, 5: None, 6: 7.0, 7: 20.0}
    filled = {r["transaction_id"]: r["tx_amount"] for r in clean(raw, _stats(spark), "impute").collect()}
    assert filled[5] == 5.0
    assert clean(raw, _stats(spark), "drop").filter("transaction_id = 5").isEmpty()


def test_row_filters_and_counts(spark):
    raw = _frame(spark, [_tx(1), _tx(2, date="2019-13-45"), _tx(3, date=None), _tx(4, label=2), _tx(5, label=None),
                         _tx(6, customer=-1), _tx(7, customer=None), _tx(8, terminal=-4), _tx(9, terminal=0),
                         _tx(1), _tx(1), _tx(9, terminal=0)])
    out = clean(raw, _stats(spark))
    assert out.columns == TRANSACTION_COLUMNS
    assert sorted(r["transaction_id"] for r in out.collect()) == [1, 9]
    profile = quality_profile(raw).first().asDict()
    # a NULL label is dropped by the filter but is not counted as invalid
    assert profile == {"row_count": 12, "bad_dates": 2, "nonpositive_amounts": 0, "invalid_labels": 1, "null_labels": 1}
    assert load_report(raw).first().asDict() == {**profile, "duplicated_ids": 2}
    assert {r["transaction_id"]: r["copies"] for r in duplicate_ids(raw).collect()} == {1: 3, 9: 2}
    assert null_profile(raw).first()["customer_id"] == 1


def test_first_row_wins(spark):
    raw = _frame(spark, [_tx(1, amount=1.0, second=9), _tx(1, amount=2.0, second=3), _tx(1, amount=3.0, second=None)])
    assert dedupe_first(raw).first()["tx_amount"] == 2.0


def test_dedupe_cuts_before_the_shuffle(spark):
    plan = dedupe_first(_frame(spark, [_tx(1)]))._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[exchange:], "rows of an id should be cut per map task"


def test_sketches_are_close(spark):
    raw = spark.range(1, 10_001).select(F.col("id").cast("double").alias("tx_amount"))
    q = approx_quartiles(raw).first()
    assert abs(q["q1"] - 2500) <= 10 and abs(q["q3"] - 7500) <= 10
    tree = amount_stats_by_tree(raw).first()
    assert abs(tree["q1"] - 2500) <= 2 and abs(tree["q3"] - 7500) <= 2 and abs(tree["median"] - 5000) <= 110
    assert amount_stats_by_tree(raw.limit(0)).first()["median"] is None
    assert abs(approx_median(raw).first()["median"] - 5000) <= 110
    exact = amount_stats(raw, exact=True).first()
    assert (exact["q1"], exact["median"], exact["q3"]) == (2500.0, 5000.0, 7500.0)
    assert (exact["lower"], exact["upper"]) == (2500 - 7500.0, 7500 + 7500.0)


def test_csv_rules(spark, tmp_path):
    path = tmp_path / "2019-08-22.txt"
    path.write_text("# tranaction_id | tx_datetime\n"
                    f"1,{DATE},5,6,12.5,24663,0,0,0\n"
                    "2,2019-08-22\n"
                    f"x,{DATE},5,six,1e2,1,0,1,0\n")
    rows = read_transactions_csv(spark, str(tmp_path / "*.txt")).collect()
    assert [r["transaction_id"] for r in rows] == [1, 2, None]
    assert rows[1]["customer_id"] is None and rows[1]["tx_datetime"] == "2019-08-22"
    assert rows[2]["terminal_id"] is None and rows[2]["tx_amount"] == 100.0
    assert read_transactions_csv(spark, str(path), comment=None).count() == 4
    assert read_transactions_csv(spark, str(path), partitions=3).rdd.getNumPartitions() == 3


def test_cleaning_job(spark, tmp_path):
    raw = _frame(spark, [_tx(i, amount=float(i)) for i in range(1, 101)] + [_tx(1, amount=1.0), _tx(500, label=7)])
    report = run_cleaning(spark, raw, str(tmp_path / "clean"), exact=True)
    assert report["row_count"] == 102 and report["duplicated_ids"] == 1 and report["clean_rows"] == 100
    assert any(name.endswith(".snappy.parquet") for name in os.listdir(tmp_path / "clean"))
    assert not math.isnan(report["median"])


def test_reject_reasons(spark):
    raw = _frame(spark, [_tx(None), _tx(1, date="x"), _tx(2, label=None), _tx(3, label=5), _tx(4, customer=None),
                         _tx(5, terminal=-1), _tx(6, amount=None), _tx(7, amount=0.0), _tx(8)])
    got = [r["why"] for r in raw.select(reject_reason().alias("why")).collect()]
    assert got == ["missing_id", "bad_date", "bad_label", "bad_label", "bad_customer", "bad_terminal",
                   "missing_amount", "nonpositive_amount", None]


def test_derived_tables_follow_their_files(spark, folder, tmp_path):
    """A table written anew in the same place and session is another table."""
    from tillwatch.catalog import batch

    events = spark.read.parquet(f"{folder}/events.parquet")
    path = f"{tmp_path}/events.parquet"
    events.filter("event_id < 100").write.parquet(path)
    few = batch.clean_table(spark, str(tmp_path)).count()
    assert batch.clean_table(spark, str(tmp_path)).count() == few
    events.write.mode("overwrite").parquet(path)
    assert batch.clean_table(spark, str(tmp_path)).count() == batch.cleaned(spark, folder).count() > few
