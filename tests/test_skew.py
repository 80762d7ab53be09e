"""Hot keys are found with a bound, spread, and joined right."""

from pyspark.sql import functions as F

from tillwatch.operators.skew import HotKeys, lookup_any, lookup_join


def _fact(spark):
    # key 1 holds most rows, many of them exact copies; key 9 is hot and unknown; NULL is hot
    rows = [(1, 5)] * 400 + [(2, i) for i in range(20)] + [(9, i) for i in range(200)] + [(None, i) for i in range(200)]
    return spark.createDataFrame(rows, "k BIGINT, x BIGINT").repartition(6)


def test_hot_keys_and_bound(spark):
    fact = _fact(spark)
    assert {r["k"] for r in HotKeys(100, 1_000).find([fact], ["k"])[0].collect()} == {1, 9, None}
    # no more than max_keys keys can be hot, however low the row limit is
    assert HotKeys(0, 3).find([fact], ["k"])[0].count() <= 3
    assert HotKeys().find([fact], ["k"]) is None and HotKeys(500, 1_000).find([fact], ["k"]) is None


def test_small_file_with_many_rows_of_one_key(spark, tmp_path):
    """Rows are counted: millions of rows of one key take the split path however few bytes they are."""
    path = str(tmp_path / "one-key")
    spark.range(2_500_000).select(F.lit(7).cast("bigint").alias("k"), F.lit(1).alias("x")).write.parquet(path)
    fact = spark.read.parquet(path)
    assert sum(f.stat().st_size for f in (tmp_path / "one-key").iterdir()) < 1 << 20
    hot, limit = HotKeys().find([fact], ["k"])
    assert [r["k"] for r in hot.collect()] == [7] and limit == 1_000_000
    joined = lookup_any(fact, spark.createDataFrame([(7, "a")], "k BIGINT, v STRING"), ["k"], HotKeys())
    assert "_scatter" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert joined.filter("v = 'a'").count() == 2_500_000


def test_lookup_is_a_left_join(spark):
    fact = _fact(spark)
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k BIGINT, v STRING")
    for hot in (HotKeys(), HotKeys(100, 1_000), HotKeys(1, 1_000)):
        got = {(r["k"], r["v"]): r["n"] for r in
               lookup_any(fact, dim, ["k"], hot).groupBy("k", "v").agg(F.count("*").alias("n")).collect()}
        assert got == {(1, "a"): 400, (2, "b"): 20, (9, None): 200, (None, None): 200}


def test_hot_rows_are_scattered_in_the_shuffle(spark):
    """With every join forced to shuffle, copies of one hot row still reach several tasks."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        fact = _fact(spark).filter("k = 1")
        dim = spark.createDataFrame([(1, "a"), (2, "b")], "k BIGINT, v STRING")
        joined = lookup_join(fact, dim, dim.filter("k = 1"), ["k"])
        parts = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert sum(r["count"] for r in parts) == 400
        assert len(parts) > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
