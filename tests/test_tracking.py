"""Runs, versions, promotion, metrics files, incremental ingest, training."""

import os

import pytest
from pyspark.sql import functions as F

from tillwatch.operators.entity_features import customer_terminal_features
from tillwatch.operators.sampling import split_by_key
from tillwatch.plans import tracking as TR
from tillwatch.plans import training as T
from tillwatch.schema import FEATURE_COLUMNS, MODEL_VERSIONS_DDL, RUNS_DDL, TRANSACTION_DDL
from tillwatch.sources.incremental import ingest_new_files, list_files, not_loaded
from tillwatch.sources.metrics import export_metrics, metrics_frame, metrics_pivot, read_metrics

EXP, MODEL = "fraud_detection", "fraud-detector"


def _promote(spark, runs, versions):
    out = TR.promote(spark.createDataFrame(runs, RUNS_DDL), spark.createDataFrame(versions, MODEL_VERSIONS_DDL), EXP, MODEL)
    return {(r["name"], r["version"]): r["current_stage"] for r in out.collect()}


RUNS = [("a", EXP, "FINISHED", 0.8, "lr"), ("b", EXP, "FINISHED", 0.9, "rf"), ("c", EXP, "RUNNING", 0.99, "rf"),
        ("d", "other", "FINISHED", 0.95, "rf")]


def test_promote_archives_the_old_one(spark):
    got = _promote(spark, RUNS, [(MODEL, 1, "a", "Production"), (MODEL, 2, "b", "None"), ("x", 7, "q", "Production"),
                                 (MODEL, 3, "z", "Staging")])
    assert got == {(MODEL, 1): "Archived", (MODEL, 2): "Production", ("x", 7): "Production", (MODEL, 3): "Staging"}


def test_promote_does_nothing(spark):
    # best run has no version
    versions = [(MODEL, 1, "a", "Production"), (MODEL, 2, "c", "None")]
    assert _promote(spark, RUNS, versions) == {(MODEL, 1): "Production", (MODEL, 2): "None"}
    # best run is in Production already
    versions = [(MODEL, 1, "a", "Production"), (MODEL, 2, "b", "Production")]
    assert _promote(spark, RUNS, versions) == {(MODEL, 1): "Production", (MODEL, 2): "Production"}


def test_best_runs_order_and_limit(spark):
    runs = [(f"r{i:02d}", EXP, "FINISHED", 0.5, "lr") for i in range(25)] + [("n", EXP, "FINISHED", None, "lr")]
    got = [r["run_id"] for r in TR.best_runs(spark.createDataFrame(runs, RUNS_DDL), EXP).collect()]
    assert got == [f"r{i:02d}" for i in range(20)]


def test_best_of_two(spark):
    ddl = "rank INT, model STRING, auc DOUBLE, pr_auc DOUBLE"
    tie = spark.createDataFrame([(0, "lr", 0.7, 0.1), (1, "rf", 0.7, 0.9)], ddl)
    assert TR.best_of_models(tie).first()["model"] == "lr"
    assert TR.best_of_models(tie.withColumn("auc", F.col("auc") + F.col("rank"))).first()["model"] == "rf"


def test_tracker(spark, tmp_path):
    tracker = TR.Tracker(spark, str(tmp_path))
    with pytest.raises(RuntimeError):
        tracker.promote_best(EXP, MODEL)
    tracker.log_run("a", EXP, {"best_auc": 0.7}, {"seed": 42}, "lr")
    assert tracker.register_version(MODEL, "a") == 1
    assert tracker.promote_best(EXP, MODEL) and not tracker.promote_best(EXP, MODEL)
    tracker.log_run("b", EXP, {"best_auc": 0.8}, {"seed": 43}, "rf")
    assert not any([tracker.promote_best(EXP, MODEL)])  # no version yet
    assert tracker.register_version(MODEL, "b") == 2
    assert tracker.promote_best(EXP, MODEL)
    stages = {r["version"]: r["current_stage"] for r in tracker.versions().collect()}
    assert stages == {1: "Archived", 2: "Production"}
    assert tracker.params().count() == 2 and tracker.metrics().count() == 2


def test_versions_in_batches(spark, tmp_path):
    """Numbers have no gaps, whatever number of runs a batch has; models count on their own."""
    tracker = TR.Tracker(spark, str(tmp_path))
    ids = spark.range(5000).select(F.format_string("run-%05d", "id").alias("run_id"))
    assert tracker.register_versions(MODEL, ids.filter("run_id < 'run-03000'").repartition(7)) == (1, 3000)
    assert tracker.register_versions(MODEL, ids.filter("run_id >= 'run-03000'")) == (3001, 5000)
    assert tracker.register_versions(MODEL, ids.limit(0)) == (5001, 5000)
    assert tracker.register_version("a/b c", "x") == 1
    got = tracker.versions().filter(F.col("name") == MODEL)
    assert got.count() == 5000 and got.filter("run_id <> format_string('run-%05d', version - 1)").isEmpty()
    before = sum(len(f) for _, _, f in os.walk(tmp_path / "model_versions"))
    tracker.log_run("run-00007", EXP, {"best_auc": 0.9}, {}, "lr")
    assert tracker.promote_best(EXP, MODEL) and not tracker.promote_best(EXP, MODEL)
    assert sum(len(f) for _, _, f in os.walk(tmp_path / "model_versions")) == before  # nothing is copied again
    assert [r["version"] for r in tracker.versions().filter("current_stage = 'Production'").collect()] == [8]


def test_of_two_registrations_one_fails(spark, tmp_path, monkeypatch):
    one, other = TR.Tracker(spark, str(tmp_path)), TR.Tracker(spark, str(tmp_path))
    assert one.register_version(MODEL, "a") == 1
    seen = one._registered()
    assert other.register_version(MODEL, "b") == 2
    monkeypatch.setattr(one, "_registered", lambda: seen)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        one.register_version(MODEL, "c")


def test_ingest_in_bounded_batches(spark, tmp_path):
    """More files than a batch takes, old ones among them, and a restart in the middle."""
    inbox = tmp_path / "in"
    inbox.mkdir()
    args = (spark, str(inbox), str(tmp_path / "manifest"), str(tmp_path / "table"))
    for i in range(5):
        (inbox / f"{i}.txt").write_text(f"{i},2019-08-22 00:00:00,1,1,2.0,0,0,0,0\n")
    os.utime(inbox / "0.txt", (1_000_000_000, 1_000_000_000))
    assert ingest_new_files(*args, files_per_batch=2) == 5
    (inbox / "late.txt").write_text("9,2019-08-22 00:00:00,1,1,2.0,0,0,0,0\n")
    os.utime(inbox / "late.txt", (1_000_000_000, 1_000_000_000))  # older than all that has been taken
    assert ingest_new_files(*args, files_per_batch=2) == 1
    os.rename(tmp_path / "manifest_checkpoint", tmp_path / "lost")  # without its log the manifest still knows the files
    assert ingest_new_files(*args, files_per_batch=2) == 0
    assert sorted(r["transaction_id"] for r in spark.read.parquet(args[3]).collect()) == [0, 1, 2, 3, 4, 9]


def test_metrics_files(spark, tmp_path):
    path = str(tmp_path / "m")
    for run in ("a", "b"):
        export_metrics(metrics_frame(spark, {"run_id": run, "best_auc": 0.5, "best_model": "lr"}, run), path)
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 2
    rows = metrics_pivot(read_metrics(spark, path), ["best_auc", "best_model", "f1"]).collect()
    assert {(r["run_id"], r["best_auc"], r["f1"]) for r in rows} == {("a", "0.5", None), ("b", "0.5", None)}


def test_ingest_skips_loaded_files(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    args = (spark, str(inbox), str(tmp_path / "manifest"), str(tmp_path / "table"))

    def put(name, ids):
        (inbox / name).write_text("# header\n" + "".join(f"{i},2019-08-22 00:00:00,1,1,2.0,0,0,0,0\n" for i in ids))

    assert not (tmp_path / "manifest").exists()
    put("2019-08-22.txt", [1, 2])
    put("notes.md", [9])
    assert ingest_new_files(*args) == 2
    assert ingest_new_files(*args) == 0
    put("2019-09-21.txt", [3])
    loaded = spark.createDataFrame([("2019-08-22.txt",)], "file_name STRING")
    assert [r["file_name"] for r in not_loaded(list_files(spark, str(inbox)), loaded).collect()] == ["2019-09-21.txt"]
    assert ingest_new_files(*args) == 1
    table = spark.read.parquet(args[3])
    assert sorted(r["transaction_id"] for r in table.collect()) == [1, 2, 3]


def test_equal_names_in_different_folders(spark, tmp_path):
    """Files are known by their path below the inbox, also when the inbox is a glob."""
    args = (spark, str(tmp_path / "in" / "*"), str(tmp_path / "manifest"), str(tmp_path / "table"))
    for n, part in enumerate(("a", "b c")):
        (tmp_path / "in" / part).mkdir(parents=True)
        (tmp_path / "in" / part / "2024-01-01.txt").write_text(f"{n},2019-08-22 00:00:00,1,1,2.0,0,0,0,0\n")
        assert ingest_new_files(*args) == 1
        assert ingest_new_files(*args) == 0
    assert sorted(r["transaction_id"] for r in spark.read.parquet(args[3]).collect()) == [0, 1]


def test_failed_ingest_can_be_repeated(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "2019-08-22.txt").write_text("1,2019-08-22 00:00:00,1,1,2.0,0,0,0,0\n")
    table = str(tmp_path / "table")
    # the first run stopped before it noted its files
    ingest_new_files(spark, str(inbox), str(tmp_path / "lost"), table)
    assert ingest_new_files(spark, str(inbox), str(tmp_path / "manifest"), table) == 1
    assert spark.read.parquet(table).count() == 1


@pytest.fixture(scope="module")
def clean(spark):
    return spark.range(600).selectExpr(
        "id AS transaction_id", "'2024-01-01 00:00:00' AS tx_datetime", "id % 17 AS customer_id", "id % 5 AS terminal_id",
        "CASE WHEN id % 50 = 3 THEN NULL ELSE CAST((id * 37) % 101 AS DOUBLE) END AS tx_amount",
        "id AS tx_time_seconds", "CAST(id % 9 AS INT) AS tx_time_days",
        "CAST((id * 37) % 101 > 80 AS INT) AS tx_fraud", "0 AS tx_fraud_scenario")


@pytest.mark.parametrize("compat", [False, True])
def test_training(spark, clean, tmp_path, compat):
    options = T.TrainingOptions(trees=3, depth=3, max_iter=5, compat=compat, sample_fraction=0.9)
    clean.write.parquet(str(tmp_path / "clean"))
    tracker = TR.Tracker(spark, str(tmp_path / "track"))
    done = T.run_training(spark, str(tmp_path / "clean"), tracker, str(tmp_path / "models"), str(tmp_path / "metrics"),
                          "r1", options=options)
    wanted = {"lr_auc", "lr_pr_auc", "rf_auc", "rf_pr_auc", "best_auc", "best_pr_auc", "precision", "recall", "f1", "test_rows"}
    assert set(done.metrics) == wanted and done.metrics["best_auc"] > 0.8
    assert done.best_model in ("logistic_regression", "random_forest") and len(done.pipeline.stages) == 3
    assert tracker.runs().first()["run_id"] == "r1" and tracker.promote_best("fraud_detection", "fraud-detector")
    names = {r["metric"] for r in read_metrics(spark, str(tmp_path / "metrics")).collect()}
    assert names == wanted | {"run_id", "best_model"}
    frame = T.training_frame(clean, T.TrainingOptions())
    scores = T.score(frame, T.load_pipeline(str(tmp_path / "models" / "r1")))
    assert scores.columns == [*frame.columns, "score"] and scores.filter("score < 0 OR score > 1").isEmpty()


def test_models_read_kept_vectors_and_curves_kept_scores(spark, clean, monkeypatch):
    """Features, split and predictions are computed once; every later pass reads what is kept, and all is given up."""
    kept = []

    class Watching(T.LogisticRegression):
        def fit(self, dataset, params=None):
            kept.append(dataset.storageLevel.useDisk and dataset.columns == ["scaled_features", T.LABEL])
            return super().fit(dataset, params)

    curve = T.score_curve
    monkeypatch.setattr(T, "candidate_models", lambda o: {
        "logistic_regression": Watching(featuresCol="scaled_features", labelCol=T.LABEL, maxIter=o.max_iter, regParam=o.reg_param)})
    monkeypatch.setattr(T, "score_curve", lambda scored: kept.append(scored.storageLevel.useDisk) or curve(scored))
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    done = T.train_and_compare(clean, T.TrainingOptions(max_iter=5))
    assert kept == [True, True] and spark.sparkContext._jsc.getPersistentRDDs().size() == before
    train, test = split_by_key(T.training_frame(clean, T.TrainingOptions()), "transaction_id", 0.8, 42)
    assert (done.train_rows, done.test_rows) == (train.count(), test.count())


def test_search_query_makes_its_features_once(spark, folder, monkeypatch):
    """The evaluator reads the stored model rows, not the windows behind them."""
    from tillwatch.catalog import batch

    plans, evaluate = [], batch.BinaryClassificationEvaluator.evaluate
    monkeypatch.setattr(batch.BinaryClassificationEvaluator, "evaluate", lambda self, rows, params=None: (
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString()) or evaluate(self, rows, params)))
    assert batch.grid_search(spark, folder).count() == 4
    assert len(plans) == 1 and "Window" not in plans[0]


def test_null_amounts(spark, clean):
    frame = customer_terminal_features(clean)
    assert T.without_nulls(frame, "drop").count() == 588
    filled = T.without_nulls(frame, "impute")
    mean = frame.agg(F.avg("tx_amount")).first()[0]
    assert filled.filter("transaction_id = 3").first()["tx_amount"] == pytest.approx(mean)
    with pytest.raises(Exception):
        T.preparation().fit(T.without_nulls(frame, "error")).transform(frame).collect()


def test_scaler_is_sample_deviation(spark, clean):
    frame = T.without_nulls(customer_terminal_features(clean), "drop")
    scaler = T.preparation().fit(frame).stages[1]
    stats = {r["feature"]: r for r in T.standardise_stats(frame).collect()}
    for i, name in enumerate(FEATURE_COLUMNS):
        assert scaler.mean[i] == pytest.approx(stats[name]["mean"])
        assert scaler.std[i] == pytest.approx(stats[name]["std"])


def test_later_rows_do_not_change_a_training_row(clean):
    for how in ("drop", "impute"):
        options = T.TrainingOptions(handle_null=how)
        cut = F.col("tx_time_seconds") < 300
        early, whole = T.training_frame(clean.filter(cut), options), T.training_frame(clean, options).filter(cut)
        assert sorted(map(str, early.collect())) == sorted(map(str, whole.collect())) and early.count() > 0


def test_means_of_training_rows_travel_with_the_pipeline(spark, clean, tmp_path):
    gaps = clean.withColumn("tx_amount", F.when(F.col("transaction_id") % 7 != 0, F.col("tx_amount")))
    done = T.train_and_compare(gaps, T.TrainingOptions(trees=2, depth=2, max_iter=3, handle_null="impute"))
    assert done.train_rows + done.test_rows == 600
    T.save_pipeline(done.pipeline, str(tmp_path / "p"))
    rows = T.past_features(gaps).select("transaction_id", *FEATURE_COLUMNS)
    assert T.score(rows, T.load_pipeline(str(tmp_path / "p"))).filter("score IS NULL").count() == 0
    plain = T.train_and_compare(gaps, T.TrainingOptions(trees=2, depth=2, max_iter=3))
    scored = T.score(rows, plain.pipeline)
    unknown = rows.filter(" OR ".join(f"{c} IS NULL" for c in FEATURE_COLUMNS)).count()
    assert scored.count() == 600 and scored.filter("score IS NULL").count() == unknown > 0


def test_empty_training_stops(spark):
    with pytest.raises(Exception):
        T.train_and_compare(spark.createDataFrame([], TRANSACTION_DDL))


def test_search_equals_a_plain_loop(spark, folder):
    """Each candidate's area is that of a fit of its own, by a plain loop over pairs of rows."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    from tillwatch.catalog import batch

    options = T.TrainingOptions(max_iter=5, handle_null="impute")
    frame = T.training_frame(batch.clean_table(spark, folder), options).persist()
    found = T.grid_search(frame, options, (0.01, 1.0), (0.0,))
    cut = frame.agg(F.percentile_approx("tx_time_seconds", options.train_share, 10_000)).first()[0]
    train, test = frame.filter(F.col("tx_time_seconds") <= cut), frame.filter(F.col("tx_time_seconds") > cut)
    assert (found.train_rows, found.test_rows) == (train.count(), test.count()) and found.test_rows > 100
    for row in found.candidates.collect():
        model = T.candidate_models(options)["logistic_regression"]
        columns = [f"{c}{T.FILLED}" for c in FEATURE_COLUMNS]
        fitted = Pipeline(stages=[T.imputer(train), T.assembler(columns), T.scaler(), model.copy({model.regParam: row["reg_param"]})]).fit(train)
        scored = fitted.transform(test).select(T.LABEL, vector_to_array("probability")[1].alias("p")).collect()
        pos, neg = [r["p"] for r in scored if r[0] == 1], [r["p"] for r in scored if r[0] == 0]
        area = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
        assert row["auc"] == pytest.approx(area, abs=1e-9)
    frame.unpersist()


def test_roc_areas_with_ties(spark):
    rows = [("a", 0.5, 1), ("a", 0.5, 0), ("a", 0.7, 1), ("a", 0.1, 0), ("b", 0.3, 1), ("c", 0.2, 0), ("d", 0.1, 1), ("d", 0.9, 0)]
    frame = spark.createDataFrame(rows, "g STRING, s DOUBLE, y INT")
    assert {r["g"]: r["auc"] for r in T.roc_areas(frame, "g", "s", "y").collect()} == {"a": 0.875, "b": None, "c": None, "d": 0.0}
