"""Feature vector, two models, comparison, and the pipeline to deploy."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.functions.amounts import safe_ratio
from tillwatch.functions.hashing import unit_hash
from tillwatch.operators.entity_features import ENTITY_COLUMNS, customer_terminal_features
from tillwatch.operators.evaluation import confusion_matrix, curve_areas, score_curve, weighted_prf
from tillwatch.operators.history import with_earlier_amounts
from tillwatch.operators.ordered import ranked
from tillwatch.operators.sampling import random_split, sample_by_key, sample_fraction, split_by_place
from tillwatch.plans.tracking import best_of_models
from tillwatch.schema import FEATURE_COLUMNS

LABEL = "tx_fraud"
#: Ending of the columns that the imputing stage adds.
FILLED = "_filled"


@dataclass(frozen=True)
class TrainingOptions:
    """``compat`` trains the leaky way: features over the whole history, sample before features, scaler
    (and imputed means) fitted on all rows, random split.

    Otherwise a row's features see earlier rows only, everything fitted sees training rows only, and
    sample and split go by id so that a retried job repeats them. ``handle_null``: what to do with a
    row that lacks an input (no amount, or the first of its customer or terminal): ``drop``, ``impute``
    (mean of the feature's known values, a stage of the pipeline) or ``error``.
    ``partitions`` of the model rows: the session's shuffle partitions by default.
    """

    sample_fraction: float = 1.0
    seed: int = 42
    train_share: float = 0.8
    max_iter: int = 30
    reg_param: float = 0.01
    trees: int = 30
    depth: int = 6
    handle_null: str = "drop"
    compat: bool = False
    partitions: int | None = None


def assembler(columns: list[str] = FEATURE_COLUMNS, handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=columns, outputCol="features", handleInvalid=handle_invalid)


def scaler() -> StandardScaler:
    return StandardScaler(inputCol="features", outputCol="scaled_features", withMean=True, withStd=True)


def preparation(columns: list[str] = FEATURE_COLUMNS) -> Pipeline:
    """Assemble and standardise."""
    return Pipeline(stages=[assembler(columns), scaler()])


def standardise_stats(df: DataFrame, columns: list[str] = FEATURE_COLUMNS) -> DataFrame:
    """Mean and sample deviation per column: what the scaler learns."""
    parts = [F.struct(F.lit(c).alias("feature"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"))
             for c in columns]
    return df.agg(F.array(*parts).alias("_rows")).select(F.inline("_rows"))


def without_nulls(df: DataFrame, how: str, columns: list[str] = FEATURE_COLUMNS) -> DataFrame:
    if how == "drop":
        return df.dropna(subset=columns)
    if how == "impute":
        means = df.select(*[F.avg(c).alias(c) for c in columns]).select(F.struct(*columns)).scalar()
        return df.withColumns({c: F.coalesce(F.col(c).cast("double"), means[c]) for c in columns})
    if how == "error":
        return df
    raise ValueError(f"handle_null: {how}")


@dataclass
class Trained:
    metrics: dict[str, float]
    params: dict[str, object]
    best_model: str
    pipeline: PipelineModel
    train_rows: int
    test_rows: int
    comparison: DataFrame


def evaluate_curve(predictions: DataFrame, label: str = LABEL) -> dict[str, float]:
    """Areas under the ROC and the precision/recall curve over every distinct score, in one pass."""
    return score_areas(predictions.select(vector_to_array(F.col("probability"))[1].alias("score"), F.col(label).alias("label")))


def score_areas(scored: DataFrame) -> dict[str, float]:
    """Both areas of scored rows (``score``, ``label``)."""
    areas = curve_areas(score_curve(scored)).first()
    return {"auc": areas["roc_auc"] or 0.0, "pr_auc": areas["pr_auc"] or 0.0}


def evaluate_labels(predictions: DataFrame, label: str = LABEL) -> dict[str, float]:
    """Weighted precision, recall and F1 from one pass (an evaluator takes one pass per number)."""
    outcomes = confusion_matrix(predictions, 0.5, "prediction", label)
    return weighted_prf(outcomes).first().asDict()


def candidate_models(options: TrainingOptions) -> dict[str, Estimator]:
    """In order of preference when equally good."""
    return {
        "logistic_regression": LogisticRegression(featuresCol="scaled_features", labelCol=LABEL,
                                                  maxIter=options.max_iter, regParam=options.reg_param),
        "random_forest": RandomForestClassifier(featuresCol="scaled_features", labelCol=LABEL,
                                                numTrees=options.trees, maxDepth=options.depth,
                                                seed=options.seed)}


SHORT = {"logistic_regression": "lr", "random_forest": "rf"}


def past_features(rows: DataFrame) -> DataFrame:
    """The five derived columns of the training frame from earlier rows only."""
    out = rows
    for key, (mean, count) in ENTITY_COLUMNS.items():
        out = with_earlier_amounts(out, key, mean, count)
    return out.withColumn("customer_amount_ratio", safe_ratio(F.col("tx_amount"), F.col("avg_customer_amount")))


def imputer(train: DataFrame, columns: list[str] = FEATURE_COLUMNS) -> SQLTransformer:
    """A stage that puts the means of ``train`` in place of NULLs."""
    means = train.select(*[F.avg(c).alias(c) for c in columns]).first()
    filled = ", ".join(f"coalesce(CAST(`{c}` AS DOUBLE), CAST({means[c] or 0.0!r} AS DOUBLE)) AS `{c}{FILLED}`" for c in columns)
    return SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__")


def training_frame(clean: DataFrame, options: TrainingOptions) -> DataFrame:
    """Clean transactions to model rows: features, sample, NULL handling, needed columns only."""
    if options.compat:
        rows = customer_terminal_features(sample_fraction(clean, options.sample_fraction, options.seed))
        return without_nulls(rows.select("transaction_id", *FEATURE_COLUMNS, LABEL), options.handle_null)
    rows = sample_by_key(past_features(clean), "transaction_id", options.sample_fraction, options.seed)
    rows = rows.select("transaction_id", *FEATURE_COLUMNS, LABEL)
    return rows if options.handle_null == "impute" else without_nulls(rows, options.handle_null)


def train_and_compare(clean: DataFrame, options: TrainingOptions = TrainingOptions()) -> Trained:
    """Train both models, compare them on the held-out rows, return the deployable best one."""
    spark = clean.sparkSession
    frame = training_frame(clean, options)
    # One even deal of the narrow model rows before dozens of passes over them.
    parts = options.partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    frame = frame.repartition(parts, "transaction_id")
    prepared = None
    if options.compat:
        prepared = preparation().fit(frame)
        frame = prepared.transform(frame)
    if not options.compat:
        frame = frame.withColumn("_place", unit_hash("transaction_id", options.seed))  # hashed once, not in every pass
    held: list[DataFrame] = []

    def hold(rows: DataFrame) -> DataFrame:
        """Rows that are read again and again; they spill to disk, and a lost block is computed again."""
        held.append(rows.persist(StorageLevel.MEMORY_AND_DISK))
        return held[-1]

    frame = hold(frame)
    try:
        train, test = (random_split(frame, options.train_share, options.seed) if options.compat else
                       split_by_place(frame, F.col("_place"), options.train_share))
        train_rows, test_rows = train.count(), test.count()
        if train_rows == 0:
            raise ValueError("empty training data: run the cleaning job first")
        if options.compat:
            ready, ready_train, ready_test = prepared, train, test
        else:
            stages = [imputer(train)] if options.handle_null == "impute" else []
            columns = [f"{c}{FILLED}" for c in FEATURE_COLUMNS] if stages else FEATURE_COLUMNS
            ready = Pipeline(stages=[*stages, assembler(columns), scaler()]).fit(train)
            # Vectors are made once, not in every pass of the models; then the rows behind them are given up.
            ready_train, ready_test = [hold(ready.transform(part).select("scaled_features", LABEL)) for part in (train, test)]
            for part in (ready_train, ready_test):
                part.count()
            frame.unpersist()
        models: dict[str, Model] = {}
        scores: dict[str, DataFrame] = {}
        results: dict[str, dict[str, float]] = {}
        for name, estimator in candidate_models(options).items():
            models[name] = estimator.fit(ready_train)
            # Each model predicts once; the curve reads its scores several times.
            scores[name] = hold(models[name].transform(ready_test).select(
                vector_to_array(F.col("probability"))[1].alias("score"), "prediction", F.col(LABEL).alias("label")))
            results[name] = score_areas(scores[name])
        comparison = spark.createDataFrame(
            [(i, n, r["auc"], r["pr_auc"]) for i, (n, r) in enumerate(results.items())],
            "rank INT, model STRING, auc DOUBLE, pr_auc DOUBLE")
        best = best_of_models(comparison).first()
        metrics = {f"{SHORT[n]}_{k}": v for n, r in results.items() for k, v in r.items()}
        metrics |= {"best_auc": best["auc"], "best_pr_auc": best["pr_auc"]}
        metrics |= evaluate_labels(scores[best["model"]], "label")
        metrics["test_rows"] = float(test_rows)
    finally:
        for rows in held:
            rows.unpersist()
    params = {"n_rows": train_rows + test_rows, "sample_fraction": options.sample_fraction,
              "seed": options.seed, "feature_cols": ",".join(FEATURE_COLUMNS),
              "lr_max_iter": options.max_iter, "lr_reg_param": options.reg_param,
              "rf_num_trees": options.trees, "rf_max_depth": options.depth}
    pipeline = PipelineModel(stages=[*ready.stages, models[best["model"]]])
    return Trained(metrics, params, best["model"], pipeline, train_rows, test_rows, comparison)


def save_pipeline(pipeline: PipelineModel, path: str) -> None:
    pipeline.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(features: DataFrame, pipeline: Transformer, column: str = "score",
          inputs: list[str] = FEATURE_COLUMNS) -> DataFrame:
    """Fraud probability per row; also on a stream. Every row stays: a row with a NULL input gets a NULL score,
    which ``decide`` turns into a review, unless the pipeline imputes. Model working columns are dropped."""
    if isinstance(pipeline.stages[0], SQLTransformer):
        scored = pipeline.transform(features).withColumn(column, vector_to_array(F.col("probability"))[1])
        return scored.select(*features.columns, column)
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in inputs])
    kept = [f"_in_{c}" for c in features.columns]
    filled = features.withColumnsRenamed(dict(zip(features.columns, kept)))
    filled = filled.withColumns({c: F.coalesce(F.col(f"_in_{c}").cast("double"), F.lit(0.0)) for c in inputs})
    scored = pipeline.transform(filled).withColumn("_score", vector_to_array(F.col("probability"))[1])
    back = scored.select(*[F.col(k).alias(c) for k, c in zip(kept, features.columns)], "_score")
    return back.withColumn(column, F.when(known, F.col("_score"))).drop("_score")


@dataclass
class Searched:
    """``candidates``: number, parameters and ROC area of each; ``best``: the pipeline of the first best one;
    ``cut``: the last time of the training rows."""

    candidates: DataFrame
    best: PipelineModel
    train_rows: int
    test_rows: int
    cut: float


def roc_areas(scored: DataFrame, group: str, score: str, label: str) -> DataFrame:
    """(group, auc): the exact area under each group's ROC curve, ties counted half, from ranks.

    One sort in ranges for all groups together; no task holds a whole group. ``scored`` is a stored or
    persisted frame. A group without positives or negatives has a NULL area.
    """
    rows = ranked(scored.select(group, score, label), [group], [score])
    ties = rows.groupBy(group, score).agg(F.min("_rank").alias("first"), F.count(F.lit(1)).alias("n"), F.sum(label).alias("pos"))
    sums = ties.groupBy(group).agg(
        F.sum(F.col("pos") * (F.col("first") + (F.col("n") + 1) / 2)).alias("ranks"), F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    pos, neg = F.col("pos").cast("double"), (F.col("n") - F.col("pos")).cast("double")
    return sums.select(group, F.try_divide(F.col("ranks") - pos * (pos + 1) / 2, pos * neg).alias("auc"))


def grid_search(frame: DataFrame, options: TrainingOptions = TrainingOptions(),
                reg_params: tuple[float, ...] = (0.001, 0.01, 0.1), elastic: tuple[float, ...] = (0.0, 0.5),
                time: str = "tx_time_seconds") -> Searched:
    """Parameter search over logistic regression, validated on the rows after those it is trained on.

    ``frame``: model rows of ``training_frame``, whose features see earlier rows only. The earliest
    ``options.train_share`` of the rows trains, the rest validates, so no candidate is judged on the past of its
    training rows. Scaler and means are fitted once, on training rows. All candidates score the validation rows in
    one pass, and their areas come from one sort.
    """
    spark = frame.sparkSession
    frame = frame.persist(StorageLevel.MEMORY_AND_DISK)
    held: list[DataFrame] = []
    try:
        cut = frame.agg(F.percentile_approx(time, options.train_share, 10_000)).first()[0]
        train, test = frame.filter(F.col(time) <= cut), frame.filter(F.col(time) > cut)
        stages = [imputer(train)] if options.handle_null == "impute" else []
        columns = [f"{c}{FILLED}" for c in FEATURE_COLUMNS] if stages else FEATURE_COLUMNS
        ready = Pipeline(stages=[*stages, assembler(columns), scaler()]).fit(train)
        ready_train = ready.transform(train).select(LABEL, "scaled_features").persist(StorageLevel.MEMORY_AND_DISK)
        held.append(ready_train)
        model = candidate_models(options)["logistic_regression"]
        grid = [(r, e) for r in reg_params for e in elastic]
        fitted = [model.copy({model.regParam: r, model.elasticNetParam: e}).fit(ready_train) for r, e in grid]
        scored = ready.transform(test)
        for i, one in enumerate(fitted):
            scored = (one.transform(scored).withColumn(f"_score_{i}", vector_to_array(F.col("probability"))[1])
                      .drop("rawPrediction", "probability", "prediction"))
        scores = F.array(*[F.struct(F.lit(i).alias("candidate"), F.col(f"_score_{i}").alias("score")) for i in range(len(grid))])
        long = scored.select(F.col(LABEL).alias("label"), F.explode(scores).alias("s")).select("s.candidate", "s.score", "label")
        long = long.persist(StorageLevel.MEMORY_AND_DISK)
        held.append(long)
        areas = {r["candidate"]: r["auc"] for r in roc_areas(long, "candidate", "score", "label").collect()}
        counted = train.count(), test.count()
    finally:
        for one in (*held, frame):
            one.unpersist()
    rows = [(i, r, e, areas.get(i)) for i, (r, e) in enumerate(grid)]
    best = max(range(len(grid)), key=lambda i: (areas.get(i) if areas.get(i) is not None else -1.0, -i))
    found = spark.createDataFrame(rows, "candidate INT, reg_param DOUBLE, elastic DOUBLE, auc DOUBLE")
    return Searched(found, PipelineModel(stages=[*ready.stages, fitted[best]]), *counted, cut)


def run_training(spark: SparkSession, clean_path: str, tracker, model_root: str, metrics_path: str, run_id: str,
                 experiment: str = "fraud_detection", model_name: str = "fraud-detector",
                 options: TrainingOptions = TrainingOptions()) -> Trained:
    """Training as a job: train, save the pipeline, log the run, register the version, export metrics."""
    from tillwatch.sources.metrics import export_metrics, metrics_frame

    trained = train_and_compare(spark.read.parquet(clean_path), options)
    save_pipeline(trained.pipeline, f"{model_root}/{run_id}")
    tracker.log_run(run_id, experiment, trained.metrics, trained.params, trained.best_model)
    tracker.register_version(model_name, run_id)
    export_metrics(metrics_frame(spark, {"run_id": run_id, **trained.metrics, "best_model": trained.best_model},
                                 run_id), metrics_path)
    return trained
