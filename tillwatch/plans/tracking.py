"""Runs, metrics and model versions as tables, and the promotion of the best run."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.operators.ordered import ranked
from tillwatch.schema import RUN_VALUES_DDL, RUNS_DDL, STAGES_DDL, VERSIONS_DDL
from tillwatch.session import scratch_path
from tillwatch.sources.paths import read_table

PRODUCTION, ARCHIVED, NO_STAGE = "Production", "Archived", "None"
MAX_RUNS = 20


def best_runs(runs: DataFrame, experiment: str, limit: int = MAX_RUNS) -> DataFrame:
    """Finished runs of an experiment, best AUC first, equal AUC by run id."""
    return (runs.filter((F.col("status") == "FINISHED") & (F.col("experiment") == experiment))
            .orderBy(F.col("best_auc").desc_nulls_last(), "run_id").limit(limit))


def best_of_models(metrics: DataFrame) -> DataFrame:
    """The model with the higher ``auc``; a tie goes to the lower ``rank`` (first trained)."""
    return (metrics.agg(F.max_by(F.struct("model", "auc", "pr_auc"), F.struct("auc", -F.col("rank"))).alias("best"))
            .select("best.*"))


def run_version(best: DataFrame, versions: DataFrame, model: str) -> DataFrame:
    """The newest version of ``model`` that the best run produced; no row when there is none."""
    return (best.limit(1).select("run_id")
            .join(versions.filter(F.col("name") == model), "run_id")
            .orderBy(F.col("version").desc()).limit(1))


def promote(runs: DataFrame, versions: DataFrame, experiment: str, model: str) -> DataFrame:
    """The version table after promotion; unchanged when there is nothing to promote.

    Nothing to promote: no version for the best run, or its version is already in Production.
    """
    target = run_version(best_runs(runs, experiment), versions, model)
    chosen = target.filter(F.col("current_stage") != PRODUCTION).select("version").scalar()
    own = F.col("name") == model
    stage = (F.when(own & (F.col("version") == chosen), PRODUCTION)
             .when(own & chosen.isNotNull() & (F.col("current_stage") == PRODUCTION), ARCHIVED)
             .otherwise(F.col("current_stage")))
    return versions.withColumn("current_stage", stage)


class Tracker:
    """Append-only tables under one folder.

    Runs, parameters and metrics are rows. A version, once registered, never changes; each change of a stage is a
    row, and the newest one counts. Nothing is copied again. The rows of a registration lie in a folder
    named by their first number, which must be new: of two writers that start at the same number one fails.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def log_runs(self, runs: DataFrame) -> None:
        """Append runs: ``run_id, experiment, status, best_auc, best_model`` and the maps ``metrics`` and ``params``."""
        for name in ("params", "metrics"):
            values = runs.select("run_id", F.explode(F.col(name).cast("map<string,string>")).alias("name", "value"))
            values.write.mode("append").parquet(f"{self.root}/run_{name}")
        kept = [c.split()[0] for c in RUNS_DDL.split(", ")]
        runs.select(kept).write.mode("append").parquet(f"{self.root}/runs")

    def log_run(self, run_id: str, experiment: str, metrics: dict[str, float], params: dict[str, object],
                best_model: str, status: str = "FINISHED") -> None:
        auc = metrics.get("best_auc")
        row = (run_id, experiment, status, None if auc is None else float(auc), best_model,
               {k: str(v) for k, v in metrics.items()}, {k: str(v) for k, v in params.items()})
        ddl = f"{RUNS_DDL}, metrics MAP<STRING, STRING>, params MAP<STRING, STRING>"
        self.log_runs(self.spark.createDataFrame([row], ddl).coalesce(1))

    def runs(self) -> DataFrame:
        return read_table(self.spark, f"{self.root}/runs", RUNS_DDL)

    def params(self) -> DataFrame:
        return read_table(self.spark, f"{self.root}/run_params", RUN_VALUES_DDL)

    def metrics(self) -> DataFrame:
        return read_table(self.spark, f"{self.root}/run_metrics", RUN_VALUES_DDL)

    def _registered(self) -> DataFrame:
        return read_table(self.spark, f"{self.root}/model_versions", f"{VERSIONS_DDL}, registration STRING").drop("registration")

    def versions(self) -> DataFrame:
        """All versions with their newest stage."""
        changes = read_table(self.spark, f"{self.root}/version_stages", STAGES_DDL)
        newest = changes.groupBy("name", "version").agg(F.max_by("current_stage", "change").alias("current_stage"))
        return (self._registered().join(newest, ["name", "version"], "left")
                .select("name", "version", "run_id", F.coalesce("current_stage", F.lit(NO_STAGE)).alias("current_stage")))

    def register_versions(self, model: str, runs: DataFrame) -> tuple[int, int]:
        """New versions of ``model`` for the ``run_id``s in their order: gap-free numbers after the last one.

        Returns the first and the last new number. Numbers are ranks in ranges of run ids plus the ranges'
        offsets, so no task sees all runs.
        """
        first = (self._registered().filter(F.col("name") == model).agg(F.max("version").alias("v")).first()["v"] or 0) + 1
        path = scratch_path(self.spark, "new-versions")
        runs.select("run_id").write.parquet(path)
        rows = ranked(self.spark.read.schema("run_id STRING").parquet(path), [], ["run_id"])
        added = rows.select(F.lit(model).alias("name"), (F.col("_rank") + first).cast("int").alias("version"), "run_id")
        place = f"{self.root}/model_versions/registration={quote(model, safe='')}-{first}"
        added.write.mode("errorifexists").parquet(place)
        return first, first - 1 + self.spark.read.schema(VERSIONS_DDL).parquet(place).count()

    def register_version(self, model: str, run_id: str) -> int:
        """A new version of ``model`` for the run; returns its number."""
        return self.register_versions(model, self.spark.createDataFrame([(run_id,)], "run_id STRING"))[0]

    def promote_best(self, experiment: str, model: str) -> bool:
        """Promote the best finished run's version; False when nothing changed."""
        best = best_runs(self.runs(), experiment)
        if best.isEmpty():
            raise RuntimeError(f"no finished run in experiment '{experiment}'")
        before = self.versions()
        changed = promote(self.runs(), before, experiment, model).exceptAll(before)
        last = read_table(self.spark, f"{self.root}/version_stages", STAGES_DDL).agg(F.max("change").alias("n")).first()["n"] or 0
        rows = changed.select("name", "version", "current_stage", F.lit(last + 1).cast("bigint").alias("change")).persist()
        try:
            if rows.isEmpty():
                return False
            rows.coalesce(1).write.mode("append").parquet(f"{self.root}/version_stages")
            return True
        finally:
            rows.unpersist()
