"""Command line: ``python -m tillwatch clean|train|promote|ingest ...`` (or by spark-submit)."""

from __future__ import annotations

import argparse
import uuid

from tillwatch.plans.clean_job import run_cleaning
from tillwatch.plans.tracking import Tracker
from tillwatch.plans.training import TrainingOptions, run_training
from tillwatch.session import build_session, object_store_conf
from tillwatch.sources.incremental import ingest_new_files


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tillwatch")
    parser.add_argument("--endpoint", help="S3-compatible endpoint, if not the session's own")
    jobs = parser.add_subparsers(dest="job", required=True)

    clean = jobs.add_parser("clean", help="raw CSV to clean Parquet")
    clean.add_argument("--input", required=True, help="path glob of the raw files")
    clean.add_argument("--output", required=True)
    clean.add_argument("--handle-null", default="keep", choices=["keep", "impute", "drop"])
    clean.add_argument("--exact", action="store_true", help="exact quantiles instead of sketches")
    clean.add_argument("--partitions", type=int)

    # Experiment and model names and the sampling defaults are what existing runs use.
    train = jobs.add_parser("train", help="train, compare, log, register")
    train.add_argument("--input", required=True, help="clean table")
    train.add_argument("--tracking", required=True, help="folder of run and version tables")
    train.add_argument("--models", required=True, help="folder of saved pipelines")
    train.add_argument("--metrics-output", required=True)
    train.add_argument("--experiment-name", default="fraud_detection")
    train.add_argument("--model-name", default="fraud-detector")
    train.add_argument("--sample-fraction", type=float, default=0.1)
    train.add_argument("--seed", type=int, default=42)
    train.add_argument("--compat", action="store_true")

    promote = jobs.add_parser("promote", help="best finished run to Production")
    promote.add_argument("--tracking", required=True)
    promote.add_argument("--experiment-name", default="fraud_detection")
    promote.add_argument("--model-name", default="fraud-detector")

    ingest = jobs.add_parser("ingest", help="append files that no earlier run has loaded")
    ingest.add_argument("--input", required=True, help="folder of raw files")
    ingest.add_argument("--manifest", required=True)
    ingest.add_argument("--output", required=True)
    ingest.add_argument("--pattern", default="*.txt")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> object:
    args = parse(argv)
    spark = build_session(f"tillwatch-{args.job}", conf=object_store_conf(args.endpoint) if args.endpoint else None)
    if args.job == "clean":
        result = run_cleaning(spark, args.input, args.output, args.exact, args.handle_null, partitions=args.partitions)
    elif args.job == "train":
        run_id = uuid.uuid4().hex
        trained = run_training(spark, args.input, Tracker(spark, args.tracking), args.models, args.metrics_output,
                               run_id, args.experiment_name, args.model_name,
                               TrainingOptions(sample_fraction=args.sample_fraction, seed=args.seed, compat=args.compat))
        result = {"run_id": run_id, "best_model": trained.best_model, **trained.metrics}
    elif args.job == "promote":
        result = Tracker(spark, args.tracking).promote_best(args.experiment_name, args.model_name)
    else:
        result = ingest_new_files(spark, args.input, args.manifest, args.output, args.pattern)
    print(result)
    return result


if __name__ == "__main__":
    main()
