"""Command line: ``python -m trolley etl|features|training ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from trolley.operators.split import Ratios
from trolley.plans.etl import MODES, run_etl
from trolley.plans.feature_tables import JOBS, run_feature_jobs
from trolley.plans.training_sets import lookup_job, ranking_set_job, two_tower_set_job
from trolley.sources.tables import Catalog


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="trolley")
    commands = top.add_subparsers(dest="command", required=True)

    etl = commands.add_parser("etl", help="raw tables to wide interaction tables")
    etl.add_argument("--raw", required=True)
    etl.add_argument("--output", required=True)
    etl.add_argument("--mode", choices=MODES, default="both")

    features = commands.add_parser("features", help="splits and feature tables")
    features.add_argument("--source", required=True)
    features.add_argument("--output", required=True)
    features.add_argument("--embeddings")
    features.add_argument("--job", choices=(*JOBS, "all"), default="all")
    features.add_argument("--env", default="prod")
    features.add_argument("--ratios", type=float, nargs=3, default=(0.8, 0.1, 0.1))

    training = commands.add_parser("training", help="lookups and training sets")
    training.add_argument("--source", required=True)
    training.add_argument("--features", required=True)
    training.add_argument("--output", required=True)
    training.add_argument("--embeddings")
    return top


def _catalog(root: str, embeddings: str | None) -> Catalog:
    return Catalog(root, {"embeddings": embeddings} if embeddings else {})


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"trolley-{args.command}").getOrCreate()
    if args.command == "etl":
        run_etl(spark, args.raw, args.output, args.mode)
    elif args.command == "features":
        run_feature_jobs(
            spark,
            _catalog(args.source, args.embeddings),
            Catalog(args.output),
            args.job,
            Ratios(*args.ratios),
            args.env,
        )
    else:
        source = _catalog(args.source, args.embeddings)
        features = Catalog(args.features)
        lookup_job(spark, source, features, args.output)
        ranking_set_job(spark, source, features, args.output)
        two_tower_set_job(spark, source, features, args.output)


if __name__ == "__main__":
    main()
