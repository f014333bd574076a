"""Jobs from the command line: ``python -m plumbtable prepare|train|predict|monitor ...``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from plumbtable.operators.metrics import Targets
from plumbtable.plans.features import run_complete_workflow
from plumbtable.plans.monitoring import MonitorConfig, monitor
from plumbtable.plans.scoring import TARGETS, batch_score
from plumbtable.plans.training import TrainConfig, metrics_table, train_all_targets
from plumbtable.sources.readers import load_csv, load_parquet, load_prepared
from plumbtable.sources.writers import save_metrics, save_report


def _words(text: str) -> list[str]:
    return [w for w in text.split(",") if w]


def _pairs(text: str) -> dict[str, str]:
    return dict(w.split("=", 1) for w in _words(text))


def _table(spark: SparkSession, path: str):
    return load_csv(spark, path) if path.endswith(".csv") else load_parquet(spark, path)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="plumbtable")
    commands = top.add_subparsers(dest="command", required=True)

    prepare = commands.add_parser("prepare", help="clean, split, encode and write train and test tables")
    prepare.add_argument("--input", required=True)
    prepare.add_argument("--workdir", required=True)
    prepare.add_argument("--numeric", type=_words, required=True, help="numeric features, comma separated")
    prepare.add_argument("--categorical", type=_words, default=[])
    prepare.add_argument("--targets", type=_words, required=True)
    prepare.add_argument("--drop", type=_words, default=[])
    prepare.add_argument("--test-size", type=float, default=0.2)
    prepare.add_argument("--seed", type=int, default=42)

    train = commands.add_parser("train", help="train one model per target on prepared tables")
    train.add_argument("--config", required=True, help="JSON with model, split and hpo sections")
    train.add_argument("--workdir", required=True)
    train.add_argument("--targets", type=_pairs, required=True, help="name=column, comma separated")
    train.add_argument("--run-name")

    predict = commands.add_parser("predict", help="score a table with stored models")
    source = predict.add_mutually_exclusive_group(required=True)
    source.add_argument("--input", help="CSV of rows")
    source.add_argument("--json", help="JSON documents of rows")
    predict.add_argument("--lines", action="store_true", default=None, help="the JSON has a document per line")
    predict.add_argument("--workdir", required=True)
    predict.add_argument("--target", choices=[*TARGETS, "both"], default="both")
    predict.add_argument("--model-name", default="xgboost")
    predict.add_argument("--output", required=True)

    watch = commands.add_parser("monitor", help="compare a current with a reference table")
    watch.add_argument("--reference", required=True)
    watch.add_argument("--current", required=True)
    watch.add_argument("--features", type=_words, required=True)
    watch.add_argument("--targets", type=_pairs, required=True, help="truth=prediction, comma separated")
    watch.add_argument("--output", required=True)
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.command == "prepare":
        run_complete_workflow(
            spark,
            _table(spark, args.input),
            args.workdir,
            [*args.numeric, *args.targets],
            args.categorical,
            args.numeric,
            args.categorical,
            args.targets,
            args.drop,
            args.test_size,
            args.seed,
        )
    elif args.command == "train":
        config = TrainConfig.from_dict(json.loads(spark.read.text(args.config, wholetext=True).first()["value"]))
        columns = list(args.targets.values())
        train, features = load_prepared(spark, f"{args.workdir}/processed/train", columns)
        test, _ = load_prepared(spark, f"{args.workdir}/processed/test", columns)
        options = dict(models_dir=f"{args.workdir}/models", runs_path=f"{args.workdir}/runs")
        # Prepared rows have no id of their own: all their columns together identify them.
        results = train_all_targets(
            train, test, features, args.targets, config, train.columns, run_name=args.run_name, **options
        )
        save_metrics(metrics_table(spark, results), f"{args.workdir}/metrics")
    elif args.command == "predict":
        batch_score(
            spark,
            f"{args.workdir}/models",
            f"{args.workdir}/state",
            args.output,
            args.input,
            args.json,
            args.target,
            args.model_name,
            args.lines,
        )
    else:
        targets: Targets = {truth: (truth, prediction) for truth, prediction in args.targets.items()}
        report = monitor(
            _table(spark, args.reference), _table(spark, args.current), MonitorConfig(args.features, targets)
        )
        save_report(report, args.output)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"plumbtable-{args.command}").getOrCreate()
    run(spark, args)
