"""Command line: ``python -m labelloom {preprocess,eda,train}``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from labelloom.config import JobConfig
from labelloom.functions.labels import DEFAULT_LABELS
from labelloom.plans.eda import run_eda
from labelloom.plans.load import load_labelled_pair
from labelloom.plans.preprocess import preprocess
from labelloom.plans.train import train_and_compare
from labelloom.session import build_session
from labelloom.sources.readers import load_processed
from labelloom.storage import clear_scratch


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="labelloom")
    commands = parser.add_subparsers(dest="command", required=True)

    for name in ("preprocess", "eda"):
        sub = commands.add_parser(name)
        sub.add_argument("--train", required=True, help="CSV with the train rows")
        sub.add_argument("--test", required=True, help="CSV with the test rows")
        sub.add_argument("--cache-dir", help="folder to land the parsed tables in")
        sub.add_argument("--labels", help="text file with one label per line, in id order")
        out = "data/processed" if name == "preprocess" else "reports/eda"
        sub.add_argument("--out", default=out)
        if name == "preprocess":
            sub.add_argument("--val-size", type=float, default=0.1)
            sub.add_argument("--seed", type=int, default=42)
            sub.add_argument("--no-dedupe", action="store_true")
            sub.add_argument("--layout", choices=("partitioned", "per_split"))
            sub.add_argument("--fmt", choices=("parquet", "csv"), default="parquet")
            sub.add_argument("--config", help="JSON whose seed, val_size and dedupe are taken in place of the options")

    sub = commands.add_parser("train")
    sub.add_argument("--config")
    sub.add_argument("--data-dir")
    sub.add_argument("--output-dir")
    sub.add_argument("--max-train-samples", type=int)
    sub.add_argument("--expected-labels", type=int, default=len(DEFAULT_LABELS))
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(f"labelloom-{args.command}")
    try:
        _run(spark, args)
    finally:
        clear_scratch(spark)


def _run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.command == "train":
        config = JobConfig.load(args.config).override(
            data_dir=args.data_dir,
            output_dir=args.output_dir,
            max_train_samples=args.max_train_samples,
        )
        splits, _, num_labels = load_processed(
            spark,
            config.data_dir,
            config.label_mapping_file,
            config.max_train_samples,
            args.expected_labels,
        )
        result = train_and_compare(
            splits,
            num_labels,
            config.eval_splits,
            config.max_eval_samples,
            config.max_length,
            config.run_baseline,
            config.metric_for_best_model,
            out_dir=config.output_dir,
            comparison_filename=config.comparison_filename,
        )
        result.metrics.orderBy("phase", "split", "metric").show(100, truncate=False)
        result.delta.orderBy("split", "metric").show(100, truncate=False)
        return

    labels = DEFAULT_LABELS
    if args.labels:
        labels = tuple(r["value"] for r in spark.read.text(args.labels).toLocalIterator() if r["value"])
    pair = load_labelled_pair(spark, args.train, args.test, args.cache_dir, labels=labels)
    if args.command == "preprocess":
        config = JobConfig.load(args.config) if args.config else None
        result = preprocess(
            pair,
            config.val_size if config else args.val_size,
            config.seed if config else args.seed,
            args.out,
            dedupe=config.dedupe if config else not args.no_dedupe,
            labels=labels,
            fmt=args.fmt,
            layout=args.layout,
        )
        print(f"removed {result.removed} exact duplicates from train")
        result.summary.orderBy("split").show()
    else:
        report = run_eda(pair, args.out)
        report.checks.show(truncate=False)
        report.imbalance.show(truncate=False)
        report.lengths.show(truncate=False)


if __name__ == "__main__":
    main()
