"""Command line: ``python -m strata {run,bronze,silver,gold,drain,enqueue,next,peek,report,compact} …``."""

from __future__ import annotations

import argparse
from dataclasses import replace
from datetime import datetime, timezone

from strata import incremental, layers, ledger, metrics, preview, quality, report, runs, session, tables
from strata.plans.config import FlagRule

JOBS = ["run", "bronze", "silver", "gold", "drain", "enqueue", "next", "peek", "report", "compact"]


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="strata")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--root", required=True, help="folder of the layer tables")
    parser.add_argument("--source", help="CSV or JSON input of run and bronze; folder of the files of drain and next")
    parser.add_argument("--run-id", default="unknown_run")
    parser.add_argument("--layer", default="silver", help="layer to peek at")
    parser.add_argument("--mode", choices=["append", "overwrite"], default="append", help="what drain does with earlier batches")
    parser.add_argument("--format", choices=["csv", "json", "parquet"], default="csv", help="format of the files of drain")
    parser.add_argument("--lines", action="store_true", help="JSON sources hold one object per line")
    parser.add_argument("--malformed", choices=["fail", "keep"], default="fail", help="what to do with malformed rows")
    parser.add_argument("--partition-by", help="column that partitions the gold layer")
    parser.add_argument("--key", help="column whose nulls are counted")
    parser.add_argument(
        "--rule", nargs=5, action="append", default=[], metavar=("COLUMN", "TARGET", "VALUE", "MATCH", "OTHER"),
        help="rule of the gold layer, in place of the default ones; may be repeated",
    )
    parser.add_argument("--pipeline", default="scheduled", help="pipeline whose queue enqueue and next work on")
    parser.add_argument("--files", nargs="*", default=[], help="names to enqueue, in order")
    args = parser.parse_args(argv)
    if args.job in ("run", "bronze", "drain", "next") and not args.source:
        parser.error(f"{args.job} needs --source")
    spark = session.build("strata")
    config = replace(layers.DEFAULT, lines=args.lines, malformed=args.malformed)
    if args.partition_by:
        config = replace(config, partition_by=args.partition_by)
    if args.key:
        config = replace(config, key=args.key)
    if args.rule:
        config = replace(config, rules=tuple(FlagRule(*rule) for rule in args.rule))
    queue, now = f"{args.root}/queue", datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")
    if args.job == "run":
        layers.run(spark, args.source, args.root, args.run_id, config)
    elif args.job == "bronze":
        layers.bronze(spark, args.source, args.root, args.run_id, config)
    elif args.job == "silver":
        layers.silver(spark, args.root, args.run_id, config)
    elif args.job == "gold":
        layers.gold(spark, args.root, args.run_id, config)
    elif args.job == "drain":
        reader = spark.read.option("recursiveFileLookup", True)
        if args.format == "parquet":
            schema = reader.parquet(args.source).schema
        elif args.format == "json":
            schema = reader.option("multiLine", not args.lines).json(args.source).schema
        else:
            schema = incremental.schema_of(spark, args.source)
        incremental.drain(
            spark, args.source, args.root, schema, f"{args.root}/checkpoint", fmt=args.format, config=config, mode=args.mode
        )
    elif args.job == "enqueue":
        entries = incremental.load_ledger(spark, queue)
        incremental.store_ledger(ledger.enqueue(entries, args.files, args.pipeline, now), queue)
    elif args.job == "next":
        incremental.run_stored(spark, queue, args.source, args.root, args.pipeline, args.run_id, now, config)
    elif args.job == "peek":
        df = tables.read_layer(spark, layers.layer_path(args.root, args.layer))
        preview.peek(df).show()
        quality.null_sums(df, df.columns).show()
    elif args.job == "compact":
        metrics.compact(spark, layers.metrics_path(args.root))
    else:
        records = runs.read_metrics(spark, layers.metrics_path(args.root))
        text = report.render(records.where(records.run_id == args.run_id)).first()
        print(text["report"] if text else f"no record of run {args.run_id}")


if __name__ == "__main__":
    main()
