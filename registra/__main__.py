"""Jobs for `spark-submit`.

`ingest` lands the archives that are new, `refine` turns a landed month into silver and gold,
and `run` does a whole month from its archives.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registra.config import (
    ACTIVE,
    KIND_LABELS,
    LOOKUP_SCHEMA,
    SAO_PAULO,
    ColumnMap,
    RunConfig,
    text_schema,
)
from registra.plans.medallion import month_metrics, refine, run
from registra.session import object_store_builder, store_options
from registra.sinks.parquet import WriteResult
from registra.streaming.ingest import ingest_archives


def label(text: str) -> tuple[str, str]:
    flag, found, name = text.partition("=")
    if not found:
        raise argparse.ArgumentTypeError(f"{text} is not flag=label")
    return flag, name


def arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="registra", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    ingest = jobs.add_parser("ingest", help="land archives that are new since the last time")
    landed = jobs.add_parser("refine", help="one landed month to silver and gold")
    whole = jobs.add_parser("run", help="archives of one month to bronze, silver and gold")

    for job in (ingest, landed, whole):
        job.add_argument("--bronze", required=True)
    for job in (ingest, whole):
        job.add_argument("--archives", required=True)
    whole.add_argument("--width", type=int, help="columns of the facts; default: their first line")
    landed.add_argument("--width", type=int, required=True, help="columns of the facts")
    for job in (landed, whole):
        job.add_argument("--silver", required=True)
        job.add_argument("--gold")
        job.add_argument("--month", required=True, help="yyyy-mm")
        cities = job.add_mutually_exclusive_group()
        cities.add_argument("--city", type=int, action="append", help="code; repeatable")
        cities.add_argument("--all-cities", action="store_true")
        job.add_argument("--guard", choices=["none", "any_column"], default="none")
        for part, name in vars(ColumnMap()).items():
            job.add_argument(f"--{part}-column", default=name, help=f"raw column, {name}")
        job.add_argument("--active", type=int, default=ACTIVE, help="status that counts")
        job.add_argument("--label", type=label, action="append", help="flag=label; repeatable")
        job.add_argument("--unique-lookup", action="store_true", help="refuse repeated codes")
        job.add_argument("--gold-by-city", action="store_true")
        job.add_argument("--search", help="also count the facts that hold this value anywhere")
    whole.add_argument("--member-conflict", choices=["all", "last"], default="all")
    whole.add_argument("--on-missing", choices=["error", "empty"], default="error")

    ingest.add_argument("--checkpoint", required=True)
    ingest.add_argument("--contains", default="", help="word in the names of the archives")
    shape = ingest.add_mutually_exclusive_group(required=True)
    shape.add_argument("--width", type=int, help="columns of the facts")
    shape.add_argument("--lookup", action="store_true", help="archives of the lookup")
    return parser.parse_args(argv)


def config(args: argparse.Namespace) -> RunConfig:
    return RunConfig(
        archives=getattr(args, "archives", ""),
        bronze=args.bronze,
        silver=args.silver,
        gold=args.gold,
        ref_month=args.month,
        width=args.width,
        columns=ColumnMap(args.municipality_column, args.status_column, args.kind_column),
        codes=None if args.all_cities else tuple(args.city or [SAO_PAULO]),
        active=args.active,
        guard=args.guard,
        on_missing=getattr(args, "on_missing", "error"),
        member_conflict=getattr(args, "member_conflict", "all"),
        unique_lookup=args.unique_lookup,
        gold_by_city=args.gold_by_city,
        search=args.search,
        kind_labels=dict(args.label or KIND_LABELS),
        storage_options=store_options(),
    )


def report(
    silver: WriteResult, gold: DataFrame | None, metrics: dict[str, int] | None = None
) -> dict[str, object]:
    """Status and counts. One row per label: its size does not depend on the flags found."""
    labels = gold.groupBy("label").agg(F.sum("n").alias("n")).collect() if gold else []
    return {
        **(metrics or {}),
        "status": silver.status,
        "silver": silver.rows,
        "gold": {row["label"]: row["n"] for row in labels},
    }


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = arguments(argv)
    spark = spark or object_store_builder(SparkSession.builder.appName("registra")).getOrCreate()
    if args.job == "ingest":
        ingest_archives(
            spark,
            args.archives,
            args.bronze,
            args.checkpoint,
            LOOKUP_SCHEMA if args.lookup else text_schema(args.width),
            args.contains,
            storage=store_options(),
        )
    elif args.job == "refine":
        cfg, schema = config(args), text_schema(args.width)
        silver, gold = refine(spark, cfg, schema)
        print(json.dumps(report(silver, gold, month_metrics(spark, cfg, schema))))
    else:
        result = run(spark, config(args))
        landed = {"facts": result.facts.rows, "lookup": result.lookup.rows}
        print(json.dumps({**landed, **report(result.silver, result.gold, result.metrics)}))


if __name__ == "__main__":
    main()
