"""Command line: ``python -m stratalake COMMAND --lake ROOT`` or the same through ``spark-submit``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import datetime, timezone
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from stratalake.datasets import trips
from stratalake.operators import marts, quality
from stratalake.plans import jobs
from stratalake.plans.sql import answers
from stratalake.sources.landing import ingest, ingest_totals
from stratalake.spec import DatasetSpec

DATASETS = {"yellow": trips.yellow, "green": trips.green}
#: Rows of a result that are printed.
SHOWN = 50
COMMANDS = ("ingest", "bronze", "silver", "gold", "analyze", "eda", "report", "reconcile", "pipeline")


def parse(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="stratalake", description=__doc__)
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("--lake", required=True, help="root folder or URI of the lake")
    parser.add_argument("--dataset", choices=sorted(DATASETS), default="yellow")
    parser.add_argument("--spec", help="module:name of a DatasetSpec, or of a function of a window that gives one")
    parser.add_argument("--months", help="bronze and silver: only these delivery months (yyyy-MM,yyyy-MM)")
    parser.add_argument("--start", default="2023-01", help="month (yyyy-MM) to begin with")
    parser.add_argument("--end", default="2023-05", help="month (yyyy-MM) to finish with")
    parser.add_argument("--window-start", help="earliest valid pickup; by default the beginning of --start")
    parser.add_argument("--window-end", help="pickups must lie before it; by default the end of --end")
    parser.add_argument("--base-url", default="", help="source of the landed files, noted in the manifest")
    parser.add_argument("--force", action="store_true", help="register months anew")
    parser.add_argument("--format", default="parquet", help="format that layer tables are written in")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> int:
    args = parse(argv)
    spark = SparkSession.builder.appName("stratalake").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spec = chosen_spec(args)
    run_id = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%SZ")
    for title, result in execute(spark, spec, args, run_id).items():
        print(f"\n{title}")
        rows = result.take(SHOWN + 1)
        spark.createDataFrame(rows[:SHOWN], result.schema).show(SHOWN, truncate=False)
        if len(rows) > SHOWN:
            print(f"only the first {SHOWN} rows are shown")
    return 0


def chosen_spec(args: argparse.Namespace) -> DatasetSpec:
    if not args.spec:
        return DATASETS[args.dataset](*window(args))
    module, _, name = args.spec.partition(":")
    found = getattr(import_module(module), name)
    return found if isinstance(found, DatasetSpec) else found(*window(args))


def window(args: argparse.Namespace) -> tuple[str, str]:
    """The valid pickup times, half open: those of the asked months unless they are given."""
    year, month = map(int, args.end.split("-"))
    after = f"{year + month // 12:04d}-{month % 12 + 1:02d}-01 00:00:00"
    return args.window_start or f"{args.start}-01 00:00:00", args.window_end or after


def execute(spark: SparkSession, spec: DatasetSpec, args: argparse.Namespace, run_id: str) -> dict[str, DataFrame]:
    """Run one command; the returned frames are what it has to show."""
    lake, fmt = args.lake, args.format
    months = args.months.split(",") if args.months else None
    if args.command == "ingest":
        statuses = ingest(
            spark, lake, spec.name, args.start, args.end, force=args.force, base_url=args.base_url, fmt=fmt
        )
        return {"months": statuses, "totals": ingest_totals(statuses)}
    if args.command == "bronze":
        jobs.run_bronze(spark, spec, lake, run_id, months=months, fmt=fmt)
    elif args.command == "silver":
        jobs.run_silver(spark, spec, lake, run_id, months=months, fmt=fmt)
        return {"checks": quality.with_outcome(jobs.check_history(spark, lake, run_id, fmt=fmt))}
    elif args.command == "gold":
        jobs.run_gold(spark, spec, lake, fmt=fmt)
    elif args.command == "analyze":
        return answers(spark, spec, lake, fmt=fmt)
    elif args.command == "eda":
        return jobs.run_profile(spark, spec, lake, "total_amount", "passenger_count", fmt=fmt)
    elif args.command == "report":
        found = answers(spark, spec, lake, fmt=fmt)
        monthly, hourly = found[trips.MONTHLY_MART], found[trips.HOURLY_MART]
        return {
            "monthly amounts": marts.trend_kpis(monthly, "pickup_year_month", "avg_total_amount", "trips"),
            "passengers by hour": marts.extreme_kpis(hourly, "pickup_hour", "avg_passenger_count", "trips"),
        }
    elif args.command == "reconcile":
        counts = jobs.reconcile_layers(spark, spec, lake, fmt=fmt)
        quality.assert_reconciled(counts)
        return {"row counts": counts}
    elif args.command == "pipeline":
        return jobs.run_pipeline(
            spark, spec, lake, args.start, args.end, run_id, force=args.force, base_url=args.base_url, fmt=fmt
        )
    return {}


if __name__ == "__main__":
    raise SystemExit(main())
