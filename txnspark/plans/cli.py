"""Job entry points: ``spark-submit -m``-style module with one sub-command per job.

    python -m txnspark.plans.cli ingest --data-dir /data/raw --limit 10000
    python -m txnspark.plans.cli promote --dry-run
    python -m txnspark.plans.cli features --limit -1
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import asdict

from pyspark.sql import SparkSession

from txnspark.plans import jobs
from txnspark.scratch import clear_scratch
from txnspark.settings import Lake


def parser() -> argparse.ArgumentParser:
    """Command line of all jobs."""
    top = argparse.ArgumentParser(prog="txnspark")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, layers: Sequence[str]) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        sub.add_argument("--catalog", help="catalog of the layered tables")
        for layer in layers:
            sub.add_argument(f"--schema-{layer}", dest=layer, help=f"name of the {layer} schema")
        sub.add_argument("--dry-run", action="store_true", help="count only, write nothing")
        return sub

    sub = command("ingest", "raw files to bronze and silver", ("bronze", "silver"))
    sub.add_argument("--data-dir", help="folder of the raw files")
    sub.add_argument("--limit", type=int, help="first N transactions; negative means all")
    sub.add_argument("--skip-tables", action="store_true", help="write the static features only")
    sub.add_argument("--skip-features", action="store_true", help="write the operational tables only")
    sub.add_argument("--skip-silver", action="store_true", help="stop after bronze")
    command("promote", "bronze to silver", ("bronze", "silver"))
    sub = command("features", "silver to gold behavioural features", ("silver", "gold"))
    sub.add_argument("--limit", type=int, help="first N by time; all by default")
    return top


def run(spark: SparkSession, argv: Sequence[str] | None = None) -> dict:
    """Run one job on a session and return its counters."""
    args = parser().parse_args(argv)
    names = {n: getattr(args, n, None) for n in ("catalog", "bronze", "silver", "gold")}
    lake = Lake(**{n: v for n, v in names.items() if v})
    limit = getattr(args, "limit", None)
    limit = None if limit is None or limit < 0 else limit
    if args.command == "ingest":
        done = jobs.ingest(
            spark,
            lake,
            data_dir=args.data_dir,
            limit=limit,
            dry_run=args.dry_run,
            skip_tables=args.skip_tables,
            skip_features=args.skip_features,
            promote_silver=not args.skip_silver,
        )
        return asdict(done)
    if args.command == "promote":
        return asdict(jobs.promote(spark, lake, dry_run=args.dry_run))
    if args.dry_run:
        return {"rows": jobs.behavioral_frame(spark, lake, limit=limit).count(), "written": False}
    return {"rows": jobs.write_behavioral(spark, lake, limit=limit), "written": True}


def main() -> None:
    spark = SparkSession.builder.appName("txnspark").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        print(run(spark))
    finally:
        clear_scratch(spark)


if __name__ == "__main__":
    main()
