"""Command line of the jobs; ``python -m eventlake <job> --help`` lists the arguments."""

import argparse
import sys
from datetime import date

from pyspark.sql import SparkSession

from eventlake.contract import ERROR, EVENT_COLUMNS
from eventlake.operators.quality import QualityError
from eventlake.plans import jobs


def arguments(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="eventlake")
    commands = parser.add_subparsers(dest="job", required=True)

    def command(name: str, help: str, *paths: str) -> argparse.ArgumentParser:
        added = commands.add_parser(name, help=help)
        for path in paths:
            added.add_argument(f"--{path}_path", required=True)
        return added

    loads = ("source", "silver", "rejected")
    daily = command("daily", "load the bronze folder of one day", *loads)
    daily.add_argument("--date", type=date.fromisoformat, required=True)

    backfill = command("backfill", "load all events of a date range", *loads)
    backfill.add_argument("--start_date", type=date.fromisoformat, required=True)
    backfill.add_argument("--end_date", type=date.fromisoformat, required=True)
    backfill.add_argument("--batch", choices=("week", "month", "year", "all"), default="month")
    backfill.add_argument(
        "--slack_days",
        type=int,
        help="how many days from its event date a row may be filed; without it all of bronze is "
        "read, whatever the range",
    )

    models = command("models", "build staging and summary", "silver", "gold")
    models.add_argument("--dates", nargs="*", help="only these event dates")

    command("checks", "run all quality checks; exit code 1 on failures", "silver", "gold")

    whole = command("day", "load, catalog, checks and models of one day", *loads, "gold")
    whole.add_argument("--date", type=date.fromisoformat, required=True)
    whole.add_argument("--database", required=True)

    erase = command("erase", "remove all rows of some users for good", "silver", "rejected")
    erase.add_argument("--gold_path", help="rebuild the models of the dates that changed")
    erase.add_argument("--users_path", required=True, help="Parquet with a user_id column")

    compact = command("compact", "rewrite partitions of many small files", "silver")
    compact.add_argument("--rejected_path", help="slices of rejected rows too")
    compact.add_argument("--gold_path", help="dates of the models too")
    compact.add_argument("--target_mb", type=int, default=jobs.TARGET_FILE >> 20)
    compact.add_argument("--dates", nargs="*", help="only these event dates")

    command("reindex", "build the id index beside silver anew", "silver")

    catalog = command("catalog", "register all tables and partitions", "silver", "rejected")
    catalog.add_argument("--gold_path")
    catalog.add_argument("--database", required=True)

    command("anomalies", "rejected rows by day and rule, from the tables", "silver", "rejected")

    drift = command("drift", "fields of some days' files against the contract", "source")
    drift.add_argument("--start_date", type=date.fromisoformat, required=True)
    drift.add_argument("--end_date", type=date.fromisoformat, required=True)

    types = command("type-drift", "fields whose type changes between days' folders", "source")
    types.add_argument("--start_date", type=date.fromisoformat, required=True)
    types.add_argument("--end_date", type=date.fromisoformat, required=True)

    for added in commands.choices.values():
        added.add_argument("--work_path", help="work area; beside silver if not given")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> list[str]:
    given = vars(args)
    paths = (given.get(f"{layer}_path") or "" for layer in ("source", "silver", "rejected", "gold"))
    lake = jobs.Lake(*paths, given.get("work_path") or "")
    if args.job == "daily":
        return [_loaded(jobs.run_daily(spark, lake, args.date))]
    if args.job == "backfill":
        batch = None if args.batch == "all" else args.batch
        dates = args.start_date, args.end_date
        return [_loaded(jobs.run_backfill(spark, lake, *dates, batch, args.slack_days))]
    if args.job == "models":
        jobs.build_models(spark, lake, args.dates)
        return []
    if args.job == "checks":
        return _checked(jobs.check_source(spark, lake) + jobs.check_models(spark, lake))
    if args.job == "day":
        loaded, checks = jobs.run_day(spark, lake, args.date, args.database)
        return [_loaded(loaded), *_checked(checks)]
    if args.job == "compact":
        target = args.target_mb << 20
        done = {"dates": jobs.compact(spark, lake, target, args.dates)}
        if args.rejected_path:
            done["slices"] = jobs.compact_rejected(spark, lake, target)
        if args.gold_path:
            done["model dates"] = jobs.compact_models(spark, lake, target)
        return [f"compacted {name}: {' '.join(found) or 'none'}" for name, found in done.items()]
    if args.job == "reindex":
        return [f"entries: {jobs.reindex(spark, lake)}"]
    if args.job == "catalog":
        jobs.register_tables(spark, lake, args.database)
        return []
    if args.job == "anomalies":
        rows = jobs.stored_anomalies(spark, lake).orderBy("event_date", ERROR).collect()
        return [f"{r.event_date} {r[ERROR]}: {r['rows']} rows, {r.rate} %" for r in rows]
    if args.job == "drift":
        rows = jobs.drift(spark, lake, EVENT_COLUMNS, args.start_date, args.end_date)
        return [f"{r.field} {r.status}: {r['rows']}" for r in rows.orderBy("field").collect()]
    if args.job == "type-drift":
        rows = jobs.type_drift(spark, lake, args.start_date, args.end_date).orderBy("day", "path").collect()
        return [f"{r.day} {r.path} {r.status}: {r.type_before} -> {r.type}" for r in rows]
    dates = jobs.erase_users(spark, lake, spark.read.parquet(args.users_path))
    return [f"changed dates: {' '.join(dates) or 'none'}"]


def lasting(spark: SparkSession, args: argparse.Namespace) -> None:
    """Tables in an in-memory catalog would vanish with the command: refuse it."""
    kind = spark.conf.get("spark.sql.catalogImplementation", "in-memory")
    if getattr(args, "database", None) and kind == "in-memory":
        sys.exit(
            "the session's catalog is in-memory, so tables would be gone when the command ends; "
            "submit with --conf spark.sql.catalogImplementation=hive and a metastore"
        )


def _loaded(done: jobs.RunReport) -> str:
    strays = f", outside of day folders: {' '.join(done.strays)}" if done.strays else ""
    return (
        f"bronze {done.bronze_rows}, good {done.good_rows}, bad {done.bad_rows}, "
        f"rejection rate {done.rejection_rate} %, dates {len(done.dates)}{strays}"
    )


def _checked(rows) -> list[str]:
    return [f"{r.table}.{r.column} {r.check}: {r.failures}" for r in rows]


def main(argv=None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName(f"eventlake-{args.job}").getOrCreate()
    lasting(spark, args)
    try:
        print("\n".join(run(spark, args)))
    except QualityError as failed:
        sys.exit(f"quality checks failed: {failed}")


if __name__ == "__main__":
    main()
