"""One query per operator; each takes the session and the folder of the given tables."""

import uuid
from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import fixture
from checks.fixture import RUN_TS
from eventlake.contract import ERROR, EVENT_COLUMNS, STAGING_COLUMNS
from eventlake.operators import enrich, monitor, quality
from eventlake.operators.transform import event_date_range, raw_events
from eventlake.operators.validate import bad, good
from eventlake.plans import jobs, models
from eventlake.sinks import publish, versions
from eventlake.sources import bronze as bronze_source
from eventlake.sources.folders import matching, remove
from eventlake.sources.silver import REJECTED_OPTIONS, SLICES, read_rejected, read_silver

SLICE_DAY, NEXT_DAY = date(2024, 1, 5), date(2024, 1, 6)
RANGE = (date(2024, 1, 10), date(2024, 1, 20))
SCAN_DATES = (date(2024, 1, 10), date(2024, 1, 19))
DRIFT_CONTRACT = (*(c for c in EVENT_COLUMNS if c != "referrer"), "campaign")


def shown(rows: DataFrame) -> DataFrame:
    """Dates and timestamps as text, so that two engines write them alike."""
    formats = {
        T.DateType(): "yyyy-MM-dd",
        T.TimestampType(): "yyyy-MM-dd HH:mm:ss.SSSSSS",
    }
    return rows.select(
        *(
            F.date_format(f.name, formats[f.dataType]).alias(f.name)
            if f.dataType in formats
            else F.col(f"`{f.name}`")
            for f in rows.schema.fields
        )
    )


def unstamped(silver: DataFrame) -> DataFrame:
    return shown(silver.drop("ingestion_timestamp"))


# Sources


def bronze_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_events(bronze_source.scan(spark, fixture.bronze_tree(spark, sf_dir)))


def bronze_daily_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fixture.bronze_tree(spark, sf_dir)
    return bronze_source.scan_days(spark, root, SLICE_DAY, SLICE_DAY).select("event_id", "user_id")


def bronze_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fixture.new_folder(spark, "plain")
    fixture.write_bronze(spark, sf_dir, root, day_folders=False)
    return raw_events(bronze_source.scan_recursive(spark, root))


def silver_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = read_silver(spark, fixture.full_lake(spark, sf_dir).silver)
    counted = (
        event_date_range(silver, *SCAN_DATES)
        .where(F.col("event_type") == "search")
        .groupBy("event_date", "event_type")
        .agg(F.count("*").alias("events"))
    )
    return shown(counted)


# Validation and transformation


def validate_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.classified(spark, sf_dir).select(*EVENT_COLUMNS, ERROR)


def valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_events(good(fixture.classified(spark, sf_dir)))


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bad(fixture.classified(spark, sf_dir)).select(*EVENT_COLUMNS, ERROR)


def silver_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unstamped(fixture.silver(spark, sf_dir))


def in_event_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unstamped(event_date_range(fixture.silver(spark, sf_dir), *RANGE))


# Sinks and catalog


def silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fixture.new_folder(spark, "silver")
    publish.write_partitions(fixture.silver(spark, sf_dir), path)
    return shown(read_silver(spark, path))


def silver_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping ranges, each loaded twice into the same silver."""
    lake = fixture.empty_lake(spark, sf_dir)
    first, last = fixture.date_bounds(spark, sf_dir)
    for start, end in 2 * [(first, RANGE[1]), (RANGE[0], last)]:
        jobs.run_backfill(spark, lake, start, end, None, slack_days=1, run_ts=RUN_TS)
    return unstamped(read_silver(spark, lake.silver))


def silver_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fixture.new_folder(spark, "silver")
    publish.write_partitions(fixture.silver(spark, sf_dir), path)
    return _files_per_partition(spark, path)


def _files_per_partition(spark: SparkSession, path: str) -> DataFrame:
    per_partition = (
        read_silver(spark, path)
        .select("event_date", "event_type", F.col("_metadata.file_path").alias("file"))
        .groupBy("event_date", "event_type")
        .agg(F.count("*").alias("rows"), F.count_distinct("file").alias("files"))
    )
    return shown(per_partition)


def rejected_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded by week, by month and from another start: one row per bad event."""
    lake = fixture.empty_lake(spark, sf_dir)
    for batch in ("week", "month"):
        fixture.backfill(spark, sf_dir, lake, batch=batch)
    jobs.run_backfill(spark, lake, RANGE[0], fixture.date_bounds(spark, sf_dir)[1], run_ts=RUN_TS)
    rejected = read_rejected(spark, lake.rejected)
    columns = (*EVENT_COLUMNS, ERROR, "rejected_at", "run", "ingest_date", *SLICES)
    return shown(rejected.select(*columns))


def _registered(spark: SparkSession, sf_dir: str, build: bool) -> str:
    lake = fixture.own_gold(spark, fixture.full_lake(spark, sf_dir))
    if build:
        jobs.build_models(spark, lake)
    database = f"lake_{uuid.uuid4().hex}"
    jobs.register_tables(spark, lake, database)
    return database


def stg_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = spark.table(f"{_registered(spark, sf_dir, build=True)}.stg_events")
    return shown(staged.select(*STAGING_COLUMNS))


def daily_event_summary_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(spark.table(f"{_registered(spark, sf_dir, build=True)}.daily_event_summary"))


def catalog_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _registered(spark, sf_dir, build=False)
    return shown(
        spark.sql(
            f"select event_date, count(*) as events from {database}.silver group by event_date"
        )
    )


def rejected_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _registered(spark, sf_dir, build=False)
    return spark.sql(
        f"select run, validation_error, count(*) as rows from {database}.rejected "
        "group by run, validation_error"
    )


# Jobs of a day


def daily_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days, each loaded twice; the second day's folder holds rows of the third."""
    lake = fixture.empty_lake(spark, sf_dir)
    for day in 2 * (SLICE_DAY, NEXT_DAY):
        jobs.run_daily(spark, lake, day, RUN_TS)
    return unstamped(read_silver(spark, lake.silver))


def whole_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load, catalog, checks and models of one day; the mart as SQL users see it."""
    lake = fixture.own_gold(spark, fixture.empty_lake(spark, sf_dir))
    database = f"lake_{uuid.uuid4().hex}"
    jobs.run_day(spark, lake, SLICE_DAY, database, RUN_TS)
    return shown(spark.table(f"{database}.daily_event_summary"))


def models_between_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by date as readers of the summary's path and of the catalog's staging count them:
    after a second day's models are written and before their list is switched, and at the end."""
    lake = fixture.own_gold(spark, fixture.empty_lake(spark, sf_dir))
    database, read = f"lake_{uuid.uuid4().hex}", fixture.new_folder(spark, "read")

    def look(phase: str) -> None:
        summary = jobs.read_summary(spark, lake.summary).groupBy("event_date")
        staged = spark.table(f"{database}.stg_events").groupBy("event_date")
        found = summary.agg(F.sum("event_count").alias("events")).withColumn("reader", F.lit("summary"))
        by_name = staged.agg(F.count("*").alias("events")).withColumn("reader", F.lit("catalog"))
        found.unionByName(by_name).write.parquet(f"{read}/phase={phase}")

    def looked(*args) -> None:
        versions.switch = switch
        look("between")
        switch(*args)

    jobs.build_models(spark, lake, jobs.run_daily(spark, lake, SLICE_DAY, RUN_TS).dates)
    jobs.register_tables(spark, lake, database)
    dates = jobs.run_daily(spark, lake, NEXT_DAY, RUN_TS).dates
    switch, versions.switch = versions.switch, looked
    try:
        jobs.build_models(spark, lake, dates)
    finally:
        versions.switch = switch
    jobs.register_tables(spark, lake, database, dates)
    look("after")
    return shown(spark.read.parquet(read).select("phase", "reader", "event_date", "events"))


# Models


def daily_event_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = models.stg_events(fixture.silver(spark, sf_dir))
    return shown(models.daily_event_summary(staging))


# Monitoring


def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.run_counts(fixture.classified(spark, sf_dir))


def rejection_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.rejection_rate(fixture.classified(spark, sf_dir))


def anomaly_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(monitor.anomalies(fixture.classified(spark, sf_dir)))


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.text(fixture.bronze_tree(spark, sf_dir))
    return monitor.schema_drift(lines, "value", DRIFT_CONTRACT)


def dynamic_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fixture.events(spark, sf_dir).select("event_id", "props")
    return monitor.dynamic_fields(lines, "props", ("k",))


DYNAMIC_PATHS = {
    "user_id": ("$.user.id", "string"),
    "plan": ("$.user.plan", "string"),
    "age": ("$.user.age", "int"),
    "value": ("$.value", "int"),
    "tag": ("$.tags[0].name", "string"),
    "weight": ("$.tags[0].weight", "double"),
    "name_as_number": ("$.tags[0].name", "int"),
    "beyond": ("$.tags[1].name", "string"),
}


def dynamic_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of nested lines by path and type, beside one of props."""
    lines = fixture.nested(spark, sf_dir).select("event_id", "line")
    found = monitor.dynamic_paths(lines, "line", DYNAMIC_PATHS)
    props = fixture.events(spark, sf_dir).select(F.col("event_id").alias("id"), "props")
    read = monitor.dynamic_paths(props, "props", {"k": ("$.k", "int")})
    return found.join(read, F.col("event_id") == F.col("id")).drop("id")


def schema_drift_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fixture.nested(spark, sf_dir)
    return shown(monitor.type_changes(monitor.field_types(lines, "line", "day")))


# Quality checks, on clean tables and on dirty ones


def _dirty(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    silver = read_silver(spark, fixture.full_lake(spark, sf_dir).silver)
    signups = silver.where(F.col("event_type") == "signup")
    return {
        "silver": silver,
        "bronze": raw_events(bronze_source.scan(spark, fixture.bronze_tree(spark, sf_dir))),
        "silver_with_copies": silver.unionByName(signups),
    }


def _checked(spark: SparkSession, sf_dir: str, columns, kind: str, values=()) -> DataFrame:
    tables = _dirty(spark, sf_dir)
    checks = [quality.Check(t, c, kind, values) for t in tables for c in columns]
    return quality.report(tables, tuple(checks))


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("event_id", "user_id", "event_type", "event_timestamp")
    return _checked(spark, sf_dir, columns, quality.NOT_NULL)


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir, ("event_id",), quality.UNIQUE)


def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = quality.EVENT_TYPES
    return _checked(spark, sf_dir, ("event_type",), quality.ACCEPTED_VALUES, types)


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = fixture.full_lake(spark, sf_dir)
    tables = {
        "silver": read_silver(spark, lake.silver),
        "stg_events": jobs.read_staging(spark, lake.staging),
        "daily_event_summary": jobs.read_summary(spark, lake.summary),
    }
    return quality.report(tables, quality.SOURCE_CHECKS + quality.MODEL_CHECKS)


# Enrichment, batches and erasure


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = fixture.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        fixture.table(spark, sf_dir, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(F.concat(F.lit("u"), "c_custkey").alias("user_id"), "n_name", "c_mktsegment")
    )


def events_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.activity_by(
        fixture.silver(spark, sf_dir),
        _customers(spark, sf_dir),
        "user_id",
        "n_name",
        "c_mktsegment",
    )


def events_with_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = enrich.enrich(
        fixture.silver(spark, sf_dir), _customers(spark, sf_dir), "user_id"
    )
    return shown(joined.select("event_id", "event_date", "user_id", "n_name", "c_mktsegment"))


def backfill_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = fixture.backfill(
        spark, sf_dir, fixture.empty_lake(spark, sf_dir), batch="week", slack_days=1
    )
    return unstamped(read_silver(spark, lake.silver))


def backfill_single_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = fixture.backfill(spark, sf_dir, fixture.empty_lake(spark, sf_dir), batch="week")
    return unstamped(read_silver(spark, lake.silver))


def erase_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers of one market segment ask to be forgotten."""
    lake = fixture.bare_lake(spark)
    publish.write_partitions(fixture.silver(spark, sf_dir), lake.silver)
    users = _customers(spark, sf_dir).where(F.col("c_mktsegment") == "BUILDING")
    jobs.erase_users(spark, lake, users)
    return unstamped(read_silver(spark, lake.silver))


# Jobs that meet, break off, or come twice


def _between_staging_and_publishing(work):
    """Runs ``work`` at the moment a load has staged its rows and has not published them."""
    whole = jobs.workarea.mark_staged

    def marked(spark, folder, request):
        whole(spark, folder, request)
        jobs.workarea.mark_staged = whole
        work()

    jobs.workarea.mark_staged = marked


def backfill_beside_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily run starts and ends while a backfill is between its two steps."""
    lake = fixture.empty_lake(spark, sf_dir)
    _between_staging_and_publishing(lambda: jobs.run_daily(spark, lake, SLICE_DAY, RUN_TS))
    fixture.backfill(spark, sf_dir, lake)
    return unstamped(read_silver(spark, lake.silver))


class _BrokenOff(RuntimeError):
    pass


def backfill_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken off after staging; the next run publishes what was staged and reads no bronze."""
    lake, passes = fixture.empty_lake(spark, sf_dir), []
    scan = bronze_source.scan_in_parts

    def broken():
        raise _BrokenOff

    def counted(*args):
        for part in scan(*args):
            passes.append(1)
            yield part

    months = len(list(scan(spark, lake.bronze)))
    bronze_source.scan_in_parts = counted
    try:
        _between_staging_and_publishing(broken)
        try:
            fixture.backfill(spark, sf_dir, lake)
        except _BrokenOff:
            fixture.backfill(spark, sf_dir, lake)
    finally:
        bronze_source.scan_in_parts = scan
    done = F.lit(len(passes) / months).cast("bigint").alias("passes_over_bronze")
    return unstamped(read_silver(spark, lake.silver)).select("*", done)


def backfill_with_stray_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One empty file outside of the day folders changes no rejected row."""
    lake = fixture.own_bronze(spark, sf_dir)
    spark.range(1).select(F.lit("").alias("value")).write.text(f"{lake.bronze}/late/export")
    jobs.run_backfill(spark, lake, *RANGE, run_ts=RUN_TS)
    return read_rejected(spark, lake.rejected).select(*EVENT_COLUMNS, ERROR)


def silver_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded in a first state, then again after dates, types and users were corrected, some of
    which turns good events bad; silver is that of the second state."""
    lake = fixture.own_bronze(spark, sf_dir, fixture.first_state)
    fixture.backfill(spark, sf_dir, lake, batch="week")
    fixture.backfill(spark, sf_dir, replace(lake, bronze=fixture.bronze_tree(spark, sf_dir)))
    return unstamped(read_silver(spark, lake.silver))


def silver_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written by 40 tasks with their own file each, then compacted."""
    lake = fixture.bare_lake(spark)
    rows = fixture.silver(spark, sf_dir).repartition(40)
    rows.write.partitionBy(*publish.SILVER_PARTITIONS).parquet(lake.silver)
    jobs.compact(spark, lake)
    return _files_per_partition(spark, lake.silver)


def rejected_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows written again by 20 tasks with their own file each slice, then compacted:
    rows and files of each slice."""
    lake = fixture.bare_lake(spark)
    rejected = read_rejected(spark, fixture.full_lake(spark, sf_dir).rejected)
    slices = rejected.repartition(20).write.partitionBy(*SLICES).options(**REJECTED_OPTIONS)
    slices.json(lake.rejected)
    jobs.compact_rejected(spark, lake)
    file = F.col("_metadata.file_path").alias("file")
    rows = read_rejected(spark, lake.rejected).select(*SLICES, file).groupBy(*SLICES)
    return shown(rows.agg(F.count("*").alias("rows"), F.count_distinct("file").alias("files")))


def anomaly_rate_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(jobs.stored_anomalies(spark, fixture.full_lake(spark, sf_dir)))


def dq_report_incremental_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of a day that are not unique in all of silver, by the dated checks through the id index:
    a clean day and one of repeated events, with a copy of an id planted inside the day, on the
    next day, on the last date and nowhere. The full suite over the rows with an id of the day
    finds the same."""
    lake = fixture.bare_lake(spark)
    publish.write_partitions(fixture.silver(spark, sf_dir), lake.silver)
    jobs.build_models(spark, lake)
    clean = F.col("event_date") == F.lit(str(SLICE_DAY)).cast("date")
    one = read_silver(spark, lake.silver).where(clean).orderBy("event_id").limit(1).collect()
    twice = fixture.events(spark, sf_dir).where("event_id = 17").select(F.to_date("ts")).first()[0]
    last = fixture.date_bounds(spark, sf_dir)[1]
    unique = tuple(c for c in quality.SOURCE_CHECKS + quality.MODEL_CHECKS if c.kind == quality.UNIQUE)
    found = []
    for name, planted in {"none": None, "inside": SLICE_DAY, "near": NEXT_DAY, "far": last}.items():
        before = set(matching(spark, f"{lake.silver}/*/*/*.parquet"))
        if planted:
            copy = spark.createDataFrame(one, read_silver(spark, lake.silver).schema)
            copy = copy.withColumn("event_date", F.lit(str(planted)).cast("date"))
            copy.write.mode("append").partitionBy(*publish.SILVER_PARTITIONS).parquet(lake.silver)
            jobs.build_models(spark, lake, [str(planted)])
        jobs.reindex(spark, lake)
        held = {"silver": read_silver(spark, lake.silver), "stg_events": jobs.read_staging(spark, lake.staging)}
        for day in {SLICE_DAY, twice}:
            inside = F.col("event_date") == F.lit(str(day)).cast("date")
            own = {n: t.join(t.where(inside).select("event_id"), "event_id", "left_semi") for n, t in held.items()}
            full = {r.table: r.failures for r in quality.report(own, unique).collect()}
            dated = jobs.source_report(spark, lake, [str(day)]).unionByName(jobs.model_report(spark, lake, [str(day)]))
            for r in dated.where(F.col("check") == quality.UNIQUE).collect():
                found.append((name, str(day), r.table, r.failures if r.failures == full[r.table] else -1))
        for path in set(matching(spark, f"{lake.silver}/*/*/*.parquet")) - before:
            remove(spark, path)
            jobs.build_models(spark, lake, [str(planted)])
    return spark.createDataFrame(found, "lake string, day string, table string, f int")


def erase_users_beside_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of one market segment are erased, from the request to its end, while a load has
    staged their rows and has not published them."""
    lake = fixture.empty_lake(spark, sf_dir)
    users = _customers(spark, sf_dir).where(F.col("c_mktsegment") == "BUILDING")
    _between_staging_and_publishing(lambda: jobs.erase_users(spark, lake, users))
    fixture.backfill(spark, sf_dir, lake)
    return unstamped(read_silver(spark, lake.silver))


def daily_resumed_after_new_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's run is broken off after staging, the rest of the day's rows come in a second file,
    and the run is asked for again."""
    late = (F.col("folder_date") == F.lit(str(SLICE_DAY)).cast("date")) & (F.xxhash64("event_id") % 2 == 0)
    lake = fixture.own_bronze(spark, sf_dir, lambda rows: rows.where(~F.coalesce(late, F.lit(False))))

    def broken():
        raise _BrokenOff

    _between_staging_and_publishing(broken)
    try:
        jobs.run_daily(spark, lake, SLICE_DAY, RUN_TS)
    except _BrokenOff:
        fixture.write_bronze(spark, sf_dir, lake.bronze, change=lambda rows: rows.where(late), mode="append")
        jobs.run_daily(spark, lake, SLICE_DAY, RUN_TS)
    return unstamped(read_silver(spark, lake.silver))


def erase_users_lasting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of one market segment are erased and one day is loaded again: rows by layer,
    and how many of them are still theirs."""
    lake = fixture.backfill(spark, sf_dir, fixture.empty_lake(spark, sf_dir))
    jobs.build_models(spark, lake)
    users = _customers(spark, sf_dir).where(F.col("c_mktsegment") == "BUILDING").select("user_id")
    jobs.erase_users(spark, lake, users)
    jobs.build_models(spark, lake, jobs.run_daily(spark, lake, SLICE_DAY, RUN_TS).dates)
    layers = {
        "silver": read_silver(spark, lake.silver),
        "rejected": read_rejected(spark, lake.rejected),
        "stg_events": jobs.read_staging(spark, lake.staging),
    }
    theirs = users.distinct().withColumnRenamed("user_id", "erased")
    counts = [
        rows.join(theirs, F.col("user_id") == F.col("erased"), "left").agg(
            F.lit(name).alias("layer"), F.count("*").alias("rows"), F.count("erased").alias("rows_of_erased")
        )
        for name, rows in layers.items()
    ]
    events = F.sum("event_count").alias("rows")
    nobody = F.lit(0).cast("bigint").alias("rows_of_erased")
    summary = jobs.read_summary(spark, lake.summary).agg(events)
    counts.append(summary.select(F.lit("daily_event_summary").alias("layer"), "rows", nobody))
    return reduce(DataFrame.unionByName, counts)


QUERIES = {
    "bronze_scan": bronze_scan,
    "bronze_daily_slice": bronze_daily_slice,
    "bronze_recursive": bronze_recursive,
    "silver_scan": silver_scan,
    "event_date_range": in_event_date_range,
    "validate_rules": validate_rules,
    "valid_rows": valid_rows,
    "rejected_rows": rejected_rows,
    "silver_transform": silver_transform,
    "silver_roundtrip": silver_roundtrip,
    "silver_upsert": silver_upsert,
    "silver_layout": silver_layout,
    "rejected_roundtrip": rejected_roundtrip,
    "stg_events": stg_events,
    "daily_event_summary": daily_event_summary,
    "daily_event_summary_table": daily_event_summary_table,
    "catalog_refresh": catalog_refresh,
    "rejected_table": rejected_table,
    "daily_load": daily_load,
    "whole_day": whole_day,
    "models_between_versions": models_between_versions,
    "run_counts": run_counts,
    "rejection_rate": rejection_rate,
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_accepted_values": dq_accepted_values,
    "dq_report": dq_report,
    "anomaly_rate": anomaly_rate,
    "events_enriched": events_enriched,
    "events_with_customer": events_with_customer,
    "schema_drift": schema_drift,
    "dynamic_fields": dynamic_fields,
    "dynamic_paths": dynamic_paths,
    "schema_drift_types": schema_drift_types,
    "backfill_batches": backfill_batches,
    "backfill_single_scan": backfill_single_scan,
    "erase_users": erase_users,
    "backfill_beside_daily": backfill_beside_daily,
    "backfill_resumed": backfill_resumed,
    "backfill_with_stray_file": backfill_with_stray_file,
    "silver_corrections": silver_corrections,
    "silver_compacted": silver_compacted,
    "rejected_compacted": rejected_compacted,
    "anomaly_rate_stored": anomaly_rate_stored,
    "dq_report_incremental_whole": dq_report_incremental_whole,
    "erase_users_lasting": erase_users_lasting,
    "erase_users_beside_load": erase_users_beside_load,
    "daily_resumed_after_new_file": daily_resumed_after_new_file,
}
