"""What Spark makes of the plans: passes, pruning, shuffles."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from checks import fixture
from conftest import RUN_TS, event, file_events, plan
from eventlake.operators import quality
from eventlake.operators.enrich import enrich
from eventlake.operators.transform import event_date_range
from eventlake.plans import jobs
from eventlake.plans.models import daily_event_summary, stg_events
from eventlake.session import split_for, split_settings
from eventlake.sinks import publish
from eventlake.sinks.tables import write_bucketed
from eventlake.sources import bronze as bronze_source
from eventlake.sources.silver import read_silver

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def tight(spark):
    """Limits scaled down so that small tables are joined like large ones."""
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512k",
    }
    before = {name: spark.conf.get(name, None) for name in limits}
    for name, value in limits.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_a_date_range_prunes_silver_partitions(spark):
    silver = read_silver(spark, fixture.full_lake(spark, SF_DIR).silver)
    days = date(2024, 1, 10), date(2024, 1, 12)
    ranged = event_date_range(silver, *days).where(F.col("event_type") == "login")
    assert "PartitionFilters: [isnotnull(event_date" in plan(ranged)
    read = ranged.select(F.col("_metadata.file_path")).distinct().collect()
    assert len(read) <= 3


def test_daily_checks_do_not_shuffle_the_ids_of_all_days(spark):
    silver = read_silver(spark, fixture.full_lake(spark, SF_DIR).silver)
    unique = tuple(c for c in quality.SOURCE_CHECKS if c.kind == quality.UNIQUE)
    shape = plan(quality.report_dates({"silver": silver}, unique, ["2024-01-05"]))
    others = shape.split("LeftSemi")
    assert "BroadcastHashJoin" in shape and len(others) > 1
    # The rest of silver reads one column and meets the day's ids before any shuffle.
    assert shape.count("ReadSchema: struct<event_id:string>") >= 2
    assert "SortMergeJoin" not in shape


def test_one_scan_for_the_checks_by_row(spark):
    silver = read_silver(spark, fixture.full_lake(spark, SF_DIR).silver)
    by_row = tuple(c for c in quality.SOURCE_CHECKS if c.kind != quality.UNIQUE)
    assert plan(quality.report({"silver": silver}, by_row)).split("(1) Scan")[0].count("Scan") == 1


def test_stored_anomalies_read_no_bronze(spark):
    shape = plan(jobs.stored_anomalies(spark, fixture.full_lake(spark, SF_DIR)))
    assert "bronze" not in shape and "ReadSchema: struct<>" in shape


def test_a_hot_user_is_split_in_a_row_by_row_join(spark, tmp_path, tight):
    number = F.col("id").cast("string")
    events = spark.range(0, 300_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.sha2(number, 256)).alias("user_id"),
        F.sha2(F.concat(number, F.lit("x")), 256).alias("page_url"),
    )
    events.write.parquet(str(tmp_path / "events"))
    events = spark.read.parquet(str(tmp_path / "events"))
    users = events.select("user_id").distinct().withColumn("plan", F.lit("pro"))
    users.write.parquet(str(tmp_path / "users"))
    joined = enrich(events, spark.read.parquet(str(tmp_path / "users")), "user_id")
    assert len(joined.collect()) == 300_000
    assert "SortMergeJoin(skew=true)" in plan(joined)


def test_the_mart_reads_only_its_columns(spark):
    staging = stg_events(read_silver(spark, fixture.full_lake(spark, SF_DIR).silver))
    shape = plan(daily_event_summary(staging))
    schema = next(line for line in shape.splitlines() if "ReadSchema" in line)
    assert "page_url" not in schema and "event_id" not in schema
    # A partial and a final aggregation around each of two shuffles.
    assert shape.split("(1) Scan")[0].count("Exchange") == 2


def test_the_load_parses_bronze_once(spark, lake, monkeypatch):
    file_events(lake, "2026-06-01", event("a"), event(None))
    scans = []
    whole = jobs.bronze_source.scan_days

    def counted(*args):
        scans.append(args)
        return whole(*args)

    monkeypatch.setattr(jobs.bronze_source, "scan_days", counted)
    jobs.run_daily(spark, lake, date(2026, 6, 1), RUN_TS)
    assert len(scans) == 1


def test_one_file_per_small_partition(spark, tmp_path):
    rows = fixture.silver(spark, SF_DIR).repartition(40)
    publish.write_partitions(rows, str(tmp_path / "silver"))
    files = list((tmp_path / "silver").rglob("*.parquet"))
    assert len(files) == len({f.parent for f in files})


def test_a_hot_partition_is_split_on_write(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = fixture.silver(spark, "/root/testdata/sf0.01").repartition(16)
        hot = rows.withColumn("event_date", F.lit("2024-01-01").cast("date")).withColumn(
            "event_type", F.lit("search")
        )
        publish.write_partitions(hot, str(tmp_path / "silver"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "silver").rglob("*.parquet"))) > 1
    assert read_silver(spark, str(tmp_path / "silver")).count() == rows.count()


def test_a_hot_id_is_split_in_the_upsert_join(spark, tmp_path, tight):
    number = F.col("id").cast("string")
    silver = spark.range(0, 300_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.sha2(number, 256)).alias("event_id"),
        F.sha2(F.concat(number, F.lit("x")), 256).alias("page_url"),
    )
    silver.write.parquet(str(tmp_path / "silver"))
    silver = spark.read.parquet(str(tmp_path / "silver"))
    incoming = silver.select("event_id").where("event_id < '5'")
    ids = publish.written_distinct(incoming, str(tmp_path / "ids"))
    survivors = silver.join(ids, "event_id", "left_anti")
    assert len(survivors.collect()) > 100_000
    assert "SortMergeJoin(skew=true)" in plan(survivors)


def test_bucketed_tables_join_without_moving_events(spark, tight):
    """A core table too large to broadcast: both sides are read where they lie, and sorted."""
    silver = fixture.silver(spark, SF_DIR)
    users = silver.select("user_id").distinct().withColumn("plan", F.length("user_id"))
    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed")
    events = write_bucketed(stg_events(silver), "bucketed.events", "user_id", 8)
    core = write_bucketed(users, "bucketed.users", "user_id", 8)
    joined = enrich(events, core, "user_id")
    shape = plan(joined)
    assert "SortMergeJoin" in shape and "Exchange" not in shape and "SelectedBucketsCount: 8 out of 8" in shape
    want = enrich(stg_events(silver), users, "user_id")
    assert "Exchange" in plan(want)
    columns = ["event_id", "user_id", "plan", "event_date"]
    assert sorted(map(str, joined.select(columns).collect())) == sorted(map(str, want.select(columns).collect()))
    spark.sql("DROP DATABASE bucketed CASCADE")


def test_five_thousand_small_files_are_few_tasks(spark, lake):
    folder = file_events(lake, "2026-06-01", event("0")).parent
    for i in range(1, 5000):
        (folder / f"part-{i}.json").write_text(json.dumps(event(str(i))) + "\n")
    size = sum(p.stat().st_size for p in folder.iterdir())

    def tasks():
        return bronze_source.scan_days(spark, lake.bronze, date(2026, 6, 1), date(2026, 6, 1)).rdd.getNumPartitions()

    before = tasks()
    with split_for(spark, 5000, size):
        assert tasks() <= 10 < 100 < before
    assert tasks() == before
    assert jobs.run_daily(spark, lake, date(2026, 6, 1), RUN_TS).good_rows == 5000


def test_large_files_are_split_as_ever():
    assert split_settings(10, 10 << 30) == split_settings(0, 0) == {"spark.sql.files.openCostInBytes": str(4 << 20)}


def test_a_load_parses_the_time_once_to_filter(spark, lake):
    file_events(lake, "2026-06-02", *(event(str(h), f"2026-06-0{h}T10:00:00Z") for h in (1, 2, 3, 4)), event("x", "noon"))
    rows = jobs._dated(bronze_source.scan_recursive(spark, lake.bronze), date(2026, 6, 2), date(2026, 6, 3))
    (moved,) = [line for line in plan(rows).splitlines() if line.startswith("Condition")]
    assert moved.count("event_timestamp") == 1
    assert sorted(r.event_id for r in rows.collect()) == ["2", "3", "x"]
    undated = bronze_source.scan_recursive(spark, lake.bronze).withColumn("folder_date", F.lit(None).cast("date"))
    assert [r.event_id for r in jobs._dated(undated, date(2026, 7, 1), date(2026, 7, 1)).collect()] == ["x"]


def test_staged_rows_hold_the_text_of_rejects_once(spark, lake, tmp_path):
    """Every field of the struct is a null to write in each good row."""
    file_events(lake, "2026-06-02", event("1", "2026-06-02T10:00:00Z"), event("2", "noon", duration_seconds="long", is_premium_user="si"))
    rows = jobs._dated(bronze_source.scan_recursive(spark, lake.bronze), date(2026, 6, 1), date(2026, 6, 3))
    jobs._stage(spark, rows, {"run": "daily", "batch": None}, str(tmp_path / "run"), RUN_TS)
    staged = spark.read.parquet(str(tmp_path / "run/rows/outcome=rejected"))
    kept = set(staged.schema["raw"].dataType.names)
    assert not kept & set(staged.columns) - {"event_timestamp", "duration_seconds", "is_premium_user"} and len(kept) == 8
    (bad,) = jobs._raw_rejects(spark, str(tmp_path / "run")).collect()
    assert (bad.event_id, bad.event_timestamp, bad.duration_seconds, bad.is_premium_user) == ("2", "noon", "long", "si")
    assert (bad.run, str(bad.ingest_date), str(bad.folder_date), str(bad.filed_date)) == ("daily", str(RUN_TS.date()), *2 * ["2026-06-02"])
    assert bad.rejected_at is not None and bad.validation_error == "bad_timestamp"
