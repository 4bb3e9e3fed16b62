"""Jobs end to end on small lakes: reruns, spill, crashes, batches."""

import json
import time
import uuid
from datetime import date, timedelta
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException

from conftest import RUN_TS, event, file_events
from eventlake.contract import EVENT_TYPES
from eventlake.operators.quality import QualityError
from eventlake.plans import jobs
from eventlake.plans.jobs import Lake
from eventlake.sinks import lease, publish, quarantine, versions, workarea
from eventlake.sources.silver import read_rejected, read_silver

JUNE = date(2026, 6, 1), date(2026, 6, 30)


def ids(spark, lake):
    return sorted(r.event_id for r in read_silver(spark, lake.silver).collect())


def partitions(lake):
    folders = (p for p in Path(lake.silver).glob("*/*") if p.is_dir())
    return sorted(str(p.relative_to(lake.silver)) for p in folders)


def daily(spark, lake, day):
    return jobs.run_daily(spark, lake, date.fromisoformat(day), RUN_TS)


def spill(lake):
    first = file_events(
        lake,
        "2026-06-01",
        event("a"),
        event("b", "2026-06-01T12:00:00+00:00"),
        event("x", "2026-06-02T00:00:00+00:00"),
    )
    file_events(
        lake,
        "2026-06-02",
        event("c", "2026-06-02T10:00:00+00:00"),
        event("d", "2026-06-02T11:00:00+00:00"),
    )
    return first


def test_midnight_spill_survives_days_and_reruns(spark, lake):
    spill(lake)
    first = daily(spark, lake, "2026-06-01")
    assert first.dates == ["2026-06-01", "2026-06-02"]
    for day in ("2026-06-02", "2026-06-01", "2026-06-02"):
        daily(spark, lake, day)
    assert ids(spark, lake) == ["a", "b", "c", "d", "x"]


def test_a_changed_type_leaves_no_stale_partition(spark, lake):
    file_events(lake, "2026-06-01", event("a", event_type="login"), event("b"))
    daily(spark, lake, "2026-06-01")
    file_events(lake, "2026-06-01", event("a", event_type="signup"), event("b"))
    daily(spark, lake, "2026-06-01")
    assert ids(spark, lake) == ["a", "b"]
    assert partitions(lake) == [
        "event_date=2026-06-01/event_type=search",
        "event_date=2026-06-01/event_type=signup",
    ]


def test_other_dates_are_not_rewritten(spark, lake):
    spill(lake)
    daily(spark, lake, "2026-06-01")
    kept = Path(lake.silver) / "event_date=2026-06-01"
    before = sorted(p.name for p in kept.rglob("*.parquet"))
    daily(spark, lake, "2026-06-02")
    assert sorted(p.name for p in kept.rglob("*.parquet")) == before


def test_copies_inside_a_batch_are_kept_for_the_unique_check(spark, lake):
    file_events(lake, "2026-06-01", event("a"), event("a"), event("b"))
    for _ in range(2):
        daily(spark, lake, "2026-06-01")
    assert ids(spark, lake) == ["a", "a", "b"]


def test_counts_and_rejected_slices(spark, lake):
    file_events(lake, "2026-06-01", event("a"), event(None), event("c", "soon"), "{broken")
    for _ in range(2):
        done = daily(spark, lake, "2026-06-01")
    assert (done.bronze_rows, done.good_rows, done.bad_rows) == (4, 1, 3)
    assert done.rejection_rate == 75.0
    rows = read_rejected(spark, lake.rejected).collect()
    assert sorted(r.validation_error for r in rows) == [
        "bad_timestamp", "missing_event_id", "missing_event_id",
    ]
    assert {(r.run, str(r.ingest_date)) for r in rows} == {("daily", "2026-06-10")}
    assert {str(r.folder_date) for r in rows} == {str(r.filed_date) for r in rows} == {"2026-06-01"}
    assert [r._corrupt_record for r in rows if r._corrupt_record] == ["{broken"]
    assert [r.event_timestamp for r in rows if r.validation_error == "bad_timestamp"] == ["soon"]
    assert len({r.rejected_at for r in rows}) == 1


def test_a_rerun_without_rejects_clears_its_slice(spark, lake):
    file_events(lake, "2026-06-01", event("a"), event(None))
    daily(spark, lake, "2026-06-01")
    file_events(lake, "2026-06-01", event("a"), event("b"))
    daily(spark, lake, "2026-06-01")
    assert not list(Path(lake.rejected).rglob("*.json"))


def rejects(spark, lake):
    rows = read_rejected(spark, lake.rejected).collect()
    return sorted((r.event_id or "", r.run) for r in rows)


def test_a_rejected_row_is_in_quarantine_once_whatever_run_wrote_it(spark, lake):
    file_events(lake, "2026-06-01", event("a"), event("x", user_id=None))
    file_events(lake, "2026-06-02", event("y", "2026-06-02T00:00:00Z", user_id=None), event("z", "soon"))
    # Filed a day early: of the second day, in the first day's folder.
    file_events(lake, "2026-06-01", event("w", "2026-06-02T01:00:00Z", user_id=None), name="late.json")
    every = ["w", "x", "y", "z"]
    for day in ("2026-06-01", "2026-06-02", "2026-06-01"):
        daily(spark, lake, day)
    assert rejects(spark, lake) == [(i, "daily") for i in every]
    for how in ({"batch": "month"}, {"batch": "week"}, {"batch": None, "slack_days": 1}):
        jobs.run_backfill(spark, lake, *JUNE, run_ts=RUN_TS, **how)
        assert rejects(spark, lake) == [(i, "backfill") for i in every]
    jobs.run_backfill(spark, lake, date(2026, 6, 2), JUNE[1], run_ts=RUN_TS)
    assert rejects(spark, lake) == [(i, "backfill") for i in every]
    daily(spark, lake, "2026-06-02")
    assert rejects(spark, lake) == [("w", "backfill"), ("x", "backfill"), ("y", "daily"), ("z", "daily")]


def test_a_reversed_range_is_refused(spark, lake):
    file_events(lake, "2026-06-01", event("a"), event(None))
    daily(spark, lake, "2026-06-01")
    with pytest.raises(ValueError, match="before it starts"):
        jobs.run_backfill(spark, lake, date(2026, 6, 1), date(2026, 5, 1), run_ts=RUN_TS)
    assert len(rejects(spark, lake)) == 1


def test_a_lake_without_gold_has_no_models(spark, lake):
    with pytest.raises(ValueError, match="no gold"):
        jobs.build_models(spark, Lake(lake.bronze, lake.silver, lake.rejected))


def test_an_event_is_followed_to_another_date_and_into_quarantine(spark, lake):
    file_events(lake, "2026-06-01", event("a"), event("g"), event("k", "2026-05-20T00:00:00Z"))
    file_events(lake, "2026-06-03", event("o", "2026-06-03T00:00:00Z"))
    jobs.run_backfill(spark, lake, date(2026, 5, 1), JUNE[1], run_ts=RUN_TS)
    moved = event("a", "2026-06-02T10:00:00Z"), event("k", "2026-06-30T00:00:00Z")
    file_events(lake, "2026-06-01", *moved, event("g", user_id=None))
    done = daily(spark, lake, "2026-06-01")
    assert done.dates == ["2026-05-20", "2026-06-01", "2026-06-02", "2026-06-30"]
    assert ids(spark, lake) == ["a", "k", "o"]
    assert rejects(spark, lake) == [("g", "daily")]
    assert partitions(lake) == [f"event_date=2026-06-{d}/event_type=search" for d in ("02", "03", "30")]


def test_settings_are_the_callers_again_after_a_job(spark, lake):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        spill(lake)
        daily(spark, lake, "2026-06-01")
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_nothing_to_load(spark, lake):
    file_events(lake, "2026-06-01", event("a"))
    done = daily(spark, lake, "2026-07-01")
    assert (done.bronze_rows, done.dates, done.rejection_rate) == (0, [], None)
    done = jobs.run_backfill(spark, lake, date(2025, 1, 1), date(2025, 2, 1), run_ts=RUN_TS)
    assert done.bronze_rows == 0
    assert not Path(lake.silver).exists()


def left_over(lake):
    return sorted(p.name for p in Path(lake.area).glob("*"))


@pytest.mark.parametrize("at", ["before", "half way", "after"])
def test_a_broken_replacement_is_finished_by_the_next_run(spark, lake, monkeypatch, at):
    spill(lake)
    daily(spark, lake, "2026-06-01")
    whole = publish.write_partitions

    def broken(rows, silver):
        if at == "half way":
            # The commit removes old partitions before it moves the new ones in.
            for path in Path(silver).rglob("event_date=2026-06-02/*/*"):
                path.unlink()
        elif at == "after":
            whole(rows, silver)
        raise RuntimeError("lost")

    monkeypatch.setattr(publish, "write_partitions", broken)
    with pytest.raises(RuntimeError, match="lost"):
        daily(spark, lake, "2026-06-02")
    monkeypatch.setattr(publish, "write_partitions", whole)
    # Any later run repairs silver first, also one that loads nothing, and reports it.
    assert daily(spark, lake, "2026-07-01").dates == ["2026-06-02"]
    assert ids(spark, lake) == ["a", "b", "c", "d", "x"]
    assert left_over(lake) == []


def test_models_repair_silver_first(spark, lake, monkeypatch):
    spill(lake)
    jobs.build_models(spark, lake, daily(spark, lake, "2026-06-01").dates)
    whole = publish.write_partitions

    def broken(rows, silver):
        for path in Path(silver).rglob("event_date=2026-06-02/*/*"):
            path.unlink()
        raise RuntimeError("lost")

    monkeypatch.setattr(publish, "write_partitions", broken)
    with pytest.raises(RuntimeError, match="lost"):
        daily(spark, lake, "2026-06-02")
    monkeypatch.setattr(publish, "write_partitions", whole)
    jobs.build_models(spark, lake, [])
    staged = jobs.read_staging(spark, lake.staging).collect()
    assert sorted(r.event_id for r in staged) == ["a", "b", "c", "d", "x"]


@pytest.mark.parametrize("step", ["replace_slices", "written_distinct", "set_aside", "mark_done"])
def test_a_publication_that_breaks_off_anywhere_is_finished(spark, lake, monkeypatch, step):
    spill(lake)
    file_events(lake, "2026-06-02", event("bad", user_id=None), name="bad.json")
    daily(spark, lake, "2026-06-01")
    place = {"replace_slices": quarantine, "mark_done": workarea}.get(step, publish)
    monkeypatch.setattr(place, step, lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        daily(spark, lake, "2026-06-02")
    monkeypatch.undo()
    assert daily(spark, lake, "2026-07-01").dates == ["2026-06-02"]
    assert ids(spark, lake) == ["a", "b", "c", "d", "x"]
    assert rejects(spark, lake) == [("bad", "daily")]
    assert left_over(lake) == []


def test_staging_that_breaks_off_is_dropped(spark, lake, monkeypatch):
    spill(lake)
    monkeypatch.setattr(workarea, "mark_staged", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        daily(spark, lake, "2026-06-02")
    monkeypatch.undo()
    assert len(left_over(lake)) == 1
    assert daily(spark, lake, "2026-06-01").dates == ["2026-06-01", "2026-06-02"]
    assert ids(spark, lake) == ["a", "b", "x"]
    assert left_over(lake) == []


def between(monkeypatch, work):
    """Runs ``work`` when a load has staged its rows and not yet published them."""
    whole = workarea.mark_staged

    def marked(*args):
        whole(*args)
        monkeypatch.setattr(workarea, "mark_staged", whole)
        work()

    monkeypatch.setattr(workarea, "mark_staged", marked)


def test_another_job_leaves_a_running_one_alone(spark, lake, monkeypatch):
    file_events(lake, "2026-06-01", event("a"), event(None))
    file_events(lake, "2026-06-02", event("b", "2026-06-02T00:00:00Z"))
    between(monkeypatch, lambda: daily(spark, lake, "2026-06-02"))
    done = jobs.run_backfill(spark, lake, *JUNE, run_ts=RUN_TS)
    assert (done.bronze_rows, done.good_rows, done.bad_rows) == (3, 2, 1)
    assert ids(spark, lake) == ["a", "b"] and len(rejects(spark, lake)) == 1


def test_lost_staging_is_an_error(spark, lake, monkeypatch):
    file_events(lake, "2026-06-01", event("a"), event(None))

    def lose():
        for path in Path(lake.area).rglob("outcome=accepted/*/*.parquet"):
            path.unlink()

    between(monkeypatch, lose)
    with pytest.raises(jobs.StagingLost):
        jobs.run_backfill(spark, lake, *JUNE, run_ts=RUN_TS)
    assert rejects(spark, lake) == [] if Path(lake.rejected).exists() else True


def test_a_staged_backfill_is_not_read_again(spark, lake, monkeypatch):
    scattered(lake)
    between(monkeypatch, lambda: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        jobs.run_backfill(spark, lake, *RANGE, run_ts=RUN_TS)
    monkeypatch.setattr(jobs, "_stage", lambda *_: pytest.fail("read again"))
    done = jobs.run_backfill(spark, lake, *RANGE, run_ts=RUN_TS)
    assert done.bronze_rows == done.good_rows + done.bad_rows > 0
    assert len(ids(spark, lake)) == done.good_rows


def test_the_lease_of_a_killed_job_runs_out(spark, lake, monkeypatch):
    spill(lake)
    Path(lake.area).mkdir()
    (Path(lake.area) / "publishing").write_text("gone")
    monkeypatch.setattr(lease, "PATIENCE", 0.0)
    with pytest.raises(lease.LeaseTaken):
        daily(spark, lake, "2026-06-01")
    monkeypatch.undo()
    monkeypatch.setattr(lease, "TTL", 0.5)
    daily(spark, lake, "2026-06-01")
    assert ids(spark, lake) == ["a", "b", "x"]


def test_a_lease_is_renewed_while_its_job_runs(spark, lake, monkeypatch):
    monkeypatch.setattr(lease, "TTL", 1.0)
    Path(lake.area).mkdir()
    with lease.Lease(spark, f"{lake.area}/publishing"):
        time.sleep(2.5)
        assert lease.alive(spark, f"{lake.area}/publishing")
    assert not lease.alive(spark, f"{lake.area}/publishing")


def scattered(lake):
    """Rows filed near and far from their date, with unreadable times, over months."""
    days = ["2026-04-29", "2026-05-01", "2026-05-31", "2026-06-01", "2026-06-20", "2026-07-01"]
    for n, day in enumerate(days):
        after = str(date.fromisoformat(day) + timedelta(days=1))
        file_events(
            lake,
            day,
            event(f"own{n}", f"{day}T10:00:00+00:00"),
            event(f"next{n}", f"{after}T00:00:00+00:00"),
            event(f"bad{n}", "unreadable"),
            event(None, f"{day}T11:00:00+00:00"),
            event(f"long{n}", f"{day}T12:00:00+00:00", duration_seconds="long"),
        )
    return days


RANGE = date(2026, 5, 1), date(2026, 6, 30)


def state(spark, lake):
    silver = read_silver(spark, lake.silver).drop("ingestion_timestamp").collect()
    bad = read_rejected(spark, lake.rejected).collect()
    return sorted(map(str, silver)), sorted((r.event_id or "", r.validation_error) for r in bad)


@pytest.mark.parametrize("how", [
    {"batch": "month"},
    {"batch": "week", "slack_days": 1},
    {"batch": "month", "slack_days": 1},
    {"batch": "year", "slack_days": 3},
    {"batch": None, "slack_days": 1},
])
def test_batches_equal_one_run(spark, tmp_path, lake, how):
    scattered(lake)
    jobs.run_backfill(spark, lake, *RANGE, batch=None, run_ts=RUN_TS)
    other = Lake(lake.bronze, str(tmp_path / "s2"), str(tmp_path / "r2"))
    done = jobs.run_backfill(spark, other, *RANGE, run_ts=RUN_TS, **how)
    assert state(spark, other) == state(spark, lake)
    assert done.bronze_rows == done.good_rows + done.bad_rows
    good = ids(spark, lake)
    assert "next2" in good and "own3" in good
    # Filed in July for the 2nd, or in April for the 30th: outside the range.
    assert not {"next5", "own5", "own0", "next0"} & set(good)


def test_day_by_day_equals_a_backfill(spark, tmp_path, lake):
    days = scattered(lake)
    wide = date(2026, 4, 1), date(2026, 7, 31)
    jobs.run_backfill(spark, lake, *wide, run_ts=RUN_TS)
    other = Lake(lake.bronze, str(tmp_path / "s2"), str(tmp_path / "r2"))
    for day in [*days, *days[:2]]:
        daily(spark, other, day)
    assert state(spark, other) == state(spark, lake)


def test_a_date_far_off_is_published_like_any_other(spark, lake):
    # A bare number reads as a year, beyond what Python's dates can hold.
    file_events(lake, "2026-06-01", event("a"), event("far", "12345"))
    for _ in range(2):
        done = daily(spark, lake, "2026-06-01")
        assert done.dates == ["+12345-01-01", "2026-06-01"]
    assert read_silver(spark, lake.silver).select("event_id").count() == 2
    jobs.build_models(spark, lake, done.dates)
    assert jobs.read_summary(spark, lake.summary).count() == 2


def test_without_known_slack_rows_filed_anywhere_are_found(spark, lake):
    file_events(lake, "2026-06-01", event("a"))
    file_events(lake, "2026-09-30", event("late"))
    jobs.run_backfill(spark, lake, *JUNE, run_ts=RUN_TS)
    assert ids(spark, lake) == ["a", "late"]


def test_backfill_beside_daily_data_doubles_nothing(spark, lake):
    spill(lake)
    daily(spark, lake, "2026-06-02")
    for _ in range(2):
        jobs.run_backfill(spark, lake, *JUNE, run_ts=RUN_TS)
    assert ids(spark, lake) == ["a", "b", "c", "d", "x"]


def test_backfill_of_a_tree_without_day_folders(spark, lake):
    folder = Path(lake.bronze) / "export" / "2026" / "06"
    folder.mkdir(parents=True)
    lines = [event("a"), event("far", "2025-06-01T00:00:00Z"), event("bad", "unreadable")]
    (folder / "f.json").write_text("\n".join(map(json.dumps, lines)))
    for start in (JUNE[0], date(2026, 5, 15)):
        done = jobs.run_backfill(spark, lake, start, JUNE[1], run_ts=RUN_TS)
        assert ids(spark, lake) == ["a"]
        assert (done.bronze_rows, done.bad_rows) == (2, 1)
        assert done.strays == [f"file:{lake.bronze}/export"]
        # Without any date, it is filed under none and replaced by the next full read.
        assert rejects(spark, lake) == [("bad", "backfill")]


def test_a_stray_file_changes_nothing_else(spark, lake):
    scattered(lake)
    jobs.run_backfill(spark, lake, *RANGE, run_ts=RUN_TS)
    before = state(spark, lake)
    folder = Path(lake.bronze) / "year=2026" / "month=06" / "day=31"
    folder.mkdir(parents=True)
    (folder / "f.json").write_text(json.dumps(event("stray", "2026-06-05T00:00:00Z")))
    (Path(lake.bronze) / "year=2026" / "month=06" / "day=__HIVE_DEFAULT_PARTITION__").mkdir()
    daily(spark, lake, "2026-06-01")
    assert state(spark, lake) == before
    jobs.run_backfill(spark, lake, *RANGE, run_ts=RUN_TS)
    after = state(spark, lake)
    assert after[1] == before[1] and len(after[0]) == len(before[0]) + 1


@pytest.mark.parametrize(
    ("batch", "first"),
    [("week", "2026-02-23"), ("month", "2026-03-01"), ("year", "2026-01-01"), (None, "all")],
)
def test_groups_begin_with_their_week_month_or_year(spark, batch, first):
    days = spark.sql("select explode(array(date '2026-03-01', null)) as event_date")
    found = [r[0] for r in days.select(publish.label_of("event_date", batch)).collect()]
    assert found == [first, publish.UNDATED if batch else first]


EVENTS = st.builds(
    event,
    st.sampled_from(["a", "b", "c", "d", "e", None]),
    st.sampled_from(["2026-05-31T23:00:00Z", "2026-06-01T10:00:00Z", "2026-06-02T10:00:00Z", "x"]),
    event_type=st.sampled_from([*EVENT_TYPES[:2], "other"]),
    duration_seconds=st.sampled_from([1, "1.5", None]),
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(days=st.lists(st.lists(EVENTS, max_size=6), min_size=2, max_size=3))
def test_every_row_ends_in_silver_or_rejected(spark, tmp_path_factory, days):
    root = tmp_path_factory.mktemp("lake")
    lake = Lake(str(root / "b"), str(root / "s"), str(root / "r"))
    for n, events in enumerate(days):
        file_events(lake, f"2026-06-0{n + 1}", *events)
    wide = date(2026, 5, 1), date(2026, 7, 31)
    done = jobs.run_backfill(spark, lake, *wide, run_ts=RUN_TS)
    again = jobs.run_backfill(spark, lake, *wide, batch="week", run_ts=RUN_TS)
    total = sum(len(events) for events in days)
    assert done.bronze_rows == again.bronze_rows == total
    assert done.good_rows + done.bad_rows == total
    if done.good_rows:
        assert read_silver(spark, lake.silver).count() == done.good_rows


# Models, catalog and the whole day


def summary(spark, lake):
    return sorted(map(str, jobs.read_summary(spark, lake.summary).collect()))


def test_rebuilding_changed_dates_equals_a_full_build(spark, tmp_path, lake):
    spill(lake)
    daily(spark, lake, "2026-06-01")
    jobs.build_models(spark, lake)
    changed = daily(spark, lake, "2026-06-02").dates
    jobs.build_models(spark, lake, changed)
    full = Lake(lake.bronze, lake.silver, lake.rejected, str(tmp_path / "full"))
    jobs.build_models(spark, full)
    assert summary(spark, lake) == summary(spark, full)
    both = [jobs.read_staging(spark, x.staging).collect() for x in (lake, full)]
    assert sorted(map(str, both[0])) == sorted(map(str, both[1]))


def test_whole_day(spark, lake):
    spill(lake)
    file_events(lake, "2026-06-02", event(None), name="late.json")
    for day in ("2026-06-01", "2026-06-02", "2026-06-02"):
        loaded, checks = jobs.run_day(
            spark, lake, date.fromisoformat(day), "whole_day", RUN_TS
        )
    assert loaded.dates == ["2026-06-02"]
    assert len(checks) == 11 and not any(row.failures for row in checks)
    counts = {
        name: spark.table(f"whole_day.{name}").count()
        for name in ("silver", "rejected", "stg_events", "daily_event_summary")
    }
    assert counts == {"silver": 5, "rejected": 1, "stg_events": 5, "daily_event_summary": 2}
    by_date = spark.sql(
        "select event_date, sum(event_count) n from whole_day.daily_event_summary group by 1"
    )
    assert {str(r.event_date): r.n for r in by_date.collect()} == {
        "2026-06-01": 2, "2026-06-02": 3,
    }


def test_bad_silver_never_reaches_the_mart(spark, lake):
    file_events(lake, "2026-06-01", event("a"), event("a"))
    with pytest.raises(QualityError, match="silver.event_id unique: 1"):
        jobs.run_day(spark, lake, date(2026, 6, 1), "gated", RUN_TS)
    with pytest.raises(AnalysisException):
        spark.table("gated.daily_event_summary")


def test_catalog_follows_new_and_vanished_partitions(spark, lake):
    file_events(lake, "2026-06-01", event("a", event_type="login"))
    daily(spark, lake, "2026-06-01")
    jobs.register_tables(spark, lake, "followed")
    assert spark.table("followed.silver").count() == 1
    file_events(lake, "2026-06-01", event("a", event_type="signup"), event("b"))
    daily(spark, lake, "2026-06-01")
    jobs.register_tables(spark, lake, "followed", ["2026-06-01"])
    types = [r.event_type for r in spark.table("followed.silver").collect()]
    assert sorted(types) == ["search", "signup"]
    assert spark.sql("show partitions followed.silver").count() == 2


# Erasure


def test_erased_users_leave_silver_and_models(spark, lake):
    file_events(
        lake,
        "2026-06-01",
        event("a", user_id="gone", event_type="login"),
        event("b", user_id="gone"),
        event("c", user_id="stays"),
    )
    file_events(lake, "2026-06-02", event("d", "2026-06-02T01:00:00Z", user_id="gone"))
    file_events(lake, "2026-06-03", event("e", "2026-06-03T01:00:00Z", user_id="stays"))
    jobs.run_backfill(spark, lake, *JUNE, run_ts=RUN_TS)
    jobs.build_models(spark, lake)
    untouched = sorted(Path(lake.silver).rglob("event_date=2026-06-03/*/*.parquet"))
    users = spark.createDataFrame([("gone",), ("gone",), ("nobody",)], "user_id string")
    dates = jobs.erase_users(spark, lake, users)
    assert dates == ["2026-06-01", "2026-06-02"]
    assert ids(spark, lake) == ["c", "e"]
    assert partitions(lake) == [
        "event_date=2026-06-01/event_type=search",
        "event_date=2026-06-03/event_type=search",
    ]
    assert sorted(Path(lake.silver).rglob("event_date=2026-06-03/*/*.parquet")) == untouched
    staged = jobs.read_staging(spark, lake.staging).collect()
    assert sorted(r.event_id for r in staged) == ["c", "e"]
    counted = jobs.read_summary(spark, lake.summary).collect()
    assert sorted(str(r.event_date) for r in counted) == ["2026-06-01", "2026-06-03"]


def test_erased_users_do_not_come_back(spark, lake):
    file_events(
        lake, "2026-06-01",
        event("a", user_id="gone"), event("b"), event("c", "soon", user_id="gone"),
        event("d", "soon"), '{"user_id": "gone", "event_id": "cut', '{"event_id": "cut',
    )
    daily(spark, lake, "2026-06-01")
    users = spark.createDataFrame([("gone",), (None,)], "user_id string")
    assert jobs.erase_users(spark, lake, users) == ["2026-06-01"]
    for again in (False, True):
        if again:
            done = daily(spark, lake, "2026-06-01")
            assert (done.bronze_rows, done.good_rows, done.bad_rows) == (3, 1, 2)
        assert ids(spark, lake) == ["b"]
        rows = read_rejected(spark, lake.rejected).collect()
        assert sorted((r.event_id or "", r._corrupt_record or "") for r in rows) == [
            ("", '{"event_id": "cut'), ("d", ""),
        ]
    assert jobs.erase_users(spark, lake, users) == []


def test_erasing_goes_month_by_month(spark, lake, monkeypatch):
    scattered(lake)
    jobs.run_backfill(spark, lake, *RANGE, run_ts=RUN_TS)
    seen = []
    whole = publish.replace

    def noted(spark, silver, folder, label):
        seen.append(label)
        whole(spark, silver, folder, label)

    monkeypatch.setattr(publish, "replace", noted)
    users = spark.createDataFrame([("user_1",)], "user_id string")
    jobs.erase_users(spark, lake, users)
    assert seen == ["2026-05", "2026-06"]
    assert ids(spark, lake) == []


def test_erasing_nobody_and_everybody(spark, lake):
    spill(lake)
    daily(spark, lake, "2026-06-01")
    schema = "user_id string"
    assert jobs.erase_users(spark, lake, spark.createDataFrame([("nobody",)], schema)) == []
    assert ids(spark, lake) == ["a", "b", "x"]
    jobs.erase_users(spark, lake, spark.createDataFrame([("user_1",)], schema))
    assert ids(spark, lake) == []
    assert partitions(lake) == []


@pytest.mark.parametrize("months", [0, 1])
def test_a_broken_erasure_is_finished_by_the_next_run(spark, lake, monkeypatch, months):
    file_events(lake, "2026-06-01", event("a", user_id="gone", event_type="login"), event("b"))
    file_events(lake, "2026-07-01", event("c", "2026-07-01T00:00:00Z", user_id="gone"))
    file_events(lake, "2026-07-01", event("d", "soon", user_id="gone"), name="bad.json")
    for day in ("2026-06-01", "2026-07-01"):
        daily(spark, lake, day)
    jobs.build_models(spark, lake)
    whole, calls = publish.write_partitions, []

    def broken(rows, silver):
        calls.append(1)
        if len(calls) > months:
            raise RuntimeError("lost")
        whole(rows, silver)

    monkeypatch.setattr(publish, "write_partitions", broken)
    users = spark.createDataFrame([("gone",)], "user_id string")
    with pytest.raises(RuntimeError):
        jobs.erase_users(spark, lake, users)
    monkeypatch.undo()
    assert daily(spark, lake, "2026-08-01").dates == ["2026-06-01", "2026-07-01"]
    assert ids(spark, lake) == ["b"] and rejects(spark, lake) == []
    assert partitions(lake) == ["event_date=2026-06-01/event_type=search"]
    staged = jobs.read_staging(spark, lake.staging).collect()
    assert [r.event_id for r in staged] == ["b"]
    assert left_over(lake) == []


# Compaction


def test_only_partitions_of_many_files_are_rewritten(spark, lake, monkeypatch):
    spill(lake)
    for day in ("2026-06-01", "2026-06-02"):
        daily(spark, lake, day)
    whole = read_silver(spark, lake.silver)
    before = sorted(map(str, whole.collect()))
    first = whole.where("event_date = date '2026-06-01'").repartition(3)
    publish.set_aside(spark, f"{lake.area}/run=x", "x", [], first)
    rows = read_silver(spark, f"{lake.area}/run=x/group=x/survivors").repartition(3)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "event_date", "event_type"
    ).parquet(lake.silver)
    untouched = sorted(Path(lake.silver).rglob("event_date=2026-06-02/*/*.parquet"))

    def broken(rows, silver):
        for path in Path(silver).rglob("event_date=2026-06-01/*/*"):
            path.unlink()
        raise RuntimeError("lost")

    monkeypatch.setattr(publish, "write_partitions", broken)
    with pytest.raises(RuntimeError, match="lost"):
        jobs.compact(spark, lake)
    monkeypatch.undo()
    # Broken off half way, it is finished like a load; then there is nothing left to do.
    daily(spark, lake, "2026-08-01")
    assert sorted(map(str, read_silver(spark, lake.silver).collect())) == before
    assert len(list(Path(lake.silver).rglob("event_date=2026-06-01/*/*.parquet"))) == 1
    assert sorted(Path(lake.silver).rglob("event_date=2026-06-02/*/*.parquet")) == untouched
    assert jobs.compact(spark, lake) == []


def test_rejected_rows_and_models_of_many_files(spark, lake, monkeypatch):
    """Compacted, also by the next job after a compaction that was broken off; rows stay."""
    for name in "abc":
        file_events(lake, "2026-06-01", event(name), event(f"bad{name}", "soon"), name=f"{name}.json")
    daily(spark, lake, "2026-06-01")
    jobs.build_models(spark, lake)
    rows = read_rejected(spark, lake.rejected)
    before = sorted(map(str, rows.collect()))
    folder = next(Path(lake.rejected).glob("*/*"))
    line = next(folder.glob("*.json")).read_text().splitlines()
    for path in folder.glob("*.json"):
        path.unlink()
    for i, one in enumerate(line):
        (folder / f"part-{i}.json").write_text(one + "\n")

    def broken(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(quarantine, "replace_slices", broken)
    with pytest.raises(RuntimeError, match="lost"):
        jobs.compact_rejected(spark, lake)
    monkeypatch.undo()
    assert jobs.compact(spark, lake) == []
    assert len(list(folder.glob("*.json"))) == 1 and jobs.compact_rejected(spark, lake) == []
    assert sorted(map(str, read_rejected(spark, lake.rejected).collect())) == before
    staged = read_rows(spark, lake)
    (version,) = Path(lake.staging).glob("event_date=*/version=*")
    small = jobs.read_staging(spark, lake.staging).drop("event_date")
    small.repartition(3).write.mode("append").parquet(str(version))
    assert jobs.compact_models(spark, lake) == ["2026-06-01"]
    assert read_rows(spark, lake) == staged and jobs.compact_models(spark, lake) == []


def read_rows(spark, lake):
    return sorted(map(str, jobs.read_staging(spark, lake.staging).collect()))


# Versions of the models


def test_readers_see_one_build_or_the_other(spark, lake, monkeypatch):
    database = f"lake_{uuid.uuid4().hex}"
    spill(lake)
    daily(spark, lake, "2026-06-01")
    jobs.build_models(spark, lake)
    jobs.register_tables(spark, lake, database)
    before, seen = (read_rows(spark, lake), summary(spark, lake)), []
    opened = jobs.read_staging(spark, lake.staging)
    by_name = spark.table(f"{database}.stg_events")
    changed = daily(spark, lake, "2026-06-02").dates
    switch = versions.switch

    def looked(*args):
        seen.append((read_rows(spark, lake), summary(spark, lake), by_name.count()))
        switch(*args)

    monkeypatch.setattr(versions, "switch", looked)
    jobs.build_models(spark, lake, changed)
    monkeypatch.undo()
    after = read_rows(spark, lake), summary(spark, lake)
    assert after != before and len(after[0]) > len(before[0])
    # before the first switch both tables are old; before the second, staging alone is new
    assert seen == [(*before, len(before[0])), (after[0], before[1], len(before[0]))]
    # who began before the switch reads on, by path and by name
    assert sorted(map(str, opened.collect())) == before[0] and by_name.count() == len(before[0])
    jobs.register_tables(spark, lake, database, changed)
    assert spark.table(f"{database}.stg_events").count() == len(after[0])
    full = Lake(lake.bronze, lake.silver, lake.rejected, f"{lake.gold}_full")
    jobs.build_models(spark, full)
    assert after == (read_rows(spark, full), summary(spark, full))


def test_a_broken_build_changes_nothing_and_leaves_nothing(spark, lake, monkeypatch):
    spill(lake)
    daily(spark, lake, "2026-06-01")
    jobs.build_models(spark, lake)
    before = read_rows(spark, lake), summary(spark, lake)
    changed = daily(spark, lake, "2026-06-02").dates

    def broken(*_):
        raise RuntimeError("lost")

    for step in ("read_version", "switch"):
        monkeypatch.setattr(versions, step, broken)
        with pytest.raises(RuntimeError, match="lost"):
            jobs.build_models(spark, lake, changed)
        monkeypatch.undo()
        assert (read_rows(spark, lake), summary(spark, lake)) == before
    jobs.build_models(spark, lake, changed)
    for table in (lake.staging, lake.summary):
        numbers = versions.numbers(spark, table)
        listed = {x for n in numbers for x in versions.folders_of(spark, table, n).values()}
        assert len(numbers) == 2 and {f"{p.parent.name}/{p.name}" for p in Path(table).glob("*/version=*")} == listed
    # the folders of the build before last go with the next list, and no others
    for _ in range(3):
        jobs.build_models(spark, lake)
    days = len(versions.current(spark, lake.staging))
    assert len(list(Path(lake.staging).glob("*/version=*"))) == 2 * days


def test_erasure_keeps_no_earlier_version(spark, lake):
    file_events(lake, "2026-06-01", event("a", user_id="gone"), event("b", user_id="stays"))
    daily(spark, lake, "2026-06-01")
    jobs.build_models(spark, lake)
    # moved and built anew: the list before still has the user's row on the first day
    file_events(lake, "2026-06-01", event("a", user_id="stays"), event("b", user_id="stays"))
    jobs.build_models(spark, lake, daily(spark, lake, "2026-06-01").dates)
    assert len(list(Path(lake.staging).rglob("*.parquet"))) == 2
    assert jobs.erase_users(spark, lake, spark.createDataFrame([("gone",)], "user_id string")) == []
    assert len(list(Path(lake.staging).rglob("*.parquet"))) == 1
    assert len(versions.numbers(spark, lake.staging)) == 1
    assert [r.user_id for r in jobs.read_staging(spark, lake.staging).collect()] == ["stays"] * 2


def test_tables_without_lists_are_built_whole_once(spark, lake):
    spill(lake)
    changed = [daily(spark, lake, day).dates for day in ("2026-06-01", "2026-06-02")][1]
    full = Lake(lake.bronze, lake.silver, lake.rejected, f"{lake.gold}_full")
    jobs.build_models(spark, full)
    jobs.read_staging(spark, full.staging).write.partitionBy("event_date").parquet(lake.staging)
    jobs.read_summary(spark, full.summary).write.partitionBy("event_date").parquet(lake.summary)
    gone = Path(lake.staging) / "event_date=2020-01-01"
    gone.mkdir()
    (gone / "part-0.parquet").write_bytes(next(Path(lake.staging).rglob("*.parquet")).read_bytes())
    assert len(read_rows(spark, lake)) > len(read_rows(spark, full))
    jobs.build_models(spark, lake, changed[:1])
    assert read_rows(spark, lake) == read_rows(spark, full) and summary(spark, lake) == summary(spark, full)
    assert not gone.exists() and not list(Path(lake.staging).glob("event_date=*/*.parquet"))


def test_models_of_an_empty_silver_have_no_rows(spark, lake):
    jobs.build_models(spark, lake)
    assert read_rows(spark, lake) == summary(spark, lake) == []
