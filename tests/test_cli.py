"""The command line."""

from datetime import date

import pytest

from conftest import event, file_events
import eventlake.__main__ as command
from eventlake.__main__ import arguments, main
from eventlake.plans import jobs
from eventlake.sources.silver import read_silver


def paths(lake):
    return ["--source_path", lake.bronze, "--silver_path", lake.silver,
            "--rejected_path", lake.rejected]


@pytest.fixture
def any_catalog(monkeypatch):
    """The tests share one session, whose in-memory catalog lasts as long as they do."""
    monkeypatch.setattr(command, "lasting", lambda *_: None)


def test_a_catalog_in_memory_is_refused(spark, lake):
    file_events(lake, "2026-06-01", event("a"))
    day = ["--date", "2026-06-01", "--gold_path", lake.gold, "--database", "x"]
    with pytest.raises(SystemExit, match="in-memory"):
        main(["day", *paths(lake), *day])
    tables = ["--silver_path", lake.silver, "--rejected_path", lake.rejected, "--database", "x"]
    with pytest.raises(SystemExit, match="in-memory"):
        main(["catalog", *tables])


def test_daily_backfill_and_models(spark, lake, capsys):
    file_events(lake, "2026-06-01", event("a"), event(None))
    file_events(lake, "2026-06-02", event("b", "2026-06-02T00:00:00Z"))
    main(["daily", *paths(lake), "--date", "2026-06-01"])
    assert "bronze 2, good 1, bad 1, rejection rate 50.0 %" in capsys.readouterr().out
    main(["backfill", *paths(lake), "--start_date", "2026-06-01", "--end_date", "2026-06-30"])
    assert read_silver(spark, lake.silver).count() == 2
    tables = ["--silver_path", lake.silver, "--gold_path", lake.gold]
    main(["models", *tables])
    assert jobs.read_summary(spark, lake.summary).count() == 2
    capsys.readouterr()
    main(["checks", *tables])
    printed = capsys.readouterr().out.splitlines()
    assert len(printed) == 11 and all(line.endswith(": 0") for line in printed)


def test_day_and_erase(spark, lake, tmp_path, capsys, any_catalog):
    file_events(lake, "2026-06-01", event("a"), event("b", user_id="gone"), event("c", user_id=None))
    day = ["--date", "2026-06-01", "--gold_path", lake.gold, "--database", "cli_day"]
    main(["day", *paths(lake), *day])
    assert spark.table("cli_day.daily_event_summary").first().event_count == 2
    spark.createDataFrame([("gone",)], "user_id string").write.parquet(str(tmp_path / "users"))
    capsys.readouterr()
    tables = ["--silver_path", lake.silver, "--rejected_path", lake.rejected]
    main(["erase", *tables, "--gold_path", lake.gold, "--users_path", str(tmp_path / "users")])
    assert capsys.readouterr().out == "changed dates: 2026-06-01\n"
    assert jobs.read_summary(spark, lake.summary).first().event_count == 1
    main(["anomalies", *tables])
    assert capsys.readouterr().out == "2026-06-01 missing_user_id: 1 rows, 50.0 %\n"
    main(["catalog", *tables, "--gold_path", lake.gold, "--database", "cli_catalog"])
    assert spark.table("cli_catalog.rejected").count() == 1
    main(["compact", "--silver_path", lake.silver])
    assert "compacted dates: none" in capsys.readouterr().out
    dates = ["--start_date", "2026-06-01", "--end_date", "2026-06-01"]
    main(["drift", "--source_path", lake.bronze, *dates])
    assert "referrer ok: 3" in capsys.readouterr().out
    assert [r.event_id for r in read_silver(spark, lake.silver).collect()] == ["a"]


def test_failed_checks_end_with_an_error(spark, lake, any_catalog):
    file_events(lake, "2026-06-01", event("a"), event("a"))
    day = ["--date", "2026-06-01", "--gold_path", lake.gold, "--database", "cli_bad"]
    with pytest.raises(SystemExit, match="silver.event_id unique: 1"):
        main(["day", *paths(lake), *day])


def test_arguments():
    args = arguments(["daily", "--source_path", "b", "--silver_path", "s", "--rejected_path", "r",
                      "--date", "2026-06-01"])
    assert args.date == date(2026, 6, 1)
    with pytest.raises(SystemExit):
        arguments(["backfill", "--source_path", "b"])
