"""Reading NDJSON: broken lines, folders, and the files a read touches."""

import gzip
import json
from datetime import date
from pathlib import Path

from conftest import event, file_events
from eventlake.contract import EVENT_COLUMNS
from eventlake.operators.validate import bad, classify
from eventlake.sources import bronze


def test_lines_that_are_no_plain_event(spark, lake):
    file_events(
        lake,
        "2026-06-01",
        event(),
        '{"event_id": "cut off',
        "{}",
        "[]",
        "null",
        '"str"',
        "",
        {**event("b"), "surprise": {"x": 1}},
        event(5),
        event("c", is_premium_user="yes", duration_seconds="not_a_number"),
    )
    rows = bronze.scan(spark, lake.bronze)
    found = rows.collect()
    assert "surprise" not in rows.columns
    by_id = {r.event_id: r for r in found if r.event_id}
    assert set(by_id) == {"a", "b", "5", "c"}
    assert by_id["c"].duration_seconds == "not_a_number"
    assert by_id["a"].duration_seconds == "30"
    assert by_id["a"].is_premium_user == "true"
    assert (by_id["a"].year, by_id["a"].month, by_id["a"].day) == (2026, 6, 1)
    # [] and the empty line give no row.
    assert len(found) == 8
    rejected = bad(classify(rows)).select("validation_error", "_corrupt_record").collect()
    texts = {r._corrupt_record for r in rejected if r.validation_error == "missing_event_id"}
    assert '{"event_id": "cut off' in texts


def test_a_field_no_row_has_is_still_a_column(spark, lake):
    file_events(lake, "2026-06-01", {"event_id": "a"})
    row = bronze.scan(spark, lake.bronze).first()
    assert row.duration_seconds is None
    assert classify(bronze.scan(spark, lake.bronze)).first().validation_error == "missing_user_id"


def test_a_day_reads_only_its_folder(spark, lake):
    for day in ("2026-06-01", "2026-06-02", "2026-06-03"):
        file_events(lake, day, event(day))
    rows = bronze.scan_days(spark, lake.bronze, date(2026, 6, 2), date(2026, 6, 2))
    assert [Path(p).parent.name for p in rows.inputFiles()] == ["day=02"]
    assert [r.event_id for r in rows.collect()] == ["2026-06-02"]
    assert str(rows.first().folder_date) == "2026-06-02"


def test_a_range_of_days_crosses_months(spark, lake):
    for day in ("2026-05-30", "2026-05-31", "2026-06-01", "2026-06-02"):
        file_events(lake, day, event(day))
    rows = bronze.scan_days(spark, lake.bronze, date(2026, 5, 31), date(2026, 6, 1))
    assert sorted(r.event_id for r in rows.collect()) == ["2026-05-31", "2026-06-01"]


def test_a_missing_day_is_empty(spark, lake):
    file_events(lake, "2026-06-01", event())
    rows = bronze.scan_days(spark, lake.bronze, date(2030, 1, 1), date(2030, 1, 1))
    assert rows.count() == 0
    assert {*EVENT_COLUMNS, "folder_date"} <= set(rows.columns)


def test_an_empty_folder_is_no_error(spark, lake):
    Path(lake.bronze).mkdir()
    assert bronze.scan(spark, lake.bronze).count() == 0


def test_any_folder_naming(spark, tmp_path):
    for folder in ("2026/06/01", "late export", "x/y/z"):
        (tmp_path / "tree" / folder).mkdir(parents=True)
        (tmp_path / "tree" / folder / "f.json").write_text(f'{{"event_id": "{folder}"}}\n')
    rows = bronze.scan_recursive(spark, str(tmp_path / "tree"))
    assert sorted(r.event_id for r in rows.collect()) == ["2026/06/01", "late export", "x/y/z"]
    assert {r.folder_date for r in rows.collect()} == {None}


def test_parts_are_the_months_of_folders(spark, lake):
    for day in ("2026-05-30", "2026-05-31", "2026-06-01"):
        file_events(lake, day, event(day))
    (Path(lake.bronze) / "_SUCCESS").touch()
    parts = list(bronze.scan_in_parts(spark, lake.bronze))
    assert [part.count() for part in parts] == [2, 1]
    assert {str(r.folder_date) for r in parts[0].collect()} == {"2026-05-30", "2026-05-31"}


def test_files_outside_of_day_folders_are_read_too(spark, lake):
    file = file_events(lake, "2026-05-30", event("a"))
    for place in (file.parents[3], file.parents[2], file.parents[1], file.parent / "late"):
        place.mkdir(exist_ok=True)
        (place / "stray.json").write_text('{"event_id": "stray"}\n')
    days, strays = bronze.folders(spark, lake.bronze)
    assert [str(day) for _, day in days] == ["2026-05-30"]
    assert len(strays) == 3
    rows = [r for part in bronze.scan_in_parts(spark, lake.bronze) for r in part.collect()]
    # A folder within a day's folder belongs to the day.
    assert sorted((r.event_id, str(r.folder_date)) for r in rows) == [
        ("a", "2026-05-30"), ("stray", "2026-05-30"), *3 * [("stray", "None")],
    ]


def test_folder_names_that_are_no_date(spark, lake):
    file_events(lake, "2026-06-30", event("a"))
    for name in ("day=31", "day=__HIVE_DEFAULT_PARTITION__", "day=x"):
        folder = Path(lake.bronze) / "year=2026" / "month=06" / name
        folder.mkdir()
        (folder / "f.json").write_text('{"event_id": "odd"}\n')
    day = bronze.scan_days(spark, lake.bronze, date(2026, 1, 1), date(2026, 12, 31))
    assert [r.event_id for r in day.collect()] == ["a"]
    days, strays = bronze.folders(spark, lake.bronze)
    assert len(days) == 1 and len(strays) == 3
    rows = [r for part in bronze.scan_in_parts(spark, lake.bronze) for r in part.collect()]
    assert sorted((r.event_id, str(r.folder_date)) for r in rows) == [
        ("a", "2026-06-30"), *3 * [("odd", "None")],
    ]


def test_compressed_files(spark, lake):
    plain = file_events(lake, "2026-06-01", event("a"))
    packed = gzip.compress(json.dumps(event("b")).encode())
    (plain.parent / "more.json.gz").write_bytes(packed)
    rows = bronze.scan(spark, lake.bronze)
    assert sorted(r.event_id for r in rows.collect()) == ["a", "b"]
