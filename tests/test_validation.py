"""Rules, parsing and silver rows on hand-made values."""

from datetime import date, datetime, timezone

import pytest

from conftest import RUN_TS, event, frame
from eventlake.contract import EVENT_COLUMNS, SILVER_COLUMNS, SILVER_SCHEMA, STAGING_COLUMNS
from eventlake.operators.transform import event_date_range, to_silver
from eventlake.operators.validate import bad, classify, good

TIMESTAMPS = {
    "2026-06-01T10:00:00+02:00": datetime(2026, 6, 1, 8, 0),
    "2026-06-01T10:00:00Z": datetime(2026, 6, 1, 10, 0),
    "2026-06-01T10:00:00.123456+00:00": datetime(2026, 6, 1, 10, 0, 0, 123456),
    "2026": datetime(2026, 1, 1),
    "2026-06": datetime(2026, 6, 1),
    "2026-06-01T00:30:00+02:00": datetime(2026, 5, 31, 22, 30),
    "2026-02-30T00:00:00+00:00": None,
    "2026-06-01T24:00:00": None,
    "20260601": None,
    "": None,
    "this is not a timestamp": None,
    None: None,
}
DURATIONS = {
    "300": 300,
    " 12 ": 12,
    "+5": 5,
    "-3": -3,
    "2147483647": 2147483647,
    "12.5": None,
    "12.": None,
    "1.0": 1,
    " -7.000 ": -7,
    ".0": None,
    "2147483648.0": None,
    "1e3": None,
    "2147483648": None,
    "": None,
    "not_a_number": None,
}


def test_timestamps(spark):
    rows = [event(str(i), text) for i, text in enumerate(TIMESTAMPS)]
    classified = classify(frame(spark, *rows))
    silver = {r.event_id: r for r in to_silver(good(classified), RUN_TS).collect()}
    errors = {r.event_id: r.validation_error for r in bad(classified).collect()}
    for i, (text, expected) in enumerate(TIMESTAMPS.items()):
        if expected is None:
            assert errors[str(i)] == "bad_timestamp", text
        else:
            assert silver[str(i)].event_timestamp == to_local(expected), text
            assert silver[str(i)].event_date == expected.date(), text


def to_local(utc: datetime) -> datetime:
    """collect() gives timestamps in the time zone of the machine."""
    return utc.replace(tzinfo=timezone.utc).astimezone().replace(tzinfo=None)


def test_durations(spark):
    rows = [event(str(i), duration_seconds=text) for i, text in enumerate(DURATIONS)]
    rows.append(event("null", duration_seconds=None))
    classified = classify(frame(spark, *rows))
    silver = {r.event_id: r.duration_seconds for r in to_silver(good(classified), RUN_TS).collect()}
    errors = {r.event_id: r.validation_error for r in bad(classified).collect()}
    assert silver.pop("null") is None
    for i, (text, expected) in enumerate(DURATIONS.items()):
        if expected is None:
            assert errors[str(i)] == "duration_not_integer", text
        else:
            assert silver[str(i)] == expected, text


FAULTS = {
    "missing_event_id": {"event_id": None},
    "missing_user_id": {"user_id": None},
    "missing_event_type": {"event_type": None},
    "invalid_event_type": {"event_type": "Search"},
    "bad_timestamp": {"event_timestamp": "soon"},
    "duration_not_integer": {"duration_seconds": "long"},
}


@pytest.mark.parametrize("first", range(6))
def test_the_first_failing_rule_names_the_row(spark, first):
    names = list(FAULTS)
    rows = []
    for later in range(first, 6):
        faults = {**FAULTS[names[later]], **FAULTS[names[first]]}
        rows.append({**event(), **faults})
    errors = [r.validation_error for r in classify(frame(spark, *rows)).collect()]
    assert errors == [names[first]] * len(rows)


def test_missing_key_and_json_null_are_the_same(spark):
    without = event()
    del without["user_id"]
    errors = classify(frame(spark, without, event(user_id=None))).select("validation_error")
    assert [r[0] for r in errors.collect()] == ["missing_user_id"] * 2


def test_unparseable_flag_becomes_null_without_a_rule(spark):
    rows = classify(frame(spark, event(is_premium_user="perhaps"), event(is_premium_user="yes")))
    assert [r.is_premium_user for r in to_silver(good(rows), RUN_TS).collect()] == [None, True]


def test_good_and_bad_split_everything(spark):
    rows = classify(frame(spark, event(), event(None), event("b", duration_seconds="x")))
    assert good(rows).count() + bad(rows).count() == rows.count() == 3
    assert "validation_error" not in good(rows).columns


def test_silver_has_exactly_its_columns(spark):
    rows = frame(spark, event()).selectExpr("*", "2026 as year", "'x' as surprise")
    silver = to_silver(good(classify(rows)), RUN_TS)
    assert tuple(silver.columns) == SILVER_COLUMNS
    assert [f.dataType for f in silver.schema] == [f.dataType for f in SILVER_SCHEMA]
    assert silver.first().ingestion_timestamp == to_local(RUN_TS.replace(tzinfo=None))


def test_column_lists():
    assert len(EVENT_COLUMNS) == 13
    assert len(SILVER_COLUMNS) == len(STAGING_COLUMNS) == 15
    assert SILVER_COLUMNS[-2:] == ("event_date", "event_type")
    assert STAGING_COLUMNS[-1] == "event_date"


def test_range_keeps_both_ends_and_drops_null_dates(spark):
    stamps = ["2026-05-31T23:59:59Z", "2026-06-01T00:00:00Z", "2026-06-02T23:59:59Z",
              "2026-06-03T00:00:00Z", "never"]
    rows = classify(frame(spark, *(event(s, s) for s in stamps)))
    silver = to_silver(rows, RUN_TS)
    kept = event_date_range(silver, date(2026, 6, 1), date(2026, 6, 2))
    assert sorted(r.event_id for r in kept.collect()) == stamps[1:3]
