"""Mart, checks, monitoring and enrichment on small frames."""

import pytest

from conftest import RUN_TS, event, frame
from eventlake.operators import enrich, monitor, quality
from eventlake.operators.quality import ACCEPTED_VALUES, NOT_NULL, UNIQUE, Check, QualityError
from eventlake.operators.transform import to_silver
from eventlake.operators.validate import classify, good
from eventlake.plans.models import daily_event_summary, stg_events


def silver(spark, *events):
    return to_silver(good(classify(frame(spark, *events))), RUN_TS)


def test_null_groups_and_null_values(spark):
    rows = [
        event("a", country_code=None, device_type=None, session_id=None,
              duration_seconds=None, is_premium_user=None),
        event("b", country_code=None, device_type=None, session_id="s",
              duration_seconds=None, is_premium_user=None, user_id="user_2"),
        event("c", duration_seconds=10),
        event("d", duration_seconds=None, is_premium_user=False),
        event("e", duration_seconds=11),
    ]
    mart = daily_event_summary(stg_events(silver(spark, *rows)))
    by_country = {r.country_code: r for r in mart.collect()}
    unknown, dutch = by_country[None], by_country["NL"]
    assert (unknown.event_count, unknown.unique_users, unknown.unique_sessions) == (2, 2, 1)
    assert unknown.premium_user_events == 0
    assert unknown.avg_duration_seconds is None
    assert (dutch.event_count, dutch.unique_users, dutch.unique_documents) == (3, 1, 1)
    assert dutch.premium_user_events == 2
    assert dutch.avg_duration_seconds == 10.5


def test_staging_drops_unknown_columns(spark):
    staged = stg_events(silver(spark, event()).selectExpr("*", "1 as surprise"))
    assert len(staged.columns) == 15 and staged.columns[-1] == "event_date"


def table(spark, *rows):
    return spark.createDataFrame(rows, "id string, kind string")


def failures(spark, rows, *checks):
    report = quality.report({"t": table(spark, *rows)}, checks)
    return {(r.column, r.check): r.failures for r in report.collect()}


def test_checks_count_their_failures(spark):
    rows = [("a", "x"), ("a", "y"), ("a", "z"), ("b", "z"), ("b", None), (None, "x"), (None, "x")]
    found = failures(
        spark,
        rows,
        Check("t", "id", NOT_NULL),
        Check("t", "kind", NOT_NULL),
        Check("t", "id", UNIQUE),
        Check("t", "kind", ACCEPTED_VALUES, ("x", "y")),
    )
    assert found == {
        ("id", NOT_NULL): 2,
        ("kind", NOT_NULL): 1,
        ("id", UNIQUE): 2,
        ("kind", ACCEPTED_VALUES): 1,
    }


def test_checks_on_an_empty_table_pass(spark):
    checks = [Check("t", "id", NOT_NULL), Check("t", "id", UNIQUE),
              Check("t", "kind", ACCEPTED_VALUES, ("x",))]
    report = quality.report({"t": table(spark, ("a", "x")).limit(0)}, checks)
    assert [row.failures for row in quality.enforce(report)] == [0, 0, 0]


def test_enforce_names_what_failed(spark):
    report = quality.report({"t": table(spark, (None, "x"))}, (Check("t", "id", NOT_NULL),))
    with pytest.raises(QualityError, match="t.id not_null: 1") as raised:
        quality.enforce(report)
    assert len(raised.value.failed) == 1


def test_eleven_checks_are_declared():
    kinds = [c.kind for c in quality.SOURCE_CHECKS + quality.MODEL_CHECKS]
    assert (kinds.count(NOT_NULL), kinds.count(UNIQUE), kinds.count(ACCEPTED_VALUES)) == (8, 2, 1)


def test_counts_and_rate(spark):
    rows = classify(frame(spark, event("a"), event("b"), event(None)))
    assert monitor.run_counts(rows).first().asDict() == {
        "bronze_rows": 3, "good_rows": 2, "bad_rows": 1,
    }
    assert monitor.rejection_rate(rows).first()[0] == 33.33
    assert monitor.rejection_rate(rows.limit(0)).first()[0] is None


def test_anomalies_by_day_and_rule(spark):
    rows = classify(frame(
        spark,
        event("a"), event("b"), event(None), event("d", duration_seconds="x"),
        event("e", "2026-06-02T00:00:00Z"), event("f", "soon"), event("g", None),
    ))
    found = {
        (r.event_date and str(r.event_date), r.validation_error): (r.rows, r.rate)
        for r in monitor.anomalies(rows).collect()
    }
    assert found == {
        ("2026-06-01", "missing_event_id"): (1, 25.0),
        ("2026-06-01", "duration_not_integer"): (1, 25.0),
        (None, "bad_timestamp"): (2, 100.0),
    }


def lines(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "value string")


def test_drift(spark):
    found = monitor.schema_drift(
        lines(spark, '{"a": 1, "b": {"c": 2}}', '{"a": null}', '{"a": 1, "a": 2}', "{broken", "[]"),
        "value",
        ("a", "z"),
    )
    assert {r.field: (r.rows, r.status) for r in found.collect()} == {
        "a": (3, "ok"), "b": (1, "unexpected"), "z": (0, "missing"),
    }


def test_dynamic_fields(spark):
    found = monitor.dynamic_fields(
        lines(spark, '{"a": 1, "b": {"c": [2]}}', '{"b": "x"}', "{broken"), "value", ("a", "b")
    )
    assert found.columns == ["a", "b"]
    assert [tuple(r) for r in found.collect()] == [("1", '{"c":[2]}'), (None, "x"), (None, None)]


def test_enrich_keeps_events_without_a_dimension_row(spark):
    events = silver(spark, event("a"), event("b", user_id="user_2"), event("c", user_id="user_2"))
    users = spark.createDataFrame([("user_2", "pro")], "user_id string, plan string")
    joined = enrich.enrich(events, users, "user_id")
    assert {r.event_id: r.plan for r in joined.collect()} == {"a": None, "b": "pro", "c": "pro"}
    counted = enrich.activity_by(events, users, "user_id", "plan")
    assert {r.plan: (r.events, r.users) for r in counted.collect()} == {
        None: (1, 1), "pro": (2, 1),
    }


def test_fields_by_path_and_type(spark):
    rows = [
        ('{"a": {"b": [1, {"c": "x"}]}, "n": "12", "t": true}', 1),
        ('{"a": {"b": "none"}, "n": 1.5}', 2),
        ("{cut", 3), ("", 4), (None, 5), ("[1]", 6), ('{"a": null}', 7),
    ]
    lines = spark.createDataFrame(rows, "line string, _json int")
    fields = {"c": ("$.a.b[1].c", "string"), "n": ("$.n", "int"), "t": ("$.t", "boolean"), "b0": ("$.a.b[0]", "int")}
    found = monitor.dynamic_paths(lines, "line", fields)
    assert found.columns == ["_json", "c", "n", "t", "b0"]
    nothing = (None, None, None, None)
    assert sorted(tuple(r) for r in found.collect()) == [
        (1, "x", 12, True, 1), (2, None, 1, None, None), *((i, *nothing) for i in range(3, 8)),
    ]


def test_types_of_fields_by_day(spark):
    rows = [
        (1, '{"a": 1, "b": {"c": "x"}, "l": [1, 2]}'), (1, '{"a": 2, "l": []}'), (1, "{cut"), (1, None),
        (2, '{"a": "2", "b": {"c": null}}'), (2, '{"a": 3}'), (3, "{cut"), (4, '{"a": "x", "b": {}, "d": 1.5}'), (4, "7"),
    ]
    lines = spark.createDataFrame(rows, "day int, line string")
    types = monitor.field_types(lines, "line", "day")
    assert sorted(tuple(r) for r in types.where("day < 3").collect()) == [
        (1, "a", "bigint", 2), (1, "b.c", "string", 2), (1, "l[]", "bigint", 2),
        (2, "a", "variant", 2), (2, "b.c", "void", 2),
    ]
    changes = {tuple(r)[1:] for r in monitor.type_changes(types).where("day = 2").collect()}
    assert changes == {("a", "variant", "bigint", "changed"), ("b.c", "void", "string", "changed"), ("l[]", None, "bigint", "gone")}
    assert monitor.type_changes(types).where("day = 1 or day = 3").count() == 0
    assert monitor.field_types(lines.limit(0), "line", "day").count() == 0
