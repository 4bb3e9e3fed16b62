"""Every query against its DuckDB SQL on the given tables."""

from datetime import datetime
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from checks import fixture
from checks.oracles import ORACLES
from checks.queries import QUERIES
from conftest import plan

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: [(value is None, str(value)) for value in row])


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    found = entry_points.queries()[name](spark, SF_DIR)
    columns = sorted(found.columns)
    expected = duck.sql(entry_points.oracle_sql()[name])
    assert sorted(expected.columns) == columns
    quoted = ", ".join(f'"{c}"' for c in columns)
    rows = ordered(tuple(row) for row in found.select(*columns).collect())
    assert rows == ordered(expected.select(quoted).fetchall())
    assert rows
    shape = plan(found)
    assert "EvalPython" not in shape and "InPandas" not in shape
    assert "CartesianProduct" not in shape and "BroadcastNestedLoopJoin" not in shape


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry_points.queries().keys()
    assert ORACLES.keys() <= entry_points.oracle_sql().keys()


def test_queries_that_load_nothing_write_no_bronze(spark, tmp_path, monkeypatch):
    """The dated checks through the id index need silver only, not the NDJSON tree of the events."""
    rows = [(n, datetime(2024, 1, 1 + n % 8, 12), n % 3, "view", 1.0, '{"k": 1}') for n in range(40)]
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/events.parquet")

    def fail(*args, **named):
        raise AssertionError("bronze is written")

    monkeypatch.setattr(fixture, "write_bronze", fail)
    found = QUERIES["dq_report_incremental_whole"](spark, str(tmp_path)).collect()
    assert {(r.lake, r.table): r.f for r in found if r.day == "2024-01-05"} == {
        (name, table): int(name != "none")
        for name in ("none", "inside", "near", "far")
        for table in ("silver", "stg_events")
    }
