import contextlib
import io
import json
import sys
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from eventlake.contract import BRONZE_SCHEMA, EVENT_COLUMNS  # noqa: E402
from eventlake.plans.jobs import Lake  # noqa: E402
from eventlake.session import prepare  # noqa: E402

RUN_TS = datetime(2026, 6, 10, 2, 0, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("eventlake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .config("spark.checkpoint.dir", str(folder / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture
def lake(tmp_path):
    return Lake(*(str(tmp_path / layer) for layer in ("bronze", "silver", "rejected", "gold")))


def event(event_id="a", timestamp="2026-06-01T10:00:00+00:00", **fields):
    good = {
        "event_id": event_id,
        "event_timestamp": timestamp,
        "event_type": "search",
        "user_id": "user_1",
        "session_id": "sess_1",
        "document_id": "doc_1",
        "university_id": "uni_1",
        "country_code": "NL",
        "device_type": "mobile",
        "page_url": "/d/1",
        "referrer": None,
        "duration_seconds": 30,
        "is_premium_user": True,
    }
    return {**good, **fields}


def file_events(lake, day, *events, name="events.json"):
    """Write events as one NDJSON file into the bronze folder of a day."""
    year, month, number = day.split("-")
    folder = Path(lake.bronze) / f"year={year}" / f"month={month}" / f"day={number}"
    folder.mkdir(parents=True, exist_ok=True)
    lines = (e if isinstance(e, str) else json.dumps(e) for e in events)
    (folder / name).write_text("\n".join(lines) + "\n")
    return folder / name


def frame(spark, *events):
    """Events as a bronze frame of text, without going through a file."""

    def text(value):
        return value if value is None or isinstance(value, str) else json.dumps(value)

    rows = [tuple(text(e.get(c)) for c in (*EVENT_COLUMNS, "_corrupt_record")) for e in events]
    return spark.createDataFrame(rows, BRONZE_SCHEMA)


def plan(rows):
    """The physical plan as explain prints it."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        rows.explain("formatted")
    return text.getvalue()
