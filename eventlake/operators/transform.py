"""Good events to silver rows, and the event-date range filter."""

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.contract import EVENT_COLUMNS, PARSED, SILVER_COLUMNS
from eventlake.functions.parsing import day, event_date, flag, stamp, whole_number


def silver_columns(run_ts: datetime) -> list[Column]:
    """The 15 silver columns over classified rows; unknown fields stay behind."""
    typed = {
        "event_timestamp": F.col(PARSED),
        "duration_seconds": whole_number("duration_seconds"),
        "is_premium_user": flag("is_premium_user"),
        "event_date": event_date(),
        "ingestion_timestamp": stamp(run_ts),
    }
    return [typed.get(c, F.col(c)).alias(c) for c in SILVER_COLUMNS]


def to_silver(good: DataFrame, run_ts: datetime) -> DataFrame:
    return good.select(*silver_columns(run_ts))


def event_date_range(silver: DataFrame, start: date, end: date) -> DataFrame:
    """Rows dated start to end, both included."""
    return silver.where(F.col("event_date").between(day(start), day(end)))


def raw_events(classified: DataFrame) -> DataFrame:
    return classified.select(*EVENT_COLUMNS)
