"""Text to typed values. Text that does not fit gives NULL, also in ANSI mode."""

from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventlake.contract import PARSED


def instant(text: str) -> Column:
    """ISO-8601 text, with or without an offset, as a timestamp."""
    return F.try_to_timestamp(F.col(text))


def whole_number(text: str) -> Column:
    """Integers, also written as integral decimals: exporters write 45.0 for a nullable 45."""
    integral = F.regexp_replace(F.col(text), r"^\s*([+-]?[0-9]+)\.0+\s*$", "$1")
    # Most texts have no point, and need no pattern.
    return F.when(F.contains(F.col(text), F.lit(".")), integral).otherwise(F.col(text)).try_cast("int")


def flag(text: str) -> Column:
    return F.col(text).try_cast("boolean")


def event_date() -> Column:
    """Date of the parsed timestamp; the text's own date would ignore its offset."""
    return F.to_date(F.col(PARSED))


def day(value: date) -> Column:
    return F.lit(value.isoformat()).cast("date")


def stamp(run_ts: datetime) -> Column:
    """One literal per run; naive values are taken as UTC."""
    if run_ts.tzinfo is None:
        run_ts = run_ts.replace(tzinfo=timezone.utc)
    return F.lit(run_ts)
