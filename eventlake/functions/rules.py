"""Validation rules in order; an event is named after the first one it fails."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventlake.contract import EVENT_TYPES, PARSED
from eventlake.functions.parsing import whole_number


def failing_conditions() -> dict[str, Column]:
    duration = F.col("duration_seconds")
    return {
        "missing_event_id": F.isnull("event_id"),
        "missing_user_id": F.isnull("user_id"),
        "missing_event_type": F.isnull("event_type"),
        "invalid_event_type": ~F.col("event_type").isin(*EVENT_TYPES),
        # A missing timestamp counts as a bad one.
        "bad_timestamp": F.isnull(PARSED),
        "duration_not_integer": duration.isNotNull() & whole_number("duration_seconds").isNull(),
    }


def first_failure() -> Column:
    """Name of the first failing rule, NULL for a good event."""
    return F.coalesce(*(F.when(fails, name) for name, fails in failing_conditions().items()))
