"""The event contract: fields, allowed values, table schemas and column orders."""

from pyspark.sql import types as T

# Field names and types every event carries, in contract order.
EVENT_FIELDS = {
    "event_id": T.StringType(),
    "event_timestamp": T.TimestampType(),
    "event_type": T.StringType(),
    "user_id": T.StringType(),
    "session_id": T.StringType(),
    "document_id": T.StringType(),
    "university_id": T.StringType(),
    "country_code": T.StringType(),
    "device_type": T.StringType(),
    "page_url": T.StringType(),
    "referrer": T.StringType(),
    "duration_seconds": T.IntegerType(),
    "is_premium_user": T.BooleanType(),
}

# The event types the lake accepts, exact and case-sensitive.
EVENT_TYPES = (
    "document_view",
    "document_download",
    "search",
    "signup",
    "login",
    "quiz_attempt",
)

EVENT_COLUMNS = tuple(EVENT_FIELDS)
CORRUPT = "_corrupt_record"
PARSED = "parsed_timestamp"
ERROR = "validation_error"

SILVER_PARTITIONS = ("event_date", "event_type")
SILVER_COLUMNS = (
    *(c for c in EVENT_COLUMNS if c != "event_type"),
    "ingestion_timestamp",
    *SILVER_PARTITIONS,
)
#: Event fields that silver does not hold as the text they came as.
TYPED_COLUMNS = tuple(c for c, t in EVENT_FIELDS.items() if t != T.StringType())
STAGING_COLUMNS = (*EVENT_COLUMNS, "ingestion_timestamp", "event_date")

_DERIVED = {"ingestion_timestamp": T.TimestampType(), "event_date": T.DateType()}


def _table(columns):
    types = {**EVENT_FIELDS, **_DERIVED}
    return T.StructType([T.StructField(c, types[c]) for c in columns])


def _text(columns):
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


# Bronze is read as text: values that do not fit their type must still reach
# the rules and the quarantine, so types come after validation.
BRONZE_SCHEMA = _text((*EVENT_COLUMNS, CORRUPT))
REJECTED_COLUMNS = (*EVENT_COLUMNS, CORRUPT, ERROR, "rejected_at", "run", "ingest_date")


def rejected_schema() -> T.StructType:
    """A new one each time: adding a field changes a StructType."""
    schema = _text((*EVENT_COLUMNS, CORRUPT, ERROR)).add("rejected_at", T.TimestampType())
    return schema.add("run", T.StringType()).add("ingest_date", T.DateType())


SILVER_SCHEMA = _table(SILVER_COLUMNS)
STAGING_SCHEMA = _table(STAGING_COLUMNS)
SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("country_code", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("device_type", T.StringType()),
        T.StructField("event_count", T.LongType()),
        T.StructField("unique_users", T.LongType()),
        T.StructField("unique_sessions", T.LongType()),
        T.StructField("unique_documents", T.LongType()),
        T.StructField("premium_user_events", T.LongType()),
        T.StructField("avg_duration_seconds", T.DoubleType()),
        T.StructField("event_date", T.DateType()),
    ]
)
