"""The staging table and the daily mart, silver -> staging -> summary."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.contract import STAGING_COLUMNS, SUMMARY_SCHEMA


def stg_events(silver: DataFrame) -> DataFrame:
    """The 15 staging columns in their order; anything else ends here."""
    return silver.withColumn("event_date", F.col("event_date").cast("date")).select(
        *STAGING_COLUMNS
    )


def daily_event_summary(staging: DataFrame) -> DataFrame:
    """Daily event metrics by country, event type and device.

    The exact distinct counts make Spark copy each row four times (Expand); the
    first shuffle is keyed by group and distinct value after a map-side combine,
    so neither a hot group nor a hot user ends up in one task.
    """
    return (
        staging.groupBy("country_code", "event_type", "device_type", "event_date")
        .agg(
            F.count("*").alias("event_count"),
            F.count_distinct("user_id").alias("unique_users"),
            F.count_distinct("session_id").alias("unique_sessions"),
            F.count_distinct("document_id").alias("unique_documents"),
            # A NULL flag counts 0, and so does a group of NULL flags.
            F.sum(F.when(F.col("is_premium_user"), 1).otherwise(0)).alias("premium_user_events"),
            F.avg("duration_seconds").alias("avg_duration_seconds"),
        )
        .select(*SUMMARY_SCHEMA.names)
    )
