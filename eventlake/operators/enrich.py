"""Events with attributes from core tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(events: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Every event with its dimension row; events without one keep NULLs.

    The dimension has each key once. No broadcast hint: Spark broadcasts a dimension
    it knows to be small, and AQE splits a hot key of a sort-merge join otherwise, if
    the dimension is read from a table rather than aggregated on the way.
    """
    return events.join(dimension, key, "left")


def activity_by(events: DataFrame, dimension: DataFrame, key: str, *groups: str) -> DataFrame:
    """Events and distinct keys per dimension attributes.

    Events are counted per key first, so the join moves one row per key and a
    hot key costs no more than any other.
    """
    per_key = events.groupBy(key).agg(F.count("*").alias("events"))
    return (
        enrich(per_key, dimension, key)
        .groupBy(*groups)
        .agg(F.sum("events").alias("events"), F.count(key).alias("users"))
    )
