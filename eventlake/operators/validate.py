"""Classify bronze events and split them into good and rejected rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.contract import ERROR, PARSED
from eventlake.functions.parsing import instant
from eventlake.functions.rules import first_failure


def classify(bronze: DataFrame) -> DataFrame:
    """Add the parsed timestamp and the name of the first rule each row fails.

    The timestamp is parsed once, below the rules, and reused by everything after.
    """
    return bronze.withColumn(PARSED, instant("event_timestamp")).withColumn(
        ERROR, first_failure()
    )


def good(classified: DataFrame) -> DataFrame:
    return classified.where(F.isnull(ERROR)).drop(ERROR)


def bad(classified: DataFrame) -> DataFrame:
    return classified.where(F.isnotnull(ERROR))
