"""Rows of given users, and all rows but theirs; ``users`` has each user_id once."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def events_of(rows: DataFrame, users: DataFrame, column: str = "user_id") -> DataFrame:
    return rows.join(users.select(F.col("user_id").alias("_erased")), F.col(column) == F.col("_erased"), "left_semi")


def without_users(rows: DataFrame, users: DataFrame, column: str = "user_id") -> DataFrame:
    return rows.join(users.select(F.col("user_id").alias("_erased")), F.col(column) == F.col("_erased"), "left_anti")
