"""Declared data-quality checks: each counts its failures, none means it passes."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.contract import EVENT_TYPES

NOT_NULL, UNIQUE, ACCEPTED_VALUES = "not_null", "unique", "accepted_values"


@dataclass(frozen=True)
class Check:
    table: str
    column: str
    kind: str
    values: tuple[str, ...] = ()


# The checks declared for the lake's tables.
SOURCE_CHECKS = (
    Check("silver", "event_id", NOT_NULL),
    Check("silver", "event_id", UNIQUE),
    Check("silver", "user_id", NOT_NULL),
    Check("silver", "event_type", NOT_NULL),
    Check("silver", "event_type", ACCEPTED_VALUES, EVENT_TYPES),
    Check("silver", "event_timestamp", NOT_NULL),
)
MODEL_CHECKS = (
    Check("stg_events", "event_id", NOT_NULL),
    Check("stg_events", "event_id", UNIQUE),
    Check("daily_event_summary", "event_date", NOT_NULL),
    Check("daily_event_summary", "event_count", NOT_NULL),
    Check("daily_event_summary", "unique_users", NOT_NULL),
)


class QualityError(RuntimeError):
    """Some check found failures; ``failed`` holds their report rows."""

    def __init__(self, failed):
        super().__init__("; ".join(f"{r.table}.{r.column} {r.check}: {r.failures}" for r in failed))
        self.failed = failed


def report(tables: dict[str, DataFrame], checks: tuple[Check, ...]) -> DataFrame:
    """One row ``table, column, check, failures`` per check.

    All not_null and accepted_values checks of a table share one scan; unique groups its column.
    """
    return _report(tables, checks, lambda table, check: _unique(table, check))


def report_dates(
    tables: dict[str, DataFrame],
    checks: tuple[Check, ...],
    dates: list[str],
    among: list[str] | None = None,
) -> DataFrame:
    """The report on some event dates, exact as long as the rest was checked before.

    Values that must be unique are grouped within these dates and looked up in the others: the
    few ids of the dates filter that column of the rest, which is not grouped. ``among`` names
    the other dates that may hold them, if that is known; no other is read then.
    """
    day = F.col("event_date").cast("string")
    inside = day.isin(*dates)
    touched = {name: table.where(inside) for name, table in tables.items()}

    def unique(table: DataFrame, check: Check) -> DataFrame:
        elsewhere = ~inside if among is None else day.isin(*among) & ~inside
        others = tables[check.table].where(elsewhere)
        return _unique_against(table, others, check)

    return _report(touched, checks, unique)


def _report(tables: dict[str, DataFrame], checks: tuple[Check, ...], unique) -> DataFrame:
    parts = []
    for name in dict.fromkeys(check.table for check in checks):
        mine = [check for check in checks if check.table == name]
        by_row = [check for check in mine if check.kind != UNIQUE]
        if by_row:
            parts.append(_one_scan(tables[name], by_row))
        parts += [unique(tables[name], check) for check in mine if check.kind == UNIQUE]
    return reduce(DataFrame.unionByName, parts)


def _one_scan(table: DataFrame, checks: list[Check]) -> DataFrame:
    """Failures are rows for not_null, and distinct values for accepted_values."""
    counts = []
    for check in checks:
        column = F.col(check.column)
        if check.kind == NOT_NULL:
            counts.append(F.count_if(F.isnull(column)))
        else:
            # accepted values are NULL here, so only the others are grouped and shuffled
            counts.append(F.count_distinct(F.when(~column.isin(*check.values), column)))
    rows = F.array(*(_row(check, count) for check, count in zip(checks, counts)))
    return table.agg(rows.alias("rows")).select(F.inline("rows"))


def _unique(table: DataFrame, check: Check) -> DataFrame:
    """Failures are values, not rows; NULL is left to not_null."""
    counted = table.where(F.isnotnull(check.column)).groupBy(check.column).count()
    return counted.where("count > 1").agg(_row(check, F.count("*")).alias("row")).select("row.*")


def _unique_against(table: DataFrame, others: DataFrame, check: Check) -> DataFrame:
    counted = table.where(F.isnotnull(check.column)).groupBy(check.column).agg(F.count("*").alias("n"))
    ids = counted.select(F.col(check.column).alias("_id"))
    seen = others.select(check.column).join(ids, F.col(check.column) == F.col("_id"), "left_semi")
    seen = seen.groupBy(check.column).agg(F.count("*").alias("n"))
    total = counted.unionByName(seen).groupBy(check.column).agg(F.sum("n").alias("n"))
    return total.where("n > 1").agg(_row(check, F.count("*")).alias("row")).select("row.*")


def _row(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.table).alias("table"),
        F.lit(check.column).alias("column"),
        F.lit(check.kind).alias("check"),
        failures.alias("failures"),
    )


def enforce(outcome: DataFrame) -> list:
    """The report's rows; raises when a check has failures."""
    rows = outcome.collect()
    failed = [row for row in rows if row.failures > 0]
    if failed:
        raise QualityError(failed)
    return rows
