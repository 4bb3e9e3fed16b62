"""Rejected rows as JSON, in slices by the folder a row came from and the date it is filed under.

A load reads its slices whole: a day all slices of its folder, a backfill all slices of its
dates. It replaces those, whatever run wrote them, so a row is in quarantine once, however days
and batches were cut. ``run`` and ``ingest_date`` are columns.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.contract import REJECTED_COLUMNS
from eventlake.sources.folders import matching, partition_values, remove
from eventlake.sources.silver import REJECTED_OPTIONS, SLICES

NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def slices(spark: SparkSession, root: str) -> list[tuple[str, str, str]]:
    """Path, folder date and filed date of the slices there are; no date is NO_DATE."""
    found = matching(spark, f"{root}/{SLICES[0]}=*/{SLICES[1]}=*")
    return [(path, *(partition_values(path)[c] for c in SLICES)) for path in found]


def in_scope(scope: dict, folder_date: str, filed: str) -> bool:
    """Whether a load of this scope reads a slice whole."""
    if folder_date not in (scope.get("days") or [folder_date]):
        return False
    first, last = scope["folders"] or ("", "~")
    if folder_date == NO_DATE:
        inside = scope["folders"] is None
    else:
        inside = first <= folder_date <= last
    if scope["dates"] is None or not inside:
        return inside
    return filed == NO_DATE or scope["dates"][0] <= filed <= scope["dates"][1]


def replace_slices(spark: SparkSession, root: str, rows: DataFrame | None, paths: list[str]) -> None:
    """Write rows into their slices and remove those of ``paths`` that get none.

    Repeating it gives the same, so a job that was broken off can be run again."""
    filled = set()
    if rows is not None:
        named = (F.coalesce(F.col(c).cast("string"), F.lit(NO_DATE)) for c in SLICES)
        filled = {tuple(key) for key in rows.select(*named).distinct().collect()}
        (
            rows.select(*REJECTED_COLUMNS, *SLICES)
            .hint("rebalance", *SLICES)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .options(**REJECTED_OPTIONS)
            .partitionBy(*SLICES)
            .json(root)
        )
    for path in paths:
        values = partition_values(path)
        if tuple(values[c] for c in SLICES) not in filled:
            remove(spark, path)
