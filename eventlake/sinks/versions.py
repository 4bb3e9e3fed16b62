"""Model tables by event_date whose readers see the rows of one build, old or new.

A build writes every date it changes into a folder of its own beside those that are being read.
Then, in one step, a new list says which folders make up the table::

    event_date=<date>/version=<build>/     rows of a date as a build left them
    _lists/<number>                        a line per date: its folder; the highest number counts

A list is written aside and moved in under a new name, so it is there as a whole or not at all.
Folders on the last two lists stay, for readers that began before the last build; older ones and
those that a build left behind when it was broken off go with the next list.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventlake.session import empty
from eventlake.sources.folders import matching, partition_values, read_text, remove, write_text

LISTS, VERSION = "_lists", "version"


def new_version() -> str:
    return f"v{uuid.uuid4().hex}"


def write_version(rows: DataFrame, path: str, version: str) -> None:
    """Write rows beside those the table has; nobody reads them before the list is switched."""
    (
        rows.withColumn(VERSION, F.lit(version))
        .write.mode("append")
        .option("compression", "snappy")
        .partitionBy("event_date", VERSION)
        .parquet(path)
    )


def numbers(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the table's lists, oldest first."""
    found = (x.rsplit("/", 1)[1] for x in matching(spark, f"{path}/{LISTS}/*"))
    return sorted(int(x) for x in found if x.isdigit())


def folders_of(spark: SparkSession, path: str, number: int) -> dict[str, str]:
    """The folder of each event date on a list."""
    lines = read_text(spark, _list(path, number)).splitlines()
    return {partition_values(line)["event_date"]: line for line in lines if line}


def current(spark: SparkSession, path: str) -> dict[str, str] | None:
    """The folder of each event date; None if the table has no list yet."""
    found = numbers(spark, path)
    return folders_of(spark, path, found[-1]) if found else None


def unversioned(spark: SparkSession, path: str) -> bool:
    """Whether a table was written without lists, its files in the folders of dates themselves."""
    return not numbers(spark, path) and bool(matching(spark, f"{path}/event_date=*/*.parquet"))


def read_current(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of the last list; of the whole path where it was written without lists."""
    listed = current(spark, path)
    if listed is None:
        return spark.read.schema(schema).parquet(path)
    return read_folders(spark, path, schema, sorted(listed.values()))


def read_version(
    spark: SparkSession, path: str, schema: StructType, version: str, dates: list[str]
) -> DataFrame:
    """Rows of some dates as a build wrote them, listed or not."""
    return read_folders(spark, path, schema, _versions(spark, path, dates, version))


def read_folders(spark: SparkSession, path: str, schema: StructType, folders: list[str]) -> DataFrame:
    if not folders:
        return empty(spark, schema)
    reader = spark.read.schema(schema).option("basePath", path)
    return reader.parquet(*(f"{path}/{x}" for x in folders)).select(*schema.names)


def switch(
    spark: SparkSession, path: str, version: str, dates: list[str] | None, keep_previous: bool = True
) -> None:
    """From now on read these dates (None: all) as the version has them: those it did not write
    are gone, the others stay as listed. Then remove what no reader needs; with
    ``keep_previous=False`` that is all but the new list's folders, on every date."""
    lists = numbers(spark, path)
    before = folders_of(spark, path, lists[-1]) if lists else {}
    stale = {x for number in lists[:-1] for x in folders_of(spark, path, number).values()}
    written = _versions(spark, path, dates, version)
    after = {} if dates is None else {d: x for d, x in before.items() if d not in dates}
    after |= {partition_values(x)["event_date"]: x for x in written}
    number = lists[-1] + 1 if lists else 1
    write_text(spark, _list(path, number), "\n".join(sorted(after.values())))
    kept = set(after.values()) | (set(before.values()) if keep_previous else set())
    stale |= set(before.values()) | set(_versions(spark, path, dates if keep_previous else None))
    for folder in sorted(stale - kept):
        remove(spark, f"{path}/{folder}")
    used = {x.split("/", 1)[0] for x in kept}
    for day in sorted({x.split("/", 1)[0] for x in stale} - used):
        remove(spark, f"{path}/{day}")
    if not lists:
        _remove_unversioned(spark, path, used)
    for old in lists[: -1 if keep_previous else None]:
        remove(spark, _list(path, old))


def _remove_unversioned(spark: SparkSession, path: str, used: set[str]) -> None:
    """Files that lie in the folders of dates themselves, from before there were lists."""
    for folder in matching(spark, f"{path}/event_date=*"):
        if folder.rsplit("/", 1)[1] not in used:
            remove(spark, folder)
    for file in matching(spark, f"{path}/event_date=*/*.parquet"):
        remove(spark, file)


def _versions(spark: SparkSession, path: str, dates: list[str] | None, version: str = "*") -> list[str]:
    if dates == []:
        return []
    wanted = "*" if dates is None else f"{{{','.join(dates)}}}"
    found = matching(spark, f"{path}/event_date={wanted}/{VERSION}={version}")
    return ["/".join(x.rsplit("/", 2)[1:]) for x in found]


def _list(path: str, number: int) -> str:
    return f"{path}/{LISTS}/{number:012d}"
