"""Bronze: one JSON object per line under year=/month=/day= folders, read as text."""

from collections.abc import Iterator
from datetime import date

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from eventlake.contract import BRONZE_SCHEMA, CORRUPT
from eventlake.session import empty
from eventlake.sources.folders import names, partition_values

#: The column that says under which day's folder a row lies.
FOLDER_DATE = "folder_date"
FILES_SCHEMA = "path string, length long, modificationTime timestamp"


def _reader(spark: SparkSession) -> DataFrameReader:
    # A given schema spares the inference pass; broken lines keep their text.
    return (
        spark.read.schema(BRONZE_SCHEMA)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )


def scan(spark: SparkSession, root: str) -> DataFrame:
    """All events below ``root``, with int ``year, month, day`` from the folders."""
    return _reader(spark).json(root)


def scan_recursive(spark: SparkSession, root: str) -> DataFrame:
    """Every file below ``root``, whatever its folders are called, with ``folder_date``."""
    return _filed(spark, [root])


def scan_days(spark: SparkSession, root: str, start: date, end: date, tree=None) -> DataFrame:
    """Events filed under the days start to end, with ``folder_date``.

    Of a tree that has been listed before nothing is listed again.
    """
    days, _ = tree or folders(spark, root)
    return _filed(spark, [path for path, filed in days if start <= filed <= end], dated=True)


def scan_in_parts(spark: SparkSession, root: str, tree=None) -> Iterator[DataFrame]:
    """All of bronze, one DataFrame per month of folders to keep jobs to a size, and one of what
    lies outside of day folders."""
    days, strays = tree or folders(spark, root)
    months = {}
    for path, filed in days:
        months.setdefault((filed.year, filed.month), []).append(path)
    for _, paths in sorted(months.items()):
        yield _filed(spark, paths, dated=True)
    if strays:
        yield _filed(spark, strays)


def folders(spark: SparkSession, root: str) -> tuple[list[tuple[str, date]], list[str]]:
    """Day folders with their dates, and everything else below ``root``: files and folders that
    lie elsewhere, or whose names are no date."""
    days, strays = [], []

    def walk(path: str, levels: tuple[str, ...]) -> None:
        for below, is_folder in names(spark, path):
            if is_folder and below.rsplit("/", 1)[1].startswith(f"{levels[0]}="):
                if len(levels) > 1:
                    walk(below, levels[1:])
                    continue
                filed = _date_of(below)
                if filed:
                    days.append((below, filed))
                    continue
            strays.append(below)

    walk(root, ("year", "month", "day"))
    return days, strays


def _date_of(path: str) -> date | None:
    values = partition_values(path)
    try:
        return date(*(int(values[part]) for part in ("year", "month", "day")))
    except (KeyError, ValueError):
        return None


def files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The files below some paths: path, length and modificationTime. Their content is not read."""
    if not paths:
        return empty(spark, FILES_SCHEMA)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    return listed.select("path", "length", "modificationTime")


def changed(before: DataFrame, now: DataFrame) -> list[str | None]:
    """The dates in the folders of files that came, went or changed between two listings; None
    stands for files outside of day folders."""
    old, new = (x.select("path", "length", "modificationTime") for x in (before, now))
    either = old.exceptAll(new).union(new.exceptAll(old)).select(folder_date(F.col("path")).alias("d"))
    return [str(r.d) if r.d else None for r in either.distinct().collect()]


def _filed(spark: SparkSession, paths: list[str], dated: bool = False) -> DataFrame:
    """Rows with the date in the name of the day folder they lie in, whatever else is read. Paths
    that are ``dated`` are such folders, so the names need no test."""
    if not paths:
        return empty(spark, BRONZE_SCHEMA).withColumn(FOLDER_DATE, F.lit(None).cast("date"))
    rows = _reader(spark).option("recursiveFileLookup", "true").json(paths)
    file = F.col("_metadata.file_path")
    return rows.select("*", (_named_date(file) if dated else folder_date(file)).alias(FOLDER_DATE))


def _named_date(file: Column) -> Column:
    """The date in the path of a file below a day folder, by cutting strings only."""
    tail = F.substring_index(file, "/year=", -1)
    month, day = (F.substring_index(F.substring_index(tail, f"/{x}=", -1), "/", 1) for x in ("month", "day"))
    return F.make_date(*(x.cast("int") for x in (F.substring_index(tail, "/", 1), month, day)))


def folder_date(file: Column) -> Column:
    """The date in year=/month=/day= of a file's path; NULL if there is none or it is no date."""
    pattern = r"/year=(\d{1,4})/month=(\d{1,2})/day=(\d{1,2})/"
    parts = [F.regexp_extract(file, pattern, i) for i in (1, 2, 3)]
    text = F.concat_ws("-", F.lpad(parts[0], 4, "0"), F.lpad(parts[1], 2, "0"), F.lpad(parts[2], 2, "0"))
    return F.when(parts[0] != "", F.to_date(F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))))
