"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.session import shared_folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


#: What the operators rely on. Spark deletes what an execution has shuffled when it ends, as
#: results are in written tables; batches of long texts stay small in Python workers.
SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def freed(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task's function that gives its memory back when it ends. Python workers live on for later
    tasks, beside other operators' workers and the executor's heap."""

    def runs(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return runs


def settle(spark: SparkSession) -> None:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)


def stored(rows: DataFrame, name: str = "table") -> DataFrame:
    """Writes rows as Parquet and reads them back: lineage ends here, a lost executor loses nothing."""
    spark = rows.sparkSession
    path = new_path(spark, name)
    settle(spark)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


#: Rows that a file has at most, for numbers of rows.
MOST_ROWS = 1 << 34


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """Rows with a column of this name: a number of each row's own, the same whenever the rows are
    read. It is made of the number of its Parquet file and its place there; other rows than those
    of a plain read of such files are stored first. Files are numbered in ranges of their paths:
    the driver sees how many each range has."""
    file, files, place = free_names(rows, "_file", "_files", "_place")

    def placed(rows: DataFrame) -> DataFrame:
        data = rows.metadataColumn("_metadata")
        return rows.select("*", data["file_path"].alias(file), data["row_index"].alias(place))

    try:
        # behind a join or an explode, several rows would have the same place
        plain = rows._jdf.queryExecution().analyzed().nodeName() == "LogicalRelation"
        found = placed(rows if plain else stored(rows, "rows"))
    except AnalysisException:
        found = placed(stored(rows, "rows"))
    paths = found.select(F.col(file).alias("path")).distinct().repartitionByRange(parts(rows.sparkSession), "path")
    listed = stored(paths.withColumn("range", F.spark_partition_id()), "files")
    listed = listed.withColumn("at", listed.metadataColumn("_metadata")["row_index"])
    before, total = {}, 1
    for r in sorted(listed.groupBy("range").agg(F.count("*").alias("n")).collect()):
        before[r.range], total = total, total + r.n
    starts = [F.lit(x) for pair in before.items() for x in pair] or [F.lit(0), F.lit(0)]
    number = (F.create_map(*starts)[F.col("range")].cast("long") + F.col("at")) * MOST_ROWS
    numbers = stored(listed.select(F.col("path").alias(files), number.alias(name)), "numbers")
    joined = found.join(numbers, F.col(file) == F.col(files))
    return joined.withColumn(name, F.col(name) + F.col(place)).drop(file, files, place)


def free_names(rows: DataFrame, *names: str) -> list[str]:
    """The names, longer where a column of the table has one of them already."""
    taken, out = {c.lower() for c in rows.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
