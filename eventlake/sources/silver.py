"""Silver Parquet partitioned by event_date and event_type, and the rejected JSON."""

from pyspark.sql import DataFrame, SparkSession

from eventlake.contract import SILVER_SCHEMA, rejected_schema

REJECTED_OPTIONS = {
    # JSON would otherwise cut timestamps to milliseconds.
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    # Here _corrupt_record is a written field, not this reader's own.
    "columnNameOfCorruptRecord": "_unreadable",
}

#: Writer options: values that hardly repeat need no dictionary.
UNIQUE_IDS = {f"parquet.enable.dictionary#{c}": "false" for c in ("event_id", "id_hash")}

#: Partition columns of the rejected rows.
SLICES = ("folder_date", "filed_date")


def read_silver(spark: SparkSession, root: str, partitions: list[str] | None = None) -> DataFrame:
    """The silver table, or only the given partition folders of it."""
    reader = spark.read.schema(SILVER_SCHEMA)
    if partitions is None:
        return reader.parquet(root)
    return reader.option("basePath", root).parquet(*partitions)


def read_rejected(spark: SparkSession, root: str) -> DataFrame:
    """Quarantined rows with the ``run`` and ``ingest_date`` that put them there, the date of
    the bronze folder they came from and the date they are filed under."""
    schema = rejected_schema()
    for column in SLICES:
        schema = schema.add(column, "date")
    return spark.read.schema(schema).options(**REJECTED_OPTIONS).json(root)
