"""Session settings the jobs rely on, and the shared folder for scratch tables."""

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SETTINGS = {
    # event_date is the UTC date of the event's instant.
    "spark.sql.session.timeZone": "UTC",
    # Splits hot (date, type) groups on write and hot ids in joins.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # 8-byte timestamps with min/max statistics instead of INT96.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

# Used where the session leaves them open.
DEFAULTS = {
    # Shuffled rows shrink about fivefold in Parquet; 64 MB would make small files.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
}


def prepare(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    for name, value in DEFAULTS.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)
    return spark


@contextmanager
def prepared(spark: SparkSession) -> Iterator[SparkSession]:
    """The settings for as long as a job runs; the caller's own come back after it."""
    before = {name: spark.conf.get(name, None) for name in (*SETTINGS, *DEFAULTS)}
    try:
        yield prepare(spark)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


#: Bounds of what opening a file is counted as, in bytes of reading: Spark's own value, and a
#: small one, so that a task takes up to 2,000 tiny files.
OPENING, LEAST_OPENING = 4 << 20, 64 << 10


def split_settings(files: int, size: int) -> dict[str, str]:
    """Settings that pack so many files of so many bytes in all into splits: a file that is small
    beside a split counts little more than its bytes."""
    cost = min(OPENING, max(LEAST_OPENING, size // files)) if files else OPENING
    return {"spark.sql.files.openCostInBytes": str(cost)}


@contextmanager
def split_for(spark: SparkSession, files: int, size: int) -> Iterator[None]:
    """Splits for such files while a job plans its scans."""
    wanted = split_settings(files, size)
    before = {name: spark.conf.get(name) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def empty(spark: SparkSession, schema: str | StructType) -> DataFrame:
    """No rows of a schema, as a plan that Spark cuts away in unions and joins."""
    fields = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    columns = ", ".join(f"cast(null as {f.dataType.simpleString()}) as `{f.name}`" for f in fields)
    return spark.sql(f"select {columns} where false")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="eventlake-"))
    return context.getCheckpointDir().rstrip("/")
