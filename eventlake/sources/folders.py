"""Folder names and removal through Hadoop's FileSystem; no event passes through here."""

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, sorted."""
    fs, path = _open(spark, pattern)
    return sorted(status.getPath().toString() for status in fs.globStatus(path) or [])


def modified(spark: SparkSession, pattern: str) -> dict[str, int]:
    """When the paths that match a glob were changed, in milliseconds."""
    fs, path = _open(spark, pattern)
    return {x.getPath().toString(): x.getModificationTime() for x in fs.globStatus(path) or []}


def exists(spark: SparkSession, path: str) -> bool:
    fs, path = _open(spark, path)
    return fs.exists(path)


def remove(spark: SparkSession, path: str) -> None:
    fs, path = _open(spark, path)
    fs.delete(path, True)


def partition_values(path: str) -> dict[str, str]:
    """``.../a=1/b=2`` as ``{"a": "1", "b": "2"}``."""
    return dict(part.split("=", 1) for part in path.split("/") if "=" in part)


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new small file of ASCII text; False if there is one already."""
    fs, target = _open(spark, path)
    if fs.exists(target):
        return False
    try:
        out = fs.create(target, False)
    except Py4JJavaError:
        return False
    out.writeBytes(text)
    out.close()
    return True


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file of ASCII text aside and move it in, so that it is whole or not there."""
    fs, target = _open(spark, path)
    _, aside = _open(spark, f"{path}.new")
    out = fs.create(aside, True)
    out.writeBytes(text)
    out.close()
    fs.delete(target, False)
    fs.rename(aside, target)


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _open(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def touch(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.setTimes(target, spark._jvm.java.lang.System.currentTimeMillis(), -1)


def seconds_old(spark: SparkSession, path: str) -> float | None:
    """Time since a file was written or touched; None if it is not there."""
    found = status(spark, path)
    if found is None:
        return None
    return (spark._jvm.java.lang.System.currentTimeMillis() - found.getModificationTime()) / 1000


def status(spark: SparkSession, path: str):
    fs, target = _open(spark, path)
    try:
        return fs.getFileStatus(target)
    except Py4JJavaError:
        return None


def sizes(spark: SparkSession, folder: str) -> list[int]:
    """Bytes of the data files in a folder."""
    fs, target = _open(spark, folder)
    found = (x for x in fs.listStatus(target) if x.isFile())
    return [x.getLen() for x in found if not x.getPath().getName().startswith(("_", "."))]


def names(spark: SparkSession, folder: str) -> list[tuple[str, bool]]:
    """Path and whether it is a folder, of what Spark would read below a folder."""
    fs, target = _open(spark, folder)
    if not fs.exists(target):
        return []
    found = ((x.getPath().toString(), x.isDirectory()) for x in fs.listStatus(target))
    return sorted(x for x in found if not x[0].rsplit("/", 1)[1].startswith(("_", ".")))
