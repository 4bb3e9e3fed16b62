"""Model tables as Parquet by event_date, and the catalog entries SQL users see."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from eventlake.sinks import versions
from eventlake.sources.folders import exists, matching

#: Table property: the number of the list of versions that a catalog table shows.
LIST_PROPERTY = "eventlake.list"


def write_bucketed(rows: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Keep rows as a table of so many buckets by a key, sorted within, and return the table.

    Two such tables of one key and number of buckets join without moving a row of either. All
    rows of a key lie in one bucket: a key that holds a large part of the rows belongs in a join
    that AQE can split instead. One shuffle writes one file per bucket."""
    where = {"path": path} if path else {}
    spread = rows.repartition(buckets, key)
    spread.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).options(**where).saveAsTable(name)
    return rows.sparkSession.table(name)


def refresh_catalog(
    spark: SparkSession,
    name: str,
    path: str,
    schema: T.StructType,
    partitions: dict[str, str],
    source: str = "parquet",
    options: dict[str, str] | None = None,
    dates: list[str] | None = None,
) -> None:
    """Make the table and every partition folder below ``path`` visible to SQL; in a table that
    is there already, with ``dates``, only the partitions of these event dates."""
    if not exists(spark, path):
        return
    if dates is not None and spark.catalog.tableExists(name):
        _refresh_dates(spark, name, path, dates)
    else:
        _create(spark, name, path, schema, partitions, source, options)
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


def refresh_versions(spark: SparkSession, name: str, path: str, schema: T.StructType) -> None:
    """Point the table's partitions to the versions that the last list names. A partition is
    switched in one step, one date after the other; only dates that differ from the list the
    catalog shows are touched, or all if that list is no longer there."""
    lists = versions.numbers(spark, path)
    if not lists:
        return
    _create(spark, name, path, schema, {"event_date": "date"})
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    shown = int(properties.get(LIST_PROPERTY, 0))
    before = versions.folders_of(spark, path, shown) if shown in lists else None
    after = versions.folders_of(spark, path, lists[-1])
    known = {r.partition.split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    new = [f"PARTITION (event_date='{d}') LOCATION '{path}/{after[d]}'" for d in sorted(after.keys() - known)]
    for day in sorted(known & after.keys()):
        if before is None or before.get(day) != after[day]:
            spark.sql(f"ALTER TABLE {name} PARTITION (event_date='{day}') SET LOCATION '{path}/{after[day]}'")
    if new:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(new)}")
    for day in sorted(known - after.keys()):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (event_date='{day}')")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{LIST_PROPERTY}' = '{lists[-1]}')")
    spark.catalog.refreshTable(name)


def _create(
    spark: SparkSession,
    name: str,
    path: str,
    schema: T.StructType,
    partitions: dict[str, str],
    source: str = "parquet",
    options: dict[str, str] | None = None,
) -> None:
    data = {f.name: f.dataType.simpleString() for f in schema.fields}
    columns = ", ".join(f"`{column}` {kind}" for column, kind in {**data, **partitions}.items())
    settings = ", ".join(f"'{key}' = \"{value}\"" for key, value in (options or {}).items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {source} "
        + (f"OPTIONS ({settings}) " if settings else "")
        + f"PARTITIONED BY ({', '.join(partitions)}) LOCATION '{path}'"
    )


def _refresh_dates(spark: SparkSession, name: str, path: str, dates: list[str]) -> None:
    """Add partitions that have come and drop those that have gone, on some event dates."""
    known = {r.partition for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    known = {x for x in known if x.split("/")[0].split("=", 1)[1] in dates}
    below = "/event_type=*" if _nested(spark, path) else ""
    found = set()
    for value in dates:
        for folder in matching(spark, f"{path}/event_date={value}{below}"):
            found.add("/".join(folder.rsplit("/", 2 if below else 1)[1:]))

    def spec(partition: str) -> str:
        values = (x.split("=", 1) for x in partition.split("/"))
        return ", ".join(f"{column}='{value}'" for column, value in values)

    for partition in sorted(found - known):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({spec(partition)})")
    for partition in sorted(known - found):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec(partition)})")


def _nested(spark: SparkSession, path: str) -> bool:
    return bool(matching(spark, f"{path}/event_date=*/event_type=*"))
