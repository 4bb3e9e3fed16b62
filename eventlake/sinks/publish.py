"""Publishing into silver: an upsert by event_id, wherever silver holds the ids.

A partition is replaced as a whole, once per run, so the rows it holds and the run does not
replace, the survivors, are written aside first. A replacement that is broken off can be
repeated from there.
"""

from collections.abc import Iterator
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.contract import SILVER_COLUMNS, SILVER_PARTITIONS, SILVER_SCHEMA
from eventlake.session import empty
from eventlake.sinks import id_index, workarea
from eventlake.sources.folders import exists, matching, partition_values, read_text, remove, write_text
from eventlake.sources.silver import UNIQUE_IDS, read_silver

UNDATED = "none"


def label_of(column: str | Column, batch: str | None) -> Column:
    """The group a date is published in: the first day of its week, month or year."""
    if batch is None:
        return F.lit("all")
    return F.coalesce(F.trunc(column, batch).cast("string"), F.lit(UNDATED))


def upsert(spark: SparkSession, silver: str, folder: str, batch: str | None) -> list[str]:
    """Publish the accepted rows of a run; return the event dates that change.

    A row replaces the silver rows of its event_id on any date, and a rejected row removes
    them. Copies of an event_id inside a run are kept for the uniqueness check to report.
    """
    label = label_of("event_date", batch).alias("label")
    # What a broken off run found may be older than silver: then every row is compared again.
    known = not workarea.complete(spark, f"{folder}/old")
    rows, old = workarea.accepted(spark, folder), _old_copies(spark, silver, folder)
    touched: dict[str, set] = {}
    coming, copies = set(), {}
    for table in (rows, old):
        if table is not None:
            counted = _counted(table).select(label, *map(_text, SILVER_PARTITIONS), "count")
            for name, *key, count in counted.collect():
                touched.setdefault(name, set()).add(tuple(key))
                if table is rows:
                    coming.add(tuple(key))
                else:
                    copies[tuple(key)] = count
    for name, keys in sorted(touched.items()):
        if workarea.done(spark, folder, name):
            continue
        filled = None
        if not workarea.ready(spark, folder, name):
            replaced = _among(spark, silver, keys)
            if replaced:
                kept = _with_survivors(spark, silver, replaced, copies) if known else replaced
                survivors = empty(spark, SILVER_SCHEMA)
                if kept:
                    gone = old.where(label == F.lit(name)).select("event_id")
                    gone = written_distinct(gone.where(_in(kept)), f"{folder}/group={name}/gone")
                    current = read_silver(spark, silver, date_folders(kept)).where(_in(kept))
                    survivors = current.join(gone, "event_id", "left_anti")
                if known:
                    filled = (coming & keys) | {key_of(path) for path in kept}
                set_aside(spark, folder, name, replaced, survivors)
        replace(spark, silver, folder, name, keys, filled)
    return sorted({event_date for keys in touched.values() for event_date, _ in keys})


def _with_survivors(
    spark: SparkSession, silver: str, replaced: list[str], copies: dict[tuple, int]
) -> list[str]:
    """The partitions that hold more rows than a run replaces. Rows are counted from the footers
    of their files, so a partition that is replaced as a whole is not read."""
    counted = _counted(read_silver(spark, silver, date_folders(replaced)).where(_in(replaced)))
    counted = counted.select(*map(_text, SILVER_PARTITIONS), "count").collect()
    held = {tuple(key): count for *key, count in counted}
    return [path for path in replaced if held.get(key_of(path), 0) != copies.get(key_of(path), 0)]


def _old_copies(spark: SparkSession, silver: str, folder: str) -> DataFrame:
    """Where silver holds the ids of a run: event_id, event_date and event_type, before anything
    of the run is published. The id index names the partitions to look in."""
    ids, named, old = f"{folder}/ids", f"{folder}/hints", f"{folder}/old"
    schema = "event_id string, event_date date, event_type string"
    if workarea.complete(spark, old):
        return spark.read.schema(schema).parquet(old)
    id_index.heal(spark, silver)
    rows = workarea.accepted(spark, folder)
    parts = [] if rows is None else [rows.select("event_id", *SILVER_PARTITIONS)]
    if exists(spark, f"{folder}/{workarea.REJECTED}"):
        bad = spark.read.schema("event_id string").parquet(f"{folder}/{workarea.REJECTED}")
        nowhere = (F.lit(None).cast(SILVER_SCHEMA[c].dataType).alias(c) for c in SILVER_PARTITIONS)
        parts.append(bad.select("event_id", *nowhere))
    found = empty(spark, schema)
    if parts:
        # Distinct ids with the partitions they go to: looked up here, and entries of the index.
        keys = reduce(DataFrame.union, parts).where("event_id is not null")
        keys = written_distinct(keys, ids).withColumn("id_hash", id_index.hashed())
        entries = keys.where("event_date is not null").select("id_hash", *SILVER_PARTITIONS)
        if id_index.state(spark, silver)["generations"]:
            hinting = id_index.hints(spark, silver, keys.select("id_hash"))
            hinting.write.mode("overwrite").options(**UNIQUE_IDS).parquet(named)
            hints = spark.read.schema(id_index.SCHEMA).parquet(named)
            hinted = keys_of(hints)
            if hinted:
                entries = id_index.matched(entries, hints, SILVER_PARTITIONS, "left_anti")
            replaced = _among(spark, silver, hinted)
            if replaced:
                held = read_silver(spark, silver, date_folders(replaced)).where(_in(replaced))
                held = held.select(id_index.hashed(), "event_id", *SILVER_PARTITIONS)
                found = id_index.matched(held, keys, ("event_id",), "left_semi").drop("id_hash")
        if rows is not None:
            id_index.add(spark, silver, entries, rows.count())
    found.write.mode("overwrite").options(**UNIQUE_IDS).parquet(old)
    return spark.read.schema(schema).parquet(old)


def _among(spark: SparkSession, silver: str, keys: set) -> list[str]:
    """The existing partition folders among (date, type) pairs."""
    dates = sorted({event_date for event_date, _ in keys})
    return [path for path in partitions_of(spark, silver, dates) if key_of(path) in keys]


def _in(partitions: list[str]) -> Column:
    """A condition that rows lie in one of the partitions; it prunes folders."""
    by_date: dict[str, list[str]] = {}
    for path in partitions:
        event_date, event_type = key_of(path)
        by_date.setdefault(event_date, []).append(event_type)
    found = F.lit(False)
    for types in sorted({tuple(sorted(x)) for x in by_date.values()}):
        dates = [d for d, x in by_date.items() if tuple(sorted(x)) == types]
        found = found | (_text("event_date").isin(*dates) & F.col("event_type").isin(*types))
    return found


def partitions_of(spark: SparkSession, silver: str, dates: list[str] | None) -> list[str]:
    """The existing partition folders of some event dates, or of all."""
    if dates == []:
        return []
    wanted = "*" if dates is None else f"{{{','.join(dates)}}}"
    return matching(spark, f"{silver}/event_date={wanted}/event_type=*")


def date_folders(partitions: list[str]) -> list[str]:
    """The folders of whole dates: fewer to list than those of date and type."""
    return sorted({path.rsplit("/", 1)[0] for path in partitions})


def by_month(partitions: list[str]) -> Iterator[tuple[str, list[str]]]:
    """Partition folders in groups of a month each, to keep jobs to a size."""
    for month, group in groupby(partitions, lambda path: key_of(path)[0].rsplit("-", 1)[0]):
        yield month, list(group)


def written_distinct(keys: DataFrame, path: str) -> DataFrame:
    """Distinct keys as a written table, to be joined against.

    Copies of a hot key are gone before the join, and both of its sides come
    straight from a shuffle, which is what AQE needs to split the hot key's rows.
    """
    keys.distinct().write.mode("overwrite").options(**UNIQUE_IDS).parquet(path)
    return keys.sparkSession.read.schema(keys.schema).parquet(path)


def set_aside(
    spark: SparkSession, folder: str, label: str, replaced: list[str], survivors: DataFrame
) -> None:
    """Write what a repeated replacement needs; the list of partitions comes last."""
    group = f"{folder}/group={label}"
    survivors.select(*SILVER_COLUMNS).write.mode("overwrite").parquet(f"{group}/survivors")
    write_text(spark, f"{group}/replaced", "\n".join(replaced))


def replace(
    spark: SparkSession,
    silver: str,
    folder: str,
    label: str,
    keys: set | None = None,
    filled: set | None = None,
) -> None:
    """Put a group's rows in place of the partitions it lists, once. The id index must have the
    rows' entries; ``keys`` are the (date, type) pairs that change, if others than those listed,
    ``filled`` those that get rows, if that is known."""
    replaced = replaced_by(spark, folder, label)
    rows = workarea.replacement(spark, folder, label)
    if rows is not None:
        write_partitions(rows, silver)
    if filled is None:
        filled = keys_of(rows) if rows is not None and replaced else set()
    for path in replaced:
        # Dynamic overwrite leaves a partition nobody writes to as it was.
        if key_of(path) not in filled:
            remove(spark, path)
    id_index.settled(spark, silver, (keys or filled) | {key_of(path) for path in replaced})
    workarea.mark_done(spark, folder, label)


def replaced_by(spark: SparkSession, folder: str, label: str) -> list[str]:
    """The partitions a group lists."""
    path = f"{folder}/group={label}/replaced"
    return read_text(spark, path).splitlines() if exists(spark, path) else []


def keys_of(rows: DataFrame) -> set[tuple[str, str]]:
    """The (date, type) partitions the rows fall in, as folder names spell them."""
    found = rows.select(*SILVER_PARTITIONS).distinct().select(*map(_text, SILVER_PARTITIONS))
    return {tuple(key) for key in found.collect()}


def _counted(rows: DataFrame) -> DataFrame:
    """Rows in each (date, type); whoever wants text or labels makes them of the few groups."""
    return rows.groupBy(*SILVER_PARTITIONS).count()


def key_of(path: str) -> tuple[str, str]:
    values = partition_values(path)
    return tuple(values[column] for column in SILVER_PARTITIONS)


def write_partitions(rows: DataFrame, silver: str) -> None:
    """Replace exactly the partitions the rows fall in, few files each.

    The rebalance brings a (date, type) together and lets AQE split a hot one.
    """
    (
        rows.hint("rebalance", *SILVER_PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .options(**UNIQUE_IDS)
        .partitionBy(*SILVER_PARTITIONS)
        .parquet(silver)
    )


def _text(column: str):
    return F.col(column).cast("string").alias(column)
