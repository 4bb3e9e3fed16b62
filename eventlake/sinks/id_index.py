"""An index of event ids beside silver: which partitions may hold an id.

Entries are (hash of the id, event_date, event_type), cut into buckets by hash. An entry is a
hint: whoever follows it reads the ids of that partition, so entries that are out of date cost a
read and never a result, while a missing one would. Therefore entries come before the rows they
are for, and rows that leave silver leave theirs behind until the index is built anew.

Layout::

    <silver>_ids/gen=<n>/bucket=<b>/    entries; as many buckets as the generation's size asks for
    <silver>_ids/state.json             the generations that count, and the time of each partition

Each publication adds a generation. Generations of like size are merged, so an entry is rewritten
a few times in all, and a few ids are looked up in one bucket per generation: bytes read grow with
the number of ids looked up and the logarithm of the history. A partition whose folder has changed
since the index saw it, by whatever hand, is indexed again before the index is used (on stores
that keep times of folders). Only the job that holds the lake's lease writes.
"""

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventlake.contract import SILVER_PARTITIONS
from eventlake.session import empty
from eventlake.sources.folders import exists, matching, modified, partition_values, read_text, remove, write_text
from eventlake.sources.silver import UNIQUE_IDS, read_silver

#: Entries that a bucket aims at; most buckets, a bound on folders; generations of a size that
#: are merged, and the factor within which sizes are alike.
TARGET, BUCKETS, MERGED, ALIKE = 1 << 18, 4096, 4, 4

SCHEMA = "id_hash long, event_date date, event_type string"
_KEYS = ("id_hash", *SILVER_PARTITIONS)


def root(silver: str) -> str:
    return f"{silver.rstrip('/')}_ids"


def hashed(column: str = "event_id") -> Column:
    return F.xxhash64(column).alias("id_hash")


def state(spark: SparkSession, silver: str) -> dict:
    path = f"{root(silver)}/state.json"
    if not exists(spark, path):
        return {"generations": [], "partitions": {}, "last": 0}
    return json.loads(read_text(spark, path))


def current(spark: SparkSession, silver: str) -> bool:
    """Whether the index has seen every partition as it is."""
    return state(spark, silver)["partitions"] == _times(spark, silver)


def heal(spark: SparkSession, silver: str) -> list[str]:
    """Index the partitions that changed since the index saw them; their names."""
    now, known = state(spark, silver), _times(spark, silver)
    changed = sorted(name for name, time in known.items() if now["partitions"].get(name) != time)
    if changed:
        rows = read_silver(spark, silver, [f"{silver}/{name}" for name in changed])
        entries = rows.where("event_id is not null").select(hashed(), *SILVER_PARTITIONS)
        # copies of a hot id are gone before a bucket comes together
        _add(spark, silver, now, entries.distinct(), rows.count())
    if now["partitions"] != known:
        _write(spark, silver, {**now, "partitions": known})
    return changed


def rebuild(spark: SparkSession, silver: str) -> int:
    """Build the index anew from silver, without what is out of date; its number of entries."""
    old = state(spark, silver)
    _write(spark, silver, {"generations": [], "partitions": {}, "last": old["last"]})
    for generation in old["generations"]:
        remove(spark, _path(silver, generation))
    heal(spark, silver)
    return sum(g["entries"] for g in state(spark, silver)["generations"])


def add(spark: SparkSession, silver: str, entries: DataFrame, most: int) -> None:
    """Add entries (id_hash, event_date, event_type), at most so many, before their rows come. They
    are those of distinct ids, so copies are rare."""
    now = state(spark, silver)
    _add(spark, silver, now, entries, most)
    _write(spark, silver, now)


def settled(spark: SparkSession, silver: str, keys: set) -> None:
    """Note that the partitions of these (date, type) pairs were written, whose rows the index has
    entries for."""
    now = state(spark, silver)
    dates = ",".join(sorted({event_date for event_date, _ in keys}))
    found = _times(spark, silver, f"event_date={{{dates}}}/event_type=*") if keys else {}
    for key in keys:
        name = "/".join(f"{c}={v}" for c, v in zip(SILVER_PARTITIONS, key))
        now["partitions"].pop(name, None)
        if name in found:
            now["partitions"][name] = found[name]
    _write(spark, silver, now)


def hints(spark: SparkSession, silver: str, ids: DataFrame) -> DataFrame:
    """The entries of ids (a written table of distinct id_hash). Of each generation only the
    buckets that ids fall in are read."""
    found = empty(spark, SCHEMA)
    for paths in looked_up(spark, silver, ids):
        found = found.union(spark.read.schema(SCHEMA).parquet(*paths))
    return found.join(ids, "id_hash", "left_semi")


def matched(rows: DataFrame, others: DataFrame, equal: tuple[str, ...], how: str) -> DataFrame:
    """Rows that have a partner of the same id_hash and equal columns among others, or none.

    The hash alone is the key, as one long is sorted by its digits; the columns, written as ranges
    so that they do not become keys, are compared only where hashes meet."""
    a, b = rows.alias("a"), others.alias("b")
    met = F.col("a.id_hash") == F.col("b.id_hash")
    for column in equal:
        met = met & F.col(f"a.{column}").between(F.col(f"b.{column}"), F.col(f"b.{column}"))
    return a.join(b, met, how)


def looked_up(spark: SparkSession, silver: str, ids: DataFrame) -> list[list[str]]:
    """The buckets that ids fall in, of each generation that has some."""
    generations = state(spark, silver)["generations"]
    widest = max((g["buckets"] for g in generations), default=1)
    hit = {0}
    if widest > 1:
        hit = {r.b for r in ids.select(_bucket(widest).alias("b")).distinct().collect()}
    found = []
    for generation in generations:
        wanted = {b % generation["buckets"] for b in hit}
        there = matching(spark, f"{_path(silver, generation)}/bucket=*")
        found.append([path for path in there if int(path.rsplit("=", 1)[1]) in wanted])
    return [paths for paths in found if paths]


def _bucket(buckets: int) -> Column:
    return F.pmod(F.col("id_hash"), F.lit(buckets)).cast("int")


def _path(silver: str, generation: dict) -> str:
    return f"{root(silver)}/gen={generation['number']}"


def _read(spark: SparkSession, silver: str, generation: dict) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(_path(silver, generation)).select(*_KEYS)


def _times(spark: SparkSession, silver: str, name: str = "event_date=*/event_type=*") -> dict[str, int]:
    found = modified(spark, f"{silver}/{name}")
    return {"/".join(f"{c}={partition_values(p)[c]}" for c in SILVER_PARTITIONS): t for p, t in found.items()}


def _write(spark: SparkSession, silver: str, now: dict) -> None:
    write_text(spark, f"{root(silver)}/state.json", json.dumps(now))


def _add(spark: SparkSession, silver: str, now: dict, entries: DataFrame, most: int) -> None:
    if not most:
        return
    _generation(spark, silver, now, entries, most)
    for sizes in _alike(now["generations"]):
        rows = _read(spark, silver, sizes[0])
        for generation in sizes[1:]:
            rows = rows.union(_read(spark, silver, generation))
        now["generations"] = [g for g in now["generations"] if g not in sizes]
        _generation(spark, silver, now, rows, sum(g["entries"] for g in sizes), copies=True)
        _write(spark, silver, now)
        for generation in sizes:
            remove(spark, _path(silver, generation))


def _alike(generations: list[dict]):
    """The smallest generations while enough of them are of like size."""
    by_size = sorted(generations, key=lambda g: g["entries"])
    alike = [g for g in by_size if g["entries"] <= ALIKE * by_size[0]["entries"]]
    if len(alike) >= MERGED:
        yield alike


def _generation(
    spark: SparkSession, silver: str, now: dict, entries: DataFrame, most: int, copies: bool = False
) -> None:
    """Write entries as a generation; ``copies`` says that some may be there a few times."""
    buckets = 1
    while buckets < BUCKETS and buckets * TARGET < most:
        buckets *= 2
    now["last"] += 1
    generation, written = {"number": now["last"], "buckets": buckets}, Observation()
    spread = _spread(entries, buckets, copies)
    spread.observe(written, F.count("*").alias("entries")).sortWithinPartitions("bucket", "id_hash").write.mode(
        "overwrite"
    ).options(**UNIQUE_IDS).partitionBy("bucket").parquet(_path(silver, generation))
    generation |= written.get
    if generation["entries"]:
        now["generations"].append(generation)
    else:
        remove(spark, _path(silver, generation))


def _spread(entries: DataFrame, buckets: int, copies: bool) -> DataFrame:
    """Entries by bucket in one shuffle; copies meet in their bucket and need no other."""
    spread = entries.withColumn("bucket", _bucket(buckets)).repartition(buckets, "bucket")
    return spread.dropDuplicates() if copies else spread
