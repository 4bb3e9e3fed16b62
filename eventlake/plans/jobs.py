"""The jobs: daily load, backfill, model build, erasure, compaction, and a whole day in order.

Jobs may run side by side. Each stages its rows in a folder of its own; tables are changed by
one job at a time. A job that was broken off after staging is finished by the next one that
changes tables, one that was broken off before is dropped. Jobs set the session's time zone and
adaptive execution as they need them and put the caller's settings back.
"""

from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass, field
from datetime import date, datetime, timedelta, timezone
from functools import wraps

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventlake.contract import (
    CORRUPT,
    ERROR,
    EVENT_COLUMNS,
    SILVER_SCHEMA,
    STAGING_SCHEMA,
    SUMMARY_SCHEMA,
    TYPED_COLUMNS,
    rejected_schema,
)
from eventlake.functions.parsing import day, event_date, stamp
from eventlake.operators import monitor, quality
from eventlake.operators.erase import events_of, without_users
from eventlake.operators.quality import MODEL_CHECKS, SOURCE_CHECKS, enforce
from eventlake.operators.transform import silver_columns
from eventlake.operators.validate import classify
from eventlake.plans.models import daily_event_summary, stg_events
from eventlake.session import empty, prepare, prepared, split_for
from eventlake.sinks import id_index, publish, quarantine, versions, workarea
from eventlake.sinks.tables import refresh_catalog, refresh_versions
from eventlake.sources import bronze as bronze_source
from eventlake.sources.folders import exists, matching, remove, sizes
from eventlake.sources.silver import REJECTED_OPTIONS, SLICES, UNIQUE_IDS, read_rejected, read_silver


@dataclass(frozen=True)
class Lake:
    """Where the lake keeps its layers; any path Hadoop can open.

    The work area and the list of erased users lie beside silver unless ``work`` says where,
    so that every job on a lake finds them, whatever its session's settings.
    """

    bronze: str
    silver: str
    rejected: str
    gold: str = ""
    work: str = ""

    @property
    def area(self) -> str:
        return self.work or f"{self.silver.rstrip('/')}_work"

    @property
    def erased(self) -> str:
        return f"{self.silver.rstrip('/')}_erased_users"

    @property
    def staging(self) -> str:
        return self._gold("stg_events")

    @property
    def summary(self) -> str:
        return self._gold("daily_event_summary")

    def _gold(self, table: str) -> str:
        if not self.gold:
            raise ValueError("the lake has no gold path, so it has no models")
        return f"{self.gold}/{table}"


class StagingLost(RuntimeError):
    """Staged rows are not those that were written; nothing was published from them."""


@dataclass
class RunReport:
    """Rows read, published and rejected, the event dates that changed, and what was read from
    places that are no day's folder."""

    bronze_rows: int = 0
    good_rows: int = 0
    bad_rows: int = 0
    dates: list[str] = field(default_factory=list)
    strays: list[str] = field(default_factory=list)

    @property
    def rejection_rate(self) -> float | None:
        return round(100.0 * self.bad_rows / self.bronze_rows, 2) if self.bronze_rows else None

    def add(self, other: "RunReport") -> None:
        self.bronze_rows += other.bronze_rows
        self.good_rows += other.good_rows
        self.bad_rows += other.bad_rows
        self.dates = sorted({*self.dates, *other.dates})
        self.strays = sorted({*self.strays, *other.strays})


def _job(work: Callable) -> Callable:
    @wraps(work)
    def run(spark: SparkSession, *args, **named):
        with prepared(spark):
            return work(spark, *args, **named)

    return run


# Loads


@_job
def run_daily(
    spark: SparkSession, lake: Lake, run_date: date, run_ts: datetime | None = None
) -> RunReport:
    """Load the folder of one day, whatever dates its events carry.

    If an equal run was broken off after it had staged its rows, they are published, and the
    folder is read again only if its files are no longer those that were staged."""
    tree = bronze_source.folders(spark, lake.bronze)
    scope = {"folders": [str(run_date)] * 2, "dates": None}
    request = {"run": "daily", "scope": scope, "batch": None}

    def parts(days: list[str] | None) -> Iterable[DataFrame]:
        rows = classify(bronze_source.scan_days(spark, lake.bronze, run_date, run_date, tree))
        return [rows.withColumn("filed", _filed())]

    paths = [path for path, filed in tree[0] if filed == run_date]
    return _load(spark, lake, paths, parts, request, run_ts)


@_job
def run_backfill(
    spark: SparkSession,
    lake: Lake,
    start: date,
    end: date,
    batch: str | None = "month",
    slack_days: int | None = None,
    run_ts: datetime | None = None,
) -> RunReport:
    """Load all events dated start to end, both included, and publish them batch after batch.

    A row is filed under its event date, or its folder's date if its timestamp is unreadable,
    or no date at all; rows without one belong to every backfill that reads all of bronze.

    ``slack_days`` says how far from its event date a row may be filed. When it is known, only
    folders that near the range are read. When it is not (None), rows may be filed anywhere:
    all of bronze is read, once.

    If an equal backfill was broken off after it had staged its rows, they are published, and
    only day folders whose files are no longer those that were staged are read again; the
    report counts the rows of both.
    """
    if end < start:
        raise ValueError(f"the range ends on {end}, before it starts on {start}")
    dates = [str(start), str(end)]
    every = bronze_source.folders(spark, lake.bronze)
    tree, folders = every, None
    if slack_days is not None:
        slack = timedelta(days=slack_days)
        folders = [str(start - slack), str(end + slack)]
        tree = [x for x in every[0] if start - slack <= x[1] <= end + slack], []
    scope = {"folders": folders, "dates": dates}
    request = {"run": "backfill", "scope": scope, "batch": batch}

    def parts(days: list[str] | None) -> Iterable[DataFrame]:
        days_, strays = tree
        if days is not None:
            days_ = [x for x in days_ if str(x[1]) in days]
            strays = strays if quarantine.NO_DATE in days else []
        if slack_days is not None:
            found = [bronze_source.scan_days(spark, lake.bronze, start - slack, end + slack, (days_, []))]
        else:
            found = bronze_source.scan_in_parts(spark, lake.bronze, (days_, strays))
        return (_dated(part, start, end) for part in found)

    done = _load(spark, lake, [*(path for path, _ in tree[0]), *tree[1]], parts, request, run_ts)
    if slack_days is None:
        done.strays = sorted(every[1])
    return done


def _filed() -> Column:
    return F.coalesce(event_date(), F.col(bronze_source.FOLDER_DATE))


def _dated(bronze: DataFrame, start: date, end: date) -> DataFrame:
    """Classified rows of a date range, and those that have no date."""
    rows = classify(bronze).withColumn("filed", _filed())
    # The filter is moved below the parsing and repeats it for each mention of the date: one is enough.
    days, after = (end - start).days, F.datediff("filed", day(start))
    return rows.where(F.coalesce(F.abs(2 * after - days) <= days, F.lit(True)))


def _load(
    spark: SparkSession,
    lake: Lake,
    paths: list[str],
    parts: Callable[[list[str] | None], Iterable[DataFrame]],
    request: dict,
    run_ts: datetime | None,
) -> RunReport:
    """Stage classified rows of some paths, then publish them. ``parts`` gives the rows, of all
    paths or of some days' folders."""
    # Listed before the rows are, so a file that comes in between is taken for a new one.
    inputs = bronze_source.files(spark, paths)

    def compared(folder: str, finished: dict) -> list[str] | None:
        if any(finished.get(name) != value for name, value in request.items()):
            return None
        before = spark.read.schema(bronze_source.FILES_SCHEMA).parquet(f"{folder}/{workarea.INPUT}")
        return [x or quarantine.NO_DATE for x in bronze_source.changed(before, inputs)]

    done, days = RunReport(), None
    with workarea.exclusive(spark, lake.area):
        for _, report, changed in _recover(spark, lake, compared):
            if changed == []:
                return report
            if changed is not None:
                done.add(report)
                days = changed
            done.dates = sorted({*done.dates, *report.dates})
    if days is not None and request["run"] == "backfill":
        request = {**request, "scope": {**request["scope"], "days": days}}
    elif days is not None:
        done, days = RunReport(dates=done.dates), None
    run_ts = run_ts or datetime.now(timezone.utc)
    with workarea.run_folder(spark, lake.area) as folder:
        listed, counts = Observation(), RunReport()
        measures = F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("size")
        inputs.observe(listed, *measures).write.parquet(f"{folder}/{workarea.INPUT}")
        with split_for(spark, **listed.get):
            for part in parts(days):
                counts.add(_stage(spark, part, request, folder, run_ts))
        staged = {name: asdict(counts)[name] for name in ("bronze_rows", "good_rows", "bad_rows")}
        marked = {**request, **staged, "run_ts": run_ts.isoformat()}
        workarea.mark_staged(spark, folder, marked)
        # Mostly done here, where no other job waits; users erased since are left to publishing.
        _leave_out(spark, lake, folder)
        with workarea.exclusive(spark, lake.area):
            for _, report, _ in _recover(spark, lake):
                done.dates = sorted({*done.dates, *report.dates})
            done.add(_publish(spark, lake, folder, marked))
    return done


def _leave_out(spark: SparkSession, lake: Lake, folder: str) -> None:
    """Note which users of the staged rows were erased, up to the last epoch of the lake's list.

    Only the rows' user_id is read and compared with the list; whoever reads staged rows leaves
    out the few users noted here."""
    listed, noted = _epochs(spark, lake), workarea.epochs(spark, f"{folder}/gone")
    paths = [path for epoch, path in listed.items() if epoch > max(noted, default=-1)]
    if not paths:
        return
    staged = empty(spark, "user_id string")
    if exists(spark, f"{folder}/{workarea.ACCEPTED}"):
        staged = staged.union(read_silver(spark, f"{folder}/{workarea.ACCEPTED}").select("user_id"))
    raw = _raw_rejects(spark, folder)
    if raw is not None:
        staged = staged.union(raw.select(_user_of()))
    hits = spark.read.schema("user_id string").parquet(*paths).join(staged, "user_id", "left_semi")
    hits.write.mode("overwrite").parquet(f"{folder}/gone/epoch={max(listed)}")


def _stage(
    spark: SparkSession,
    classified: DataFrame,
    request: dict,
    folder: str,
    run_ts: datetime,
) -> RunReport:
    """Cut classified rows into a written table that feeds both sinks.

    This is the only pass over bronze text. The write has no shuffle, so its Observation counts
    each row once even when tasks are repeated elsewhere.
    """
    counts = Observation()
    rejected = F.isnotnull(ERROR)
    # What the silver columns do not hold already: each field costs a null in every good row.
    kept = F.struct(
        *TYPED_COLUMNS,
        CORRUPT,
        ERROR,
        F.lit(request["run"]).alias("run"),
        F.col(bronze_source.FOLDER_DATE),
        F.col("filed").alias(SLICES[1]),
    )
    (
        classified.observe(counts, *monitor.count_metrics())
        .select(
            *silver_columns(run_ts),
            F.when(rejected, kept).alias("raw"),
            F.when(rejected, "rejected").otherwise("accepted").alias("outcome"),
            F.when(rejected, "none")
            .otherwise(publish.label_of(event_date(), request["batch"]))
            .alias("batch"),
        )
        .write.mode("append")
        .options(**UNIQUE_IDS)
        .partitionBy("outcome", "batch")
        .parquet(f"{folder}/{workarea.ROWS}")
    )
    return RunReport(**counts.get)


def _user_of() -> Column:
    """The user of a row; of an unreadable line, what its text says."""
    broken = F.regexp_extract(F.col(CORRUPT), r'"user_id"\s*:\s*"([^"]*)"', 1)
    return F.coalesce("user_id", F.nullif(broken, F.lit("")))


def _publish(spark: SparkSession, lake: Lake, folder: str, request: dict) -> RunReport:
    """Bring a staged run into the tables; may be repeated until it is through.

    Users erased since the run was staged are left out: the list may have grown while the run
    waited for its lease, or lay broken off."""
    counts = RunReport(*(request[name] for name in ("bronze_rows", "good_rows", "bad_rows")))
    path = f"{folder}/{workarea.ACCEPTED}"
    whole = read_silver(spark, path) if exists(spark, path) else None
    found = [0 if rows is None else rows.count() for rows in (whole, _raw_rejects(spark, folder))]
    if found != [counts.good_rows, counts.bad_rows]:
        raise StagingLost(f"{folder}: {found} rows instead of {counts.good_rows}, {counts.bad_rows}")
    _leave_out(spark, lake, folder)
    raw = _staged_rejects(spark, folder)
    if workarea.gone(spark, folder) is not None:
        accepted = workarea.accepted(spark, folder)
        left = [0 if rows is None else rows.count() for rows in (accepted, raw)]
        counts = RunReport(sum(left), *left)
    slices = quarantine.slices(spark, lake.rejected)
    stale = [x for x, *dates in slices if quarantine.in_scope(request["scope"], *dates)]
    quarantine.replace_slices(spark, lake.rejected, raw, stale)
    counts.dates = publish.upsert(spark, lake.silver, folder, request["batch"])
    return counts


def _raw_rejects(spark: SparkSession, folder: str) -> DataFrame | None:
    path = f"{folder}/{workarea.REJECTED}"
    if not exists(spark, path):
        return None
    texts = [c for c in EVENT_COLUMNS if c not in TYPED_COLUMNS]
    raw = [f"{c}: string" for c in (*TYPED_COLUMNS, CORRUPT, ERROR, "run")] + [f"{c}: date" for c in SLICES]
    columns = [*(f"{c} string" for c in texts), "ingestion_timestamp timestamp", f"raw struct<{', '.join(raw)}>"]
    rows = spark.read.schema(", ".join(columns)).parquet(path)
    known = {c: F.col(c) for c in texts} | {
        "rejected_at": F.col("ingestion_timestamp"),
        "ingest_date": F.to_date("ingestion_timestamp"),
    }
    names = (*rejected_schema().names, *SLICES)
    return rows.select(*(known.get(c, F.col(f"raw.{c}")).alias(c) for c in names))


def _staged_rejects(spark: SparkSession, folder: str) -> DataFrame | None:
    """The staged rejected rows of a run, but for those of users to leave out."""
    raw, users = _raw_rejects(spark, folder), workarea.gone(spark, folder)
    if raw is None or users is None:
        return raw
    return without_users(raw.withColumn("_user", _user_of()), users, "_user").drop("_user")


def _recover(
    spark: SparkSession, lake: Lake, compared: Callable[[str, dict], list | None] = lambda *_: None
) -> list[tuple[dict, RunReport, list | None]]:
    """Finish runs that were broken off after staging, drop those that were before. Beside each
    request and report, what ``compared`` says of the run's folder."""
    finished = []
    for folder in workarea.broken_off(spark, lake.area):
        request = workarea.staged(spark, folder)
        if request is not None:
            work = {"erase": _erase, "compact": _compacted}.get(request["run"], _publish)
            finished.append((request, work(spark, lake, folder, request), compared(folder, request)))
        remove(spark, folder)
    return finished


def _recovered_dates(spark: SparkSession, lake: Lake) -> list[str]:
    return sorted({d for _, report, _ in _recover(spark, lake) for d in report.dates})


# Models


@_job
def build_models(spark: SparkSession, lake: Lake, dates: list[str] | None = None) -> None:
    """Build staging from silver and the summary from staging.

    All of it, or only some event dates: a date is a group key, so rebuilding the
    dates that changed gives the same tables. Either way it goes month after month,
    which bounds the summary's shuffle.

    Readers of a table see it as the build before left it until all dates are written, then as
    this one does, in one step; staging switches before the summary. Catalog tables follow with
    ``register_tables``.
    """
    _ = lake.staging
    with workarea.exclusive(spark, lake.area):
        # Models must not see a silver partition some run left half replaced.
        recovered = _recovered_dates(spark, lake)
        _build(spark, lake, None if dates is None else sorted({*dates, *recovered}))


def _build(
    spark: SparkSession, lake: Lake, dates: list[str] | None, keep_previous: bool = True
) -> None:
    tables = (lake.staging, lake.summary)
    if dates == [] and (keep_previous or not versions.numbers(spark, lake.staging)):
        return
    if any(versions.unversioned(spark, table) for table in tables):
        dates = None
    version = versions.new_version()
    for _, month in publish.by_month(publish.partitions_of(spark, lake.silver, dates)):
        # Silver files hold one date each, so staging is written without a shuffle.
        folders = publish.date_folders(month)
        rows = stg_events(read_silver(spark, lake.silver, folders))
        versions.write_version(rows, lake.staging, version)
        days = [folder.rsplit("=", 1)[1] for folder in folders]
        staged = versions.read_version(spark, lake.staging, STAGING_SCHEMA, version, days)
        # Groups come out spread by all four keys; a date's few rows belong in one file.
        summary = daily_event_summary(staged).hint("rebalance", "event_date")
        versions.write_version(summary, lake.summary, version)
    for table in tables:
        versions.switch(spark, table, version, dates, keep_previous)


def read_staging(spark: SparkSession, path: str) -> DataFrame:
    return versions.read_current(spark, path, STAGING_SCHEMA)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    return versions.read_current(spark, path, SUMMARY_SCHEMA)


# Erasure and compaction


@_job
def erase_users(spark: SparkSession, lake: Lake, users: DataFrame) -> list[str]:
    """Remove all rows of the given ``user_id``s for good; return the dates that changed.

    The users are first added to the lake's list of erased users under a number of their own.
    Every load notes up to which number it has left users out, and compares under the lease it
    publishes with, so bronze need not be rewritten and a load beside the erasure brings nobody
    back. Then they leave silver, month after month, the rejected
    rows, and, if the lake has them, the models of the dates that changed. A request that is
    broken off is finished by the next job.
    """
    with workarea.run_folder(spark, lake.area) as folder:
        wanted = users.select(F.col("user_id").cast("string")).where("user_id is not null")
        publish.written_distinct(wanted, f"{folder}/users")
        request = {"run": "erase"}
        workarea.mark_staged(spark, folder, request)
        with workarea.exclusive(spark, lake.area):
            recovered = _recovered_dates(spark, lake)
            return sorted({*recovered, *_erase(spark, lake, folder, request).dates})


def _epochs(spark: SparkSession, lake: Lake) -> dict[int, str]:
    """The list of erased users by the number of the erasure that added them."""
    before = {0: f"{lake.erased}/part-*"} if matching(spark, f"{lake.erased}/part-*") else {}
    return before | workarea.epochs(spark, lake.erased)


def _erase(spark: SparkSession, lake: Lake, folder: str, request: dict) -> RunReport:
    users = spark.read.schema("user_id string").parquet(f"{folder}/users")
    listed, own = _epochs(spark, lake), f"{folder}/epoch"
    # Written first: an erasure that is finished later keeps its number.
    if not exists(spark, own):
        workarea.write_text(spark, own, str(1 + max(listed, default=0)))
    epoch = int(workarea.read_text(spark, own))
    users.write.mode("overwrite").parquet(f"{lake.erased}/epoch={epoch}")
    dates = _erase_rejected(spark, lake, folder, users)
    dates |= _erase_silver(spark, lake, folder, users)
    if lake.gold:
        # Versions that earlier readers might still read can hold the users' rows: none is kept.
        _build(spark, lake, sorted(dates), keep_previous=False)
    return RunReport(dates=sorted(dates))


def _erase_silver(spark: SparkSession, lake: Lake, folder: str, users: DataFrame) -> set[str]:
    # What an earlier attempt had begun comes first: silver is whole after it.
    dates = _finish_groups(spark, lake, folder)
    if not publish.partitions_of(spark, lake.silver, None):
        return dates
    touched = publish.keys_of(events_of(read_silver(spark, lake.silver), users))
    found = publish.partitions_of(spark, lake.silver, sorted({d for d, _ in touched}))
    found = [path for path in found if publish.key_of(path) in touched]
    for month, group in publish.by_month(found):
        current = read_silver(spark, lake.silver, group)
        publish.set_aside(spark, folder, month, group, without_users(current, users))
        publish.replace(spark, lake.silver, folder, month)
    return dates | {event_day for event_day, _ in touched}


def _finish_groups(spark: SparkSession, lake: Lake, folder: str) -> set[str]:
    """Complete the replacements that a run has prepared; the dates of all it prepared."""
    dates = set()
    for path in matching(spark, f"{folder}/group=*"):
        label = path.rsplit("=", 1)[1]
        if workarea.ready(spark, folder, label):
            dates |= {publish.key_of(x)[0] for x in publish.replaced_by(spark, folder, label)}
            if not workarea.done(spark, folder, label):
                publish.replace(spark, lake.silver, folder, label)
    return dates


def _erase_rejected(spark: SparkSession, lake: Lake, folder: str, users: DataFrame) -> set[str]:
    """Rewrite the slices that hold rows of the users; changes no event dates."""
    if not workarea.complete(spark, f"{folder}/{workarea.SLICES}"):
        if not quarantine.slices(spark, lake.rejected):
            return set()
        rows = _sliced(read_rejected(spark, lake.rejected)).withColumn("_user", _user_of())
        hit = events_of(rows, users, "_user").select("_slice").distinct()
        names = [r._slice for r in hit.collect()]
        touched = rows.where(F.col("_slice").isin(names))
        _set_slices_aside(spark, folder, without_users(touched, users, "_user").drop("_user"), names)
    _replace_slices(spark, lake, folder)
    return set()


def _sliced(rejected: DataFrame) -> DataFrame:
    """Rejected rows with the name of the slice they lie in."""
    pattern = rf"({SLICES[0]}=[^/]+/{SLICES[1]}=[^/]+)/[^/]+$"
    return rejected.withColumn("_slice", F.regexp_extract(F.col("_metadata.file_path"), pattern, 1))


def _set_slices_aside(spark: SparkSession, folder: str, rows: DataFrame, names: list[str]) -> None:
    """Write the rows that some slices are to hold; their list, which comes last, says that the
    replacement may begin."""
    rows.drop("_slice").write.mode("overwrite").parquet(f"{folder}/{workarea.ASIDE}")
    found = spark.createDataFrame([(name,) for name in names], "name string")
    found.write.mode("overwrite").parquet(f"{folder}/{workarea.SLICES}")


def _replace_slices(spark: SparkSession, lake: Lake, folder: str) -> None:
    """Put the rows set aside in place of their slices; may be repeated."""
    listed = spark.read.schema("name string").parquet(f"{folder}/{workarea.SLICES}").collect()
    names = {r.name for r in listed}
    slices = quarantine.slices(spark, lake.rejected)
    paths = [path for path, *_ in slices if "/".join(path.rsplit("/", 2)[1:]) in names]
    aside = spark.read.parquet(f"{folder}/{workarea.ASIDE}") if names else None
    quarantine.replace_slices(spark, lake.rejected, aside, paths)


#: Bytes of a silver file that compaction aims at, and how many files too many a partition may have.
TARGET_FILE, SPARE_FILES = 128 << 20, 1


@_job
def compact(
    spark: SparkSession, lake: Lake, target: int = TARGET_FILE, dates: list[str] | None = None
) -> list[str]:
    """Rewrite silver partitions with more files than their bytes need; return their dates.

    Rows stay as they are, so models need no rebuild. It goes month after month through the same
    replacement as a load. ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` bounds the rows
    of one file (before compression), ``spark.sql.files.maxPartitionBytes`` the splits read.
    """
    with workarea.run_folder(spark, lake.area) as folder, workarea.exclusive(spark, lake.area):
        _recover(spark, lake)
        found = publish.partitions_of(spark, lake.silver, dates)
        small = [path for path in found if _too_many(sizes(spark, path), target)]
        for month, group in publish.by_month(small):
            # No staged.json: broken off before a replacement, there is nothing to finish.
            publish.set_aside(spark, folder, month, group, read_silver(spark, lake.silver, group))
            workarea.mark_staged(spark, folder, {"run": "compact"})
            publish.replace(spark, lake.silver, folder, month)
        return sorted({publish.key_of(path)[0] for path in small})


@_job
def compact_rejected(spark: SparkSession, lake: Lake, target: int = TARGET_FILE) -> list[str]:
    """Rewrite slices of rejected rows with more files than their bytes need; return their names."""
    with workarea.run_folder(spark, lake.area) as folder, workarea.exclusive(spark, lake.area):
        _recover(spark, lake)
        found = [path for path, *_ in quarantine.slices(spark, lake.rejected)]
        names = ["/".join(p.rsplit("/", 2)[1:]) for p in found if _too_many(sizes(spark, p), target)]
        if names:
            rows = _sliced(read_rejected(spark, lake.rejected))
            _set_slices_aside(spark, folder, rows.where(F.col("_slice").isin(names)), names)
            workarea.mark_staged(spark, folder, {"run": "compact"})
            _replace_slices(spark, lake, folder)
        return sorted(names)


@_job
def compact_models(spark: SparkSession, lake: Lake, target: int = TARGET_FILE) -> list[str]:
    """Build the dates anew whose staging or summary has more files than its bytes need."""
    with workarea.exclusive(spark, lake.area):
        dates = set(_recovered_dates(spark, lake))
        for table in (lake.staging, lake.summary):
            listed = versions.current(spark, table) or {}
            dates |= {d for d, x in listed.items() if _too_many(sizes(spark, f"{table}/{x}"), target)}
        if dates:
            _build(spark, lake, sorted(dates))
        return sorted(dates)


def _compacted(spark: SparkSession, lake: Lake, folder: str, request: dict) -> RunReport:
    """Finish a compaction; no rows and no dates change by it."""
    _finish_groups(spark, lake, folder)
    if workarea.complete(spark, f"{folder}/{workarea.SLICES}"):
        _replace_slices(spark, lake, folder)
    return RunReport()


def _too_many(files: list[int], target: int) -> bool:
    return len(files) > max(1, -(-sum(files) // target)) + SPARE_FILES - 1


# Catalog, checks, and the whole day


@_job
def register_tables(
    spark: SparkSession, lake: Lake, database: str, dates: list[str] | None = None
) -> None:
    """Show silver, rejected, staging and summary, with their partitions, to SQL users.

    With ``dates`` only partitions of these event dates are brought up to date in silver if the
    catalog has it already. The partitions of staging and summary are pointed to the versions
    that the last build lists, one date after the other. Whether the tables outlive the session is up to its catalog.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    by_date = {"event_date": "date"}
    silver = {**by_date, "event_type": "string"}
    rejected = {column: "date" for column in SLICES}
    refresh_catalog(spark, f"{database}.silver", lake.silver, SILVER_SCHEMA, silver, dates=dates)
    refresh_catalog(
        spark,
        f"{database}.rejected",
        lake.rejected,
        rejected_schema(),
        rejected,
        "json",
        REJECTED_OPTIONS,
    )
    if lake.gold:
        refresh_versions(spark, f"{database}.stg_events", lake.staging, STAGING_SCHEMA)
        refresh_versions(spark, f"{database}.daily_event_summary", lake.summary, SUMMARY_SCHEMA)


@_job
def run_day(
    spark: SparkSession,
    lake: Lake,
    run_date: date,
    database: str,
    run_ts: datetime | None = None,
) -> tuple[RunReport, list]:
    """A whole day: load, catalog, source checks, models, model checks.

    Source checks come before the models, so bad silver never reaches the mart. Only the dates
    that changed are checked, against all others where a check spans dates.
    """
    loaded = run_daily(spark, lake, run_date, run_ts)
    register_tables(spark, lake, database, loaded.dates)
    checked = check_source(spark, lake, loaded.dates)
    build_models(spark, lake, loaded.dates)
    register_tables(spark, lake, database, loaded.dates)
    return loaded, checked + check_models(spark, lake, loaded.dates)


def check_source(spark: SparkSession, lake: Lake, dates: list[str] | None = None) -> list:
    """Report rows of the checks on silver; raises QualityError when one fails."""
    return enforce(source_report(spark, lake, dates))


def check_models(spark: SparkSession, lake: Lake, dates: list[str] | None = None) -> list:
    return enforce(model_report(spark, lake, dates))


def source_report(spark: SparkSession, lake: Lake, dates: list[str] | None = None) -> DataFrame:
    return _report(spark, lake, {"silver": _silver(spark, lake)}, SOURCE_CHECKS, dates)


def model_report(spark: SparkSession, lake: Lake, dates: list[str] | None = None) -> DataFrame:
    tables = {
        "stg_events": read_staging(spark, lake.staging),
        "daily_event_summary": read_summary(spark, lake.summary),
    }
    return _report(spark, lake, tables, MODEL_CHECKS, dates)


@_job
def reindex(spark: SparkSession, lake: Lake) -> int:
    """Build the id index anew from silver; the number of its entries."""
    with workarea.exclusive(spark, lake.area):
        _recover(spark, lake)
        return id_index.rebuild(spark, lake.silver)


def _report(
    spark: SparkSession, lake: Lake, tables: dict, checks: tuple, dates: list[str] | None
) -> DataFrame:
    """The report on all or some dates; the id index says which others may hold their ids."""
    if dates is None:
        return quality.report(tables, checks)
    among = None
    if id_index.current(spark, lake.silver):
        ids = read_silver(spark, lake.silver).where(F.col("event_date").cast("string").isin(*dates))
        ids = ids.where("event_id is not null").select(id_index.hashed()).distinct()
        hinted = id_index.hints(spark, lake.silver, ids).select(F.col("event_date").cast("string"))
        among = sorted(r.event_date for r in hinted.distinct().collect())
    return quality.report_dates(tables, checks, dates, among)


def _silver(spark: SparkSession, lake: Lake) -> DataFrame:
    if not matching(spark, f"{lake.silver}/event_date=*"):
        return empty(spark, SILVER_SCHEMA)
    return read_silver(spark, lake.silver)


def stored_anomalies(spark: SparkSession, lake: Lake) -> DataFrame:
    """Anomaly rates from the quarantine and silver; bronze is not read."""
    prepare(spark)
    return monitor.stored_anomalies(read_rejected(spark, lake.rejected), _silver(spark, lake))


def drift(spark: SparkSession, lake: Lake, contract: tuple[str, ...], start: date, end: date) -> DataFrame:
    """Fields seen in some days' folders against the contract."""
    days, _ = bronze_source.folders(prepare(spark), lake.bronze)
    paths = [path for path, filed in days if start <= filed <= end]
    lines = spark.read.text(paths) if paths else empty(spark, "value string")
    return monitor.schema_drift(lines, "value", contract)


def type_drift(spark: SparkSession, lake: Lake, start: date, end: date) -> DataFrame:
    """Fields, at any depth, whose type changed between the days' folders of a range."""
    days, _ = bronze_source.folders(prepare(spark), lake.bronze)
    paths = [path for path, filed in days if start <= filed <= end]
    lines = spark.read.text(paths) if paths else empty(spark, "value string")
    dated = lines.withColumn("day", bronze_source.folder_date(F.col("_metadata.file_path")) if paths else F.lit(None).cast("date"))
    return monitor.type_changes(monitor.field_types(dated, "value", "day"))
