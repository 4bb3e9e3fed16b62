"""The given ``events`` table in the shape of the event contract, for both engines."""

import uuid
from dataclasses import replace
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.contract import CORRUPT, EVENT_COLUMNS
from eventlake.operators.transform import to_silver
from eventlake.operators.validate import classify, good
from eventlake.plans.jobs import Lake, build_models, run_backfill
from eventlake.session import prepare, shared_folder

CUT_LINE = '{"event_id": "e0000'
RUN_TS = datetime(2024, 2, 1, 2, 0, tzinfo=timezone.utc)

_SPARK_TS = "date_format({}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"
_DUCKDB_TS = "strftime({}, '%Y-%m-%dT%H:%M:%S.%f')"
SPARK_SLOTS = {
    "ts": _SPARK_TS.format("ts"),
    "east": _SPARK_TS.format("ts + interval 2 hours"),
    "west": _SPARK_TS.format("ts - interval 330 minutes"),
    "day": "date_format(ts, 'yyyyMMdd')",
    "k": "cast(get_json_object(props, '$.k') as int)",
}
DUCKDB_SLOTS = {
    "ts": _DUCKDB_TS.format("ts"),
    "east": _DUCKDB_TS.format("ts + interval 2 hours"),
    "west": _DUCKDB_TS.format("ts - interval 330 minutes"),
    "day": "strftime(ts, '%Y%m%d')",
    "k": "cast(json_extract_string(props, '$.k') as int)",
}

# One text for both engines. One event in 16 is bad, by one rule each; one in 500 is filed under
# the day before its own, like an export that runs past midnight. One in 1000 is a line that was
# cut off, one in 1000 comes twice (but for a few days, kept clean for jobs that refuse copies),
# some carry another offset, a missing duration or flag, or a duration as an integral decimal.
FIELDS_SQL = """
select
  case when event_id % 80 = 3 then null
       else concat('e', lpad(cast(event_id as varchar(20)), 10, '0')) end as event_id,
  case when event_id % 80 = 43 then 'around noon'
       when event_id % 7 = 1 then concat({east}, '+02:00')
       when event_id % 7 = 2 then concat({west}, '-05:30')
       when event_id % 7 = 3 then concat({ts}, 'Z')
       else concat({ts}, '+00:00') end as event_timestamp,
  case when event_id % 160 = 150 then null
       when event_id % 160 = 151 then concat('x-', event_type)
       when event_type = 'view' then 'document_view'
       when event_type = 'click' then 'document_download'
       when event_type = 'purchase' then 'quiz_attempt'
       when event_type = 'signup' then 'signup'
       when {k} % 2 = 0 then 'search' else 'login' end as event_type,
  case when event_id % 80 = 63 then null
       else concat('u', cast(user_id as varchar(20))) end as user_id,
  concat('s', cast(user_id as varchar(20)), '/', {day}) as session_id,
  concat('d', cast((event_id * 31) % 977 as varchar(20))) as document_id,
  concat('n', cast(user_id % 25 as varchar(20))) as university_id,
  concat('C', cast(user_id % 25 as varchar(20))) as country_code,
  concat('kind-', cast(event_id % 3 as varchar(20))) as device_type,
  concat('/d/', cast((event_id * 31) % 977 as varchar(20)), '?k=', cast({k} as varchar(20)))
    as page_url,
  case when event_id % 6 = 5 then null
       else concat('r', cast(event_id % 6 as varchar(20))) end as referrer,
  case when event_id % 80 = 23 then 'a while'
       when event_id % 11 = 4 then null
       when event_id % 13 = 5 then concat(cast(cast(floor(value) as int) as varchar(20)), '.0')
       else cast(cast(floor(value) as int) as varchar(20)) end as duration_seconds,
  case when event_id % 17 = 6 then null when user_id % 5 = 0 then 'true' else 'false' end
    as is_premium_user,
  case when event_id % 500 = 7 then cast(ts as date) - 1
       else cast(ts as date) end as folder_date,
  event_id % 1000 = 33 as cut,
  event_id % 1000 = 17
    and cast(ts as date) not between date '2024-01-04' and date '2024-01-08' as twice
from events
"""
_LINE = ", ".join(f"case when cut then null else {c} end as {c}" for c in EVENT_COLUMNS)
BRONZE_SQL = f"""
select {_LINE}, folder_date, cut from (
  select * from ({FIELDS_SQL}) f union all select * from ({FIELDS_SQL}) f where twice) g
"""

# One line of nested JSON per event, whose fields change in the course of the table: a number
# becomes text, an object gets a field, an array is missing for a day; one line in 700 is cut off.
# Braces are written as parentheses, which both engines translate.
NESTED_SQL = """
select event_id, cast(ts as date) as day, translate(
  case when event_id % 700 = 9 then '("id": 1, "user": ('
  else concat('("id": ', cast(event_id as varchar(20)),
    ', "user": ("id": "u', cast(user_id as varchar(20)), '", "plan": ',
    case when user_id % 5 = 0 then '"premium"' else 'null' end,
    case when cast(ts as date) < date '2024-01-20' then ''
         else concat(', "age": ', cast(user_id % 90 as varchar(20))) end,
    '), "value": ',
    case when cast(ts as date) < date '2024-01-12' then cast(cast(floor(value) as int) as varchar(20))
         when event_id % 2 = 0 then concat('"', cast(cast(floor(value) as int) as varchar(20)), '"')
         else '"a lot"' end,
    case when cast(ts as date) = date '2024-01-08' then ''
         else concat(', "tags": [("name": "', event_type, '", "weight": ', cast({k} as varchar(20)), ')]') end,
    ')') end, '()', concat(chr(123), chr(125))) as line
from events
"""


def nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, day, line) of the nested lines."""
    sql = NESTED_SQL.format(**SPARK_SLOTS).replace("from events", "from {events}")
    return spark.sql(sql, events=events(spark, sf_dir))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/events.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 13 raw text fields, whether the line is cut off, and the date of the folder it is in."""
    sql = BRONZE_SQL.format(**SPARK_SLOTS).replace("from events", "from {events}")
    rows = spark.sql(sql, events=events(spark, sf_dir))
    return rows.withColumn(CORRUPT, F.when(F.col("cut"), CUT_LINE))


def first_state(rows: DataFrame) -> DataFrame:
    """The events as an export had them before corrections: some a day earlier, of another type,
    or with the fault still to come."""
    number = F.substring("event_id", 2, 20).try_cast("long")
    earlier = F.try_to_timestamp("event_timestamp") - F.expr("interval 1 day")
    text = F.concat(F.date_format(earlier, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    whole = F.col("event_type").isin("search", "login") & (number % 9 == 5)
    return rows.withColumns(
        {
            "event_timestamp": F.when((number % 9 == 2) & text.isNotNull(), text).otherwise(
                F.col("event_timestamp")
            ),
            "event_type": F.when(whole, "signup").otherwise(F.col("event_type")),
            "user_id": F.coalesce("user_id", F.lit("u0")),
        }
    )


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(bronze(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(good(classified(spark, sf_dir)), RUN_TS)


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(prepare(spark))}/{name}-{uuid.uuid4().hex}"


def write_bronze(
    spark: SparkSession,
    sf_dir: str,
    root: str,
    day_folders: bool = True,
    change=lambda rows: rows,
    mode: str = "error",
) -> str:
    """The events as NDJSON; NULL fields are left out of a line.

    Without ``day_folders`` all lines lie in one folder with a plain name.
    """
    rows = change(bronze(spark, sf_dir))
    filed = F.col("folder_date").cast("string")
    year = F.left(filed, F.length(filed) - 6)
    parts = {"year": year, "month": F.substring(filed, -5, 2), "day": F.right(filed, F.lit(2))}
    lines = rows.select(
        F.coalesce(CORRUPT, F.to_json(F.struct(*EVENT_COLUMNS))).alias("value"),
        *(value.alias(name) for name, value in parts.items()),
    )
    if day_folders:
        lines.hint("rebalance", *parts).write.mode(mode).partitionBy(*parts).text(root)
    else:
        lines.select("value").write.text(f"{root}/export/all")
    return root


_prepared: dict[tuple, object] = {}


def _once(spark: SparkSession, name: str, sf_dir: str, make):
    key = (spark.sparkContext.applicationId, name, sf_dir)
    if key not in _prepared:
        _prepared[key] = make()
    return _prepared[key]


def bronze_tree(spark: SparkSession, sf_dir: str) -> str:
    """The NDJSON tree of the events, written once per application."""
    return _once(
        spark, "bronze", sf_dir, lambda: write_bronze(spark, sf_dir, new_folder(spark, "bronze"))
    )


def date_bounds(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    return tuple(events(spark, sf_dir).agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first())


def empty_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The events' bronze tree with nothing published from it yet."""
    root = new_folder(spark, "lake")
    return Lake(bronze_tree(spark, sf_dir), f"{root}/silver", f"{root}/rejected", f"{root}/gold")


def bare_lake(spark: SparkSession) -> Lake:
    """An empty lake for queries that load nothing; there is no bronze."""
    root = new_folder(spark, "lake")
    return Lake(*(f"{root}/{layer}" for layer in ("bronze", "silver", "rejected", "gold")))


def own_bronze(spark: SparkSession, sf_dir: str, change=lambda rows: rows) -> Lake:
    """An empty lake over a bronze tree of its own, with changed rows."""
    lake = bare_lake(spark)
    write_bronze(spark, sf_dir, lake.bronze, change=change)
    return lake


def backfill(spark: SparkSession, sf_dir: str, lake: Lake, **how) -> Lake:
    run_backfill(spark, lake, *date_bounds(spark, sf_dir), run_ts=RUN_TS, **how)
    return lake


def full_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Silver, rejected and both models of the events, built once per application."""

    def make():
        lake = backfill(spark, sf_dir, empty_lake(spark, sf_dir))
        build_models(spark, lake)
        return lake

    return _once(spark, "lake", sf_dir, make)


def own_gold(spark: SparkSession, lake: Lake) -> Lake:
    return replace(lake, gold=new_folder(spark, "gold"))
