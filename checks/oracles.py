"""The same results as plain DuckDB SQL over the given tables."""

from checks.fixture import BRONZE_SQL, DUCKDB_SLOTS, NESTED_SQL
from checks.queries import DRIFT_CONTRACT

# Lists of its own, so that a value or column lost in the engine shows as a difference.
# The fields of an event, the types it may have, the columns of the tables.
EVENT_COLUMNS = (
    "event_id event_timestamp event_type user_id session_id document_id university_id country_code"
    " device_type page_url referrer duration_seconds is_premium_user"
).split()
TYPES = "'document_view', 'document_download', 'search', 'signup', 'login', 'quiz_attempt'"
SILVER_COLUMNS = [c for c in EVENT_COLUMNS if c != "event_type"]
SILVER_COLUMNS += ["ingestion_timestamp", "event_date", "event_type"]
STAGING_COLUMNS = [*EVENT_COLUMNS, "ingestion_timestamp", "event_date"]
RAW = ", ".join(EVENT_COLUMNS)
SHOWN = {
    "event_timestamp": "strftime(event_timestamp, '%Y-%m-%d %H:%M:%S.%f') as event_timestamp",
    "event_date": "strftime(event_date, '%Y-%m-%d') as event_date",
    "ingestion_timestamp": "'2024-02-01 02:00:00.000000' as ingestion_timestamp",
}
UNSTAMPED = ", ".join(
    SHOWN.get(c, c) for c in SILVER_COLUMNS if c != "ingestion_timestamp"
)
STAMPED = ", ".join(SHOWN.get(c, c) for c in SILVER_COLUMNS)
STAGED = ", ".join(SHOWN.get(c, c) for c in STAGING_COLUMNS)

# Whole seconds may carry an integral decimal; an instant is written in UTC.
DURATION = "try_cast(regexp_replace(duration_seconds, '[.]0$', '') as int)"
INSTANT = "try_cast(event_timestamp as timestamptz) at time zone 'UTC'"

CHAIN = f"""
with bronze as ({BRONZE_SQL.format(**DUCKDB_SLOTS)}),
v as (
  select *, {INSTANT} as instant,
    case
      when event_id is null then 'missing_event_id'
      when user_id is null then 'missing_user_id'
      when event_type is null then 'missing_event_type'
      when event_type not in ({TYPES}) then 'invalid_event_type'
      when {INSTANT} is null then 'bad_timestamp'
      when {DURATION} is null and duration_seconds is not null then 'duration_not_integer'
    end as validation_error
  from bronze),
silver as (
  select event_id, instant as event_timestamp, event_type, user_id, session_id, document_id,
    university_id, country_code, device_type, page_url, referrer, {DURATION} as duration_seconds,
    try_cast(is_premium_user as boolean) as is_premium_user,
    cast(instant as date) as event_date, folder_date
  from v where validation_error is null)
"""

SUMMARY = CHAIN + """
select strftime(day, '%Y-%m-%d') as event_date, event_type, device_type, country_code,
  mean as avg_duration_seconds, premium as premium_user_events, docs as unique_documents,
  sessions as unique_sessions, users as unique_users, n as event_count
from (
  select g.event_date as day, event_type, device_type, country_code, count(*) as n,
    count(*) filter (where is_premium_user) as premium, count(distinct document_id) as docs,
    count(distinct session_id) as sessions, count(distinct user_id) as users,
    sum(duration_seconds)::double / count(duration_seconds) as mean
  from silver g {where} group by all) daily
"""

DIRTY = f"""{CHAIN},
tables as (
  select 'silver' as t, event_id, user_id, event_type, cast(event_timestamp as varchar) as seen_at
  from silver
  union all
  select 'bronze', event_id, user_id, event_type, event_timestamp from bronze
  union all
  select 'silver_with_copies', event_id, user_id, event_type, cast(event_timestamp as varchar)
  from silver
  union all
  select 'silver_with_copies', event_id, user_id, event_type, cast(event_timestamp as varchar)
  from silver where event_type = 'signup'),
names as (select distinct t from tables)
"""


def _not_null(column: str, source: str) -> str:
    return (
        f"select t as \"table\", '{column}' as \"column\", 'not_null' as \"check\", "
        f"count(*) - count({source}) as failures from tables group by t"
    )


def _failing_values(column: str, check: str, having: str) -> str:
    return (
        f"select n.t as \"table\", '{column}' as \"column\", '{check}' as \"check\", "
        f"count(f.t) as failures from names n left join ("
        f"select t, {column} from tables where {column} is not null "
        f"group by t, {column} having {having}) f on f.t = n.t group by n.t"
    )


DQ_REPORT = f"""{CHAIN},
mart as (
  select country_code, event_type, device_type, event_date, count(*) as event_count,
    count(distinct user_id) as unique_users
  from silver group by country_code, event_type, device_type, event_date),
copies as (
  select count(*) as n from
    (select event_id from silver where event_id is not null group by event_id having count(*) > 1)),
others as (
  select count(distinct event_type) as n from silver where event_type not in ({TYPES})),
s as (select count(*) - count(event_id) as i, count(*) - count(user_id) as u,
    count(*) - count(event_type) as y, count(*) - count(event_timestamp) as z from silver),
m as (select count(*) - count(event_date) as d, count(*) - count(event_count) as c,
    count(*) - count(unique_users) as u from mart)
select 'silver' as "table", 'event_id' as "column", 'not_null' as "check", i as failures from s
union all select 'silver', 'event_id', 'unique', n from copies
union all select 'silver', 'user_id', 'not_null', u from s
union all select 'silver', 'event_type', 'not_null', y from s
union all select 'silver', 'event_type', 'accepted_values', n from others
union all select 'silver', 'event_timestamp', 'not_null', z from s
union all select 'stg_events', 'event_id', 'not_null', i from s
union all select 'stg_events', 'event_id', 'unique', n from copies
union all select 'daily_event_summary', 'event_date', 'not_null', d from m
union all select 'daily_event_summary', 'event_count', 'not_null', c from m
union all select 'daily_event_summary', 'unique_users', 'not_null', u from m
"""

ANOMALIES = f"""{CHAIN},
per_rule as (
  select cast(instant as date) as d, validation_error, count(*) as n from v group by all),
rated as (
  select d, validation_error, n,
    round(cast(100.0 as double) * n / cast(sum(n) over (partition by d) as bigint), 2) as rate
  from per_rule)
select strftime(d, '%Y-%m-%d') as event_date, validation_error, n as rows, rate
from rated where validation_error is not null
"""

ENRICHED = f"""{CHAIN}
select n_name, c_mktsegment, count(*) as events, count(distinct user_id) as users
from silver left join customer on user_id = concat('u', cast(c_custkey as varchar))
left join nation on c_nationkey = n_nationkey
group by n_name, c_mktsegment
"""

WITH_CUSTOMER = f"""{CHAIN}
select event_id, strftime(event_date, '%Y-%m-%d') as event_date, user_id, n_name, c_mktsegment
from silver left join customer on user_id = concat('u', cast(c_custkey as varchar))
left join nation on c_nationkey = n_nationkey
"""

DRIFT = (
    CHAIN
    + " union all ".join(
        f"select '{c}' as field, count({c}) as rows, "
        f"'{'ok' if c in DRIFT_CONTRACT else 'unexpected'}' as status from bronze"
        for c in EVENT_COLUMNS
    )
    + " union all select 'campaign', cast(0 as bigint), 'missing'"
)

REJECTED = f"""{CHAIN}
select {RAW}, validation_error, '2024-02-01 02:00:00.000000' as rejected_at, 'backfill' as run,
  '2024-02-01' as ingest_date, strftime(folder_date, '%Y-%m-%d') as folder_date,
  strftime(coalesce(cast(instant as date), folder_date), '%Y-%m-%d') as filed_date
from v where validation_error is not null
"""

# Text that is cut off is no JSON; names are those of the other engine's types.
NESTED = f"""
with lines as (select event_id, day, case when json_valid(line) then line end as line
  from ({NESTED_SQL.format(**DUCKDB_SLOTS)}) n)
"""
DYNAMIC_PATHS = f"""{NESTED}
select l.event_id, json_extract_string(line, '$.user.id') as user_id,
  json_extract_string(line, '$.user.plan') as plan,
  try_cast(json_extract_string(line, '$.user.age') as int) as age,
  try_cast(json_extract_string(line, '$.value') as int) as value,
  json_extract_string(line, '$.tags[0].name') as tag,
  try_cast(json_extract_string(line, '$.tags[0].weight') as double) as weight,
  try_cast(json_extract_string(line, '$.tags[0].name') as int) as name_as_number,
  json_extract_string(line, '$.tags[1].name') as beyond,
  try_cast(json_extract_string(props, '$.k') as int) as k
from lines l join events e on e.event_id = l.event_id
"""
TYPE_CHANGES = f"""{NESTED},
paths as (select unnest(['id', 'user.id', 'user.plan', 'user.age', 'value', 'tags[].name', 'tags[].weight']) as path),
seen as (
  select day, path, json_type(line, '$.' || replace(path, '[]', '[0]')) as t
  from lines, paths where line is not null),
kinds as (
  select day, path,
    case when count(distinct t) filter (where t <> 'NULL') > 1 then 'variant'
      when max(t) filter (where t <> 'NULL') is null then 'void'
      else case max(t) filter (where t <> 'NULL') when 'VARCHAR' then 'string' else 'bigint' end end as type
  from seen where t is not null group by day, path),
days as (select day, lead(day) over (order by day) as next_day from (select distinct day from lines where line is not null)),
old as (select next_day as day, path, type from kinds join days using (day) where next_day is not null),
new as (select day, path, type from kinds where day > (select min(day) from days)),
changes as (
  select coalesce(n.day, o.day) as day, coalesce(n.path, o.path) as path, n.type as type, o.type as type_before
  from old o full join new n on n.day = o.day and n.path = o.path where n.type is distinct from o.type)
select strftime(c.day, '%Y-%m-%d') as day, path, type, type_before,
  case when type_before is null then 'new' when type is null then 'gone' else 'changed' end as status
from changes c
"""

PUBLISHED = f"{CHAIN} select {UNSTAMPED} from silver"
LEFT = (
    f"{PUBLISHED} where user_id not in (select concat('u', cast(c_custkey as varchar)) from customer "
    "where c_mktsegment = 'BUILDING')"
)

ORACLES = {
    "bronze_scan": f"{CHAIN} select {RAW} from bronze",
    "bronze_daily_slice": f"{CHAIN} select event_id, user_id from bronze "
    "where folder_date = date '2024-01-05'",
    "bronze_recursive": f"{CHAIN} select {RAW} from bronze",
    "silver_scan": f"{CHAIN} select strftime(s.event_date, '%Y-%m-%d') as event_date, event_type, "
    "count(*) as events from silver s where s.event_date between date '2024-01-10' "
    "and date '2024-01-19' and event_type = 'search' group by s.event_date, event_type",
    "event_date_range": f"{CHAIN}, ranged as (select * from silver where event_date "
    f"between date '2024-01-10' and date '2024-01-20') select {UNSTAMPED} from ranged",
    "validate_rules": f"{CHAIN} select {RAW}, validation_error from v",
    "valid_rows": f"{CHAIN} select {RAW} from v where validation_error is null",
    "rejected_rows": f"{CHAIN} select {RAW}, validation_error from v "
    "where validation_error is not null",
    "silver_transform": PUBLISHED,
    "silver_roundtrip": f"{CHAIN} select {STAMPED} from silver",
    "silver_upsert": PUBLISHED,
    "silver_layout": f"{CHAIN} select strftime(s.event_date, '%Y-%m-%d') as event_date, "
    "event_type, count(*) as rows, cast(1 as bigint) as files from silver s "
    "group by s.event_date, event_type",
    "rejected_roundtrip": REJECTED,
    "stg_events": f"{CHAIN} select {STAGED} from silver",
    "daily_event_summary": SUMMARY.format(where=""),
    "daily_event_summary_table": SUMMARY.format(where=""),
    "daily_load": f"{PUBLISHED} where folder_date between date '2024-01-05' and date '2024-01-06'",
    "whole_day": SUMMARY.format(where="where folder_date = date '2024-01-05'"),
    "models_between_versions": f"""{CHAIN}
      select phase, reader, strftime(event_date, '%Y-%m-%d') as event_date, count(*) as events
      from silver cross join (select unnest(['between', 'after']) as phase) phases
        cross join (select unnest(['summary', 'catalog']) as reader) readers
      where folder_date = date '2024-01-05'
        or (folder_date = date '2024-01-06' and phase = 'after')
      group by phase, reader, event_date""",
    "catalog_refresh": f"{CHAIN} select strftime(s.event_date, '%Y-%m-%d') as event_date, "
    "count(*) as events from silver s group by s.event_date",
    "rejected_table": f"{CHAIN} select 'backfill' as run, validation_error, count(*) as rows from v "
    "where validation_error is not null group by validation_error",
    "run_counts": f"{CHAIN} select count(*) as bronze_rows, "
    "count(*) - count(validation_error) as good_rows, count(validation_error) as bad_rows from v",
    "rejection_rate": f"{CHAIN} select round(cast(100.0 as double) * count(validation_error) "
    "/ nullif(count(*), 0), 2) as rejection_rate from v",
    "dq_not_null": DIRTY
    + " union all ".join(
        _not_null(column, source)
        for column, source in (
            ("event_id", "event_id"),
            ("user_id", "user_id"),
            ("event_type", "event_type"),
            ("event_timestamp", "seen_at"),
        )
    ),
    "dq_unique": DIRTY + _failing_values("event_id", "unique", "count(*) > 1"),
    "dq_accepted_values": DIRTY
    + _failing_values("event_type", "accepted_values", f"event_type not in ({TYPES})"),
    "dq_report": DQ_REPORT,
    "anomaly_rate": ANOMALIES,
    "events_enriched": ENRICHED,
    "events_with_customer": WITH_CUSTOMER,
    "schema_drift": DRIFT,
    "dynamic_fields": "select event_id, json_extract_string(props, '$.k') as k from events",
    "dynamic_paths": DYNAMIC_PATHS,
    "schema_drift_types": TYPE_CHANGES,
    "backfill_batches": PUBLISHED,
    "backfill_single_scan": PUBLISHED,
    "backfill_beside_daily": PUBLISHED,
    "backfill_resumed": f"{CHAIN} select {UNSTAMPED}, "
    "cast(1 as bigint) as passes_over_bronze from silver",
    "backfill_with_stray_file": f"{CHAIN} select {RAW}, validation_error from v "
    "where validation_error is not null "
    "and coalesce(cast(instant as date), folder_date) between date '2024-01-10' "
    "and date '2024-01-20'",
    "silver_corrections": PUBLISHED,
    "silver_compacted": f"{CHAIN}, per as (select s.event_date, event_type, count(*) as n "
    "from silver s group by s.event_date, event_type) select strftime(p.event_date, '%Y-%m-%d') "
    "as event_date, event_type, n as rows, cast(1 as bigint) as files from per p",
    "rejected_compacted": f"""{CHAIN},
      slices as (select folder_date, coalesce(cast(instant as date), folder_date) as filed_date, count(*) as n
        from v where validation_error is not null group by all)
      select strftime(s.folder_date, '%Y-%m-%d') as folder_date,
        strftime(s.filed_date, '%Y-%m-%d') as filed_date, n as rows, cast(1 as bigint) as files from slices s""",
    "anomaly_rate_stored": ANOMALIES,
    "dq_report_incremental_whole": f"""{CHAIN},
      lakes as (select unnest(['none', 'inside', 'near', 'far']) as lake),
      days as (select date '2024-01-05' as day
        union select cast(ts as date) from events where event_id = 17),
      held as (select lake, event_id, event_date from lakes, silver
        union all select lake,
          (select min(event_id) from silver where event_date = date '2024-01-05'),
          case lake when 'inside' then date '2024-01-05' when 'near' then date '2024-01-06'
            else (select max(event_date) from silver) end
        from lakes where lake <> 'none'),
      repeated as (select lake, event_id from held group by lake, event_id having count(*) > 1),
      found as (select lake, event_date, count(distinct event_id) as f
        from held semi join repeated using (lake, event_id) group by lake, event_date)
      select lakes.lake, cast(day as varchar) as day, "table", cast(coalesce(f, 0) as int) as f
      from lakes cross join days
        cross join (select unnest(['silver', 'stg_events']) as "table") names
        left join found on found.lake = lakes.lake and found.event_date = day""",
    "erase_users_lasting": f"""{CHAIN},
      gone as (select concat('u', cast(c_custkey as varchar)) as g from customer
        where c_mktsegment = 'BUILDING'),
      stays as (select * from silver where user_id not in (select g from gone)),
      bad as (select * from v where validation_error is not null
        and (user_id is null or user_id not in (select g from gone)))
      select 'silver' as layer, count(*) as rows, cast(0 as bigint) as rows_of_erased from stays
      union all select 'rejected', count(*), 0 from bad
      union all select 'stg_events', count(*), 0 from stays
      union all select 'daily_event_summary', count(*), 0 from stays""",
    "erase_users": LEFT,
    "erase_users_beside_load": LEFT,
    "daily_resumed_after_new_file": f"{PUBLISHED} where folder_date = date '2024-01-05'",
}
