"""DuckDB SQL for each driver query (the correctness oracle).

Written independently of the Spark code: plain SQL over the registered
views. Shared CTE text is composed from small helpers below.
"""

from __future__ import annotations

FEED = """feed as (
  select user_id, event_type, value::decimal(18,2) as value,
         strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as current_ts,
         event_id::varchar as pos,
         strftime(date_trunc('day', ts), '%Y%m%d%H%M%S') as batchno
  from events)"""

W1_ORDER = (
    "kafka_ts desc nulls last, try_cast(trail_file_pos as decimal(38,0)) desc nulls last, "
    "trail_file_pos desc nulls last"
)
W2_ORDER = (
    "try_cast(trail_file_pos as decimal(38,0)) desc nulls last, trail_file_pos desc nulls last, "
    "kafka_ts desc nulls last, src asc"
)

ROW_KEY = "regexp_replace(concat_ws('', user_id, kafka_ts), '[-:.,/ ]', '', 'g')"


def landing(name: str, where: str, run_ts: str) -> str:
    """Selected + renamed landing rows, latest per key (W1), not yet cast."""
    return f"""{name} as (
  select user_id, event_type, value, current_ts as kafka_ts, pos as trail_file_pos,
         '{run_ts}' as last_updated_date
  from feed where {where}
  qualify row_number() over (partition by user_id order by {W1_ORDER}) = 1)"""


def prepared(name: str, src: str, date: bool = False) -> str:
    """Cast-all + derived columns on top of a landing CTE."""
    if date:
        parts = (
            "year(try_cast(kafka_ts as timestamp))::int as part_1, "
            "month(try_cast(kafka_ts as timestamp))::int as part_2, "
            "try_cast(kafka_ts as timestamp)::date as part_3"
        )
    else:
        parts = "substring(event_type, 1, 3) as part_1"
    return f"""{name} as (
  select user_id::varchar as user_id, event_type, value::varchar as value, kafka_ts,
         trail_file_pos, last_updated_date,
         {ROW_KEY} as row_key, {parts}
  from {src})"""


def merged(name: str, delta: str, base: str, parts: list[str], order: str = W2_ORDER, whole: bool = False) -> str:
    match = " and ".join(f"{delta}.{p} is not distinct from {base}.{p}" for p in parts)
    scope = "" if whole else f" where exists (select 1 from {delta} where {match})"
    return f"""{name} as (
  select * exclude (src) from (
    select *, 1 as src from {delta}
    union all
    select *, 0 as src from {base}{scope}
  ) qualify row_number() over (partition by user_id order by {order}) = 1)"""


def batch_between(lo: str, hi: str) -> str:
    return f"batchno >= '{lo}' and batchno <= '{hi}'"


BASE_RUN_TS = "2024-01-20 00:00:00"
DELTA_RUN_TS = "2024-01-22 00:00:00"
SECOND_RUN_TS = "2024-01-23 00:00:00"
BASE_WHERE = batch_between("20240101000000", "20240119000000")
DELTA_WHERE = batch_between("20240120000000", "20991231000000")
ALL_WHERE = batch_between("20240101000000", "20991231000000")


def _with(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


SQL: dict[str, str] = {}

SQL["latest_in_delta"] = _with(FEED, landing("d", ALL_WHERE, DELTA_RUN_TS)) + "select * from d"

SQL["scd1_merge"] = _with(
    FEED,
    landing("bl", BASE_WHERE, BASE_RUN_TS),
    prepared("b", "bl"),
    landing("dl", DELTA_WHERE, DELTA_RUN_TS),
    prepared("d", "dl"),
    merged("m", "d", "b", ["part_1"]),
) + "select * from m"

SQL["scd1_merge_untouched_partitions"] = _with(
    FEED,
    landing("bl", BASE_WHERE, BASE_RUN_TS),
    prepared("b", "bl"),
    landing("dl", DELTA_WHERE + " and event_type in ('click', 'view')", DELTA_RUN_TS),
    prepared("d", "dl"),
    merged("m", "d", "b", ["part_1"]),
) + "select * from m"

# the same merge against the snapshot kept as a bucketed catalog table
SQL["scd1_merge_bucketed"] = SQL["scd1_merge_untouched_partitions"]


SQL["scd1_multi_part"] = _with(
    FEED,
    landing("bl", batch_between("20240101000000", "20240120000000"), BASE_RUN_TS),
    prepared("b", "bl", date=True),
    landing("dl", DELTA_WHERE, DELTA_RUN_TS),
    prepared("d", "dl", date=True),
    merged("m", "d", "b", ["part_1", "part_2", "part_3"]),
) + "select * from m"


SQL["scd1_merge_lexicographic"] = _with(
    FEED,
    landing("bl", BASE_WHERE, BASE_RUN_TS),
    prepared("b", "bl"),
    landing("dl", DELTA_WHERE, DELTA_RUN_TS),
    prepared("d", "dl"),
    merged("m", "d", "b", ["part_1"], order="trail_file_pos desc nulls last, kafka_ts desc nulls last, src asc"),
) + "select * from m"

SQL["scd1_merge_global_keys"] = _with(
    FEED,
    landing("bl", BASE_WHERE, BASE_RUN_TS),
    prepared("b", "bl"),
    landing("dl", DELTA_WHERE + " and event_type in ('click', 'view')", DELTA_RUN_TS),
    prepared("d", "dl"),
    merged("m", "d", "b", ["part_1"], whole=True),
) + "select * from m"

SQL["incremental_filter"] = "select * from orders where o_orderdate > timestamp '1999-01-01 00:00:00'"


def replaced(name: str, base: str, delta: str, merge: str) -> str:
    return f"""{name} as (
  select * from {base} where not exists (select 1 from {delta} where {delta}.part_1 is not distinct from {base}.part_1)
  union all select * from {merge})"""


SQL["scd1_two_batches"] = _with(
    FEED,
    landing("bl", BASE_WHERE, BASE_RUN_TS),
    prepared("b", "bl"),
    landing("d1l", "batchno = '20240120000000' and event_type in ('click', 'view')", DELTA_RUN_TS),
    prepared("d1", "d1l"),
    merged("m1", "d1", "b", ["part_1"]),
    replaced("s1", "b", "d1", "m1"),
    landing("d2l", DELTA_WHERE, SECOND_RUN_TS),
    prepared("d2", "d2l"),
    merged("m2", "d2", "s1", ["part_1"]),
    replaced("s2", "s1", "d2", "m2"),
) + "select * from s2"

SQL["cast_all_string"] = """
select event_id::varchar as event_id, ts::varchar as ts, user_id::varchar as user_id,
       event_type, value::varchar as value, props
from events"""

SQL["row_key"] = _with(FEED) + """
select pos as trail_file_pos,
       regexp_replace(concat_ws('', user_id::varchar, current_ts), '[-:.,/ ]', '', 'g') as row_key
from feed"""

SQL["part_prefix"] = _with(FEED) + """
select pos as trail_file_pos, substring(event_type, 1, 3) as part_1 from feed"""

SQL["part_dates"] = _with(FEED) + """
select pos as trail_file_pos,
       year(try_cast(current_ts as timestamp))::int as part_1,
       month(try_cast(current_ts as timestamp))::int as part_2,
       try_cast(current_ts as timestamp)::date as part_3
from feed"""

SQL["touched_partitions"] = _with(
    FEED, landing("dl", ALL_WHERE, DELTA_RUN_TS), prepared("d", "dl")
) + "select distinct part_1 from d"

SQL["touched_partitions_dates"] = _with(
    FEED, landing("dl", ALL_WHERE, DELTA_RUN_TS), prepared("d", "dl", date=True)
) + "select distinct part_1, part_2, part_3 from d"

HOURLY = """hourly as (
  select distinct strftime(date_trunc('hour', ts), '%Y%m%d%H%M%S') as batchno from events)"""

SQL["batches_closed"] = _with(HOURLY) + """
select batchno from hourly where batchno >= '20240110000000' and batchno <= '20240112230000'"""

SQL["batches_open"] = _with(HOURLY) + """
select batchno from hourly where batchno >= '20240125000000'"""

SQL["batches_after_mark"] = _with(FEED, HOURLY) + f"""
select batchno from hourly
where batchno > (select max(batchno) from feed where {BASE_WHERE})"""

SQL["batch_id_valid"] = """
with c as (
  select event_id, event_type,
         strftime(ts, '%Y%m') || lpad((user_id % 40)::varchar, 2, '0') || strftime(ts, '%H%M%S') as c14
  from events),
k as (
  select event_id,
         case when event_type = 'click' then substring(c14, 1, 13)
              when event_type = 'error' then substring(c14, 1, 13) || 'x'
              else c14 end as candidate
  from c)
select event_id, candidate,
       coalesce(strftime(try_strptime(candidate, '%Y%m%d%H%M%S'), '%Y%m%d%H%M%S') = candidate, false) as is_valid
from k"""

SYNC_LOG = """sync_log as (
  select 'events_app' as app_name, 'events' as table_name,
         epoch(date_trunc('hour', ts))::bigint::varchar as batch_no,
         case event_type when 'signup' then 'file_sync' when 'click' then 'partition_sync'
                         when 'error' then 'batch_deleted' end as activity_type,
         ts as event_ts
  from events where event_type in ('signup', 'click', 'error'))"""

VERSIONS = "versions as (select distinct epoch(date_trunc('hour', ts))::bigint as t from events)"

PENDING = """pending as (
  select t, count(*) over ()::bigint as n_pending,
         case when count(*) over () = 1 then 'publish' else 'merge_all' end as action
  from versions
  where t > (select coalesce(max(batch_no), '0') from sync_log
             where app_name = 'events_app' and table_name = 'events' and activity_type = 'file_sync'
               and event_ts < timestamp '2024-01-29 00:00:00')::bigint)"""

CANDIDATES = """cand as (
  select batch_no,
         sum(case when activity_type = 'file_sync' then 1 else 0 end)::bigint as file_sync,
         sum(case when activity_type = 'partition_sync' then 1 else 0 end)::bigint as part_sync,
         sum(case when activity_type = 'batch_deleted' then 1 else 0 end)::bigint as batch_del
  from sync_log where app_name = 'events_app' and table_name = 'events'
  group by batch_no)"""

SQL["high_water_mark"] = _with(SYNC_LOG) + """
select activity_type, max(batch_no) as mark from sync_log group by activity_type"""

SQL["pending_versions"] = _with(SYNC_LOG, VERSIONS, PENDING) + "select * from pending"

SQL["retention_candidates"] = _with(SYNC_LOG, CANDIDATES) + """
select * from cand where file_sync > 0 and batch_del = 0 and batch_no <> '0'"""

SQL["audit_rows"] = _with(
    FEED,
    landing("bl", BASE_WHERE, BASE_RUN_TS),
    prepared("b", "bl"),
    landing("dl", DELTA_WHERE, DELTA_RUN_TS),
    prepared("d", "dl"),
    merged("m", "d", "b", ["part_1"]),
) + f"""
select 'events_app' as app_name, 'events' as table_name, batchno as batch_no,
       timestamp '{DELTA_RUN_TS}' as process_start_time, timestamp '{SECOND_RUN_TS}' as process_end_time,
       (select count(*) from m)::bigint as record_count
from (select distinct batchno from feed where {DELTA_WHERE})"""

SQL["sync_rows"] = _with(SYNC_LOG, VERSIONS, PENDING, CANDIDATES) + f"""
select 'events_app' as app_name, 'events' as table_name, t::varchar as batch_no,
       'file_sync' as activity_type, timestamp '{DELTA_RUN_TS}' as file_sync_time,
       null::timestamp as partition_sync_time, null::timestamp as file_delete_time,
       n_pending as record_count
from pending
union all
select 'events_app', 'events', batch_no, 'batch_deleted', null::timestamp, null::timestamp,
       timestamp '{SECOND_RUN_TS}', null::bigint
from cand where file_sync > 0 and batch_del = 0 and batch_no <> '0'"""


# ---------------------------------------------------------------- COD push

COD = """cod as (
  select c_custkey as CUST_ID,
         (case when c_mktsegment = 'AUTOMOBILE' then null when c_acctbal >= 0 then 1 else 0 end)::int as COD_ALLOWED
  from customer),
split as (
  select CUST_ID, COD_ALLOWED, case COD_ALLOWED when 1 then 'allow' when 0 then 'block' end as operation
  from cod where COD_ALLOWED in (0, 1))"""


def numbered(size: int) -> str:
    return f"""nb as (
  select operation, CUST_ID,
         ((row_number() over (partition by operation order by CUST_ID) - 1) // {size})::bigint as batch_index
  from split),
payload as (
  select operation, batch_index, count(*)::bigint as n_ids, min(CUST_ID) as first_id, max(CUST_ID) as last_id,
         string_agg(CUST_ID::varchar, ',' order by CUST_ID) as id_list
  from nb group by operation, batch_index)"""


PUSHED = """req as (
  select p.*,
         ((case when operation = 'block'
                then (select count(*) from payload where operation = 'allow') else 0 end) + batch_index + 1)::bigint
           as request_seq,
         (select sum(n_ids) from payload q where q.operation = p.operation)::bigint as op_total
  from payload p),
resp as (
  select *, case when first_id % 4 = 3 then (case when operation = 'block' then 500 else 404 end) else 200 end as code,
         '20240122000000' || repeat('0', greatest(0, 6 - len(request_seq::varchar))) || request_seq::varchar as request_no
  from req)"""

SQL["flag_split"] = _with(COD) + "select * from split"

SQL["chunk_counts"] = _with(COD) + """
select operation, count(*)::bigint as n_ids, ceil(count(*) / 700)::bigint as n_batches
from split group by operation"""

SQL["request_batches"] = _with(COD, numbered(700)) + "select * from payload"
SQL["request_batches_50"] = _with(COD, numbered(50)) + "select * from payload"

SQL["route_status"] = _with(COD, numbered(50), PUSHED) + """
select 'cod_app' as app_name, request_no || '1' || '1' as request_key, op_total as record_count, request_no,
       1 as request_counter, op_total as success_count, 'env:PRD & op:' || operation as status,
       date '2024-01-22' as status_record_date_dt, '20240122000000' as batch_no, n_ids as batch_record_count
from resp where code = 200"""

SQL["route_errors"] = _with(COD, numbered(50), PUSHED) + """
select request_seq, operation, code,
       case when code between 400 and 499 then 'client_error' else 'server_error' end as outcome,
       '{"error": "rejected", "op": "' || operation || '", "first": ' || first_id::varchar || '}' as body,
       date '2024-01-22' as part_record_date_dt, '20240122000000' as batch_no,
       'rejected' as error, operation as op, first_id as first
from resp where code <> 200"""

# ---------------------------------------------------------------- flat files

FLAT = """tax as (
  select o_custkey::varchar as gstin, o_orderpriority as gst_type,
         strftime(o_orderdate, '%Y-%m-%d') as transaction_date,
         case o_orderstatus when 'O' then 'VALID' when 'F' then 'ACTIVE' when 'P' then 'REJECTED' end as status
  from orders),
flat as (
  select distinct gstin, gst_type, transaction_date, status, '2024-01-22' as load_timestamp,
         try_strptime(transaction_date, '%Y-%m-%d')::date as process_date,
         month(try_strptime(transaction_date, '%Y-%m-%d'))::int as month,
         year(try_strptime(transaction_date, '%Y-%m-%d'))::int as year,
         md5(gstin) as gstin_hash
  from tax where status in ('VALID', 'ACTIVE'))"""

SQL["flat_transform"] = _with(FLAT) + "select * from flat"
SQL["export_by_type"] = _with(FLAT) + "select * from flat"
SQL["flat_type_counts"] = _with(FLAT) + "select gst_type, count(*)::bigint as record_count from flat group by gst_type"
SQL["flat_summary"] = _with(FLAT) + """
select 'gstr1' as section, '2024-01-22' as process_date, count(*)::bigint as record_count,
       (count(distinct gst_type) + max((gst_type is null)::int))::bigint as file_count,
       0::bigint as error_count, 'COMPLETED' as status
from flat"""

# ---------------------------------------------------------------- envelopes

ENVELOPES = """env as (
  select event_id as request_id, user_id::varchar as gstin, event_type, props, value from events),
parsed as (
  select request_id, gstin,
         case event_type when 'purchase' then null
                         when 'view' then 'No data field in API response'
                         when 'error' then 'GST API error: rate limit for ' || gstin
                         when 'signup' then 'GST API error: Unknown error'
                         else 'Malformed API response' end as error,
         case when event_type = 'purchase' then props end as data,
         event_type, props, value
  from env),
api as (
  select request_id, gstin, (data->>'k')::int as k from parsed where error is null)"""

SQL["parse_envelope"] = _with(ENVELOPES) + "select request_id, gstin, error is null as ok, error, data from parsed"
SQL["envelope_data"] = _with(ENVELOPES) + "select * from api"
SQL["envelope_errors"] = _with(ENVELOPES) + """
select 'api_parse_error_' || request_id::varchar as action_id, '2024-01-22' as timestamp,
       'API_PARSE_ERROR' as action_type, gstin as data
from parsed where error is not null"""
SQL["union_payload_schemas"] = _with(ENVELOPES) + """
select request_id, gstin, k, null::double as v from api
union all
select request_id, gstin, (props->>'k')::int as k, value as v from parsed"""

STATUS = """st as (
  select c_custkey::varchar as gstin,
         case when c_mktsegment in ('BUILDING', 'FURNITURE') then 'VALID' when c_mktsegment = 'MACHINERY' then 'ACTIVE'
              when c_mktsegment = 'HOUSEHOLD' then 'CANCELLED' else 'SUSPENDED' end as status
  from customer
  union all
  select c_custkey::varchar, 'ACTIVE' from customer where c_nationkey = 0)"""

SQL["valid_records_left_status"] = _with(ENVELOPES, STATUS) + """
select a.* from (select *, case when k >= 50 then 'VALID' else 'EXPIRED' end as status from api) a
join st s on a.gstin = s.gstin where a.status in ('VALID', 'ACTIVE')"""
SQL["valid_records_right_status"] = _with(ENVELOPES, STATUS) + """
select a.* from api a join st s on a.gstin = s.gstin where s.status in ('VALID', 'ACTIVE')"""

REQUESTS = """sch as (
  select lower(n_name) as gst_type, case when n_nationkey % 2 = 0 then '2023-24' else '2024-25' end as fy
  from nation join region on n_regionkey = r_regionkey where r_name = 'ASIA'),
reqs as (
  select c_custkey::varchar as gstin, c_mktsegment as section, gst_type, fy,
         'http://api.test/fetch?gstin=' || c_custkey::varchar || '&fy=' || fy || '&section=' || c_mktsegment as url,
         c_custkey % 6 as kind
  from customer cross join sch)"""

SQL["request_fanout"] = _with(REQUESTS) + "select gstin, section, gst_type, fy, url from reqs"
RESPONSES = """fetched as (
  select event_id as request_id, user_id::varchar as gstin, 'gstr' || (user_id % 3)::varchar as gst_type,
         case when user_id % 2 = 0 then '2023-24' else '2024-25' end as fy, (event_id % 6 + 1)::int as attempts,
         (case when event_type in ('purchase', 'view', 'signup') then 200
               when event_type = 'error' then case event_id % 3 when 0 then 429 when 1 then 503 else 404 end
               when event_id % 4 <> 0 then 500 end)::int as code,
         event_type, props
  from events),
outcomes as (
  select *, case when code is null then 'exception' when code = 200 then 'ok' when code in (429, 503) then 'rate_limited'
                 when code between 400 and 499 then 'client_error' else 'server_error' end as outcome
  from fetched),
by_type as (
  select gstin, gst_type, fy,
         case when gst_type = 'gstr1' and fy = '2024-25' then 'SUSPENDED' else status end as status
  from st, (values ('gstr0'), ('gstr1'), ('gstr2')) g(gst_type), (values ('2023-24'), ('2024-25')) y(fy)),
typed as (
  select request_id, gstin, gst_type, fy, (props->>'k')::int as k from outcomes
  where outcome = 'ok' and event_type = 'purchase'),
valid as (
  select t.* from typed t join by_type s using (gstin, gst_type, fy) where s.status in ('VALID', 'ACTIVE'))"""

SQL["fetch_outcomes"] = _with(STATUS, RESPONSES) + "select request_id, gstin, gst_type, fy, attempts, code, outcome from outcomes"
SQL["api_metrics"] = _with(STATUS, RESPONSES) + """
select sum(attempts)::bigint as api_calls, sum(case when outcome = 'ok' then 1 else 0 end)::bigint as api_success,
       sum(case when outcome <> 'ok' then 1 else 0 end)::bigint as api_failure
from outcomes"""
SQL["valid_records_by_type"] = _with(STATUS, RESPONSES) + "select * from valid"
SQL["gst_valid_summary"] = _with(STATUS, RESPONSES) + """
select f.gst_type, f.fy as financial_year, count(v.request_id)::bigint as record_count, '2024-01-22' as process_date
from (select distinct gst_type, fy from outcomes) f left join valid v on f.gst_type = v.gst_type and f.fy = v.fy
group by f.gst_type, f.fy"""
SQL["json_by_type_roundtrip"] = SQL["valid_records_by_type"]
SQL["catalog_audit_roundtrip"] = (
    "with once as (" + SQL["audit_rows"] + ") select * from once union all select * replace (0::bigint as record_count) from once"
)
SQL["schedule_expand"] = """
select '/gst' as rootpath, 'data/' as datapath, 'status/' as statuspath, 'session/' as sessionpath,
       lower(n_name) as gst_type, r_name as schedule_id,
       case when n_nationkey % 2 = 0 then '2023-24' else '2024-25' end as fy,
       (n_nationkey % 3 + 1)::varchar as force_refresh_month, '24' as refresh_timeout_hours
from nation join region on n_regionkey = r_regionkey where r_name = 'ASIA'"""
SQL["envelope_array_data"] = """
select event_id as request_id, user_id::varchar as gstin, (props->>'k')::int as k from events
where event_type in ('purchase', 'view')
union all
select event_id, user_id::varchar, -1 from events where event_type = 'purchase'"""
SQL["parse_failures"] = """
select 'api_parse_error_' || event_id::varchar as action_id, '2024-01-22' as timestamp,
       'API_PARSE_ERROR' as action_type, user_id::varchar as data
from events where event_type = 'click'"""

# ---------------------------------------------------------------- calendar

DAYS = """days as (
  select event_id, case when user_id % 2 = 0 then '/data/gstr2a/' else '/data/gstr1/' end as path, ts::date as day
  from events),
prof as (
  select *, case when path like '%gstr2a%' and day(day) in (12, 13) then '24hr'
                 when path like '%gstr2a%' and dayofweek(day) + 1 in (7, 1) then '1day'
                 else 'default' end as profile
  from days)"""

SQL["refresh_profile"] = _with(DAYS) + """
select event_id, profile, day(day)::int as day_of_month, (dayofweek(day) + 1)::int as day_of_week,
       dayname(day) as weekday
from prof"""

SQL["month_list"] = _with(DAYS) + """
select path, day, unnest(case when profile = '24hr' then list_slice(m, 2, 3) else m end)::date as month_start
from (select distinct path, day, profile,
             generate_series(date_trunc('month', day)::timestamp - interval 2 month,
                             date_trunc('month', day)::timestamp, interval 1 month) as m
      from prof)"""

# ---------------------------------------------------------------- round trips

SQL["landing_json_roundtrip"] = _with(FEED) + f"select * from feed where {ALL_WHERE}"

SQL["orc_partition_roundtrip"] = _with(
    FEED,
    landing("bl", BASE_WHERE, BASE_RUN_TS),
    prepared("b", "bl"),
    landing("dl", DELTA_WHERE + " and event_type in ('click', 'view')", DELTA_RUN_TS),
    prepared("d", "dl"),
    merged("m", "d", "b", ["part_1"]),
    replaced("s", "b", "d", "m"),
) + "select * from s"

SQL["csv_rename"] = """
select c_name as COMPANY1, 'BP' || c_nationkey::varchar as BUSSINESSPALCE1, c_custkey::varchar as GSTIN1,
       '012024' as FP1, c_mktsegment as SECTION1, 'user' || c_custkey::varchar as USER1,
       'app' || c_custkey::varchar as APPKEY, 'sek' || c_custkey::varchar as SEK,
       'tok' || c_custkey::varchar as AUTHTOKEN, c_acctbal::varchar as TEMP
from customer"""


SQL["scd1_merge_indexed"] = SQL["scd1_merge_global_keys"]

SQL["scd1_merge_files"] = _with(
    FEED,
    landing("bl", BASE_WHERE, BASE_RUN_TS),
    prepared("b", "bl"),
    landing("dl", DELTA_WHERE + " and event_type in ('click', 'view')", DELTA_RUN_TS),
    prepared("d", "dl"),
    merged("m", "d", "b", ["part_1"]),
    replaced("s", "b", "d", "m"),
) + "select * from s"

SQL["scd1_merge_lines"] = f"""
with lines as (
  select l_orderkey, l_linenumber, l_extendedprice::decimal(18,2) as price, l_returnflag,
         strftime(l_shipdate, '%Y-%m-%d') as kafka_ts, l_partkey * 1000000 + l_suppkey as p
  from lineitem),
latest as (
  select * from lines qualify row_number() over (partition by l_orderkey, l_linenumber order by kafka_ts desc, p desc) = 1)
select l_orderkey::varchar as l_orderkey, l_linenumber::varchar as l_linenumber,
       (case when l_orderkey % 10 = 0 then price + 1 else price end)::decimal(18,2)::varchar as price,
       l_returnflag, kafka_ts, (case when l_orderkey % 10 = 0 then p + 1000000000000000 else p end)::varchar as trail_file_pos,
       case when l_orderkey % 10 = 0 then '{DELTA_RUN_TS}' else '{BASE_RUN_TS}' end as last_updated_date,
       l_orderkey::varchar || l_linenumber::varchar as row_key, l_returnflag as part_1
from latest
where l_returnflag in (select l_returnflag from latest where l_orderkey % 10 = 0)"""


# ---------------------------------------------------------------- landing in full

LINES = """made as (
  select *, event_id % 50 as kind, strftime(date_trunc('day', ts), '%Y%m%d%H%M%S') as batchno,
         '{"user_id":' || case event_id % 50 when 13 then '"x' || coalesce(user_id::varchar, 'null') || '"'
                                             when 21 then 'null' else coalesce(user_id::varchar, 'null') end
         || ',"event_type":"' || event_type || '","value":'
         || case event_id % 50 when 34 then '"n/a"' else coalesce(value::decimal(18,2)::varchar, 'null') end
         || ',"current_ts":"' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '","pos":"' || event_id::varchar || '"}' as whole
  from events),
told as (
  select *, case when kind = 7 then 'unreadable' when kind in (13, 34) then 'value does not cast'
                 when kind = 21 or user_id is null then 'null key' end as reason,
         case when kind = 7 then whole[1:30] else whole end as raw
  from made)"""

SQL["landing_quarantine"] = _with(LINES) + """
select case when reason is null then user_id end as user_id, case when reason is null then event_type end as event_type,
       case when reason is null then value::decimal(18,2) end as value,
       case when reason is null then strftime(ts, '%Y-%m-%d %H:%M:%S.%f') end as current_ts,
       case when reason is null then event_id::varchar end as pos, batchno,
       case when reason is not null then raw end as line, reason
from told"""

SQL["landing_counts"] = _with(LINES) + """
select count(*)::bigint as n_lines, count(*) filter (reason is null)::bigint as n_good, count(reason)::bigint as n_quarantined from told"""

SQL["landing_schema_merge"] = """
select event_id, case when day(ts) <= 10 then event_id::varchar when day(ts) <= 20 then event_id::varchar || '.25'
                      else 'n' || event_id::varchar end as v,
       case when day(ts) > 20 then true end as late, strftime(date_trunc('day', ts), '%Y%m%d%H%M%S') as batchno
from events"""

LEDGER = """hours as (select distinct date_trunc('hour', ts) as h from events),
ledger as (
  select strftime(h, '%Y%m%d%H%M%S') as batchno from hours
  where h >= timestamp '2024-01-05 02:00:00' and h < timestamp '2024-01-25' and hour(h) % 3 <> 1)"""

SQL["batches_processed"] = _with(LEDGER) + "select batchno from ledger"
SQL["batches_unprocessed"] = _with(LEDGER) + """
select strftime(h, '%Y%m%d%H%M%S') as batchno from hours
where strftime(h, '%Y%m%d%H%M%S') > (select min(batchno) from ledger)
  and strftime(h, '%Y%m%d%H%M%S') not in (select batchno from ledger)"""

# ---------------------------------------------------------------- publishing

SQL["publish_manifest"] = SQL["orc_partition_roundtrip"]

TWO_VERSIONS = _with(
    FEED,
    landing("bl", BASE_WHERE, BASE_RUN_TS),
    prepared("b", "bl"),
    landing("dl", DELTA_WHERE + " and event_type in ('click', 'view')", DELTA_RUN_TS),
    prepared("d", "dl"),
    merged("m", "d", "b", ["part_1"]),
)
SQL["publish_rollback"] = TWO_VERSIONS + "select * from b"
SQL["version_counts"] = TWO_VERSIONS + """
select 1705708800::bigint as t, count(*)::bigint as n_rows from b
union all select 1705881600, count(*) from m"""
SQL["manifest_folders"] = TWO_VERSIONS + """
select 1705708800::bigint as t, part_1, count(*)::bigint as n_rows from b
where part_1 not in (select part_1 from d) group by part_1
union all select 1705881600, part_1, count(*) from m group by part_1"""

ODD = """odd as (
  select event_id::varchar as id, event_id, 'old' as state,
         case event_type when 'signup' then null when 'view' then 'R&D' when 'purchase' then 'éco' when 'error' then 'err' end as part_1
  from events)"""

SQL["publish_emptied_partition"] = _with(ODD) + """
select id, case when part_1 = 'err' then 'old' else 'new' end as state, part_1 from odd
where part_1 = 'err' or ((part_1 is null or part_1 = 'R&D') and event_id % 2 = 0)"""

SQL["partitions_registered"] = _with(ODD) + """
select part_1, count(*)::bigint as n_rows from odd
where part_1 is null or part_1 in ('err', 'R&D') group by part_1"""

SQL["versions_roundtrip"] = "select distinct epoch(date_trunc('day', ts))::bigint as t from events"

# ---------------------------------------------------------------- configs and checks

SQL["rule_table_expand"] = """
select lower(r_name) as columnkey, lower(n_name) as columnname,
       case when n_nationkey % 7 <> 1 then n_nationkey::varchar end as columnformula
from nation join region on n_regionkey = r_regionkey where n_nationkey % 7 not in (3, 5)"""

SQL["schema_check"] = """
select unnest(['GSTIN1', 'COMPANY1', 'USER1']) as column_name, unnest([true, true, false]) as present,
       (select count(*) > 0 from customer) as has_rows"""

SQL["substitute_mark"] = """
select o_orderkey, o_orderdate from orders where o_orderdate > (select date_trunc('year', max(o_orderdate)) from orders)"""

SQL["summary_csv_roundtrip"] = _with(FLAT) + """
select section, '2024-01-22' as process_date, count(*)::bigint as record_count,
       (count(distinct gst_type) + max((gst_type is null)::int))::bigint as file_count,
       0::bigint as error_count, 'COMPLETED' as status
from flat, (values ('gstr1'), ('gstr2a')) s(section) group by section"""

SQL["resume_requests"] = _with(
    COD, numbered(50), PUSHED,
    """done as (select operation, unnest(string_split(id_list, ',')) as id from resp where code = 200)""",
    """rest as (
  select s.operation, s.CUST_ID,
         ((row_number() over (partition by s.operation order by s.CUST_ID) - 1) // 50)::bigint as batch_index
  from split s where not exists (select 1 from done d where d.operation = s.operation and d.id = s.CUST_ID::varchar))""",
) + """
select operation, batch_index, count(*)::bigint as n_ids, min(CUST_ID) as first_id, max(CUST_ID) as last_id,
       string_agg(CUST_ID::varchar, ',' order by CUST_ID) as id_list
from rest group by operation, batch_index"""


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
