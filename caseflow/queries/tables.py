"""How the given tables stand in for the source's records.

Requests: every line item is one observed version of its order, with the spelling noise, bad values
and copies the staging layer has to handle. Landing records: every event is one JSON record.
Each frame has its SQL twin next to it, as common table expressions for the comparison.
"""

from __future__ import annotations

from datetime import date
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.functions import iso_text
from caseflow.functions.rules import COMPLAINT_FAMILIES, OTHER_FAMILY
from caseflow.plans.core import (
    dim_agency,
    dim_complaint_type,
    dim_date,
    dim_location,
    fct_request_status_history,
    fct_service_requests,
)
from caseflow.plans.staging import latest_requests, request_versions
from caseflow.schema import RECORD_FIELDS, landed_name

# Clocks the queries are run at, after the newest row of the tables they look at.
REQUESTS_AS_OF = "2001-12-01 00:00:00"
EVENTS_AS_OF = "2024-02-01 12:30:00"
CALENDAR_START = date(1995, 1, 1)

COMPLAINT_TYPES = [
    "Noise - Street/Sidewalk",
    " noise",
    "HEAT/HOT WATER",
    "Illegal Parking",
    "Abandoned Vehicle",
    "Water System",
    "Sewer",
    "Street Condition",
    "Dirty Condition",
    "Graffiti",
    "UNSANITARY CONDITION",
    "Rodent",
    "Outdoor Dining",
    "PAINT/PLASTER",
    "Homeless Person Assistance",
    "Damaged Tree",
    "Theater Complaint",
    "Consumer Complaint",
]
BOROUGH_SPELLINGS = ["Bronx", "BROOKLYN", " Manhattan ", "queens", "STATEN ISLAND", "Unspecified"]
OPEN_STATUSES = ["Open", " OPEN", "started", "In Progress", "assigned", "Pending ", "Mystery"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(index: Column, values: list[str]) -> Column:
    """Value number ``index`` (from 0) of a list; null past its end."""
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def minutes_after(ts: Column, minutes: Column) -> Column:
    zero = F.lit(0)
    return ts.cast("timestamp_ntz") + F.make_dt_interval(zero, zero, minutes.cast("int"), zero)


def text(c: Column) -> Column:
    return c.cast("string")


def landed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem, its order and the customer, with the columns of a landed row that tell versions apart.

    Lines meet their order under the request's key as it is landed: what is grouped by that key
    afterwards lies there already, and the narrow columns are shuffled, not the text made of them.
    """
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("ck"), F.col("c_nationkey").alias("nk"), "c_mktsegment"
    )
    orders = table(spark, sf_dir, "orders").select(
        text(F.col("o_orderkey")).alias("unique_key"),
        F.col("o_custkey").alias("ck"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("ordered"),
        "o_orderpriority",
    )
    lines = table(spark, sf_dir, "lineitem").select(
        text(F.col("l_orderkey")).alias("unique_key"),
        F.col("l_orderkey").alias("k"),
        F.col("l_linenumber").alias("ln"),
        "l_partkey",
        "l_suppkey",
        "l_returnflag",
        "l_linestatus",
        F.col("l_shipdate").cast("timestamp_ntz").alias("shipped"),
    )
    rows = lines.join(orders.join(customers, "ck"), "unique_key")
    updated = updated_at()
    sys_id = F.concat_ws(
        "-", F.lit("row"), "k", "ln", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"
    )
    return rows.withColumns(
        {
            "sys_id": sys_id,
            "sys_updated_at": F.concat(iso_text(updated), F.lit("Z")),
            "_ingested_at": F.concat(text(landing_day(updated)), F.lit("T00:00:00")),
        }
    )


def updated_at() -> Column:
    return minutes_after(F.col("shipped"), F.col("ln") * 60 + F.col("k") % 60)


def landing_day(updated: Column) -> Column:
    return F.to_date(F.date_add(F.to_date(updated), 1))


def landed_text(rows: DataFrame) -> DataFrame:
    """The landed text rows of the joined ones."""
    k, ck, nk, ln = (F.col(c) for c in ("k", "ck", "nk", "ln"))
    updated = updated_at()
    closing = (F.col("l_linestatus") == "F") | (k % 10 == 0)
    closed_text = F.when(k % 97 == 0, "not yet").when(
        closing, iso_text(minutes_after(updated, k % 977))
    )
    segment = F.col("c_mktsegment")
    status = F.when(
        F.col("l_linestatus") == "F",
        F.when(k % 5 == 0, " closed ").when(k % 5 == 1, "CLOSED").otherwise("Closed"),
    ).otherwise(pick((k + ln) % 8, OPEN_STATUSES))
    day = text(landing_day(updated))
    return rows.select(
        "sys_id",
        "sys_updated_at",
        F.concat(iso_text("ordered"), F.lit("Z")).alias("sys_created_at"),
        F.concat(F.lit("v"), text(ln)).alias("sys_version"),
        "unique_key",
        F.when(k % 211 == 0, "n/a")
        .otherwise(iso_text(minutes_after(F.col("ordered"), k % 1440)))
        .alias("created_date"),
        closed_text.alias("closed_date"),
        F.when(ck % 50 == 0, None)
        .when(ck % 3 == 0, F.concat(F.lit(" "), F.lower(segment)))
        .otherwise(segment)
        .alias("agency"),
        F.when(ck % 7 == 6, None)
        .when(ck % 7 < 3, F.concat(segment, F.lit(" Dept ")))
        .otherwise(F.concat(F.lit("Dept of "), segment))
        .alias("agency_name"),
        pick(k % 19, COMPLAINT_TYPES).alias("complaint_type"),
        F.when(k % 23 == 0, None)
        .otherwise(F.concat(F.lit("Detail "), text(F.floor(k / 19).cast("long") % 4)))
        .alias("descriptor"),
        F.when(ln % 2 == 0, "Street ").otherwise("Residential").alias("location_type"),
        F.when(ck % 20 == 0, "unknown")
        .when(ck % 20 == 1, F.concat(F.lit(" "), text(nk + 10000), F.lit(" ")))
        .otherwise(text(nk + 10000))
        .alias("incident_zip"),
        F.concat(text(ck), F.lit(" Main Street")).alias("incident_address"),
        F.when(ck % 4 == 0, "INTERSECTION").otherwise("ADDRESS").alias("address_type"),
        F.when(ck % 5 != 0, F.concat(F.lit("City "), text(ck % 5))).alias("city"),
        status.alias("status"),
        text(F.date_add(F.to_date("ordered"), 30)).alias("due_date"),
        F.concat(F.lit("  Result "), "l_returnflag", F.lit(" ")).alias("resolution_description"),
        closed_text.alias("resolution_action_updated_date"),
        F.concat(text(nk % 12), F.lit(" BOARD")).alias("community_board"),
        text(nk % 51).alias("council_district"),
        F.concat(F.lit("Precinct "), text(nk % 77)).alias("police_precinct"),
        text(k * 7 % 1000003).alias("bbl"),
        pick((nk + F.when(ck % 11 == 0, 1).otherwise(0)) % 6, BOROUGH_SPELLINGS).alias("borough"),
        F.col("o_orderpriority").alias("open_data_channel_type"),
        F.when(ck % 13 == 0, "n/a")
        .when(ck % 13 == 1, "40.7d")
        .otherwise(F.concat(F.lit("40."), F.lpad(text(ck % 100), 2, "0")))
        .alias("latitude"),
        F.when(ck % 17 == 0, None)
        .otherwise(F.concat(F.lit("-73."), F.lpad(text(k % 100), 2, "0")))
        .alias("longitude"),
        F.concat(F.lit("run-"), day).alias("_run_id"),
        F.concat(F.lit("run-"), day, F.lit("-0000")).alias("_batch_id"),
        "_ingested_at",
        F.when(ln == 7, '{"line":7}').alias("_extra"),
    )


@lru_cache(maxsize=4)
def raw_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed text rows: lineitem, its order and the customer."""
    return landed_text(landed_lines(spark, sf_dir))


RAW_SQL = rf"""
lines as (
    select l_orderkey as k, l_linenumber as ln, o_custkey as ck, c_nationkey as nk, c_mktsegment,
           l_partkey, l_suppkey, l_returnflag, l_linestatus, o_orderpriority,
           o_orderdate as ordered,
           l_shipdate + to_minutes(l_linenumber * 60 + l_orderkey % 60) as updated
    from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey
),
iso as (
    select *, case when k % 97 = 0 then 'not yet'
                   when l_linestatus = 'F' or k % 10 = 0
                   then replace((updated + to_minutes(k % 977))::varchar, ' ', 'T') end as closed_text,
           (updated::date + 1)::date::varchar as day
    from lines
),
raw_requests as (
    select
        'row-' || k || '-' || ln || '-' || l_partkey || '-' || l_suppkey || '-' || l_returnflag
            || '-' || l_linestatus as sys_id,
        replace(updated::varchar, ' ', 'T') || 'Z' as sys_updated_at,
        replace(ordered::varchar, ' ', 'T') || 'Z' as sys_created_at,
        'v' || ln as sys_version,
        k::varchar as unique_key,
        case when k % 211 = 0 then 'n/a'
             else replace((ordered + to_minutes(k % 1440))::varchar, ' ', 'T') end as created_date,
        closed_text as closed_date,
        case when ck % 50 = 0 then null when ck % 3 = 0 then ' ' || lower(c_mktsegment)
             else c_mktsegment end as agency,
        case when ck % 7 = 6 then null when ck % 7 < 3 then c_mktsegment || ' Dept '
             else 'Dept of ' || c_mktsegment end as agency_name,
        ({sql_list(COMPLAINT_TYPES)})[k % 19 + 1] as complaint_type,
        case when k % 23 <> 0 then 'Detail ' || (k // 19 % 4) end as descriptor,
        case when ln % 2 = 0 then 'Street ' else 'Residential' end as location_type,
        case when ck % 20 = 0 then 'unknown' when ck % 20 = 1 then ' ' || (nk + 10000) || ' '
             else (nk + 10000)::varchar end as incident_zip,
        ck || ' Main Street' as incident_address,
        case when ck % 4 = 0 then 'INTERSECTION' else 'ADDRESS' end as address_type,
        case when ck % 5 <> 0 then 'City ' || (ck % 5) end as city,
        case when l_linestatus <> 'F' then ({sql_list(OPEN_STATUSES)})[(k + ln) % 8 + 1]
             when k % 5 = 0 then ' closed ' when k % 5 = 1 then 'CLOSED' else 'Closed' end as status,
        (ordered::date + 30)::date::varchar as due_date,
        '  Result ' || l_returnflag || ' ' as resolution_description,
        closed_text as resolution_action_updated_date,
        (nk % 12) || ' BOARD' as community_board,
        (nk % 51)::varchar as council_district,
        'Precinct ' || (nk % 77) as police_precinct,
        (k * 7 % 1000003)::varchar as bbl,
        ({sql_list(BOROUGH_SPELLINGS)})[(nk + case when ck % 11 = 0 then 1 else 0 end) % 6 + 1]
            as borough,
        o_orderpriority as open_data_channel_type,
        case when ck % 13 = 0 then 'n/a' when ck % 13 = 1 then '40.7d'
             else '40.' || lpad((ck % 100)::varchar, 2, '0') end as latitude,
        case when ck % 17 <> 0 then '-73.' || lpad((k % 100)::varchar, 2, '0') end as longitude,
        'run-' || day as _run_id, 'run-' || day || '-0000' as _batch_id,
        day || 'T00:00:00' as _ingested_at,
        case when ln = 7 then '{{"line":7}}' end as _extra
    from iso
)"""


def request_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run log of the requests: one run per month of updates; early and some later ones failed."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.to_date(F.trunc(F.col("l_shipdate").cast("date"), "month")).alias("m")
    )
    months = lines.groupBy("m").agg(F.count("*").alias("n"))
    nxt = F.add_months("m", 1)
    failed = (F.year("m") <= 1996) | (F.month("m") % 6 == 0)

    def midnight(day: Column) -> Column:
        return F.concat(text(day), F.lit("T00:00:00"))

    return months.select(
        F.concat(F.lit("run-"), F.date_format("m", "yyyy-MM")).alias("run_id"),
        nxt.cast("timestamp_ntz").alias("started_at"),
        minutes_after(nxt.cast("timestamp_ntz"), F.lit(7)).alias("finished_at"),
        F.when(failed, "failed").otherwise("succeeded").alias("status"),
        midnight(F.col("m")).alias("watermark_from"),
        midnight(nxt).alias("watermark_to"),
        F.col("n").alias("rows_fetched"),
        F.lit(1).alias("files_written"),
        midnight(F.col("m")).alias("max_updated_seen"),
        F.when(F.month("m") % 4 == 0, F.array(F.lit("line")))
        .otherwise(F.array().cast("array<string>"))
        .alias("unexpected_keys"),
        F.when(failed, "boom").alias("error"),
    )


RUNS_SQL = """
months as (
    select date_trunc('month', l_shipdate)::date as m, count(*) as n from lineitem group by 1
),
runs as (
    select 'run-' || strftime(m, '%Y-%m') as run_id,
           (m + interval 1 month)::timestamp as started_at,
           (m + interval 1 month)::timestamp + interval 7 minute as finished_at,
           case when year(m) <= 1996 or month(m) % 6 = 0 then 'failed' else 'succeeded' end as status,
           m::varchar || 'T00:00:00' as watermark_from,
           (m + interval 1 month)::date::varchar || 'T00:00:00' as watermark_to,
           n as rows_fetched,
           1::int as files_written,
           m::varchar || 'T00:00:00' as max_updated_seen,
           case when month(m) % 4 = 0 then ['line'] else []::varchar[] end as unexpected_keys,
           case when year(m) <= 1996 or month(m) % 6 = 0 then 'boom' end as error
    from months
),
coverage as (
    select min(try_cast(watermark_from as timestamp)) as coverage_start
    from runs where status = 'succeeded'
)"""


# --- staged and modelled requests --------------------------------------------------------


@lru_cache(maxsize=4)
def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_requests(landed_lines(spark, sf_dir), landed_text)


@lru_cache(maxsize=4)
def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return request_versions(raw_requests(spark, sf_dir))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fct_service_requests(requests(spark, sf_dir), REQUESTS_AS_OF)


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fct_request_status_history(versions(spark, sf_dir))


def agencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_agency(requests(spark, sf_dir))


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_location(requests(spark, sf_dir))


def complaint_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_complaint_type(requests(spark, sf_dir))


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar over the years the orders span."""
    return dim_date(spark, REQUESTS_AS_OF, CALENDAR_START)



def ts_sql(c: str) -> str:
    return f"try_cast(replace({c}, 'Z', '') as timestamp)"


STAGED_SQL = f"""
newest as (
    select * from (
        select *, row_number() over (partition by unique_key
            order by sys_updated_at desc, _ingested_at desc, sys_id desc) as rn
        from raw_requests)
    where rn = 1
),
requests as (
    select unique_key, {ts_sql('created_date')} as created_at, {ts_sql('closed_date')} as closed_at,
        {ts_sql('due_date')} as due_at,
        {ts_sql('resolution_action_updated_date')} as resolution_updated_at,
        upper(trim(agency)) as agency, trim(agency_name) as agency_name,
        trim(complaint_type) as complaint_type, trim(descriptor) as descriptor,
        trim(location_type) as location_type, trim(status) as status_raw,
        case upper(trim(status)) when 'CLOSED' then 'Closed' when 'OPEN' then 'Open'
            when 'IN PROGRESS' then 'In Progress' when 'STARTED' then 'In Progress'
            when 'ASSIGNED' then 'Assigned' when 'PENDING' then 'Pending'
            else 'Unspecified' end as status,
        trim(resolution_description) as resolution_description,
        trim(open_data_channel_type) as channel, incident_zip as incident_zip_raw,
        case when regexp_full_match(trim(incident_zip), '[0-9]{{5}}') then trim(incident_zip) end
            as incident_zip,
        case when list_contains(['BRONX','BROOKLYN','MANHATTAN','QUEENS','STATEN ISLAND'],
            upper(trim(borough))) then upper(trim(borough)) end as borough,
        trim(city) as city, trim(community_board) as community_board,
        trim(council_district) as council_district, trim(police_precinct) as police_precinct,
        trim(incident_address) as incident_address, trim(address_type) as address_type,
        try_cast(latitude as double) as latitude, try_cast(longitude as double) as longitude,
        bbl, sys_id, {ts_sql('sys_updated_at')} as source_updated_at, _run_id as ingest_run_id,
        _batch_id as ingest_batch_id, _ingested_at, _extra as extra_json
    from newest
)"""

VERSIONS_SQL = f"""
versions as (
    select unique_key, sys_updated_at, {ts_sql('sys_updated_at')} as source_updated_at,
        trim(status) as status_raw, {ts_sql('closed_date')} as closed_at,
        trim(resolution_description) as resolution_description, upper(trim(agency)) as agency,
        _ingested_at
    from (select *, row_number() over (partition by unique_key, sys_updated_at
              order by _ingested_at, sys_id) as rn
          from raw_requests)
    where rn = 1
)"""

HISTORY_SQL = """
history as (
    select unique_key, sys_updated_at, source_updated_at, status_raw as status, closed_at, agency,
        row_number() over w as version_no, lag(status_raw) over w as previous_status,
        lag(source_updated_at) over w as previous_updated_at, _ingested_at
    from versions
    window w as (partition by unique_key order by source_updated_at, sys_updated_at)
)"""

FACT_SQL = f"""
fact as (
    select unique_key, created_at, closed_at, created_at::date as created_date,
        closed_at::date as closed_date, agency as agency_key,
        md5(coalesce(complaint_type, '') || '|' || coalesce(descriptor, '')) as complaint_type_key,
        incident_zip as location_key, borough, status, channel, location_type, address_type,
        community_board, council_district, police_precinct, latitude, longitude,
        (latitude is not null and longitude is not null) as has_geo,
        (status = 'Closed') as is_closed,
        (closed_at is not null and closed_at < created_at) as has_invalid_close_time,
        case when closed_at >= created_at
            then date_diff('minute', created_at, closed_at) / 60.0 end as hours_to_close,
        case when closed_at is null
            then date_diff('minute', created_at, timestamp '{REQUESTS_AS_OF}') / 60.0 / 24.0 end
            as open_age_days,
        resolution_description, source_updated_at, _ingested_at
    from requests
)"""

def hits_sql(patterns: list[str]) -> str:
    return " or ".join(f"lower(complaint_type) like '{p}'" for p in patterns)


# The rules are stated once, in functions/rules.py; what is compared is how they are applied.
FAMILY_SQL = (
    "case "
    + " ".join(f"when {hits_sql(patterns)} then '{name}'" for name, patterns in COMPLAINT_FAMILIES)
    + f" else '{OTHER_FAMILY}' end"
)

CALENDAR_SELECT_SQL = """
    select date_day, year(date_day)::int as year, quarter(date_day)::int as quarter,
        month(date_day)::int as month, strftime(date_day, '%Y-%m') as year_month,
        weekofyear(date_day)::int as iso_week, date_trunc('week', date_day)::date as week_start,
        dayofweek(date_day)::int as day_of_week, strftime(date_day, '%a') as day_name,
        dayofweek(date_day) in (0, 6) as is_weekend
    from {}"""

DIMS_SQL = f"""
agency_names as (
    select agency, agency_name, count(*) as n from requests where agency is not null group by all
),
agencies as (
    select agency as agency_key, agency,
        (max(struct_pack(n := n, v := agency_name)) filter (agency_name is not null)).v
            as agency_name,
        sum(n)::bigint as n_requests_seen
    from agency_names group by agency
),
places as (
    select incident_zip, borough, city, count(*) as n from requests
    where incident_zip is not null group by all
),
locations as (
    select incident_zip as location_key, incident_zip,
        (max(struct_pack(n := n, v := borough)) filter (borough is not null)).v as borough,
        (max(struct_pack(n := n, v := city)) filter (city is not null)).v as city,
        sum(n)::bigint as n_requests_seen
    from places group by incident_zip
),
complaint_types as (
    select md5(coalesce(complaint_type, '') || '|' || coalesce(descriptor, ''))
            as complaint_type_key,
        complaint_type, descriptor, {FAMILY_SQL} as complaint_family, count(*) as n_requests_seen
    from requests group by complaint_type, descriptor
),
days as (
    select unnest(generate_series(timestamp '{CALENDAR_START}',
        timestamp '{REQUESTS_AS_OF}' + interval 1 year, interval 1 day))::date as date_day
),
calendar as ({CALENDAR_SELECT_SQL.format('days')})"""

MARTS_SQL = f"""
volume as (
    select f.created_date, d.year_month, d.is_weekend, coalesce(f.borough, 'UNKNOWN') as borough,
        c.complaint_family, f.agency_key as agency, count(*) as n_requests,
        count_if(f.is_closed)::bigint as n_closed, count_if(f.has_geo)::bigint as n_with_geo
    from fact f join complaint_types c on c.complaint_type_key = f.complaint_type_key
        left join calendar d on d.date_day = f.created_date
    where f.created_at >= (select coverage_start from coverage)
    group by all
),
resolution as (
    select date_trunc('week', f.created_date)::date as week_start, f.agency_key as agency,
        a.agency_name, count(*) as n_closed,
        round(median(f.hours_to_close), 1) as median_hours_to_close,
        round(quantile_cont(f.hours_to_close, 0.9), 1) as p90_hours_to_close,
        -- exact mean of whole minutes: a sum of doubles would depend on the row order
        round(sum(round(f.hours_to_close * 60)::bigint) / (60.0::double * count(*)), 1)
            as mean_hours_to_close,
        count_if(f.hours_to_close <= 24)::double / count(*) as share_closed_within_24h
    from fact f join agencies a on a.agency_key = f.agency_key
    where f.is_closed and f.hours_to_close is not null
        and f.created_at >= (select coverage_start from coverage)
    group by all
),
backlog as (
    select agency_key as agency, coalesce(borough, 'UNKNOWN') as borough, status,
        case when open_age_days < 1 then '0. < 1 day' when open_age_days < 7 then '1. 1-7 days'
             when open_age_days < 30 then '2. 7-30 days' when open_age_days < 90 then '3. 30-90 days'
             else '4. > 90 days' end as age_bucket,
        count(*) as n_open, round(avg(open_age_days), 1) as avg_age_days,
        max(open_age_days) as max_age_days, timestamp '{REQUESTS_AS_OF}' as as_of
    from fact where not is_closed group by all
),
last_ok as (select * from runs where status = 'succeeded' order by started_at desc, run_id desc limit 1),
last_any as (select * from runs order by started_at desc, run_id desc limit 1),
health as (
    select count(*) as n_requests, max(source_updated_at) as newest_source_update,
        date_diff('hour', max(source_updated_at), timestamp '{REQUESTS_AS_OF}')
            as hours_since_source_update,
        max(_ingested_at) as newest_ingest,
        count_if(has_invalid_close_time)::bigint as n_invalid_close_time,
        (select run_id from last_ok) as last_successful_run_id,
        (select finished_at from last_ok) as last_successful_run_at,
        (select rows_fetched from last_ok) as last_successful_rows,
        (select status from last_any) as last_run_status,
        (select error from last_any) as last_run_error,
        (select count(*) from runs where status = 'succeeded') as n_successful_runs,
        (select count(*) from runs where status = 'failed') as n_failed_runs
    from fact
    having (select count(*) from last_ok) > 0
)"""


def with_ctes(select: str, *ctes: str) -> str:
    return "with " + ",".join(ctes) + "\n" + select


def over_staged(select: str) -> str:
    return with_ctes(select, RAW_SQL, STAGED_SQL)


def over_versions(select: str) -> str:
    return with_ctes(select, RAW_SQL, VERSIONS_SQL)


def over_history(select: str) -> str:
    return with_ctes(select, RAW_SQL, VERSIONS_SQL, HISTORY_SQL)


def over_core(select: str) -> str:
    return with_ctes(select, RAW_SQL, STAGED_SQL, FACT_SQL, DIMS_SQL)


def over_marts(select: str) -> str:
    return with_ctes(select, RAW_SQL, RUNS_SQL, STAGED_SQL, FACT_SQL, DIMS_SQL, MARTS_SQL)


def request_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw requests as JSON records of the source (column ``value``)."""
    raw = raw_requests(spark, sf_dir)
    fields = [F.col(landed_name(f)).alias(f) for f in RECORD_FIELDS if landed_name(f) in raw.columns]
    return raw.select(F.to_json(F.struct(*fields)).alias("value"))


# --- events as landed JSON records -------------------------------------------------------


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as one JSON record of the source, with nested and undeclared members."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    stamp = F.concat(iso_text("ts"), F.lit("Z"))
    drift = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(',"props":'), "props"))
    more = F.when(F.col("event_id") % 5 == 0, F.lit(',"flag":true,"note":"x"'))
    value = F.concat(
        F.lit('{":id":"row-'),
        F.lpad(text(F.col("event_id")), 12, "0"),
        F.lit('",":updated_at":"'),
        stamp,
        F.lit('","unique_key":"'),
        text(F.col("user_id")),
        F.lit('","status":"'),
        "event_type",
        F.lit('","location":'),
        "props",
        F.lit(',":@computed_region_f5dn_yrer":"'),
        text(F.col("user_id") % 5),
        F.lit('"'),
        F.coalesce(drift, F.lit("")),
        F.coalesce(more, F.lit("")),
        F.lit("}"),
    )
    return e.select(value.alias("value"), "ts", "event_id")


LANDED_SQL = """
landed as (
    select 'row-' || lpad(event_id::varchar, 12, '0') as sys_id,
        replace(ts::varchar, ' ', 'T') || 'Z' as sys_updated_at,
        user_id::varchar as unique_key, event_type as status,
        replace(props, ' ', '') as location,
        (user_id % 5)::varchar as sys_computed_region_f5dn_yrer,
        case when event_id % 15 = 0
                 then '{"props":' || replace(props, ' ', '') || ',"flag":true,"note":"x"}'
             when event_id % 3 = 0 then '{"props":' || replace(props, ' ', '') || '}'
             when event_id % 5 = 0 then '{"flag":true,"note":"x"}' end as _extra,
        ts, event_id, user_id, event_type
    from events
)"""


def event_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The version log of the events: one version per event of its user, landed at midnight, and
    the last 15 minutes of every day landed again with the next day's run."""
    next_day = F.date_add(F.to_date("ts"), 1)
    overlaps = (F.hour("ts") == 23) & (F.minute("ts") >= 45)
    landings = F.when(overlaps, F.array(next_day, F.date_add(next_day, 1)))
    e = table(spark, sf_dir, "events").select(
        text(F.col("user_id")).alias("unique_key"),
        text(F.col("event_id")).alias("sys_id"),
        F.concat(iso_text("ts"), F.lit("Z")).alias("sys_updated_at"),
        F.col("event_type").alias("status"),
        F.col("props").alias("_extra"),
        F.explode(landings.otherwise(F.array(next_day))).alias("landed_on"),
    )
    stamp = F.concat(text(F.col("landed_on")), F.lit("T00:00:00"))
    return e.withColumn("_ingested_at", stamp).drop("landed_on")


EVENT_VERSIONS_SQL = """
landings as (
    select *, ts::date + 1 as landed_on from events
    union all
    select *, ts::date + 2 from events where hour(ts) = 23 and minute(ts) >= 45
),
log as (
    select user_id::varchar as unique_key, event_id::varchar as sys_id,
        replace(ts::varchar, ' ', 'T') || 'Z' as sys_updated_at, event_type as status,
        props as _extra, landed_on::date::varchar || 'T00:00:00' as _ingested_at
    from landings
)"""
