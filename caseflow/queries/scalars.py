"""Column functions, each over a whole table of the values it is meant for."""

from __future__ import annotations


from pyspark.sql import functions as F

from caseflow import functions as fn
from caseflow.functions.dates import as_ntz
from caseflow.functions.rules import STATUS_NAMES
from caseflow.operators.quantiles import round1
from caseflow.plans.core import days_of, hours_to_close, open_age_days, request_flags
from caseflow.queries import tables as t

# Fixed instant between the events, so that differences to it have both signs.
MIDDLE = "2024-01-15 12:34:56.5"


def order_times(spark, sf_dir):
    """Order dates in the spellings a source may send, good and bad."""
    o = t.table(spark, sf_dir, "orders")
    plain = F.col("o_orderdate").cast("timestamp_ntz").cast("string")
    spellings = [
        F.concat(F.translate(plain, " ", "T"), F.lit("Z")),
        F.substring(plain, 1, 4),
        F.substring(plain, 1, 7),
        F.substring(plain, 1, 10),
        F.concat(F.lit(" "), F.substring(plain, 1, 10), F.lit(" ")),
        F.concat(plain, F.lit(".123456")),
        F.lit("now"),
        F.substring(plain, 1, 16),
        F.concat(F.lit("Z"), plain),
        F.concat(plain, F.lit(".1234567Z")),
        F.translate(F.substring(plain, 1, 10), "-", "/"),
        F.concat(F.substring(plain, 1, 10), F.lit("T")),
        F.concat(F.substring(plain, 1, 10), F.lit(" 10")),
        F.lit("1995-02-30"),
        F.lit("1995/02-03"),
        F.concat(F.substring(plain, 1, 10), F.lit("T24:00:00")),
        F.concat(plain, F.lit(" UTC")),
        F.concat(plain, F.lit("+02")),
        F.concat(plain, F.lit("-0230")),
        F.concat(F.substring(plain, 1, 10), F.lit("  10:00:00")),
        F.translate(F.substring(plain, 1, 10), "-", " "),
        F.translate(F.substring(plain, 1, 10), "-", "\\"),
        F.concat(F.lit("  "), F.substring(plain, 1, 10)),
        F.concat(F.substring(plain, 1, 10), F.lit(" 24:00:01")),
    ]
    return o.select("o_orderkey", F.get(F.array(*spellings), F.col("o_orderkey").cast("int") % 25)
                    .alias("txt"))


def c1(spark, sf_dir):
    return order_times(spark, sf_dir).select(
        "o_orderkey", "txt", fn.parse_ts("txt").alias("parsed")
    )


C1_SQL = """
with o as (select o_orderkey, o_orderdate::varchar as p from orders),
s as (
    select o_orderkey, [replace(p, ' ', 'T') || 'Z', substr(p, 1, 4), substr(p, 1, 7),
        substr(p, 1, 10), ' ' || substr(p, 1, 10) || ' ', p || '.123456', 'now', substr(p, 1, 16),
        'Z' || p, p || '.1234567Z', replace(substr(p, 1, 10), '-', '/'), substr(p, 1, 10) || 'T',
        substr(p, 1, 10) || ' 10', '1995-02-30', '1995/02-03', substr(p, 1, 10) || 'T24:00:00',
        p || ' UTC', p || '+02', p || '-0230', substr(p, 1, 10) || '  10:00:00',
        replace(substr(p, 1, 10), '-', ' '), replace(substr(p, 1, 10), '-', chr(92)),
        '  ' || substr(p, 1, 10), substr(p, 1, 10) || ' 24:00:01'][o_orderkey % 25 + 1] as txt
    from o)
select o_orderkey, txt, try_cast(replace(txt, 'Z', '') as timestamp) as parsed from s"""


def c2(spark, sf_dir):
    c = t.table(spark, sf_dir, "customer")
    noisy = F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit("\t  "))
    texts = F.when(F.col("c_custkey") % 2 == 0, noisy).otherwise(F.col("c_name"))
    return c.select(
        "c_custkey", fn.clean_text(texts).alias("text"), fn.clean_code(texts).alias("code")
    )


C2_SQL = """
with n as (
    select c_custkey, case when c_custkey % 2 = 0
        then ' ' || chr(160) || lower(c_mktsegment) || chr(9) || chr(8195) || ' '
        else c_name end as x from customer)
select c_custkey, trim(x) as text, upper(trim(x)) as code from n"""


def c3(spark, sf_dir):
    raw = t.raw_requests(spark, sf_dir)
    return raw.select("sys_id", fn.normalise_status("status").alias("status"))


STATUS_SQL = ", ".join(f"'{k}': '{v}'" for k, v in STATUS_NAMES.items())
C3_SQL = t.with_ctes(
    f"""select sys_id, coalesce(map {{{STATUS_SQL}}}[upper(trim(status))], 'Unspecified') as status
    from raw_requests""",
    t.RAW_SQL,
)


def c4(spark, sf_dir):
    c = t.table(spark, sf_dir, "customer")
    tail = F.when(F.col("c_custkey") % 3 == 0, "\n").when(F.col("c_custkey") % 3 == 1, " ")
    zips = F.concat((F.col("c_custkey") + 9900).cast("string"), F.coalesce(tail, F.lit("")))
    return c.select("c_custkey", fn.clean_zip(zips).alias("zip"), zips.alias("zip_raw"))


C4_SQL = """
with z as (
    select c_custkey, (c_custkey + 9900)::varchar || case c_custkey % 3 when 0 then chr(10)
        when 1 then ' ' else '' end as zip_raw from customer)
select c_custkey, case when regexp_full_match(trim(zip_raw), '[0-9]{5}') then trim(zip_raw) end as zip,
    zip_raw from z"""


def c5(spark, sf_dir):
    raw = t.raw_requests(spark, sf_dir)
    return raw.groupBy("borough", fn.allowed("borough", fn.BOROUGHS).alias("cleaned")).agg(
        F.count("*").alias("n")
    )


C5_SQL = t.with_ctes(
    """select borough, case when upper(trim(borough)) <> 'UNSPECIFIED' then upper(trim(borough)) end
    as cleaned, count(*) as n from raw_requests group by all""",
    t.RAW_SQL,
)


def c6(spark, sf_dir):
    li = t.table(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    number = F.col("l_quantity").cast("int").cast("string")
    suffix = F.get(
        F.array(*map(F.lit, ["", "d", "f", " ", "e1", ".5", "x"])), (ln - 1).cast("int")
    )
    raw = F.concat(number, suffix)
    return li.groupBy(raw.alias("txt")).agg(
        F.max(fn.to_double(raw)).alias("value"), F.count("*").alias("n")
    )


C6_SQL = """
with x as (
    select l_quantity::int::varchar || ['', 'd', 'f', ' ', 'e1', '.5', 'x'][l_linenumber] as txt
    from lineitem)
select txt, try_cast(txt as double) as value, count(*) as n from x group by all"""


def c7(spark, sf_dir):
    raw = t.raw_requests(spark, sf_dir)
    key = fn.composite_key("complaint_type", "descriptor")
    return raw.select("sys_id", key.alias("complaint_type_key"))


C7_SQL = t.with_ctes(
    """select sys_id, md5(coalesce(complaint_type, '') || '|' || coalesce(descriptor, ''))
    as complaint_type_key from raw_requests""",
    t.RAW_SQL,
)


def c8(spark, sf_dir):
    raw = t.raw_requests(spark, sf_dir)
    family = fn.complaint_family("complaint_type").alias("complaint_family")
    return raw.groupBy("complaint_type", family).agg(F.count("*").alias("n"))


C8_SQL = t.with_ctes(
    f"select complaint_type, {t.FAMILY_SQL} as complaint_family, count(*) as n from raw_requests "
    "group by all",
    t.RAW_SQL,
)


def c9(spark, sf_dir):
    o = t.table(spark, sf_dir, "orders")
    late = F.when(F.col("o_orderkey") % 50 == 0, None).otherwise(F.col("o_orderkey") % 200 / 2)
    return o.groupBy(fn.age_bucket(late).alias("age_bucket")).agg(F.count("*").alias("n"))


C9_SQL = """
with x as (
    select case when o_orderkey % 50 <> 0 then o_orderkey % 200 / 2 end as d from orders)
select case when d < 1 then '0. < 1 day' when d < 7 then '1. 1-7 days' when d < 30
    then '2. 7-30 days' when d < 90 then '3. 30-90 days' else '4. > 90 days' end as age_bucket,
    count(*) as n from x group by all"""


def c10(spark, sf_dir):
    e = t.table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp_ntz")
    middle = as_ntz(MIDDLE)
    return e.select(
        "event_id",
        fn.minutes_between(ts, middle).alias("minutes"),
        fn.hours_between(ts, middle).alias("hours"),
        fn.days_between(ts, middle).alias("days"),
        F.round(fn.elapsed_hours(ts, middle), 6).alias("elapsed"),
    )


C10_SQL = f"""
select event_id, date_diff('minute', ts, timestamp '{MIDDLE}') as minutes,
    date_diff('hour', ts, timestamp '{MIDDLE}') as hours,
    date_diff('day', ts, timestamp '{MIDDLE}') as days,
    round(epoch_us(timestamp '{MIDDLE}') / 3.6e9 - epoch_us(ts) / 3.6e9, 6) as elapsed
from events"""


def c11(spark, sf_dir):
    o = t.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"))
    counted = o.groupBy("d").agg(F.count("*").alias("n"))
    parts = [c.alias(name) for name, c in fn.date_parts("d").items()]
    return counted.select("d", "n", *parts)


C11_SQL = """
select o_orderdate::date as d, count(*) as n, extract(year from d)::int as year,
    extract(quarter from d)::int as quarter, extract(month from d)::int as month,
    strftime(d, '%Y-%m') as year_month, extract(week from d)::int as iso_week,
    (d - (extract(isodow from d) - 1)::int)::date as week_start, extract(dow from d)::int as day_of_week,
    strftime(d, '%a') as day_name, extract(dow from d) in (0, 6) as is_weekend
from orders group by 1"""


def c12(spark, sf_dir):
    return t.table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day"))


C12_SQL = "select event_id, ts::date as day from events"


def c13(spark, sf_dir):
    flags = [c.alias(name) for name, c in request_flags().items()]
    return t.requests(spark, sf_dir).select("unique_key", *flags)


C13_SQL = t.over_staged(
    """select unique_key, not (latitude is null or longitude is null) as has_geo,
    upper(trim(status_raw)) = 'CLOSED' is true as is_closed,
    case when closed_at is null then false else closed_at < created_at end as has_invalid_close_time
    from requests"""
)


def c14(spark, sf_dir):
    return t.requests(spark, sf_dir).select("unique_key", hours_to_close().alias("hours_to_close"))


C14_SQL = t.over_staged(
    """select unique_key, case when closed_at >= created_at then
    (epoch(date_trunc('minute', closed_at)) - epoch(date_trunc('minute', created_at)))::bigint
    // 60 / 60 end as hours_to_close from requests"""
)


def c15(spark, sf_dir):
    age = open_age_days(t.REQUESTS_AS_OF).alias("open_age_days")
    return t.requests(spark, sf_dir).select("unique_key", age)


C15_SQL = t.over_staged(
    f"""select unique_key, case when closed_at is null then
    date_diff('minute', created_at, timestamp '{t.REQUESTS_AS_OF}') / 60 / 24 end as open_age_days
    from requests"""
)


def c16(spark, sf_dir):
    key = fn.concat_key("created_at", "borough", "agency")
    return t.requests(spark, sf_dir).select(
        "unique_key", fn.or_unknown("borough").alias("borough"), F.md5(key).alias("grain")
    )


C16_SQL = t.over_staged(
    """select unique_key, ifnull(borough, 'UNKNOWN') as borough,
    md5(created_at || borough || agency) as grain from requests"""
)


def c17(spark, sf_dir):
    o = t.table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        round1(F.col("o_totalprice")).alias("price"),
        round1((F.col("o_orderkey") % 6000) / F.lit(60.0) - F.lit(20.0)).alias("hours"),
    )


C17_SQL = """
select o_orderkey, round(o_totalprice, 1) as price,
    round((o_orderkey % 6000) / 60.0::double - 20.0::double, 1) as hours from orders"""


def c18(spark, sf_dir):
    o = t.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("d0")
    )
    until = F.date_add("d0", (F.col("o_orderkey") % 5).cast("int"))
    days = days_of(o, F.col("d0"), until).withColumnRenamed("date_day", "day")
    return days.groupBy("day").agg(F.count("*").alias("n"))


C18_SQL = """
with x as (select unnest(generate_series(o_orderdate, o_orderdate + to_days((o_orderkey % 5)::int),
    interval 1 day))::date as day from orders)
select day, count(*) as n from x group by all"""


QUERIES = {
    "c1_parse_ts": (c1, C1_SQL),
    "c2_clean_text": (c2, C2_SQL),
    "c3_normalise_status": (c3, C3_SQL),
    "c4_clean_zip": (c4, C4_SQL),
    "c5_clean_borough": (c5, C5_SQL),
    "c6_to_double": (c6, C6_SQL),
    "c7_surrogate_key": (c7, C7_SQL),
    "c8_classify": (c8, C8_SQL),
    "c9_age_bucket": (c9, C9_SQL),
    "c10_boundaries_between": (c10, C10_SQL),
    "c11_date_parts": (c11, C11_SQL),
    "c12_date_cast": (c12, C12_SQL),
    "c13_flags": (c13, C13_SQL),
    "c14_hours_to_close": (c14, C14_SQL),
    "c15_open_age_days": (c15, C15_SQL),
    "c16_labels_and_keys": (c16, C16_SQL),
    "c17_rounding": (c17, C17_SQL),
    "c18_day_series": (c18, C18_SQL),
}
