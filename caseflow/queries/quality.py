"""Data-quality checks over the given tables."""

from __future__ import annotations


from pyspark.sql import functions as F

from caseflow.functions import BOROUGHS, concat_key
from caseflow.operators import checks as c
from caseflow.plans import build as b
from caseflow.plans.quality import LATITUDE_RANGE, staging_checks
from caseflow.plans.refresh import Refresh, check_results, run_checks
from caseflow.plans.store import Warehouse
from caseflow.queries import model
from caseflow.queries import tables as t
from caseflow.schema import Settings
from caseflow.session import scratch_path


def lineitem(spark, sf_dir):
    return t.table(spark, sf_dir, "lineitem")


def h1(spark, sf_dir):
    return c.unique(lineitem(spark, sf_dir), concat_key("l_orderkey", "l_linenumber", sep="|"))


H1_SQL = """
select l_orderkey || '|' || l_linenumber as unique_field, count(*) as n_records
from lineitem group by 1 having count(*) > 1"""


def h2(spark, sf_dir):
    return c.not_null(t.requests(spark, sf_dir), "created_at").select("unique_key", "agency")


def h3(spark, sf_dir):
    return c.accepted_values(t.raw_requests(spark, sf_dir), "borough", BOROUGHS)


H3_SQL = t.with_ctes(
    """select borough as value_field, count(*) as n_records from raw_requests
    where borough not in ('BRONX', 'BROOKLYN', 'MANHATTAN', 'QUEENS', 'STATEN ISLAND')
    group by all""",
    t.RAW_SQL,
)


def h4(spark, sf_dir):
    """Line items whose last line points past the orders, so that orphans exist."""
    lost = F.when(F.col("l_linenumber") == 7, -F.col("l_orderkey")).otherwise(F.col("l_orderkey"))
    child = lineitem(spark, sf_dir).withColumn("l_orderkey", lost)
    return c.relationships(child, "l_orderkey", t.table(spark, sf_dir, "orders"), "o_orderkey")


H4_SQL = """
select -l_orderkey as from_field, count(*) as n_records from lineitem
where l_linenumber = 7 group by all"""


def h4_holds(spark, sf_dir):
    orders = t.table(spark, sf_dir, "orders")
    return c.relationships(lineitem(spark, sf_dir), "l_orderkey", orders, "o_orderkey")


def h5(spark, sf_dir):
    return c.within_range(t.requests(spark, sf_dir), "latitude", *LATITUDE_RANGE)


def h6(spark, sf_dir):
    return c.zip_is_5_digits(t.raw_requests(spark, sf_dir), "incident_zip")


def h7(spark, sf_dir):
    rows = t.requests(spark, sf_dir).filter(c.is_closed_before_created())
    return rows.select("unique_key", "created_at", "closed_at")


def h8(spark, sf_dir):
    """Orders created after a day in the middle of the table, with a day of slack."""
    rows = t.requests(spark, sf_dir).filter(c.is_created_in_future("2001-01-01"))
    return rows.select("unique_key", "created_at")


def h9(spark, sf_dir):
    return c.duplicate_rate(t.raw_requests(spark, sf_dir), 0.001).withColumn(
        "duplicate_rate", F.round("duplicate_rate", 9)
    )


H9_SQL = t.with_ctes(
    """select n_rows, n_versions, round((n_rows - n_versions) / n_rows, 9) as duplicate_rate,
    case when (n_rows - n_versions) / n_rows > 0.001 then 'WARN' else 'PASS' end as status
    from (select count(*) as n_rows, count(distinct (unique_key, sys_updated_at)) as n_versions
          from raw_requests)""",
    t.RAW_SQL,
)


def h10(spark, sf_dir):
    rows = c.raw_freshness(t.event_versions(spark, sf_dir), t.EVENTS_AS_OF)
    return rows.withColumn("hours_since_update", F.round("hours_since_update", 6))


H10_SQL = t.with_ctes(
    f"""select n as newest_source_update, round(h, 6) as hours_since_update,
    case when h > 72 then 'ERROR' when h > 36 then 'WARN' else 'PASS' end as status
    from (select max(try_cast(replace(sys_updated_at, 'Z', '') as timestamp)) as n,
          (epoch_us(timestamp '{t.EVENTS_AS_OF}') - epoch_us(n)) / 3.6e9 as h from log)""",
    t.EVENT_VERSIONS_SQL,
)


def h11(spark, sf_dir):
    rows = c.schema_stable(t.request_runs(spark, sf_dir))
    return rows.withColumn("unexpected_keys", F.array_join("unexpected_keys", ","))


H11_SQL = t.with_ctes(
    """select run_id, array_to_string(unexpected_keys, ',') as unexpected_keys,
    case when len(unexpected_keys) > 0 then 'WARN' else 'PASS' end as status
    from runs order by started_at desc limit 1""",
    t.RUNS_SQL,
)


def h12(spark, sf_dir):
    return c.last_run_succeeded(t.request_runs(spark, sf_dir))


H12_SQL = t.with_ctes(
    """select run_id, status as run_status, coalesce(error, '') as error, rows_fetched,
    case when status = 'succeeded' then 'PASS' else 'ERROR' end as status
    from runs order by started_at desc limit 1""",
    t.RUNS_SQL,
)


def h13(spark, sf_dir):
    health = model.f4(spark, sf_dir)
    return c.within_range(health, "hours_since_source_update", 0, 72)


def h14(spark, sf_dir):
    """Status of the known close-time anomaly per agency, warn above 0 and fail above 5,000."""
    counts = t.requests(spark, sf_dir).groupBy("agency").agg(
        F.count_if(c.is_closed_before_created()).alias("failing_rows")
    )
    status = c.CLOSED_BEFORE_CREATED.status_column(F.col("failing_rows") * 10)
    return counts.withColumn("status", status)


H14_SQL = t.over_staged(
    """select agency, count_if(closed_at < created_at) as failing_rows,
    case when failing_rows * 10 > 5000 then 'ERROR' when failing_rows > 0 then 'WARN'
    else 'PASS' end as status from requests group by agency"""
)


def checked(spark, sf_dir):
    """Store the staged tables and run their checks; returns the warehouse and the outcome."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"), Settings(buckets=8))
    wh.create(b.REQUESTS, t.requests(spark, sf_dir), None)
    wh.create(b.VERSIONS, t.versions(spark, sf_dir), None)
    state = Refresh("first")
    run_checks(wh, state, staging_checks(t.REQUESTS_AS_OF))
    return wh, state


def h15(spark, sf_dir):
    """The stored failing rows of one check."""
    wh, state = checked(spark, sf_dir)
    stored = spark.read.parquet(wh.path(f"dq/closed_not_before_created/build={state.build_id}"))
    return stored.select("unique_key", "created_at", "closed_at")


def h16(spark, sf_dir):
    """Recorded results of the staging gate and whether it blocks the later layers."""
    wh, state = checked(spark, sf_dir)
    rows = check_results(wh).filter(F.col("failing_rows") > 0)
    return rows.select("test", "failing_rows", F.lit(not state.ok).alias("blocked"))


H16_SQL = t.over_staged(
    """select * , true as blocked from (
    unpivot (select count_if(created_at is null) as not_null_service_requests_created_at,
        count_if(latitude not between 40.49 and 40.92) as within_range_service_requests_latitude,
        count_if(longitude not between -74.26 and -73.70)
            as within_range_service_requests_longitude,
        count_if(closed_at < created_at) as closed_not_before_created from requests)
    on columns(*) into name test value failing_rows)"""
)

CLOSED_SQL = t.over_staged(
    "select unique_key, created_at, closed_at from requests where closed_at < created_at"
)

QUERIES = {
    "h1_unique": (h1, H1_SQL),
    "h2_not_null": (
        h2,
        t.over_staged("select unique_key, agency from requests where created_at is null"),
    ),
    "h3_accepted_values": (h3, H3_SQL),
    "h4_relationships": (h4, H4_SQL),
    "h4_relationships_hold": (
        h4_holds,
        "select l_orderkey as from_field, count(*) as n_records from lineitem "
        "where l_orderkey not in (select o_orderkey from orders) group by all",
    ),
    "h5_within_range": (
        h5,
        t.over_staged(
            "select latitude from requests where latitude < 40.49 or latitude > 40.92"
        ),
    ),
    "h6_zip_is_5_digits": (
        h6,
        t.with_ctes(
            "select incident_zip from raw_requests "
            "where not regexp_full_match(incident_zip, '[0-9]{5}')",
            t.RAW_SQL,
        ),
    ),
    "h7_closed_before_created": (h7, CLOSED_SQL),
    "h8_no_future_created": (
        h8,
        t.over_staged(
            "select unique_key, created_at from requests "
            "where created_at > timestamp '2001-01-01' + interval 1 day"
        ),
    ),
    "h9_duplicate_rate": (h9, H9_SQL),
    "h10_raw_freshness": (h10, H10_SQL),
    "h11_schema_stable": (h11, H11_SQL),
    "h12_last_run_succeeded": (h12, H12_SQL),
    "h13_health_freshness": (
        h13,
        t.over_marts(
            "select hours_since_source_update from health "
            "where hours_since_source_update not between 0 and 72"
        ),
    ),
    "h14_severity": (h14, H14_SQL),
    "h15_store_failures": (h15, CLOSED_SQL),
    "h16_gate": (h16, H16_SQL),
}
