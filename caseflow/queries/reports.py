"""Report queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from caseflow.plans import profile_shift as shift
from caseflow.plans import reports as r
from caseflow.plans.refresh import check_results
from caseflow.queries import model, quality
from caseflow.queries import tables as t
from caseflow.sources.runlog import coverage_start

FIRST_DAY, LAST_DAY = date(1998, 1, 1), date(1998, 6, 30)
RANGE_SQL = "date '1998-01-01' and date '1998-06-30'"


def g1(spark, sf_dir):
    """Freshness of every agency's newest update, as of two days after the newest of all."""
    fact = t.fact(spark, sf_dir)
    newest = fact.groupBy("agency_key").agg(F.max("source_updated_at").alias("newest"))
    hours = r.hours_between("newest", F.lit("2001-11-07 00:00:00").cast("timestamp_ntz"))
    rows = newest.withColumn("hours", hours)
    return rows.select("agency_key", "hours", r.freshness_label("hours").alias("freshness"))


G1_SQL = t.over_core(
    """select agency_key, date_diff('hour', max(source_updated_at), timestamp '2001-11-07') as hours,
    case when hours > 72 then 'STALE' when hours > 36 then 'LATE' else 'FRESH' end as freshness
    from fact group by agency_key"""
)


def g2(spark, sf_dir):
    return r.volume_headline(r.volume_selection(model.f1(spark, sf_dir)))


G2_SQL = t.over_marts(
    """select coalesce(sum(n_requests), 0)::bigint as n_requests,
    coalesce(sum(n_closed), 0)::double / greatest(coalesce(sum(n_requests), 0), 1) as share_closed,
    1 - coalesce(sum(n_with_geo), 0)::double / greatest(coalesce(sum(n_requests), 0), 1)
        as share_without_geo
    from volume where borough <> 'UNKNOWN' and created_date between
        (select min(created_date) from volume)
        and (select greatest(min(created_date), max(created_date) - 1) from volume)"""
)


def g3(spark, sf_dir):
    return r.category_ranking(model.f1(spark, sf_dir))


def g3_boroughs(spark, sf_dir):
    return r.borough_list(model.f1(spark, sf_dir))


def selected(spark, sf_dir):
    return r.volume_selection(model.f1(spark, sf_dir), FIRST_DAY, LAST_DAY)


def g4(spark, sf_dir):
    return r.densify(selected(spark, sf_dir), "complaint_family", FIRST_DAY, LAST_DAY)


G4_SQL = t.over_marts(
    f"""select d.date_day as created_date, c.complaint_family,
        coalesce(sum(v.n_requests), 0)::bigint as n_requests
    from calendar d
    cross join (select distinct complaint_family from volume where borough <> 'UNKNOWN'
                and created_date between {RANGE_SQL}) c
    left join volume v on v.created_date = d.date_day and v.complaint_family = c.complaint_family
        and v.borough <> 'UNKNOWN'
    where d.date_day between {RANGE_SQL} group by all"""
)


def g4_order(spark, sf_dir):
    return r.category_ranking(selected(spark, sf_dir), "borough")


G4_ORDER_SQL = t.over_marts(
    f"""select borough, sum(n_requests)::bigint as n_requests from volume
    where borough <> 'UNKNOWN' and created_date between {RANGE_SQL} group by all"""
)


def g5(spark, sf_dir):
    return r.agency_resolution(model.f2(spark, sf_dir), FIRST_DAY, LAST_DAY)


G5_SQL = t.over_marts(
    """select agency, agency_name, sum(n_closed)::bigint as n_closed,
    round(sum(median_hours_to_close * n_closed), 6) / sum(n_closed) as weighted_median_hours,
    round(sum(p90_hours_to_close * n_closed), 6) / sum(n_closed) as weighted_p90_hours,
    round(sum(share_closed_within_24h * n_closed), 6) / sum(n_closed) as within_24h
    from resolution where week_start between date '1997-12-26' and date '1998-06-30'
    group by agency, agency_name order by 3 desc, agency limit 10"""
)


def g6(spark, sf_dir):
    return r.backlog_by_agency(r.known_boroughs(model.f3(spark, sf_dir)), 3)


G6_SQL = t.over_marts(
    """select agency, age_bucket, sum(n_open)::bigint as n_open from backlog
    where borough <> 'UNKNOWN' and agency in (select agency from backlog
        where borough <> 'UNKNOWN' and agency is not null
        group by agency order by sum(n_open) desc, agency limit 3)
    group by all"""
)


def g7(spark, sf_dir):
    return r.backlog_totals(r.known_boroughs(model.f3(spark, sf_dir)))


G7_SQL = t.over_marts(
    """select age_bucket, substr(age_bucket, 4) as label, sum(n_open)::bigint as n_open
    from backlog where borough <> 'UNKNOWN' group by all"""
)


def g8(spark, sf_dir):
    return r.status_transitions(t.history(spark, sf_dir), 12)


G8_SQL = t.over_history(
    """select coalesce(previous_status, '(first seen)') as from_status, status as to_status,
    count(*) as n from history where version_no > 1 group by all
    order by n desc, from_status, to_status nulls last limit 12"""
)


def g9(spark, sf_dir):
    return r.versions_histogram(t.raw_requests(spark, sf_dir))


G9_SQL = t.with_ctes(
    """select n_versions, count(*) as requests from (
    select count(distinct sys_updated_at) as n_versions from raw_requests group by unique_key)
    group by all""",
    t.RAW_SQL,
)


def g10(spark, sf_dir):
    return r.version_gap_stats(t.history(spark, sf_dir))


G10_SQL = t.over_history(
    """select count(*) as requests_with_2plus_versions,
    round(avg(date_diff('hour', previous_updated_at, source_updated_at)), 1)
        as avg_hours_between_versions,
    max(version_no) as max_versions from history where version_no > 1"""
)


def g11(spark, sf_dir):
    return r.late_closures(t.history(spark, sf_dir), t.fact(spark, sf_dir))


G11_SQL = t.with_ctes(
    """select date_diff('day', f.created_at, h.source_updated_at) as days_after_creation,
    count(*) as closures from history h join fact f using (unique_key)
    where h.version_no > 1 and h.status = 'Closed' and h.previous_status <> 'Closed'
    group by all order by 1 nulls last limit 15""",
    t.RAW_SQL,
    t.STAGED_SQL,
    t.VERSIONS_SQL,
    t.HISTORY_SQL,
    t.FACT_SQL,
)


def dq_results(spark, sf_dir):
    """The recorded outcome of every check of a stored build."""
    wh, _ = quality.checked(spark, sf_dir)
    return check_results(wh)


def g12(spark, sf_dir):
    return r.dq_summary(dq_results(spark, sf_dir))


def g12_headline(spark, sf_dir):
    return r.dq_headline(dq_results(spark, sf_dir))


DQ_SQL = f"""
results as (
    unpivot (select count_if(unique_key is null) as not_null_service_requests_unique_key,
        count_if(created_at is null) as not_null_service_requests_created_at,
        count_if(not regexp_full_match(incident_zip, '[0-9]{{5}}'))
            as zip_is_5_digits_service_requests_incident_zip,
        count_if(latitude not between 40.49 and 40.92) as within_range_service_requests_latitude,
        count_if(longitude not between -74.26 and -73.70)
            as within_range_service_requests_longitude,
        count_if(source_updated_at is null) as not_null_service_requests_source_updated_at,
        count_if(closed_at < created_at) as closed_not_before_created,
        count_if(created_at > timestamp '{t.REQUESTS_AS_OF}' + interval 1 day)
            as no_future_created_at,
        (select count(*) from (select unique_key from requests group by 1 having count(*) > 1))
            as unique_service_requests_unique_key,
        count(distinct status) filter (status not in (
            'Closed', 'Open', 'In Progress', 'Assigned', 'Pending', 'Unspecified'))
            as accepted_values_service_requests_status,
        count(distinct borough) filter (borough not in (
            'BRONX', 'BROOKLYN', 'MANHATTAN', 'QUEENS', 'STATEN ISLAND'))
            as accepted_values_service_requests_borough,
        (select count(*) from (select 1 from versions group by unique_key, sys_updated_at
            having count(*) > 1)) as unique_request_versions_version,
        (select count_if(unique_key is null) from versions) as not_null_request_versions_unique_key
        from requests)
    on columns(*) into name test value failing_rows
)"""


def g13(spark, sf_dir):
    return r.health_report(model.f4(spark, sf_dir))


G13_SQL = t.over_marts(
    """select n_requests, newest_source_update::varchar as newest_source_update,
    hours_since_source_update, n_invalid_close_time, n_successful_runs, n_failed_runs from health"""
)


def g13_banner(spark, sf_dir):
    return r.freshness_banner(model.f4(spark, sf_dir))


G13_BANNER_SQL = t.over_marts(
    """select newest_source_update, hours_since_source_update,
    case when hours_since_source_update > 72 then 'STALE' when hours_since_source_update > 36
    then 'LATE' else 'FRESH' end as freshness from health"""
)


def g14(spark, sf_dir):
    start = coverage_start(t.request_runs(spark, sf_dir)).scalar()
    return r.late_arrivals(t.requests(spark, sf_dir), start)


G14_SQL = t.with_ctes(
    """select count(*) as n_requests,
    count_if(created_at < (select coverage_start from coverage))::bigint
        as n_created_before_coverage,
    count(distinct source_updated_at) as n_update_times,
    (select max(n) from (select count(*) as n from requests group by source_updated_at))
        as largest_tie from requests""",
    t.RAW_SQL,
    t.RUNS_SQL,
    t.STAGED_SQL,
)


def g15(spark, sf_dir):
    rates = r.null_rates(t.requests(spark, sf_dir))
    return rates.select(*[F.round(c, 9).alias(c) for c in rates.columns])


G15_SQL = t.over_staged(
    """select round(count_if(latitude is null or longitude is null) / count(*), 9)
        as no_coordinates,
    round(count_if(incident_zip is null) / count(*), 9) as no_zip,
    round(count_if(borough is null) / count(*), 9) as no_borough from requests"""
)

def g3_levels(spark, sf_dir):
    return r.volume_levels(r.volume_selection(model.f1(spark, sf_dir)))


G3_LEVELS_SQL = t.over_marts(
    """select case grouping_id(complaint_family, borough, agency, created_date)
            when 15 then 'headline' when 7 then 'family' when 11 then 'borough' when 13 then 'agency'
            when 14 then 'day' when 6 then 'day_family' when 10 then 'day_borough' end as level,
        complaint_family, borough, agency, created_date, sum(n_requests)::bigint as n_requests,
        sum(n_closed)::double / greatest(sum(n_requests), 1) as share_closed,
        1 - sum(n_with_geo)::double / greatest(sum(n_requests), 1) as share_without_geo
    from volume where borough <> 'UNKNOWN' and created_date between
        (select min(created_date) from volume)
        and (select greatest(min(created_date), max(created_date) - 1) from volume)
    group by grouping sets ((), (complaint_family), (borough), (agency), (created_date),
        (created_date, complaint_family), (created_date, borough))"""
)


def g15_shift(spark, sf_dir):
    """Landed text by the month it was landed in, each month against the one before."""
    raw = t.raw_requests(spark, sf_dir)
    bins = {c: F.col(c) for c in ("agency", "status", "borough")}
    bins["latitude"] = shift.numeric_bin(F.col("latitude"), [40.25, 40.5, 40.75])
    bins["incident_zip"] = F.substring(F.trim("incident_zip"), 1, 4)
    return shift.shifts(shift.profile(raw, F.substring("_ingested_at", 1, 7), bins))


G15_SHIFT_SQL = t.with_ctes(
    """select landing, previous, col as "column", sum(n)::bigint as n_rows, count(*) as n_bins,
        round(coalesce(sum(n) filter (bin is null), 0) / sum(n), 6) as null_rate,
        round(coalesce(sum(n_before) filter (bin is null), 0) / sum(n_before), 6) as previous_null_rate,
        round(max(abs(n / rows - n_before / rows_before)), 6) as largest_gap,
        round(sum((p - q) * ln(p / q)), 6) as psi,
        case when psi > 0.25 then 'ERROR' when psi > 0.1 then 'WARN' else 'PASS' end as status
    from (select *, (n + 0.5::double) / (rows + 0.5::double * n_bins) as p,
              (n_before + 0.5::double) / (rows_before + 0.5::double * n_bins) as q
          from (select *, sum(n) over pair as rows, sum(n_before) over pair as rows_before,
                    count(*) over pair as n_bins
                from (select m.landing, m.previous, c.col, c.bin,
                          coalesce(sum(c.n) filter (c.landing = m.landing), 0) as n,
                          coalesce(sum(c.n) filter (c.landing = m.previous), 0) as n_before
                      from months m join counts c on c.landing in (m.landing, m.previous)
                      where m.previous is not null group by all)
                window pair as (partition by landing, col)))
    group by landing, previous, col""",
    t.RAW_SQL,
    """cells as (
        select left(_ingested_at, 7) as landing, agency, status, borough,
            case when isnan(lat) then null else (lat >= 40.25)::int + (lat >= 40.5)::int
                + (lat >= 40.75)::int end::varchar as latitude,
            left(trim(incident_zip), 4) as incident_zip
        from (select *, try_cast(case when latitude similar to '[-0-9.]+' then latitude end as double) as lat
              from raw_requests)
    )""",
    """counts as (
        select landing, col, bin, count(*) as n from (
            select landing, unnest(['agency', 'status', 'borough', 'latitude', 'incident_zip']) as col,
                unnest([agency, status, borough, latitude, incident_zip]) as bin from cells)
        group by all
    )""",
    "months as (select landing, lag(landing) over (order by landing) as previous"
    " from (select distinct landing from counts))",
)

QUERIES = {
    "g3_volume_levels": (g3_levels, G3_LEVELS_SQL),
    "g15_profile_shift": (g15_shift, G15_SHIFT_SQL),
    "g1_freshness_label": (g1, G1_SQL),
    "g2_volume_selection": (g2, G2_SQL),
    "g3_family_ranking": (
        g3,
        t.over_marts(
            "select complaint_family, sum(n_requests)::bigint as n_requests from volume group by all"
        ),
    ),
    "g3_boroughs": (g3_boroughs, t.over_marts("select distinct borough from volume")),
    "g4_densify": (g4, G4_SQL),
    "g4_category_order": (g4_order, G4_ORDER_SQL),
    "g5_agency_resolution": (g5, G5_SQL),
    "g6_backlog_by_agency": (g6, G6_SQL),
    "g7_backlog_totals": (g7, G7_SQL),
    "g8_status_transitions": (g8, G8_SQL),
    "g9_versions_histogram": (g9, G9_SQL),
    "g10_version_gap_stats": (g10, G10_SQL),
    "g11_late_closures": (g11, G11_SQL),
    "g12_dq_summary": (
        g12,
        t.with_ctes(
            "select test, failing_rows from results",
            t.RAW_SQL,
            t.STAGED_SQL,
            t.VERSIONS_SQL,
            DQ_SQL,
        ),
    ),
    "g12_dq_headline": (
        g12_headline,
        t.with_ctes(
            "select count(*) as n_tests, count_if(failing_rows > 0)::bigint as n_failing from results",
            t.RAW_SQL,
            t.STAGED_SQL,
            t.VERSIONS_SQL,
            DQ_SQL,
        ),
    ),
    "g13_health_report": (g13, G13_SQL),
    "g13_freshness_banner": (g13_banner, G13_BANNER_SQL),
    "g14_late_arrivals": (g14, G14_SQL),
    "g15_null_rates": (g15, G15_SQL),
}
