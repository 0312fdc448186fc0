"""Marts and checks from merged state, the backlog of past days, survival curves."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.operators import checks as c
from caseflow.operators.incremental import touched
from caseflow.plans import backlog_on as past
from caseflow.plans import delta_marts as dm
from caseflow.plans import landing_sketch as ls
from caseflow.plans import resolution_sketch as rs
from caseflow.plans import survival
from caseflow.plans.core import fct_service_requests
from caseflow.plans.staging import latest_requests
from caseflow.queries import tables as t
from caseflow.session import materialise, scratch_path
from caseflow.sources.runlog import coverage_start

# The requests land in three parts; each closes, reopens and moves requests of the parts before.
PARTS = ["v2", "v4", "v7"]
# What the marts and the sketches read of the fact: the builds compute no more of it.
FACT_COLUMNS = [
    "unique_key",
    "created_at",
    "created_date",
    "agency_key",
    "complaint_type_key",
    "borough",
    "status",
    "has_geo",
    "is_closed",
    "hours_to_close",
    "open_age_days",
]


class Build(NamedTuple):
    """The fact after a build, and the rows of the requests it touched, before and after."""

    fact: DataFrame
    old: DataFrame | None
    new: DataFrame


def builds(spark, sf_dir) -> list[Build]:
    raw, done = t.raw_requests(spark, sf_dir), []
    version, before = F.col("sys_version"), None
    for part in PARTS:
        staged = latest_requests(raw.filter(version <= part))
        fact = fct_service_requests(staged, t.REQUESTS_AS_OF).select(*FACT_COLUMNS)
        fact = materialise(fact, "fact")
        if done:
            landed = raw.filter(version <= part).filter(version > before)
            keys = materialise(landed.select("unique_key").distinct(), "keys")
            done.append(Build(fact, touched(done[-1].fact, keys), touched(fact, keys)))
        else:
            done.append(Build(fact, None, fact))
        before = part
    return done


def f2_sketch(spark, sf_dir):
    """State of three builds, each written once; quantiles are compared in rank with the durations."""
    runs = materialise(t.request_runs(spark, sf_dir), "runs")
    root = scratch_path(spark, "resolution")
    for number, build in enumerate(builds(spark, sf_dir)):
        new = rs.durations(build.new, runs)
        if build.old is None:
            rows = rs.sketched(new, number)
        else:
            current = rs.durations(build.fact, runs)
            old = materialise(rs.durations(build.old, runs), "old")
            rows = rs.next_state(old, materialise(new, "new"), current, number)
        rows.drop("build").write.parquet(f"{root}/build={number}")
    state = spark.read.parquet(root)
    errors = rs.rank_errors(state, rs.durations(build.fact, runs))
    within = errors.groupBy(*rs.KEYS).agg((F.max("rank_error") <= rs.RANK_ERROR).alias("within_error"))
    mart = rs.resolution_of_sketches(state, t.agencies(spark, sf_dir))
    return mart.drop("median_hours_to_close", "p90_hours_to_close").join(within, rs.KEYS)


F2_SKETCH_SQL = t.over_marts(
    """select week_start, agency, agency_name, n_closed, mean_hours_to_close, share_closed_within_24h,
    true as within_error from resolution"""
)


def f1_deltas(spark, sf_dir):
    state = None
    for build in builds(spark, sf_dir):
        state = materialise(dm.fold_volume(state, build.old, build.new), "volume")
    start = coverage_start(t.request_runs(spark, sf_dir)).first()[0]
    types, days = t.complaint_types(spark, sf_dir), t.calendar(spark, sf_dir)
    return dm.volume_of_state(state, types, days, start)


def f3_deltas(spark, sf_dir):
    state = None
    for build in builds(spark, sf_dir):
        state = materialise(dm.fold_backlog(state, build.old, build.new), "backlog")
    return dm.backlog_of_state(state, t.REQUESTS_AS_OF)


def f3_on(spark, sf_dir):
    """The backlog at the end of every day a run was started on."""
    dates = t.request_runs(spark, sf_dir).select(F.to_date("started_at").alias("on_date"))
    created = t.fact(spark, sf_dir).select("unique_key", "created_date")
    return past.backlog_on(t.history(spark, sf_dir), created, dates)


F3_ON_SQL = t.with_ctes(
    """select on_date, agency, v.status, case when on_date - created_date < 1 then '0. < 1 day'
        when on_date - created_date < 7 then '1. 1-7 days'
        when on_date - created_date < 30 then '2. 7-30 days'
        when on_date - created_date < 90 then '3. 30-90 days' else '4. > 90 days' end as age_bucket,
    count(*) as n_open
    from (select unique_key, agency, source_updated_at::date as first_day,
            case upper(status) when 'CLOSED' then 'Closed' when 'OPEN' then 'Open'
                when 'IN PROGRESS' then 'In Progress' when 'STARTED' then 'In Progress'
                when 'ASSIGNED' then 'Assigned' when 'PENDING' then 'Pending'
                else 'Unspecified' end as status,
            coalesce(lead(source_updated_at) over (partition by unique_key order by version_no)::date,
                date '9999-12-31') as end_day
          from history) v
    join (select distinct started_at::date as on_date from runs) d
        on first_day <= on_date and on_date < end_day
    left join fact using (unique_key)
    where v.status <> 'Closed' group by all""",
    t.RAW_SQL,
    t.RUNS_SQL,
    t.VERSIONS_SQL,
    t.HISTORY_SQL,
    t.STAGED_SQL,
    t.FACT_SQL,
)


H9_LOGS = {"requests": (t.raw_requests, 0.001), "events": (t.event_versions, 0.20)}


def h9_sketch(spark, sf_dir):
    """Duplicate rates of two logs from the sketches of their landings. Where the limit lies within
    the error, the exact check decides."""
    rates = []
    for name, (log, limit) in H9_LOGS.items():
        raw = log(spark, sf_dir)
        sketches = materialise(ls.landing_sketches(raw), "landings")
        rate, exact = ls.duplicate_rate(sketches, limit), c.duplicate_rate(raw, limit)
        if not rate.first()["decided"]:
            rate = rate.drop("status").join(exact.select("n_rows", "status"), "n_rows")
        off = F.abs(F.col("duplicate_rate") - F.col("exact_rate"))
        exact_rate = exact.select("n_rows", F.col("duplicate_rate").alias("exact_rate"))
        checked = rate.join(exact_rate, "n_rows")
        rates.append(
            checked.select(
                F.lit(name).alias("log"),
                "n_rows",
                "status",
                (off <= F.col("rate_error") + 1e-12).alias("within_error"),
            )
        )
    return reduce(DataFrame.unionByName, rates)


def _h9_rows(name: str, table: str) -> str:
    return f"""select '{name}' as log, n_rows, case when (n_rows - n_versions) / n_rows > {H9_LOGS[name][1]}
        then 'WARN' else 'PASS' end as status, true as within_error
    from (select count(*) as n_rows, count(distinct (unique_key, sys_updated_at)) as n_versions
          from {table})"""


H9_SKETCH_SQL = t.with_ctes(
    _h9_rows("requests", "raw_requests") + " union all " + _h9_rows("events", "log"),
    t.RAW_SQL,
    t.EVENT_VERSIONS_SQL,
)


def g14_overlaps(spark, sf_dir):
    """How much of every day's landing the day before had landed; exact up to 16,384 versions a day."""
    sketches = materialise(ls.landing_sketches(t.event_versions(spark, sf_dir)), "landings")
    return ls.overlaps(sketches)


G14_OVERLAPS_SQL = t.with_ctes(
    """select _ingested_at as landing, count(*) as n_rows,
        count(distinct (unique_key, sys_updated_at)) as n_versions,
        count(distinct (unique_key, sys_updated_at)) filter (known) as n_again
    from (select l._ingested_at, l.unique_key, l.sys_updated_at,
              exists (select 1 from log x where x._ingested_at = d.before
                  and x.unique_key = l.unique_key and x.sys_updated_at = l.sys_updated_at) as known
          from log l join (select landing, lag(landing) over (order by landing) as before
                           from (select distinct _ingested_at as landing from log)) d
              on d.landing = l._ingested_at)
    group by 1""",
    t.EVENT_VERSIONS_SQL,
)

def f2_survival(spark, sf_dir):
    counts = survival.durations(t.fact(spark, sf_dir), t.request_runs(spark, sf_dir))
    return survival.close_survival(counts)


F2_SURVIVAL_SQL = t.over_marts(
    """select agency, sum(n_closed)::bigint as n_closed, sum(n_open)::bigint as n_open,
    """
    + "".join(
        f"round(coalesce(min(share) filter (minutes <= {d * 1440}), 1.0::double), 9) as share_open_after_{d}d, "
        for d in survival.HORIZONS
    )
    + """round(min(minutes) filter (share <= 0.5) / 60.0::double, 6) as median_hours_to_close
    from (select *, product(1.0::double - n_closed::double / n_at_risk) over (partition by agency
              order by minutes rows between unbounded preceding and current row) as share
          from (select *, sum(n_closed + n_open) over (partition by agency order by minutes
                    rows between current row and unbounded following) as n_at_risk
                from (select agency_key as agency,
                          round(case when is_closed then hours_to_close * 60
                              when open_age_days >= 0 then open_age_days * 1440 end)::bigint as minutes,
                          count_if(is_closed) as n_closed, count_if(not is_closed) as n_open
                      from fact
                      where agency_key is not null and created_at >= (select coverage_start from coverage)
                      group by 1, 2 having minutes is not null)))
    group by agency"""
)

QUERIES = {
    "f2_close_survival": (f2_survival, F2_SURVIVAL_SQL),
    "f1_volume_deltas": (f1_deltas, t.over_marts("select * from volume")),
    "f2_resolution_sketch": (f2_sketch, F2_SKETCH_SQL),
    "f3_backlog_deltas": (f3_deltas, t.over_marts("select * from backlog")),
    "f3_backlog_on": (f3_on, F3_ON_SQL),
    "h9_duplicate_rate_sketch": (h9_sketch, H9_SKETCH_SQL),
    "g14_landing_overlap": (g14_overlaps, G14_OVERLAPS_SQL),
}
