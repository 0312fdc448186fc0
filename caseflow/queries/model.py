"""Dimensions, facts and marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseflow.plans import marts as m
from caseflow.plans.core import calendar, days_of
from caseflow.queries import tables as t


def e4(spark, sf_dir):
    """The calendar of the days the orders span, and a year more."""
    days = F.to_date("o_orderdate")
    bounds = t.table(spark, sf_dir, "orders").agg(
        F.min(days).alias("first"), F.add_months(F.max(days), 12).alias("last")
    )
    return calendar(days_of(bounds, F.col("first"), F.col("last")))


E4_SQL = t.CALENDAR_SELECT_SQL.format(
    """(select unnest(generate_series(min(o_orderdate)::date::timestamp,
        max(o_orderdate)::date + interval 1 year, interval 1 day))::date as date_day from orders)"""
)


def e7(spark, sf_dir):
    """Fact with its type (inner), its day (left) and its agency (inner)."""
    fact = t.fact(spark, sf_dir).select(
        "unique_key", "created_date", "agency_key", "complaint_type_key"
    )
    types = t.complaint_types(spark, sf_dir).select("complaint_type_key", "complaint_family")
    days = t.calendar(spark, sf_dir).select(F.col("date_day").alias("created_date"), "day_name")
    names = t.agencies(spark, sf_dir).select("agency_key", "agency_name")
    joined = fact.join(types, "complaint_type_key").join(days, "created_date", "left")
    return joined.join(names, "agency_key")


E7_SQL = t.over_core(
    """select unique_key, created_date, agency_key, f.complaint_type_key, complaint_family, day_name,
    agency_name from fact f join complaint_types c using (complaint_type_key)
    left join calendar d on d.date_day = f.created_date join agencies using (agency_key)"""
)


def f1(spark, sf_dir):
    return m.mart_daily_volume(
        t.fact(spark, sf_dir),
        t.complaint_types(spark, sf_dir),
        t.calendar(spark, sf_dir),
        t.request_runs(spark, sf_dir),
    )


def f2(spark, sf_dir):
    return m.mart_resolution_time(
        t.fact(spark, sf_dir), t.agencies(spark, sf_dir), t.request_runs(spark, sf_dir)
    )


def f3(spark, sf_dir):
    return m.mart_open_backlog(t.fact(spark, sf_dir), t.REQUESTS_AS_OF)


def f4(spark, sf_dir):
    return m.mart_pipeline_health(
        t.fact(spark, sf_dir), t.request_runs(spark, sf_dir), t.REQUESTS_AS_OF
    )


QUERIES = {
    "e1_dim_agency": (t.agencies, t.over_core("select * from agencies")),
    "e2_dim_location": (t.locations, t.over_core("select * from locations")),
    "e3_dim_complaint_type": (t.complaint_types, t.over_core("select * from complaint_types")),
    "e4_dim_date": (e4, E4_SQL),
    "e5_fct_service_requests": (t.fact, t.over_core("select * from fact")),
    "e6_fct_status_history": (t.history, t.over_history("select * from history")),
    "e7_star_joins": (e7, E7_SQL),
    "f1_daily_volume": (f1, t.over_marts("select * from volume")),
    "f2_resolution_time": (f2, t.over_marts("select * from resolution")),
    "f3_open_backlog": (f3, t.over_marts("select * from backlog")),
    "f4_pipeline_health": (f4, t.over_marts("select * from health")),
}
