"""Marts: daily volume, time to resolution, open backlog, pipeline health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.functions import age_bucket, as_ntz, hours_between, or_unknown
from caseflow.functions.dates import week_start
from caseflow.operators.quantiles import (
    quantile_of_ranked,
    ranked_counts,
    round1,
    value_counts,
)
from caseflow.sources.runlog import FAILED, SUCCEEDED, coverage_start, latest_run


def count_where(condition: Column) -> Column:
    """Aggregate: rows for which the condition holds."""
    return F.sum(F.when(condition, 1).otherwise(0)).cast("long")


def created_in_coverage(fact: DataFrame, runs: DataFrame) -> DataFrame:
    """Complete cohorts only; the start is a scalar subquery, so the scan can be filtered by it."""
    return fact.filter(F.col("created_at") >= coverage_start(runs).scalar())


def mart_daily_volume(
    fact: DataFrame, complaint_types: DataFrame, calendar: DataFrame, runs: DataFrame
) -> DataFrame:
    """Requests created per day, borough, family and agency.

    The fact is counted per complaint key first, so the joins move counts, not requests.
    """
    counts = (
        created_in_coverage(fact, runs)
        .groupBy(
            "created_date",
            or_unknown("borough").alias("borough"),
            "complaint_type_key",
            F.col("agency_key").alias("agency"),
        )
        .agg(
            F.count("*").alias("n_requests"),
            count_where(F.col("is_closed")).alias("n_closed"),
            count_where(F.col("has_geo")).alias("n_with_geo"),
        )
    )
    return volume_of_counts(counts, complaint_types, calendar)


def volume_of_counts(counts: DataFrame, complaint_types: DataFrame, calendar: DataFrame) -> DataFrame:
    """The mart from requests counted per day, borough, complaint key and agency."""
    families = complaint_types.select("complaint_type_key", "complaint_family")
    days = calendar.select(F.col("date_day").alias("created_date"), "year_month", "is_weekend")
    joined = counts.join(families, "complaint_type_key").join(days, "created_date", "left")
    grain = ["created_date", "year_month", "is_weekend", "borough", "complaint_family", "agency"]
    sums = [F.sum(c).alias(c) for c in ("n_requests", "n_closed", "n_with_geo")]
    return joined.groupBy(*grain).agg(*sums)


def mart_resolution_time(fact: DataFrame, agencies: DataFrame, runs: DataFrame) -> DataFrame:
    """Week of creation by agency: number closed, median, p90, mean and the share within a day.

    Quantiles are exact, over counts per distinct duration: no group is held in memory.
    """
    closed = created_in_coverage(fact, runs).filter(
        F.col("is_closed") & F.col("hours_to_close").isNotNull() & F.col("agency_key").isNotNull()
    )
    keys, value = ["week_start", "agency"], "hours_to_close"
    durations = closed.select(
        week_start("created_date").alias("week_start"), F.col("agency_key").alias("agency"), value
    )
    ranked = ranked_counts(value_counts(durations, keys, value), keys, value)
    n = F.sum("_n")
    # Durations are whole minutes, so their sum is exact and does not depend on the task order.
    minutes = F.sum(F.round(F.col(value) * 60).cast("long") * F.col("_n"))
    stats = ranked.groupBy(*keys).agg(
        n.alias("n_closed"),
        round1(quantile_of_ranked(value, 0.5)).alias("median_hours_to_close"),
        round1(quantile_of_ranked(value, 0.9)).alias("p90_hours_to_close"),
        round1(minutes / (F.lit(60.0) * n)).alias("mean_hours_to_close"),
        (F.sum(F.when(F.col(value) <= 24, F.col("_n")).otherwise(0)) / n.cast("double")).alias(
            "share_closed_within_24h"
        ),
    )
    names = agencies.select(F.col("agency_key").alias("agency"), "agency_name")
    return stats.join(names, "agency").select(
        *keys,
        "agency_name",
        "n_closed",
        "median_hours_to_close",
        "p90_hours_to_close",
        "mean_hours_to_close",
        "share_closed_within_24h",
    )


def mart_open_backlog(fact: DataFrame, as_of) -> DataFrame:
    """Requests that are not closed, by age. A null age (a close time without the closed status)
    falls into the last bucket."""
    return (
        fact.filter(~F.col("is_closed"))
        .groupBy(
            F.col("agency_key").alias("agency"),
            or_unknown("borough").alias("borough"),
            "status",
            age_bucket("open_age_days").alias("age_bucket"),
        )
        .agg(*backlog_measures(F.lit(1)))
        .withColumn("as_of", as_ntz(as_of))
    )


def backlog_measures(n: Column) -> list[Column]:
    """Aggregates over rows that stand for ``n`` open requests each. Ages are whole minutes, so their
    sum does not depend on the task order."""
    age = F.col("open_age_days")
    minutes = F.sum(F.round(age * (24 * 60)).cast("long") * n)
    aged = F.sum(F.when(age.isNotNull(), n))
    return [
        F.sum(n).cast("long").alias("n_open"),
        round1(minutes / (F.lit(24 * 60.0) * aged)).alias("avg_age_days"),
        F.max(age).alias("max_age_days"),
    ]


def mart_pipeline_health(fact: DataFrame, runs: DataFrame, as_of) -> DataFrame:
    """One row for the banner; none while no run has succeeded."""
    facts = fact.agg(
        F.count("*").alias("n_requests"),
        F.max("source_updated_at").alias("newest_source_update"),
        F.max("_ingested_at").alias("newest_ingest"),
        count_where(F.col("has_invalid_close_time")).alias("n_invalid_close_time"),
    )
    last_ok = latest_run(runs, ok_only=True).select(
        F.struct("run_id", "finished_at", "rows_fetched")
    )
    last_any = latest_run(runs).select(F.struct("status", "error"))
    tally = runs.agg(
        F.struct(
            F.count_if(F.col("status") == SUCCEEDED).alias("ok"),
            F.count_if(F.col("status") == FAILED).alias("failed"),
        )
    )
    row = facts.withColumns(
        {"_ok": last_ok.scalar(), "_any": last_any.scalar(), "_tally": tally.scalar()}
    ).filter(F.col("_ok").isNotNull())
    return row.select(
        "n_requests",
        "newest_source_update",
        hours_between("newest_source_update", as_ntz(as_of)).alias("hours_since_source_update"),
        "newest_ingest",
        "n_invalid_close_time",
        F.col("_ok.run_id").alias("last_successful_run_id"),
        F.col("_ok.finished_at").alias("last_successful_run_at"),
        F.col("_ok.rows_fetched").alias("last_successful_rows"),
        F.col("_any.status").alias("last_run_status"),
        F.col("_any.error").alias("last_run_error"),
        F.col("_tally.ok").alias("n_successful_runs"),
        F.col("_tally.failed").alias("n_failed_runs"),
    )
