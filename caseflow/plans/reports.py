"""Report queries over the marts, the history, the landing zone and the run log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.functions import days_between, freshness_label, hours_between
from caseflow.operators.quantiles import round1
from caseflow.plans.core import days_from
from caseflow.plans.marts import count_where
from caseflow.schema import Settings

Day = date | Column
UNKNOWN = "UNKNOWN"
FIRST_SEEN = "(first seen)"


def _day(value: Day) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("date")


def ratio(part: Column, whole: Column) -> Column:
    return part.cast("double") / whole.cast("double")


def freshness_banner(
    health: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    hours = F.col("hours_since_source_update")
    label = freshness_label(hours, settings.fresh_warn_hours, settings.fresh_error_hours)
    return health.select("newest_source_update", hours, label.alias("freshness"))


def default_range(volume: DataFrame) -> tuple[Column, Column]:
    """First day, and the day before the newest one: the newest is always partial."""
    first = volume.agg(F.min("created_date").alias("d")).scalar()
    bounds = volume.agg(F.min("created_date").alias("lo"), F.max("created_date").alias("hi"))
    last = bounds.select(F.greatest("lo", F.date_sub("hi", 1)).alias("d")).scalar()
    return first, last


def volume_selection(
    volume: DataFrame,
    first: Day | None = None,
    last: Day | None = None,
    boroughs: Sequence[str] | None = None,
    families: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of the daily volume mart in the selection; unknown boroughs are off by default."""
    if first is None or last is None:
        low, high = default_range(volume)
        first, last = first or low, last or high
    rows = volume.filter(F.col("created_date").between(_day(first), _day(last)))
    if boroughs is None:
        rows = rows.filter(F.col("borough") != UNKNOWN)
    else:
        rows = rows.filter(F.col("borough").isin(list(boroughs)))
    return rows if families is None else rows.filter(F.col("complaint_family").isin(list(families)))


def volume_headline(selection: DataFrame) -> DataFrame:
    """Total, share closed and share without coordinates; an empty selection divides by one."""
    sums = selection.agg(
        *[
            F.coalesce(F.sum(c), F.lit(0)).alias(c)
            for c in ("n_requests", "n_closed", "n_with_geo")
        ]
    )
    whole = F.greatest("n_requests", F.lit(1).cast("long"))
    return sums.select(
        "n_requests",
        ratio(F.col("n_closed"), whole).alias("share_closed"),
        (F.lit(1.0) - ratio(F.col("n_with_geo"), whole)).alias("share_without_geo"),
    )


def category_ranking(volume: DataFrame, by: str = "complaint_family") -> DataFrame:
    """Categories by total requests, largest first."""
    totals = volume.groupBy(by).agg(F.sum("n_requests").alias("n_requests"))
    return totals.orderBy(F.col("n_requests").desc(), F.col(by))


# Levels of the volume report, each by its columns.
VOLUME_LEVELS = {
    "headline": [],
    "family": ["complaint_family"],
    "borough": ["borough"],
    "agency": ["agency"],
    "day": ["created_date"],
    "day_family": ["created_date", "complaint_family"],
    "day_borough": ["created_date", "borough"],
}


def volume_levels(
    selection: DataFrame, levels: Mapping[str, Sequence[str]] = VOLUME_LEVELS
) -> DataFrame:
    """All levels of the volume report in one scan and one shuffle: headline, rankings and series.

    A row per ``level`` and group: the columns a level does not go by are null, the sums and shares
    are those of ``volume_headline``. A group by a null value keeps its row and its level. Levels by
    the same columns are one. An empty selection has no rows, not even a headline.
    """
    keys = list(dict.fromkeys(c for columns in levels.values() for c in columns))

    def number(columns: Sequence[str]) -> int:
        """grouping_id: a bit for each column summed over, the first column's the highest."""
        return sum(1 << (len(keys) - 1 - i) for i, key in enumerate(keys) if key not in columns)

    names = {number(columns): name for name, columns in levels.items()}
    sums = selection.groupingSets([[F.col(c) for c in cs] for cs in levels.values()], *keys).agg(
        F.grouping_id().alias("gid"),
        *[F.sum(c).alias(c) for c in ("n_requests", "n_closed", "n_with_geo")],
    )
    label = F.coalesce(*[F.when(F.col("gid") == gid, name) for gid, name in names.items()])
    whole = F.greatest("n_requests", F.lit(1).cast("long"))
    return sums.select(
        label.alias("level"),
        *keys,
        "n_requests",
        ratio(F.col("n_closed"), whole).alias("share_closed"),
        (F.lit(1.0) - ratio(F.col("n_with_geo"), whole)).alias("share_without_geo"),
    )


def borough_list(volume: DataFrame) -> DataFrame:
    return volume.select("borough").distinct().orderBy("borough")


def densify(selection: DataFrame, by: str, first: Day, last: Day) -> DataFrame:
    """Every day of the range for every category, zeros filled, in long format."""
    daily = selection.groupBy("created_date", by).agg(F.sum("n_requests").alias("n"))
    days = days_from(first, last)
    # Each category row unfolds into its own days.
    grid = selection.select(by).distinct().select(by, F.explode(days).alias("created_date"))
    return grid.join(daily, ["created_date", by], "left").select(
        "created_date", by, F.coalesce("n", F.lit(0)).alias("n_requests")
    )


def agency_resolution(resolution: DataFrame, first: Day, last: Day, n: int = 10) -> DataFrame:
    """Per agency: weekly medians, p90s and shares averaged by number closed; top ``n`` agencies."""
    weeks = resolution.filter(
        F.col("week_start").between(F.date_sub(_day(first), 6), _day(last))
    )
    total = F.sum("n_closed")

    def weighted(column: str) -> Column:
        # The rounding drops what the order of the additions leaves behind.
        return F.round(F.sum(F.col(column) * F.col("n_closed")), 6) / total

    rows = weeks.groupBy("agency", "agency_name").agg(
        total.alias("n_closed"),
        weighted("median_hours_to_close").alias("weighted_median_hours"),
        weighted("p90_hours_to_close").alias("weighted_p90_hours"),
        weighted("share_closed_within_24h").alias("within_24h"),
    )
    return rows.orderBy(F.col("n_closed").desc(), "agency").limit(n)


def known_boroughs(backlog: DataFrame, boroughs: Sequence[str] | None = None) -> DataFrame:
    if boroughs is None:
        return backlog.filter(F.col("borough") != UNKNOWN)
    return backlog.filter(F.col("borough").isin(list(boroughs)))


def backlog_by_agency(backlog: DataFrame, n: int = 10) -> DataFrame:
    """Open requests per age bucket of the ``n`` agencies with the most."""
    totals = backlog.filter(F.col("agency").isNotNull()).groupBy("agency")
    top = totals.agg(F.sum("n_open").alias("t")).orderBy(F.col("t").desc(), "agency").limit(n)
    rows = backlog.join(top, "agency", "left_semi").groupBy("agency", "age_bucket")
    return rows.agg(F.sum("n_open").alias("n_open"))


def backlog_totals(backlog: DataFrame) -> DataFrame:
    totals = backlog.groupBy("age_bucket").agg(F.sum("n_open").alias("n_open"))
    label = F.split_part("age_bucket", F.lit(". "), F.lit(2))
    return totals.select("age_bucket", label.alias("label"), "n_open")


def status_transitions(history: DataFrame, n: int = 10) -> DataFrame:
    """The commonest status changes."""
    changes = history.filter(F.col("version_no") > 1).groupBy(
        F.coalesce("previous_status", F.lit(FIRST_SEEN)).alias("from_status"),
        F.col("status").alias("to_status"),
    )
    ordered = changes.agg(F.count("*").alias("n")).orderBy(
        F.col("n").desc(), "from_status", F.col("to_status").asc_nulls_last()
    )
    return ordered.limit(n)


def versions_histogram(raw: DataFrame) -> DataFrame:
    """How many requests have been seen in how many versions."""
    versions = raw.groupBy("unique_key").agg(
        F.count_distinct("sys_updated_at").alias("n_versions")
    )
    return versions.groupBy("n_versions").agg(F.count("*").alias("requests"))


def version_gap_stats(history: DataFrame) -> DataFrame:
    """Rows after the first of each request, their mean gap in hours, the longest sequence.

    The first figure counts later versions: a request with three of them counts twice.
    """
    gap = hours_between("previous_updated_at", "source_updated_at")
    return history.filter(F.col("version_no") > 1).agg(
        F.count("*").alias("requests_with_2plus_versions"),
        round1(F.avg(gap)).alias("avg_hours_between_versions"),
        F.max("version_no").alias("max_versions"),
    )


def late_closures(history: DataFrame, fact: DataFrame, n: int = 15) -> DataFrame:
    """Days from creation to an observed closing; the first ``n`` values."""
    closings = history.filter(
        (F.col("version_no") > 1)
        & (F.col("status") == "Closed")
        & (F.col("previous_status") != "Closed")
    )
    # Only the day matters, so closings are counted per request and day before the join.
    daily = closings.groupBy("unique_key", F.to_date("source_updated_at").alias("day")).agg(
        F.count("*").alias("n")
    )
    joined = daily.join(fact.select("unique_key", "created_at"), "unique_key")
    days = days_between("created_at", "day").alias("days_after_creation")
    counted = joined.groupBy(days).agg(F.sum("n").alias("closures"))
    return counted.orderBy(F.col("days_after_creation").asc_nulls_last()).limit(n)


def dq_summary(results: DataFrame) -> DataFrame:
    """Checks by number of failing rows."""
    return results.select("test", "failing_rows").orderBy(F.col("failing_rows").desc(), "test")


def dq_headline(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count("*").alias("n_tests"), count_where(F.col("failing_rows") > 0).alias("n_failing")
    )


def health_report(health: DataFrame) -> DataFrame:
    return health.select(
        "n_requests",
        F.col("newest_source_update").cast("string").alias("newest_source_update"),
        "hours_since_source_update",
        "n_invalid_close_time",
        "n_successful_runs",
        "n_failed_runs",
    )


def late_arrivals(requests: DataFrame, coverage: Column) -> DataFrame:
    """Requests created before coverage, update times, and the most rows sharing one of them."""
    per_stamp = requests.groupBy("source_updated_at").agg(
        F.count("*").alias("n"), count_where(F.col("created_at") < coverage).alias("late")
    )
    return per_stamp.agg(
        F.sum("n").alias("n_requests"),
        F.sum("late").alias("n_created_before_coverage"),
        F.count("source_updated_at").alias("n_update_times"),
        F.max(F.when(F.col("source_updated_at").isNotNull(), F.col("n"))).alias("largest_tie"),
    )


def null_rates(requests: DataFrame) -> DataFrame:
    """Share of cleaned rows without coordinates, zip or borough."""

    def share(missing: Column) -> Column:
        return F.avg(missing.cast("int"))

    return requests.agg(
        share(F.col("latitude").isNull() | F.col("longitude").isNull()).alias("no_coordinates"),
        share(F.col("incident_zip").isNull()).alias("no_zip"),
        share(F.col("borough").isNull()).alias("no_borough"),
    )
