"""Star schema: four dimensions, the request fact and the status history."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.functions import complaint_family, composite_key, date_parts, minutes_between
from caseflow.functions.dates import as_ntz
from caseflow.operators.sequence import number_versions
from caseflow.schema import Settings

def complaint_key() -> Column:
    return composite_key("complaint_type", "descriptor")


def most_frequent(value: str, n: str = "n") -> Column:
    """Aggregate: the non-null value with the highest count; the larger value on a tie."""
    ranked = F.when(F.col(value).isNotNull(), F.struct(n, value))
    return F.max(ranked).getField(value)


def dim_agency(requests: DataFrame) -> DataFrame:
    """One row per agency with its commonest spelling."""
    spelled = requests.filter(F.col("agency").isNotNull()).groupBy("agency", "agency_name")
    counts = spelled.agg(F.count("*").alias("n"))
    return counts.groupBy(F.col("agency").alias("agency_key"), "agency").agg(
        most_frequent("agency_name").alias("agency_name"), F.sum("n").alias("n_requests_seen")
    )


def dim_location(requests: DataFrame) -> DataFrame:
    """One row per zip: borough and city of its most frequent (borough, city) pair."""
    placed = requests.filter(F.col("incident_zip").isNotNull())
    counts = placed.groupBy("incident_zip", "borough", "city").agg(F.count("*").alias("n"))
    return counts.groupBy(F.col("incident_zip").alias("location_key"), "incident_zip").agg(
        most_frequent("borough").alias("borough"),
        most_frequent("city").alias("city"),
        F.sum("n").alias("n_requests_seen"),
    )


def dim_complaint_type(requests: DataFrame) -> DataFrame:
    """One row per (type, descriptor). Null and empty text share a key but are two rows."""
    counts = requests.groupBy("complaint_type", "descriptor").agg(
        F.count("*").alias("n_requests_seen")
    )
    return counts.select(
        complaint_key().alias("complaint_type_key"),
        "complaint_type",
        "descriptor",
        complaint_family("complaint_type").alias("complaint_family"),
        "n_requests_seen",
    )


def days_from(start: date | Column, end: date | Column) -> Column:
    """Array of the days of the closed range; null when it is empty."""
    first, last = ((b if isinstance(b, Column) else F.lit(b)).cast("date") for b in (start, end))
    return F.when(first <= last, F.sequence(first, last, F.expr("interval 1 day")))


def days_of(bounds: DataFrame, start: date | Column, end: date | Column) -> DataFrame:
    """One row per day of the closed range of every row of ``bounds``."""
    return bounds.select(F.explode(days_from(start, end)).alias("date_day"))


def day_series(spark: SparkSession, start: date | Column, end: date | Column) -> DataFrame:
    """One row per day of the closed range."""
    return days_of(spark.range(1), start, end)


def calendar(days: DataFrame) -> DataFrame:
    """Attributes of the days in ``date_day``."""
    return days.select("date_day", *[c.alias(name) for name, c in date_parts("date_day").items()])


def dim_date(spark: SparkSession, as_of, start: date = Settings.calendar_start) -> DataFrame:
    """Calendar from ``start`` to one year after ``as_of``."""
    end = F.add_months(F.to_date(as_ntz(as_of)), 12)
    return calendar(day_series(spark, start, end))


def hours_to_close() -> Column:
    """Only for closes not before the creation; minutes are whole, hours are double."""
    minutes = minutes_between("created_at", "closed_at").cast("double")
    return F.when(F.col("closed_at") >= F.col("created_at"), minutes / F.lit(60.0))


def open_age_days(as_of) -> Column:
    minutes = minutes_between("created_at", as_ntz(as_of)).cast("double")
    days = minutes / F.lit(60.0) / F.lit(24.0)
    return F.when(F.col("closed_at").isNull(), days)


def request_flags() -> dict[str, Column]:
    closed, created = F.col("closed_at"), F.col("created_at")
    return {
        "has_geo": F.col("latitude").isNotNull() & F.col("longitude").isNotNull(),
        "is_closed": F.col("status") == "Closed",
        "has_invalid_close_time": closed.isNotNull() & (closed < created),
    }


def fct_service_requests(
    requests: DataFrame, as_of, keep: Sequence[str] = ()
) -> DataFrame:
    """Request fact, current state. ``is_closed`` follows the status, the open age the close time.
    ``keep`` carries columns through."""
    return requests.select(
        "unique_key",
        "created_at",
        "closed_at",
        F.to_date("created_at").alias("created_date"),
        F.to_date("closed_at").alias("closed_date"),
        F.col("agency").alias("agency_key"),
        complaint_key().alias("complaint_type_key"),
        F.col("incident_zip").alias("location_key"),
        "borough",
        "status",
        "channel",
        "location_type",
        "address_type",
        "community_board",
        "council_district",
        "police_precinct",
        "latitude",
        "longitude",
        *[c.alias(name) for name, c in request_flags().items()],
        hours_to_close().alias("hours_to_close"),
        open_age_days(as_of).alias("open_age_days"),
        "resolution_description",
        "source_updated_at",
        "_ingested_at",
        *keep,
    )


def fct_request_status_history(versions: DataFrame, lying: str | None = None) -> DataFrame:
    """One row per observed version with its number and the state before it; ``lying`` names the
    column by which the rows of a key lie together already, and stays."""
    kept = [lying] if lying else []
    rows = versions.select(
        "unique_key",
        "sys_updated_at",
        "source_updated_at",
        F.col("status_raw").alias("status"),
        "closed_at",
        "agency",
        "_ingested_at",
        *kept,
    )
    return number_versions(rows, "unique_key", lying).select(
        "unique_key",
        "sys_updated_at",
        "source_updated_at",
        "status",
        "closed_at",
        "agency",
        "version_no",
        "previous_status",
        "previous_updated_at",
        "_ingested_at",
        *kept,
    )
