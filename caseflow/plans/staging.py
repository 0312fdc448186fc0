"""Staging tables: typed rows, one per request or one per observed version."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.functions import (
    BOROUGHS,
    allowed,
    clean_code,
    clean_text,
    clean_zip,
    normalise_status,
    parse_ts,
    to_double,
)
from caseflow.operators.incremental import first_per_version, latest_per_key


# The raw columns that typed rows are made of, or ranked by.
REQUEST_COLUMNS = """
    unique_key created_date closed_date due_date resolution_action_updated_date agency agency_name
    complaint_type descriptor location_type status resolution_description open_data_channel_type
    incident_zip borough city community_board council_district police_precinct incident_address
    address_type latitude longitude bbl sys_id sys_updated_at _run_id _batch_id _ingested_at _extra
""".split()


def typed_requests(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Clean and type raw rows; where cleaning can lose information the raw text stays as *_raw.
    ``keep`` carries columns through."""
    return raw.select(
        "unique_key",
        parse_ts("created_date").alias("created_at"),
        parse_ts("closed_date").alias("closed_at"),
        parse_ts("due_date").alias("due_at"),
        parse_ts("resolution_action_updated_date").alias("resolution_updated_at"),
        clean_code("agency").alias("agency"),
        *[
            clean_text(c).alias(c)
            for c in ("agency_name", "complaint_type", "descriptor", "location_type")
        ],
        clean_text("status").alias("status_raw"),
        normalise_status("status").alias("status"),
        clean_text("resolution_description").alias("resolution_description"),
        clean_text("open_data_channel_type").alias("channel"),
        F.col("incident_zip").alias("incident_zip_raw"),
        clean_zip("incident_zip").alias("incident_zip"),
        allowed("borough", BOROUGHS).alias("borough"),
        *[
            clean_text(c).alias(c)
            for c in (
                "city",
                "community_board",
                "council_district",
                "police_precinct",
                "incident_address",
                "address_type",
            )
        ],
        to_double("latitude").alias("latitude"),
        to_double("longitude").alias("longitude"),
        "bbl",
        "sys_id",
        parse_ts("sys_updated_at").alias("source_updated_at"),
        F.col("_run_id").alias("ingest_run_id"),
        F.col("_batch_id").alias("ingest_batch_id"),
        "_ingested_at",
        F.col("_extra").alias("extra_json"),
        *keep,
    )


def latest_requests(
    raw: DataFrame,
    completed: Callable[[DataFrame], DataFrame] | None = None,
    lying: str | None = None,
) -> DataFrame:
    """One typed row per request: its newest version.

    ``completed`` makes the raw columns that ranking versions does not need, of the rows that stay:
    the sort then holds narrow rows. ``lying`` names the column by which the rows of a key lie
    together already, and stays: they are ranked there without a shuffle.
    """
    newest = latest_per_key(raw, [lying or "unique_key"])
    return typed_requests(completed(newest) if completed else newest, [lying] if lying else [])


def request_versions(raw: DataFrame, lying: str | None = None) -> DataFrame:
    """One typed row per observed version; copies collapse to the first that landed. ``lying`` as
    for ``latest_requests``."""
    return first_per_version(raw, [lying or "unique_key", "sys_updated_at"]).select(
        "unique_key",
        "sys_updated_at",
        parse_ts("sys_updated_at").alias("source_updated_at"),
        clean_text("status").alias("status_raw"),
        parse_ts("closed_date").alias("closed_at"),
        clean_text("resolution_description").alias("resolution_description"),
        clean_code("agency").alias("agency"),
        "_ingested_at",
        *([lying] if lying else []),
    )
