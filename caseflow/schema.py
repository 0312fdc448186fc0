"""Fixed schemas and settings of the landing zone, the run log and the checks."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import types as T

# Record fields kept from the source and their landed names.
SYSTEM_FIELDS = {
    ":id": "sys_id",
    ":updated_at": "sys_updated_at",
    ":created_at": "sys_created_at",
    ":version": "sys_version",
}

# The columns the source declares, in its order.
DATA_COLUMNS = """
    unique_key created_date closed_date agency agency_name complaint_type descriptor descriptor_2
    location_type incident_zip incident_address street_name cross_street_1 cross_street_2
    intersection_street_1 intersection_street_2 address_type city landmark facility_type status
    due_date resolution_description resolution_action_updated_date community_board
    council_district police_precinct bbl borough x_coordinate_state_plane
    y_coordinate_state_plane open_data_channel_type park_facility_name park_borough vehicle_type
    taxi_company_borough taxi_pick_up_location bridge_highway_name bridge_highway_direction
    road_ramp bridge_highway_segment latitude longitude location
    :@computed_region_f5dn_yrer :@computed_region_yeji_bk3q :@computed_region_sbqj_enih
    :@computed_region_92fq_4b7q
""".split()

COMPUTED_PREFIX = ":@"
META_COLUMNS = ["_run_id", "_batch_id", "_ingested_at", "_extra"]


def landed_name(field: str) -> str:
    """Column name a record field gets in the landing zone."""
    if field in SYSTEM_FIELDS:
        return SYSTEM_FIELDS[field]
    if field.startswith(COMPUTED_PREFIX):
        return "sys_" + field.removeprefix(COMPUTED_PREFIX)
    return field


RECORD_FIELDS = [*SYSTEM_FIELDS, *DATA_COLUMNS]
RAW_COLUMNS = [landed_name(f) for f in RECORD_FIELDS] + META_COLUMNS


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


RECORD_SCHEMA = text_schema(RECORD_FIELDS)
RAW_SCHEMA = text_schema(RAW_COLUMNS)
LANDING_SCHEMA = T.StructType([*RAW_SCHEMA.fields, T.StructField("ingest_date", T.DateType())])

RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("started_at", T.TimestampNTZType()),
        T.StructField("finished_at", T.TimestampNTZType()),
        T.StructField("status", T.StringType()),
        T.StructField("watermark_from", T.StringType()),
        T.StructField("watermark_to", T.StringType()),
        T.StructField("rows_fetched", T.LongType()),
        T.StructField("files_written", T.IntegerType()),
        T.StructField("max_updated_seen", T.StringType()),
        T.StructField("unexpected_keys", T.ArrayType(T.StringType())),
        T.StructField("error", T.StringType()),
    ]
)
RUN_COLUMNS = RUN_SCHEMA.fieldNames()
RUN_EVENT_SCHEMA = T.StructType(
    [
        *RUN_SCHEMA.fields,
        T.StructField("event_seq", T.LongType()),
        T.StructField("generation", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Settings:
    """Defaults of the pipeline; pass a changed copy (``dataclasses.replace``) to override."""

    overlap_minutes: int = 15
    backfill_start: str = "2026-09-01T00:00:00"
    # Hours after which data is late and stale.
    fresh_warn_hours: float = 36
    fresh_error_hours: float = 72
    max_hours_since_update: float = 72
    # First day of the calendar dimension.
    calendar_start: date = date(2010, 1, 1)
    # Hash buckets of the upserted tables, a file each: aim at roughly 1 GB of data per bucket.
    buckets: int = 64
    # A table that is to take more rows in one of them is given more buckets.
    bucket_rows: int = 500_000
    # Files written by one landing task roll over at this many rows.
    rows_per_file: int = 1_000_000
