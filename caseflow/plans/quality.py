"""The declared checks of every layer."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseflow.functions import BOROUGHS, STATUSES, concat_key
from caseflow.operators import checks as c
from caseflow.operators.checks import Check
from caseflow.plans import build as b
from caseflow.schema import Settings

RAW, RUNS, QUARANTINE = "raw", "meta/ingest_runs", "meta/quarantine"

# Bounding box of the covered area and the accepted durations.
LATITUDE_RANGE = (40.49, 40.92)
LONGITUDE_RANGE = (-74.26, -73.70)
HOURS_RANGE = (0, 100_000)
DAILY_ROWS_RANGE = (1, 1_000_000)


def _named(kind: str, table: str, column: str) -> str:
    return f"{kind}_{table.split('/')[-1]}_{column}"


def not_null(table: str, column: str) -> Check:
    return Check(_named("not_null", table, column), table, predicate=F.col(column).isNull())


def unique(table: str, value: Column, label: str) -> Check:
    rows = lambda tables: c.unique(tables(table), value)
    return Check(_named("unique", table, label), table, failing=rows)


def accepted(table: str, column: str, values: list[str]) -> Check:
    rows = lambda tables: c.accepted_values(tables(table), column, values)
    bad = c.is_not_accepted(column, values)
    return Check(_named("accepted_values", table, column), table, predicate=bad, failing=rows)


def related(table: str, column: str, parent: str) -> Check:
    rows = lambda tables: c.relationships(
        tables(table), column, tables(parent), column
    )
    name = _named("relationships", table, column)
    return Check(name, table, failing=rows, weight="n_records", inputs=(parent,))


def in_range(table: str, column: str, low: float, high: float) -> Check:
    predicate = c.is_outside(column, low, high)
    return Check(
        _named("within_range", table, column), table, predicate=predicate, columns=(column,)
    )


def blocking_checks(now, settings: Settings = Settings()) -> list[Check]:
    """Before anything is built: raw is fresh and the last run succeeded."""
    fresh = partial(_freshness, now=now, settings=settings)
    return [
        Check("landing_is_recent", RUNS, reports=fresh, clock=True),
        Check(
            "newest_run_is_ok",
            RUNS,
            reports=lambda tables: c.last_run_succeeded(tables(RUNS)),
            clock=True,
        ),
    ]


def _freshness(tables, now, settings):
    """From the run log, which knows the newest update; from the landing zone if the log is lost."""
    runs = tables(RUNS)
    newest = runs.select(F.col("max_updated_seen").alias("sys_updated_at"))
    return c.raw_freshness(
        tables(RAW) if runs.isEmpty() else newest,
        now,
        settings.fresh_warn_hours,
        settings.fresh_error_hours,
    )


def raw_checks() -> list[Check]:
    return [
        not_null(RAW, "unique_key"),
        not_null(RAW, "sys_updated_at"),
        Check(
            "few_repeated_versions", RAW, reports=lambda tables: c.duplicate_rate(tables(RAW))
        ),
        Check(
            "no_quarantined_lines",
            QUARANTINE,
            reports=lambda tables: c.none_quarantined(tables(QUARANTINE), tables(RUNS)),
            inputs=(RUNS,),
            clock=True,
        ),
        Check(
            "no_undeclared_keys",
            RUNS,
            reports=lambda tables: c.schema_stable(tables(RUNS)),
            clock=True,
        ),
    ]


def staging_checks(as_of) -> list[Check]:
    requests, versions = b.REQUESTS, b.VERSIONS
    zip_bad = c.is_not_zip("incident_zip")
    return [
        unique(requests, F.col("unique_key"), "unique_key"),
        not_null(requests, "unique_key"),
        not_null(requests, "created_at"),
        accepted(requests, "status", STATUSES),
        accepted(requests, "borough", BOROUGHS),
        Check(
            _named("zip_is_5_digits", requests, "incident_zip"),
            requests,
            predicate=zip_bad,
            columns=("incident_zip",),
        ),
        in_range(requests, "latitude", *LATITUDE_RANGE),
        in_range(requests, "longitude", *LONGITUDE_RANGE),
        not_null(requests, "source_updated_at"),
        Check(
            "closed_not_before_created",
            requests,
            c.CLOSED_BEFORE_CREATED,
            predicate=c.is_closed_before_created(),
            columns=("unique_key", "created_at", "closed_at"),
        ),
        Check(
            "no_future_created_at",
            requests,
            predicate=c.is_created_in_future(as_of),
            columns=("unique_key", "created_at"),
            clock=True,
        ),
        unique(versions, concat_key("unique_key", "sys_updated_at", sep="|"), "version"),
        not_null(versions, "unique_key"),
    ]


def core_checks() -> list[Check]:
    version = concat_key("unique_key", "sys_updated_at", sep="|")
    keys = [
        (b.AGENCIES, "agency_key"),
        (b.COMPLAINTS, "complaint_type_key"),
        (b.LOCATIONS, "location_key"),
        (b.CALENDAR, "date_day"),
    ]
    dims = [make for t, k in keys for make in (unique(t, F.col(k), k), not_null(t, k))]
    return [
        unique(b.FACT, F.col("unique_key"), "unique_key"),
        not_null(b.FACT, "unique_key"),
        not_null(b.FACT, "created_at"),
        related(b.FACT, "agency_key", b.AGENCIES),
        not_null(b.FACT, "complaint_type_key"),
        related(b.FACT, "complaint_type_key", b.COMPLAINTS),
        related(b.FACT, "location_key", b.LOCATIONS),
        accepted(b.FACT, "status", STATUSES),
        in_range(b.FACT, "hours_to_close", *HOURS_RANGE),
        unique(b.HISTORY, version, "version"),
        *dims,
        accepted(b.LOCATIONS, "borough", BOROUGHS),
    ]


def mart_checks(settings: Settings = Settings()) -> list[Check]:
    grain = concat_key("created_date", "borough", "complaint_family", "agency")
    return [
        unique(b.VOLUME, grain, "grain"),
        in_range(b.VOLUME, "n_requests", *DAILY_ROWS_RANGE),
        in_range(b.RESOLUTION, "median_hours_to_close", *HOURS_RANGE),
        in_range(b.HEALTH, "hours_since_source_update", 0, settings.max_hours_since_update),
    ]
