"""The whole refresh: ingest, blocking checks, then layer by layer with its checks."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.operators.checks import ERROR, Check, Result, evaluate
from caseflow.plans import quality
from caseflow.plans.build import build_core, build_marts, build_staging
from caseflow.plans.ingest import RunResult, Source, ingest, utc_now
from caseflow.plans.store import Warehouse
from caseflow.session import literal_rows, together
from caseflow.sources.landing import NO_FILES

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("build_id", T.StringType()),
        T.StructField("checked_at", T.TimestampNTZType()),
        T.StructField("test", T.StringType()),
        T.StructField("failing_rows", T.LongType()),
        T.StructField("status", T.StringType()),
        # What a whole-table check reported, as JSON.
        T.StructField("details", T.StringType()),
        # State of the checked tables; an outcome holds until it changes.
        T.StructField("state", T.StringType()),
    ]
)


@dataclass
class Refresh:
    build_id: str
    run: RunResult | None = None
    built: list[str] = field(default_factory=list)
    results: list[Result] = field(default_factory=list)
    blocked_by: list[str] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return not self.blocked_by


def tables_of(wh: Warehouse):
    """Look a table up by the name the checks use."""

    def table(name: str) -> DataFrame:
        if name == quality.RAW:
            return wh.raw()
        if name == quality.RUNS:
            return wh.runs.runs()
        if name == quality.QUARANTINE:
            return wh.quarantined()
        return wh.read(name)

    return table


def table_states(wh: Warehouse, names: set[str]) -> dict[str, str]:
    """For each table a text that changes whenever it does: its build, or what the runs landed."""
    states = {name: f"build {wh.build_no(name)}" for name in names}
    if landing := names & {quality.RAW, quality.RUNS, quality.QUARANTINE}:
        landed = wh.runs.runs().filter("rows_fetched > 0")
        row = landed.agg(F.count("*").alias("n"), F.max("run_id").alias("last")).first()
        # Without a log nothing is known about the landing zone.
        state = f"{row['n']} runs to {row['last']}" if row["n"] else f"unknown {uuid.uuid4().hex}"
        states |= dict.fromkeys(landing, state)
    return states


def last_results(wh: Warehouse) -> dict[str, Row]:
    """The newest outcome of every check: one row each."""
    newest = F.max_by(F.struct("failing_rows", "status", "details", "state"), "checked_at")
    return {r["test"]: r["r"] for r in stored_results(wh).groupBy("test").agg(newest.alias("r")).collect()}


def run_checks(wh: Warehouse, state: Refresh, checks: list[Check]) -> bool:
    """Evaluate, record and store failing rows; false when the build must stop here.

    The outcome of a check whose tables have not changed since is taken over, unless it depends
    on the clock. Of a check's failing rows the newest copy is kept, and none once it passes.
    """
    last = last_results(wh)
    states = table_states(wh, {name for c in checks for name in (c.table, *c.inputs)})
    reads = {c.name: "; ".join(states[name] for name in (c.table, *c.inputs)) for c in checks}

    def holds(c: Check) -> bool:
        return not c.clock and c.name in last and last[c.name]["state"] == reads[c.name]

    known = {
        c.name: Result(c, last[c.name]["failing_rows"], last[c.name]["status"], last[c.name]["details"])
        for c in checks
        if holds(c)
    }
    new = {r.check.name: r for r in evaluate(wh.spark, [c for c in checks if not holds(c)], tables_of(wh))}
    results = [known.get(c.name) or new[c.name] for c in checks]
    now = utc_now()
    rows = [
        (state.build_id, now, r.check.name, r.failing_rows, r.status, r.details, reads[r.check.name])
        for r in results
    ]
    frame = literal_rows(wh.spark, RESULT_SCHEMA, rows)
    frame.write.mode("append").parquet(wh.path("dq/results"))

    def store(check: Check) -> None:
        failing = check.failing_rows(tables_of(wh))
        failing.write.parquet(wh.path(f"dq/{check.name}/build={state.build_id}"))
        wh.keep_only(f"dq/{check.name}", {f"build={state.build_id}"}, "build=")

    together(wh.spark, [partial(store, r.check) for r in new.values() if r.failing_rows])
    for r in new.values():
        if not r.failing_rows and r.check.name in last and last[r.check.name]["failing_rows"]:
            wh.keep_only(f"dq/{r.check.name}", set(), "build=")
    state.results += results
    state.blocked_by += [r.check.name for r in results if r.status == ERROR]
    return state.ok


def stored_results(wh: Warehouse) -> DataFrame:
    try:
        return wh.spark.read.schema(RESULT_SCHEMA).parquet(wh.path("dq/results"))
    except AnalysisException as e:
        if e.getCondition() in NO_FILES:
            return wh.spark.createDataFrame([], RESULT_SCHEMA)
        raise


def check_results(wh: Warehouse, build_id: str | None = None) -> DataFrame:
    """Recorded results of one build, by default the latest."""
    results = stored_results(wh)
    if build_id is None:
        newest = results.agg(F.max_by("build_id", "checked_at").alias("b")).scalar()
        return results.filter(F.col("build_id") == newest)
    return results.filter(F.col("build_id") == build_id)


def refresh(
    wh: Warehouse,
    source: Source | None,
    as_of: datetime | None = None,
    now: datetime | None = None,
    start: str | None = None,
    force_start: bool = False,
) -> Refresh:
    """Ingest and rebuild what the gates allow.

    ``now`` is the UTC clock of runs and update stamps, ``as_of`` the source-local clock of ages.
    A failed gate leaves the later layers as the last good build wrote them.
    """
    now = now or utc_now()
    as_of = as_of or now
    state = Refresh(uuid.uuid4().hex)
    if source is not None:
        state.run = ingest(wh, source, start=start, force_start=force_start, now=now)
    if not run_checks(wh, state, quality.blocking_checks(now, wh.settings)):
        return state
    layers = [
        ("raw", lambda: None, quality.raw_checks),
        ("staging", lambda: build_staging(wh), lambda: quality.staging_checks(as_of)),
        ("core", lambda: build_core(wh, as_of), quality.core_checks),
        ("marts", lambda: build_marts(wh, as_of), lambda: quality.mart_checks(wh.settings)),
    ]
    for layer, make, checks in layers:
        make()
        state.built.append(layer)
        if not run_checks(wh, state, checks()):
            break
    return state
