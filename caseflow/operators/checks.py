"""Data-quality checks: failing rows, their count, and the status a policy gives the count."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.functions import as_ntz, elapsed_hours, parse_ts
from caseflow.functions.text import is_zip
from caseflow.session import together

PASS, WARN, ERROR = "PASS", "WARN", "ERROR"


# --- severity --------------------------------------------------------------------------


@dataclass(frozen=True)
class Policy:
    """Counts above a bound warn or fail; ``None`` switches the level off."""

    warn_over: float | None = None
    error_over: float | None = 0

    def status(self, failing: float) -> str:
        if self.error_over is not None and failing > self.error_over:
            return ERROR
        if self.warn_over is not None and failing > self.warn_over:
            return WARN
        return PASS

    def status_column(self, failing: Column) -> Column:
        out = F.lit(PASS)
        if self.warn_over is not None:
            out = F.when(failing > self.warn_over, WARN).otherwise(out)
        if self.error_over is not None:
            out = F.when(failing > self.error_over, ERROR).otherwise(out)
        return out


FAIL_ON_ANY = Policy()
# Fixed value: so many requests may be closed before they were created.
CLOSED_BEFORE_CREATED = Policy(warn_over=0, error_over=5000)


# --- failing rows ----------------------------------------------------------------------


def unique(df: DataFrame, value: Column) -> DataFrame:
    """Non-null values that occur more than once."""
    counts = df.filter(value.isNotNull()).groupBy(value.alias("unique_field"))
    return counts.agg(F.count("*").alias("n_records")).filter(F.col("n_records") > 1)


def is_not_accepted(column: str, values: Sequence[str]) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(list(values))


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Non-null values outside the list, with their number of rows."""
    bad = df.filter(is_not_accepted(column, values))
    return bad.groupBy(F.col(column).alias("value_field")).agg(F.count("*").alias("n_records"))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-null child keys without a parent, with their number of child rows.

    Child rows are counted per key before the join, so a key held by most rows is one row in it.
    """
    keys = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("from_field"))
    counted = keys.agg(F.count("*").alias("n_records"))
    parents = parent.select(F.col(parent_column).alias("from_field"))
    return counted.join(parents, "from_field", "left_anti")


def is_outside(column: str, low: Any, high: Any) -> Column:
    """Predicate of the range check: non-null and outside the closed range."""
    c = F.col(column)
    return c.isNotNull() & ((c < low) | (c > high))


def is_not_zip(column: str) -> Column:
    return F.col(column).isNotNull() & ~is_zip(column)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def within_range(df: DataFrame, column: str, low: Any, high: Any) -> DataFrame:
    return df.filter(is_outside(column, low, high)).select(column)


def zip_is_5_digits(df: DataFrame, column: str) -> DataFrame:
    return df.filter(is_not_zip(column)).select(column)


def is_closed_before_created() -> Column:
    return F.col("closed_at") < F.col("created_at")


def is_created_in_future(as_of) -> Column:
    return F.col("created_at") > as_ntz(as_of) + F.expr("interval 1 day")


# --- whole-table checks: one row with a status -----------------------------------------


def duplicate_rate(raw: DataFrame, limit: float = 0.20) -> DataFrame:
    """Share of landed rows that are further copies of a version; above the limit it warns."""
    counts = raw.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("unique_key", "sys_updated_at").alias("n_versions"),
    )
    rows = F.col("n_rows").cast("double")
    rate = F.when(F.col("n_rows") > 0, (F.col("n_rows") - F.col("n_versions")) / rows)
    rate = F.coalesce(rate, F.lit(0.0))
    return counts.select(
        "*",
        rate.alias("duplicate_rate"),
        F.when(rate > limit, WARN).otherwise(PASS).alias("status"),
    )


def raw_freshness(raw: DataFrame, as_of, warn_hours: float = 36, error_hours: float = 72):
    """Hours since the newest update; an empty landing zone is an error."""
    newest = raw.agg(F.max(parse_ts("sys_updated_at")).alias("newest_source_update"))
    hours = elapsed_hours("newest_source_update", as_ntz(as_of))
    return newest.select(
        "newest_source_update",
        hours.alias("hours_since_update"),
        F.when(F.col("newest_source_update").isNull() | (hours > error_hours), ERROR)
        .when(hours > warn_hours, WARN)
        .otherwise(PASS)
        .alias("status"),
    )


def _newest_run(runs: DataFrame, *columns: str) -> DataFrame:
    newest = F.max_by(F.struct(*columns), F.struct("started_at", "run_id"))
    return runs.agg(newest.alias("r")).select("r.*")


def schema_stable(runs: DataFrame) -> DataFrame:
    """Warns while the latest run saw keys outside the declared columns."""
    latest = _newest_run(runs, "run_id", "unexpected_keys")
    keys = F.coalesce(F.col("unexpected_keys"), F.array().cast("array<string>"))
    return latest.select(
        "run_id",
        keys.alias("unexpected_keys"),
        F.when(F.size(keys) > 0, WARN).otherwise(PASS).alias("status"),
    )


def none_quarantined(lines: DataFrame, runs: DataFrame) -> DataFrame:
    """Warns while the latest run left lines in quarantine."""
    latest = _newest_run(runs, "run_id").select("run_id").scalar()
    counted = lines.filter(F.col("run_id") == latest).agg(F.count("*").alias("n_lines"))
    return counted.withColumn("status", F.when(F.col("n_lines") > 0, WARN).otherwise(PASS))


def last_run_succeeded(runs: DataFrame) -> DataFrame:
    """Fails when the latest run did not succeed, and when there is none."""
    latest = _newest_run(runs, "run_id", F.col("status").alias("run_status"), "error", "rows_fetched")
    ok = F.coalesce(F.col("run_status") == "succeeded", F.lit(False))
    return latest.select(
        "run_id",
        "run_status",
        F.coalesce("error", F.lit("")).alias("error"),
        "rows_fetched",
        F.when(ok, PASS).otherwise(ERROR).alias("status"),
    )


# --- declared checks -------------------------------------------------------------------

Tables = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Check:
    """A named check of one table.

    ``predicate`` marks the failing rows of a row check; all row checks of a table are counted in
    one scan. ``failing`` gives the failing rows as a frame of its own (with a predicate as well, it
    is only asked for when the scan has found some). ``reports`` gives one row with a status.
    ``inputs`` are the other tables it reads; ``clock`` marks a check whose outcome changes with
    time, so that it is evaluated even if no table has changed.
    """

    name: str
    table: str
    policy: Policy = FAIL_ON_ANY
    predicate: Column | None = None
    columns: tuple[str, ...] = ()
    failing: Callable[[Tables], DataFrame] | None = None
    weight: str | None = None
    reports: Callable[[Tables], DataFrame] | None = None
    inputs: tuple[str, ...] = ()
    clock: bool = False

    def failing_rows(self, tables: Tables) -> DataFrame:
        if self.reports is not None:
            return self.reports(tables).filter(F.col("status") != PASS)
        if self.failing is not None:
            return self.failing(tables)
        rows = tables(self.table).filter(self.predicate)
        return rows.select(*self.columns) if self.columns else rows

    def count_failing(self, tables: Tables) -> int:
        n = F.sum(self.weight) if self.weight else F.count("*")
        return int(self.failing_rows(tables).agg(n).first()[0] or 0)


@dataclass(frozen=True)
class Result:
    check: Check
    failing_rows: int
    status: str
    details: str | None = None


def scan_rows(checks: Sequence[Check], df: DataFrame) -> dict[str, int]:
    """Rows marked by the predicate of every check, in one scan."""
    return df.agg(*[F.count_if(c.predicate).alias(c.name) for c in checks]).first().asDict()


def evaluate(spark: SparkSession, checks: Sequence[Check], tables: Tables) -> list[Result]:
    """Count the failing rows of every check, independent queries side by side."""
    by_table: dict[str, list[Check]] = {}
    for check in checks:
        if check.predicate is not None:
            by_table.setdefault(check.table, []).append(check)
    scans = [partial(scan_rows, group, tables(table)) for table, group in by_table.items()]
    marked = {name: n for counts in together(spark, scans) for name, n in counts.items()}

    def result(check: Check) -> Result:
        if check.reports is not None:
            report = check.reports(tables)
            row = report.select("status", F.to_json(F.struct(*report.columns)).alias("d")).first()
            return Result(check, int(row["status"] != PASS), row["status"], row["d"])
        failing = marked.get(check.name)
        if failing is None or (failing and check.failing is not None):
            failing = check.count_failing(tables)
        return Result(check, failing, check.policy.status(failing))

    return together(spark, [partial(result, c) for c in checks])
