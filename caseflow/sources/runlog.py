"""The run log: append-only run events, the current state per run, and the high-watermark."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.functions import parse_ts
from caseflow.schema import RUN_COLUMNS, RUN_EVENT_SCHEMA, RUN_SCHEMA, Settings
from caseflow.session import literal_rows, materialise
from caseflow.sources.landing import NO_FILES

SUCCEEDED, FAILED, RUNNING = "succeeded", "failed", "running"


class WindowRefused(ValueError):
    """An explicit start was given although a watermark exists."""


# --- frames over the log ---------------------------------------------------------------


def run_state(events: DataFrame) -> DataFrame:
    """Current row per run: the latest event of each run id."""
    state = F.max_by(F.struct(*[c for c in RUN_COLUMNS if c != "run_id"]), "event_seq")
    return events.groupBy("run_id").agg(state.alias("s")).select("run_id", "s.*")


def last_successful_watermark(runs: DataFrame) -> DataFrame:
    return runs.filter(F.col("status") == SUCCEEDED).agg(F.max("watermark_to").alias("watermark"))


def watermark_from_raw(raw: DataFrame, runs: DataFrame) -> DataFrame:
    """Newest landed update, but only while no run at all is logged; else null.

    A log with nothing but failed runs gives null: their files end in the middle of a window.
    """
    logged = runs.agg(F.count("*").alias("n")).scalar()
    newest = raw.agg(F.max("sys_updated_at").alias("newest"))
    return newest.select(F.when(logged == 0, F.col("newest")).alias("watermark"))


def coverage_start(runs: DataFrame) -> DataFrame:
    """First update time ever covered; null, and so empty cohort marts, before the first success."""
    ok = runs.filter(F.col("status") == SUCCEEDED)
    return ok.agg(F.min(parse_ts("watermark_from")).alias("coverage_start"))


def recent_runs(runs: DataFrame, n: int = 20) -> DataFrame:
    """The newest runs for the run panel."""
    return (
        runs.orderBy(F.col("started_at").desc_nulls_last(), F.col("run_id").desc())
        .limit(n)
        .select(
            "run_id",
            "status",
            "started_at",
            "watermark_from",
            "watermark_to",
            "rows_fetched",
            "files_written",
            "unexpected_keys",
            "error",
        )
    )


def all_runs(runs: DataFrame) -> DataFrame:
    return runs.select(
        "run_id",
        "status",
        "watermark_from",
        "watermark_to",
        "rows_fetched",
        "files_written",
        "max_updated_seen",
        "unexpected_keys",
        "started_at",
    ).orderBy(F.col("started_at").asc_nulls_last(), "run_id")


def latest_run(runs: DataFrame, ok_only: bool = False) -> DataFrame:
    """The run that started last, as at most one row."""
    if ok_only:
        runs = runs.filter(F.col("status") == SUCCEEDED)
    return runs.orderBy(F.col("started_at").desc_nulls_last(), F.col("run_id").desc()).limit(1)


# --- the stored log --------------------------------------------------------------------


class RunLog:
    """Two events per run: ``running`` at the start, the outcome at the end. Nothing is updated."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def _stored(self) -> DataFrame:
        try:
            found = self.spark.read.schema(RUN_EVENT_SCHEMA).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() in NO_FILES:
                return self.spark.createDataFrame([], RUN_EVENT_SCHEMA)
            raise
        return found.withColumn("generation", F.coalesce("generation", F.lit(0)))

    def generation(self) -> int:
        """How often the log has been replaced by an import."""
        return self._stored().agg(F.max("generation")).first()[0] or 0

    def events(self) -> DataFrame:
        """The events of the newest generation."""
        found = self._stored()
        newest = found.agg(F.max("generation").alias("g")).scalar()
        return found.filter(F.col("generation") == newest)

    def runs(self) -> DataFrame:
        return run_state(self.events())

    def _append(self, event_seq: int, **values) -> None:
        row = tuple(values.get(c) for c in RUN_COLUMNS) + (event_seq, self.generation())
        frame = literal_rows(self.spark, RUN_EVENT_SCHEMA, [row])
        frame.write.mode("append").parquet(self.path)

    def start(self, run_id: str, started_at: datetime, lower: str, upper: str) -> None:
        self._append(
            0,
            run_id=run_id,
            started_at=started_at,
            status=RUNNING,
            watermark_from=lower,
            watermark_to=upper,
            rows_fetched=0,
            files_written=0,
        )

    def finish(
        self,
        run_id: str,
        status: str,
        summary: dict,
        started_at: datetime,
        finished_at: datetime,
        lower: str,
        upper: str,
        error: str | None = None,
    ) -> None:
        self._append(
            1,
            run_id=run_id,
            started_at=started_at,
            finished_at=finished_at,
            status=status,
            watermark_from=lower,
            watermark_to=upper,
            rows_fetched=summary["rows"],
            files_written=summary["files"],
            max_updated_seen=summary["max_updated_seen"],
            unexpected_keys=summary["unexpected_keys"],
            error=error,
        )

    def export_json(self, path: str) -> int:
        """Write the current state as portable JSON; returns the number of runs."""
        self.runs().coalesce(1).write.mode("overwrite").json(path)
        return self.spark.read.schema(RUN_SCHEMA).json(path).count()

    def import_json(self, path: str) -> int:
        """Replace the whole log by an export; a missing export changes nothing.

        A broken line or a run without id or status fails the import before anything is written.
        The imported rows are appended as a new generation by one job; readers see the newest
        generation, so the log is never without its rows.
        """
        try:
            # One plan reads and checks: what was checked is what is appended.
            runs = materialise(
                self.spark.read.schema(RUN_SCHEMA).option("mode", "FAILFAST").json(path), "runs"
            )
        except AnalysisException as e:
            if e.getCondition() in NO_FILES:
                return 0
            raise
        known = F.col("status").isin(SUCCEEDED, FAILED, RUNNING)
        broken = F.col("run_id").isNull() | ~F.coalesce(known, F.lit(False))
        found = runs.agg(F.count_if(broken).alias("broken"), F.count("*").alias("n")).first()
        if found["broken"]:
            raise ValueError(f"{found['broken']} of {found['n']} runs have no id or no known status")
        events = runs.withColumns(
            {"event_seq": F.lit(1).cast("long"), "generation": F.lit(self.generation() + 1).cast("long")}
        )
        events.coalesce(1).write.mode("append").parquet(self.path)
        return found["n"]


# --- the run window --------------------------------------------------------------------


def as_text(at: Column) -> Column:
    """A time the way windows are written: whole seconds, no zone."""
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")


def read_watermark(raw: DataFrame, runs: DataFrame) -> str | None:
    """High-watermark text: from the log, or from the landing zone where the log is lost."""
    logged = last_successful_watermark(runs).first()["watermark"]
    if logged:
        return logged
    if runs.isEmpty():
        return raw.agg(F.max("sys_updated_at")).first()[0]
    return None


def before_watermark(spark: SparkSession, watermark: str, minutes: int) -> str:
    """The watermark moved back by the overlap; it is parsed like any time of the source."""
    at = parse_ts(F.lit(watermark)) - F.make_dt_interval(mins=F.lit(minutes))
    moved = spark.range(1).select(as_text(at)).first()[0]
    if moved is None:
        raise ValueError(f"not a time: {watermark}")
    return moved


def resolve_window(
    spark: SparkSession,
    watermark: str | None,
    now: datetime,
    start: str | None = None,
    force_start: bool = False,
    settings: Settings = Settings(),
) -> tuple[str, str]:
    """The run's ``(lower, upper]``: watermark minus overlap, or the start; up to the run start."""
    if force_start and not start:
        raise ValueError("force_start needs a start")
    if start and watermark and not force_start:
        raise WindowRefused(f"a watermark exists ({watermark}); force the start to override it")
    if watermark and not force_start:
        lower = before_watermark(spark, watermark, settings.overlap_minutes)
    else:
        lower = start or settings.backfill_start
    return lower, now.isoformat(timespec="seconds")
