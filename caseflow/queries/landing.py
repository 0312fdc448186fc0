"""Landing, paging, run log and watermark."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from caseflow.operators.paging import assign_pages, keyset_page
from caseflow.plans.ingest import ingest
from caseflow.plans.store import Warehouse
from caseflow.queries import tables as t
from caseflow.session import scratch_path
from caseflow.sources import landing as zone
from caseflow.sources import runlog as r

RUN_ID, BATCH_ID, STAMP, LANDED_ON = "run-1", "run-1-0000", "2024-02-01T00:00:00", "2024-02-01"
AFTER, THROUGH = "2024-01-10 00:00:00", "2024-01-20 00:00:00"
PAGE = 700
SHOWN = [
    "sys_id",
    "sys_updated_at",
    "unique_key",
    "status",
    "location",
    "sys_computed_region_f5dn_yrer",
    "closed_date",
]


def landed(spark, sf_dir):
    return zone.normalise(t.event_lines(spark, sf_dir), RUN_ID, BATCH_ID, STAMP)


def from_landed(select: str) -> str:
    return t.with_ctes(select, t.LANDED_SQL)


SHOWN_SQL = (
    "sys_id, sys_updated_at, unique_key, status, location, sys_computed_region_f5dn_yrer, "
    "null::varchar as closed_date"
)


def stored_landing(spark, sf_dir):
    root = scratch_path(spark, "landing")
    zone.write_batch(landed(spark, sf_dir), root, LANDED_ON, 1_000_000)
    return zone.read_landing(spark, root)


def a1(spark, sf_dir):
    return stored_landing(spark, sf_dir).select(*SHOWN, "_extra", "_run_id", "ingest_date")


def a2(spark, sf_dir):
    return landed(spark, sf_dir).select(*SHOWN)


ODD_LINES = {
    0: ("", ',"x":{"a":1,"a":2}}'),
    1: ("", ',"due_date":{"a":[{"b":1,"b":1}]}}'),
    2: ("", "} trailing"),
    3: ("", '},{"unique_key":"1"}'),
    4: ("", ',"unique_key":"2"}'),
    5: ("", ""),
    6: ("[", "}]"),
    7: ("  ", ',"descriptor":"{\\"a\\"}[1"} '),
    8: ("", ',"odd":[{"n":1.5},{"n":null}]}'),
}


def a2_odd(spark, sf_dir):
    """Lines with repeated names, with more or less than one object: each is landed or set aside."""
    kind = F.col("event_id") % 11
    body, value = F.expr("substring(value, 1, length(value) - 1)"), F.col("value")
    for n, (front, back) in ODD_LINES.items():
        value = F.when(kind == n, F.concat(F.lit(front), body, F.lit(back))).otherwise(value)
    lines = t.event_lines(spark, sf_dir).select("event_id", value.alias("value"))
    read = zone.read_lines(lines, keep=["event_id"])
    good = F.when(~F.col("_broken"), F.col("_r.unique_key"))
    return read.select(
        "event_id",
        F.col("_broken").alias("broken"),
        good.alias("unique_key"),
        F.when(~F.col("_broken"), F.col("_r.descriptor")).alias("descriptor"),
        F.when(kind == 8, F.col("_extra")).alias("_extra"),
    )


A2_ODD_SQL = from_landed(
    """select event_id, event_id % 11 < 7 as broken, case when event_id % 11 >= 7 then unique_key end
        as unique_key,
    case when event_id % 11 = 7 then '{"a"}[1' end as descriptor,
    case when event_id % 11 = 8
        then coalesce(left(_extra, -1) || ',', '{') || '"odd":[{"n":1.5},{"n":null}]}' end as _extra
    from landed"""
)


def a3(spark, sf_dir):
    return landed(spark, sf_dir).select("sys_id", "_extra")


def a4(spark, sf_dir):
    keys = zone.unexpected_key_list(landed(spark, sf_dir))
    return keys.select(F.array_join("unexpected_keys", ",").alias("unexpected_keys"))


def a5(spark, sf_dir):
    nested = landed(spark, sf_dir).groupBy("location")
    return nested.agg(F.count("*").alias("n"))


def a6(spark, sf_dir):
    region = landed(spark, sf_dir).groupBy("sys_computed_region_f5dn_yrer")
    return region.agg(F.count("*").alias("n"))


def a7(spark, sf_dir):
    return landed(spark, sf_dir).select("sys_id", "_run_id", "_batch_id", "_ingested_at")


def a8(spark, sf_dir):
    """Land the same records twice: the zone only grows."""
    root = scratch_path(spark, "landing")
    for day in ("2024-02-01", "2024-02-02"):
        zone.write_batch(landed(spark, sf_dir), root, day, 1_000_000)
    rows = zone.read_landing(spark, root).groupBy("ingest_date", "status")
    return rows.agg(F.count("*").alias("n"))


def events(spark, sf_dir):
    return t.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def a9(spark, sf_dir):
    return zone.window_slice(events(spark, sf_dir), AFTER, THROUGH, "ts").select("event_id", "ts")


def a10(spark, sf_dir):
    return zone.window_count(landed(spark, sf_dir), AFTER, THROUGH)


def a11(spark, sf_dir):
    """The page after the newest event of the tenth day."""
    e = events(spark, sf_dir)
    last = e.filter(F.col("ts") <= F.lit(AFTER).cast("timestamp_ntz"))
    cursor = last.agg(F.max(F.struct("ts", "event_id")).alias("c"))
    at = (cursor.select("c.ts").scalar(), cursor.select("c.event_id").scalar())
    return keyset_page(e, "ts", "event_id", PAGE, at).select("event_id", "ts")


def a12(spark, sf_dir):
    e = events(spark, sf_dir).select("ts", "event_id")
    paged = assign_pages(e, "ts", "event_id", PAGE, unique=True)
    return paged.select("event_id", "row_no", "page_no")


def a12_ties(spark, sf_dir):
    """Pages over heavily tied keys: line items by ship day, equal rows included."""
    li = t.table(spark, sf_dir, "lineitem").select(
        F.trunc(F.col("l_shipdate").cast("date"), "year").alias("day"), "l_linenumber"
    )
    paged = assign_pages(li, "day", "l_linenumber", PAGE)
    return paged.groupBy("page_no", "day", "l_linenumber").agg(F.count("*").alias("n"))


def a13(spark, sf_dir):
    return zone.max_updated_seen(landed(spark, sf_dir))


def joined_keys(runs):
    return runs.withColumn("unexpected_keys", F.array_join("unexpected_keys", ","))


def run_events(spark, sf_dir):
    """Two events per run: the start, then the outcome."""
    done = t.request_runs(spark, sf_dir).withColumn("event_seq", F.lit(1).cast("long"))
    empty = {
        c: F.lit(None).cast(done.schema[c].dataType)
        for c in ("finished_at", "max_updated_seen", "unexpected_keys", "error")
    }
    started = done.withColumns(
        {
            **empty,
            "status": F.lit("running"),
            "rows_fetched": F.lit(0).cast("long"),
            "event_seq": F.lit(0).cast("long"),
        }
    )
    return started.unionByName(done)


def a14(spark, sf_dir):
    """Export the log, import it elsewhere."""
    one = r.RunLog(spark, scratch_path(spark, "runs"))
    run_events(spark, sf_dir).write.parquet(one.path)
    exported = scratch_path(spark, "export")
    one.export_json(exported)
    two = r.RunLog(spark, scratch_path(spark, "runs"))
    two.import_json(exported)
    return joined_keys(two.runs())


def b1(spark, sf_dir):
    """Ingest the events as one run in a new warehouse and return its run-log row."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    lines = t.event_lines(spark, sf_dir).select("value")
    now = datetime(2024, 2, 1)
    ingest(wh, lambda lo, hi: lines, start="2024-01-01T00:00:00", now=now, clock=lambda: now)
    runs = joined_keys(wh.runs.runs())
    return runs.drop("run_id", "files_written", "error")


B1_SQL = from_landed(
    """select timestamp '2024-02-01' as started_at, timestamp '2024-02-01' as finished_at,
    'succeeded' as status, '2024-01-01T00:00:00' as watermark_from,
    '2024-02-01T00:00:00' as watermark_to, count(*) as rows_fetched,
    max(sys_updated_at) as max_updated_seen, 'flag,note,props' as unexpected_keys
    from landed where ts > timestamp '2024-01-01' and ts <= timestamp '2024-02-01'"""
)


def b2(spark, sf_dir):
    return joined_keys(r.run_state(run_events(spark, sf_dir)))


def b3(spark, sf_dir):
    return r.last_successful_watermark(t.request_runs(spark, sf_dir))


def b4(spark, sf_dir):
    """Lost log: the watermark comes from the landed rows; with any run logged it does not."""
    raw = t.raw_requests(spark, sf_dir)
    runs = t.request_runs(spark, sf_dir)
    lost = r.watermark_from_raw(raw, runs.filter(F.lit(False)))
    kept = r.watermark_from_raw(raw, runs.filter("status = 'failed'"))
    return lost.withColumn("log", F.lit("lost")).unionByName(
        kept.withColumn("log", F.lit("failed runs"))
    )


def b5(spark, sf_dir):
    """The next window after the log: watermark less the overlap."""
    watermark = r.last_successful_watermark(t.request_runs(spark, sf_dir))
    newest = watermark.first()["watermark"]
    lower, upper = r.resolve_window(spark, newest, datetime(2001, 12, 1))
    return watermark.select("watermark", F.lit(lower).alias("lower"), F.lit(upper).alias("upper"))


B5_SQL = t.with_ctes(
    """select max(watermark_to) as watermark,
    strftime(max(watermark_to)::timestamp - interval 15 minute, '%Y-%m-%dT%H:%M:%S') as lower,
    '2001-12-01T00:00:00' as upper from runs where status = 'succeeded'""",
    t.RUNS_SQL,
)


def b6(spark, sf_dir):
    """A source that fails after its first frame: the frame stays, the run is logged as failed."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    lines = t.event_lines(spark, sf_dir)
    now = datetime(2024, 2, 1)

    def failing(lower, upper):
        yield lines.filter("ts <= timestamp_ntz'2024-01-10'").select("value")
        raise RuntimeError("boom")

    try:
        ingest(wh, failing, start="2024-01-01T00:00:00", now=now, clock=lambda: now)
    except RuntimeError:
        pass
    ingest(
        wh,
        lambda lo, hi: lines.select("value"),
        start="2024-01-01T00:00:00",
        now=now,
        clock=lambda: now,
    )
    return wh.runs.runs().select("status", "rows_fetched", "error", "watermark_from")


B6_SQL = """
select 'failed' as status, count(*) as rows_fetched, 'RuntimeError(''boom'')' as error,
    '2024-01-01T00:00:00' as watermark_from
from events where ts > timestamp '2024-01-01' and ts <= timestamp '2024-01-10'
union all
select 'succeeded', count(*), null, '2024-01-01T00:00:00'
from events where ts > timestamp '2024-01-01' and ts <= timestamp '2024-02-01'"""


def b7(spark, sf_dir):
    return r.coverage_start(t.request_runs(spark, sf_dir))


def b8(spark, sf_dir):
    return joined_keys(r.recent_runs(t.request_runs(spark, sf_dir)))


def b9(spark, sf_dir):
    return joined_keys(r.all_runs(t.request_runs(spark, sf_dir)))


def runs_sql(select: str) -> str:
    return t.with_ctes(select, t.RUNS_SQL)


ALL_RUN_COLUMNS = """run_id, started_at, finished_at, status, watermark_from, watermark_to, rows_fetched,
    files_written, max_updated_seen, array_to_string(unexpected_keys, ',') as unexpected_keys, error"""

QUERIES = {
    "a1_read_landing": (
        a1,
        from_landed(
            f"select {SHOWN_SQL}, _extra, '{RUN_ID}' as _run_id, date '{LANDED_ON}' as ingest_date "
            "from landed"
        ),
    ),
    "a2_normalise": (a2, from_landed(f"select {SHOWN_SQL} from landed")),
    "a2_odd_lines": (a2_odd, A2_ODD_SQL),
    "a3_capture_drift": (a3, from_landed("select sys_id, _extra from landed")),
    "a4_unexpected_keys": (
        a4,
        from_landed(
            "select string_agg(k, ',' order by k) as unexpected_keys from "
            "(select distinct unnest(json_keys(_extra)) as k from landed)"
        ),
    ),
    "a5_nested_values": (
        a5,
        from_landed("select location, count(*) as n from landed group by all"),
    ),
    "a6_computed_columns": (
        a6,
        from_landed(
            "select sys_computed_region_f5dn_yrer, count(*) as n from landed group by all"
        ),
    ),
    "a7_stamp": (
        a7,
        from_landed(
            f"select sys_id, '{RUN_ID}' as _run_id, '{BATCH_ID}' as _batch_id, "
            f"'{STAMP}' as _ingested_at from landed"
        ),
    ),
    "a8_write_batch": (
        a8,
        from_landed(
            "select d as ingest_date, status, count(*) as n from "
            "(select *, unnest([date '2024-02-01', date '2024-02-02']) as d from landed) group by all"
        ),
    ),
    "a9_window_slice": (
        a9,
        f"select event_id, ts from events where ts > timestamp '{AFTER}' "
        f"and ts <= timestamp '{THROUGH}'",
    ),
    "a10_window_count": (
        a10,
        f"select count(*) as n_rows from events where ts > timestamp '{AFTER}' "
        f"and ts <= timestamp '{THROUGH}'",
    ),
    "a11_keyset_page": (
        a11,
        f"select event_id, ts from events where (ts, event_id) > (select (ts, event_id) from events "
        f"where ts <= timestamp '{AFTER}' order by ts desc, event_id desc limit 1) "
        f"order by ts, event_id limit {PAGE}",
    ),
    "a12_assign_pages": (
        a12,
        f"select event_id, row_number() over (order by ts, event_id) - 1 as row_no, "
        f"(row_number() over (order by ts, event_id) - 1) // {PAGE} as page_no from events",
    ),
    "a12_assign_pages_ties": (
        a12_ties,
        f"select page_no, day, l_linenumber, count(*) as n from (select date_trunc('year', "
        f"l_shipdate)::date as day, l_linenumber, (row_number() over (order by "
        f"date_trunc('year', l_shipdate), l_linenumber) - 1) // {PAGE} as page_no from lineitem) "
        "group by all",
    ),
    "a13_max_updated_seen": (
        a13,
        from_landed("select max(sys_updated_at) as max_updated_seen from landed"),
    ),
    "a14_run_log_round_trip": (a14, runs_sql(f"select {ALL_RUN_COLUMNS} from runs")),
    "b1_run_summary": (b1, B1_SQL),
    "b2_run_log_state": (b2, runs_sql(f"select {ALL_RUN_COLUMNS} from runs")),
    "b3_last_watermark": (
        b3,
        runs_sql("select max(watermark_to) as watermark from runs where status = 'succeeded'"),
    ),
    "b4_watermark_from_raw": (
        b4,
        t.with_ctes(
            "select max(sys_updated_at) as watermark, 'lost' as log from raw_requests "
            "union all select null, 'failed runs'",
            t.RAW_SQL,
        ),
    ),
    "b5_resolve_window": (b5, B5_SQL),
    "b6_failed_run": (b6, B6_SQL),
    "b7_coverage_start": (
        b7,
        runs_sql(
            "select min(try_cast(watermark_from as timestamp)) as coverage_start from runs "
            "where status = 'succeeded'"
        ),
    ),
    "b8_recent_runs": (
        b8,
        runs_sql(
            "select run_id, status, started_at, watermark_from, watermark_to, rows_fetched, "
            "files_written, array_to_string(unexpected_keys, ',') as unexpected_keys, error "
            "from runs order by started_at desc limit 20"
        ),
    ),
    "b9_all_runs": (
        b9,
        runs_sql(
            "select run_id, status, watermark_from, watermark_to, rows_fetched, files_written, "
            "max_updated_seen, array_to_string(unexpected_keys, ',') as unexpected_keys, "
            "started_at from runs order by started_at"
        ),
    ),
}
