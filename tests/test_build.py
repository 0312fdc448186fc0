import os
from contextlib import contextmanager
from datetime import datetime

import pytest
from conftest import lines, record, rows, same_rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from caseflow.operators.incremental import latest_per_key, merge_latest, newest_of_batches, upsert
from caseflow.operators.sequence import number_versions
from caseflow.plans import build as b
from caseflow.plans.core import fct_request_status_history, fct_service_requests
from caseflow.plans import quality
from caseflow.plans.refresh import Refresh, check_results, refresh, run_checks
from caseflow.plans.staging import REQUEST_COLUMNS, latest_requests, request_versions
from caseflow.plans.store import KEYED, MARK_FIELDS, WRITERS, Warehouse
from caseflow.schema import Settings
from caseflow.session import held
from caseflow.sources.landing import normalise, write_batch
from caseflow.streaming import landing_stream
from caseflow.streaming.landing_stream import run_available

AS_OF = datetime(2026, 9, 15)


def land(wh, run, stamp, records, status="succeeded"):
    """Land records as one run, with its log entry."""
    df = normalise(lines(wh.spark, records), run, f"{run}-0000", stamp)
    write_batch(df.coalesce(1), wh.raw_path, stamp[:10], 100)
    at = datetime.fromisoformat(stamp)
    summary = {
        "rows": len(records),
        "files": 1,
        "max_updated_seen": records[-1][":updated_at"],
        "unexpected_keys": [],
    }
    wh.runs.finish(run, status, summary, at, at, "2026-09-01T00:00:00", stamp)


def build(wh, as_of=AS_OF):
    b.build_staging(wh)
    b.build_core(wh, as_of)
    b.build_marts(wh, as_of)


def reported(*numbers, **members):
    """Requests seen at noon of their day, one a day from the third on."""
    return [record(n, f"2026-09-{2 + n:02d}T12:00:00.000Z", **members) for n in numbers]


def first_batch():
    return reported(1, 2, 3, 4, 5)


def second_batch():
    """Request 2 is closed long after it was made, 4 comes again as it was, the rest is untouched."""
    late = {"status": "closed ", "closed_date": "2026-09-13T04:30:00.000"}
    return [record(2, "2026-09-13T05:00:00.000Z", **late), *reported(4)]


def test_a_late_close_and_an_overlap(spark, wh):
    land(wh, "one", "2026-09-10T00:10:00", first_batch())
    build(wh)
    before = {r["unique_key"]: r for r in wh.read(b.FACT).collect()}
    land(wh, "two", "2026-09-13T06:10:00", second_batch())
    build(wh)
    after = {r["unique_key"]: r for r in wh.read(b.FACT).collect()}
    assert set(after) == set(before) == {str(50_000 + n) for n in range(1, 6)}
    changed = {k for k in after if after[k] != before[k]}
    assert changed == {"50002", "50004"}, "the copy only carries a newer stamp"
    assert after["50004"].asDict() | {"_ingested_at": None} == before["50004"].asDict() | {"_ingested_at": None}
    assert (after["50002"]["is_closed"], after["50002"]["hours_to_close"]) == (True, 66.5)
    steps = wh.read(b.HISTORY).filter("unique_key in ('50002', '50004')")
    assert rows(steps.select("unique_key", "version_no", "previous_status")) == [
        ("50002", 1, None),
        ("50002", 2, "Open"),
        ("50004", 1, None),
    ]
    assert wh.read(b.VERSIONS).count() == 6
    assert wh.read(b.VOLUME).agg(F.sum("n_requests"), F.sum("n_closed")).first() == (5, 1)
    assert wh.read(b.HEALTH).first()["last_successful_run_id"] == "two"


def test_a_failed_rebuild_keeps_the_table(spark, wh):
    wh.replace(b.AGENCIES, spark.range(5))
    broken = spark.range(5).select(F.raise_error(F.lit("boom")).cast("long").alias("id"))
    with pytest.raises(Exception, match="boom"):
        wh.replace(b.AGENCIES, broken)
    assert Warehouse(spark, wh.root, wh.settings).read(b.AGENCIES).count() == 5


def test_a_lost_build_changes_nothing_and_a_reader_keeps_its_state(spark, wh):
    land(wh, "run0", *BATCHES[0])
    build(wh)
    reader = Warehouse(spark, wh.root, wh.settings)
    seen = rows(reader.read(b.FACT).select("unique_key", "status"))
    held = reader.read(b.FACT).select("unique_key", "status")
    # Half a build: files without a mark.
    wh.read(b.REQUESTS).limit(2).write.parquet(wh.path(wh._new_part(b.REQUESTS)))
    land(wh, "run1", *BATCHES[1])
    build(wh)
    assert rows(held) == seen == rows(reader.read(b.FACT).select("unique_key", "status"))
    now = Warehouse(spark, wh.root, wh.settings)
    assert same_rows(now.read(b.REQUESTS), latest_requests(now.raw()))
    assert wh.vacuum() and same_rows(now.read(b.REQUESTS), latest_requests(now.raw()))


def test_increments_of_any_size_equal_the_rebuild(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), Settings(buckets=4))
    land(wh, "run0", "2026-09-11T02:00:00", many(10, range(40)))
    build(wh)
    for n, keys in enumerate([range(3, 6), [4, 50], [], range(30)]):
        land(wh, f"run{n + 1}", f"2026-09-1{n + 2}T02:00:00", many(11 + n, keys) or many(9, [1]))
        build(wh)
        raw = wh.raw()
        assert same_rows(wh.read(b.REQUESTS), latest_requests(raw))
        assert same_rows(wh.read(b.HISTORY), fct_request_status_history(request_versions(raw)))
        assert same_rows(wh.read(b.FACT), fct_service_requests(latest_requests(raw), AS_OF))


def exchanges_over_scan(df, table):
    """Exchanges on the way from the stored table's scan to the root of the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    path, found = [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        path = [p for p in path if p[0] < depth] + [(depth, line.strip(" :+-"))]
        if "FileScan" in line and table in line:
            found = path
    assert found is not None, plan
    return [p for _, p in found if p.startswith(("Exchange", "BroadcastExchange"))]


def test_stored_rows_are_merged_where_they_lie(spark, wh, monkeypatch):
    land(wh, "run0", *BATCHES[0])
    build(wh)
    written = {}
    plain = Warehouse._write

    def watched(self, name, placed, through):
        written[name] = exchanges_over_scan(placed, "caseflow_")
        plain(self, name, placed, through)

    monkeypatch.setattr(Warehouse, "_write", watched)
    land(wh, "run1", *BATCHES[1])
    # Staging only: each of its merges reads one stored table, its own.
    b.build_staging(wh)
    assert written == {b.REQUESTS: [], b.VERSIONS: []}
    new = wh.read(b.REQUESTS).limit(1)
    wh.replace_keys(b.REQUESTS, new, new, None)
    files = spark.read.parquet(wh.path(wh.build_mark(b.REQUESTS)["path"])).inputFiles()
    assert len(files) <= wh.settings.buckets


def test_facts_and_sequences_are_made_where_their_rows_lie(spark, wh, monkeypatch):
    land(wh, "run0", *BATCHES[0])
    build(wh)
    written = {}
    plain = Warehouse._write

    def watched(self, name, placed, through):
        written[name] = exchanges_over_scan(placed, "caseflow_")
        plain(self, name, placed, through)

    monkeypatch.setattr(Warehouse, "_write", watched)
    land(wh, "run1", *BATCHES[1])
    b.build_staging(wh)
    written.clear()
    changed = spark.createDataFrame([("50003",), ("50004",), ("50004",), (None,)], "unique_key string")
    b.build_fact(wh, AS_OF, changed)
    b.build_history(wh, changed)
    assert written == {b.FACT: [], b.HISTORY: []}
    assert not {"_key"} & {*wh.read(b.FACT).columns, *wh.read(b.HISTORY).columns}


def test_a_large_table_gets_more_buckets(spark, tmp_path):
    """Also one that outgrows those it has; the rows are the same in any number of them."""
    wh = Warehouse(spark, str(tmp_path / "wh"), Settings(buckets=2, bucket_rows=8))
    seen = []
    for i, records in enumerate([many(10, range(5)), many(11, range(30)), many(12, range(3))]):
        land(wh, f"run{i}", f"2026-09-1{i + 2}T02:00:00", records)
        build(wh)
        seen.append([wh.build_mark(n)["buckets"] for n in (b.REQUESTS, b.VERSIONS, b.FACT, b.HISTORY)])
    assert seen == [[2] * 4, [4] * 4, [4] * 4]
    raw = wh.raw()
    requests, versions = latest_requests(raw), request_versions(raw)
    for name, whole in [
        (b.REQUESTS, requests),
        (b.VERSIONS, versions),
        (b.FACT, fct_service_requests(requests, AS_OF)),
        (b.HISTORY, fct_request_status_history(versions)),
    ]:
        again = Warehouse(spark, wh.root, wh.settings)
        assert same_rows(again.read(name), whole)


def test_rows_of_unknown_number_are_sorted_in_many_tasks(spark, wh, monkeypatch):
    """Their partitions are a multiple of the buckets, so each holds rows of one bucket only."""
    parts = {}
    plain = Warehouse._write

    def watched(self, name, placed, through):
        parts[name] = placed.rdd.getNumPartitions()
        plain(self, name, placed, through)

    monkeypatch.setattr(Warehouse, "_write", watched)
    rows = spark.range(1000).selectExpr("cast(id as string) as unique_key", "id as n")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "10")
    try:
        wh.create("t", rows, None)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert parts == {"t": 12}
    files = spark.read.parquet(wh.path(wh.build_mark("t")["path"])).inputFiles()
    assert len(files) <= 12 and same_rows(wh.read("t"), rows)


def test_rows_are_written_to_their_buckets_without_a_sort(spark, wh):
    """They stay in the order they come in, also where a task has rows of several buckets."""
    rows = spark.range(400).selectExpr("cast(id as string) as unique_key", "id as n")
    for buckets in (4, 16):
        wh.expect("t", buckets * wh.settings.bucket_rows)
        placed = wh._placed("t", rows, 4).sortWithinPartitions(F.desc(KEYED))
        wh._write("t", placed, None)
        assert spark.conf.get(WRITERS[0]) == "0" and same_rows(wh.read("t"), rows)
        files = wh.read("t", keyed=True).select(F.input_file_name().alias("f"), KEYED).collect()
        by_file = {f: [k for at, k in files if at == f] for f, _ in files}
        assert len(by_file) == buckets
        descending = [f for f, keys in by_file.items() if keys == sorted(keys, reverse=True)]
        assert len(descending) >= 4


def test_a_held_setting_is_restored_once_the_last_has_ended(spark):
    name = WRITERS[0]
    before = spark.conf.get(name)
    outer, inner = held(spark, name, "3"), held(spark, name, "3")
    outer.__enter__()
    inner.__enter__()
    outer.__exit__(None, None, None)
    assert spark.conf.get(name) == "3"
    inner.__exit__(None, None, None)
    assert spark.conf.get(name) == before


def test_stored_rows_meet_keys_without_an_order(spark, wh):
    """Unless the buckets have become too few for the keys."""
    wh.create("t", spark.range(40).selectExpr("cast(id as string) as unique_key", "id as n"), None)
    keys = spark.createDataFrame([("7",), ("x",)], "unique_key string")
    for rows, join, other in [(0, "ShuffledHashJoin", "Sort"), (9 * 500_000, "SortMergeJoin", "Broadcast")]:
        wh.expect("t", rows)
        found = wh.rows_of("t", keys)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert join in plan and other not in plan and rows_as_tuples(found) == [("7", 7)]
    new = spark.createDataFrame([("7", 70)], "unique_key string, n long")
    wh.replace_keys("t", new, keys, None)
    assert wh.read("t").filter("unique_key = '7'").collect() == new.collect()
    assert wh.read("t").count() == 40 and wh.buckets_of("t") == 16


@pytest.mark.parametrize("root", ["wh", "w h%20\u00e9"])
def test_a_micro_batch_is_read_by_the_columns_needed(spark, tmp_path, monkeypatch, root):
    wh = Warehouse(spark, str(tmp_path / root), Settings(buckets=4))
    plans = []

    def watched(wh, batch, *rest, plain=landing_stream.build_versions):
        plans.append(batch.select("status")._jdf.queryExecution().executedPlan().toString())
        return plain(wh, batch, *rest)

    monkeypatch.setattr(landing_stream, "build_versions", watched)
    raw = normalise(lines(spark, first_batch()), "r1", "r1-0000", "2026-09-10T00:00:00")
    for day in ("2026-09-10", "2026-09-11"):  # a first build and a merge
        write_batch(raw, wh.raw_path, day, 3)
        run_available(wh, AS_OF, str(tmp_path / "checkpoint"))
    assert len(plans) == 2 and all("FileScan" in p and "descriptor" not in p for p in plans)
    requests = latest_requests(raw)
    assert same_rows(wh.read(b.REQUESTS), requests)
    assert same_rows(wh.read(b.FACT), fct_service_requests(requests, AS_OF))
    # A frame that comes from no file is folded in as it is.
    other = Warehouse(spark, str(tmp_path / "other"), wh.settings)
    landing_stream.fold_batch(other, raw.limit(0), AS_OF)
    assert not other.exists(b.REQUESTS)
    landing_stream.fold_batch(other, raw, AS_OF)
    assert same_rows(other.read(b.FACT), wh.read(b.FACT))


def test_null_keys_are_merged_like_others(spark, wh):
    new = spark.createDataFrame([(None, "a", 1), ("x", "a", 1)], "unique_key string, v string, n int")
    wh.append_unseen("t", new, ["unique_key", "v"], None)
    more = spark.createDataFrame([(None, "a", 2), (None, None, 2), ("", "a", 2)], new.schema)
    for _ in range(2):
        wh.append_unseen("t", more, ["unique_key", "v"], None)
    assert sorted(map(str, rows_as_tuples(wh.read("t")))) == sorted(
        map(str, [(None, "a", 1), ("x", "a", 1), (None, None, 2), ("", "a", 2)])
    )
    wh.replace_keys("t", new.limit(0), spark.createDataFrame([(None,)], "unique_key string"), None)
    assert sorted(rows_as_tuples(wh.read("t"))) == [("", "a", 2), ("x", "a", 1)]
    assert rows_as_tuples(wh.rows_of("t", new)) == [("x", "a", 1)]


def rows_as_tuples(df):
    return [tuple(r) for r in df.collect()]


def test_no_change_build_rewrites_only_the_clock_marts(wh):
    land(wh, "run1", "2026-09-11T02:00:00", first_batch())
    build(wh)
    before = wh.builds().count()
    assert b.build_staging(wh) is False and b.build_core(wh, AS_OF) is False
    b.build_marts(wh, AS_OF)
    assert wh.builds().count() == before + 2


def many(day, keys):
    state = "Closed" if day % 3 == 0 else "Open"
    return [record(k, f"2026-09-{day:02d}T01:33:0{k % 10}.000Z", status=state) for k in keys]


BATCHES = [
    ("2026-09-11T02:00:00", many(10, range(12)) + many(11, range(6))),
    ("2026-09-12T02:00:00", many(11, range(3, 9)) + many(12, range(0, 12, 2))),
    # A replayed old version next to new ones: it must not win.
    ("2026-09-13T02:00:00", many(10, range(4)) + many(9, range(2)) + many(13, [7, 40])),
]
NO_STAMP = "_ingested_at"


def test_incremental_equals_full_rebuild(spark, wh):
    for i, (stamp, records) in enumerate(BATCHES):
        land(wh, f"run{i}", stamp, records)
        build(wh)
    raw = wh.raw()
    requests, versions = latest_requests(raw), request_versions(raw)
    assert same_rows(wh.read(b.REQUESTS), requests)
    assert same_rows(wh.read(b.VERSIONS), versions)
    assert same_rows(wh.read(b.FACT), fct_service_requests(requests, AS_OF))
    assert same_rows(wh.read(b.HISTORY), fct_request_status_history(versions))


def test_interrupted_build_is_repeated(spark, wh):
    land(wh, "run0", *BATCHES[0])
    build(wh)
    older = wh.builds().groupBy("table").agg(F.max_by(F.struct(*MARK_FIELDS), "build_no").alias("m"))
    marks = {r["table"]: r["m"] for r in older.collect()}
    land(wh, "run1", *BATCHES[1])
    b.build_staging(wh)
    # The marks of that build are lost: another writer starts from the older ones.
    again = Warehouse(spark, wh.root, wh.settings)
    again._marks = marks
    build(again)
    assert same_rows(again.read(b.REQUESTS), latest_requests(again.raw()))
    assert same_rows(again.read(b.HISTORY), fct_request_status_history(request_versions(again.raw())))


def test_stream_equals_batch(spark, wh, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")
    for i, (stamp, records) in enumerate(BATCHES):
        land(wh, f"run{i}", stamp, records)
        if i != 1:
            run_available(wh, AS_OF, checkpoint, files_per_trigger=1)
    raw = wh.raw()
    requests, versions = latest_requests(raw), request_versions(raw)
    assert same_rows(wh.read(b.FACT), fct_service_requests(requests, AS_OF))
    history = fct_request_status_history(versions)
    assert same_rows(wh.read(b.HISTORY).drop(NO_STAMP), history.drop(NO_STAMP))


def test_files_of_one_run_may_arrive_in_several_micro_batches(spark, wh, tmp_path):
    """All rows share one stamp, so the fact must follow keys, not stamps."""
    stamp = "2026-09-11T02:00:00"
    for part in range(3):
        df = normalise(lines(spark, many(10, range(part * 4, part * 4 + 4))), "r", "b", stamp)
        write_batch(df.coalesce(1), wh.raw_path, stamp[:10], 100)
    run_available(wh, AS_OF, str(tmp_path / "checkpoint"), files_per_trigger=1)
    assert wh.read(b.FACT).count() == 12


def test_new_staging_columns_are_appended(spark, wh):
    land(wh, "run0", *BATCHES[0])
    b.build_requests(wh)
    new = wh.read(b.REQUESTS).limit(1).withColumn("added", F.lit("n"))
    new = new.withColumn("source_updated_at", F.lit("2030-01-01").cast("timestamp_ntz"))
    wh.upsert(b.REQUESTS, new, ["unique_key"], b.NEWEST_FIRST, "2030-01-01")
    stored = Warehouse(spark, wh.root, wh.settings).read(b.REQUESTS)
    assert rows(stored.groupBy("added").count().fillna("", ["added"])) == [("", 11), ("n", 1)]
    assert stored.schema["status"].metadata["comment"].startswith("One of the listed")


def test_upsert_replaces_by_key_and_merge_keeps_the_newest(spark):
    old = spark.createDataFrame([("a", 5, "old"), ("b", 1, "old")], "k string, t int, v string")
    new = spark.createDataFrame([("a", 3, "new"), ("c", 1, "new")], "k string, t int, v string")
    assert rows(upsert(old, new, ["k"])) == [("a", 3, "new"), ("b", 1, "old"), ("c", 1, "new")]
    merged = merge_latest(old, new, ["k"], ["t"])
    assert rows(merged) == [("a", 5, "old"), ("b", 1, "old"), ("c", 1, "new")]


def test_hot_and_null_keys_are_numbered_by_day(spark, uncoalesced):
    base = "timestamp_ntz'2026-01-01 00:00:00'"
    hour = F.expr(f"{base} + make_dt_interval(0, cast(id * 7919 % 3001 as int))")
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 3 == 1, (F.col("id") % 100).cast("string"))
        .alias("k"),
        F.when(F.col("id") % 50 != 0, hour).alias("source_updated_at"),
        F.format_string("%06d", "id").alias("sys_updated_at"),
        (F.col("id") % 5).cast("string").alias("status"),
    )
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("sequence", "building the plan runs nothing")
    numbered = number_versions(df, "k")
    assert list(tracker.getJobIdsForGroup("sequence")) == []
    w = Window.partitionBy("k").orderBy(F.col("source_updated_at").asc_nulls_last(), "sys_updated_at")
    plain = df.withColumns(
        {
            "version_no": F.row_number().over(w).cast("long"),
            "previous_status": F.lag("status").over(w),
            "previous_updated_at": F.lag("source_updated_at").over(w),
        }
    )
    assert numbered.groupBy("k").agg(F.max("version_no").alias("n")).filter("n = 1000").count() == 2
    assert same_rows(plain, numbered)


def test_dedupe_limits_ranks_before_the_shuffle(spark):
    df = spark.range(100).select(
        (F.col("id") % 7).alias("unique_key"),
        F.col("id").cast("string").alias("sys_updated_at"),
        F.lit("s").alias("_ingested_at"),
        F.lit("i").alias("sys_id"),
    )
    plan = latest_per_key(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@contextmanager
def unread(path):
    """Reading the folder fails meanwhile: its files are away."""
    os.rename(path, f"{path}-away")
    try:
        yield
    finally:
        os.rename(f"{path}-away", path)


def refresh_checks(wh, now):
    """All checks of a refresh, without its builds."""
    state = Refresh("again")
    for checks in (
        quality.blocking_checks(now, wh.settings),
        quality.raw_checks(),
        quality.staging_checks(AS_OF),
        quality.core_checks(),
        quality.mart_checks(wh.settings),
    ):
        assert run_checks(wh, state, checks)
    return state


def feed(spark, records):
    return lambda lower, upper: lines(spark, records)


def test_refresh_runs_every_layer(spark, wh):
    now = datetime(2026, 9, 14)
    state = refresh(wh, feed(spark, second_batch() + first_batch()[:1]), now=now, as_of=AS_OF,
                    start="2026-09-01T00:00:00")
    assert state.ok, state.blocked_by
    assert state.built == ["raw", "staging", "core", "marts"]
    assert len(state.results) == 43
    assert wh.read(b.HEALTH).first()["n_requests"] == 3
    assert check_results(wh).count() == check_results(wh, state.build_id).count() == 43
    details = check_results(wh).filter("test = 'few_repeated_versions'").first()["details"]
    assert '"n_versions":3' in details
    # Nothing has landed: outcomes are taken over, only what follows the clock is checked again.
    with unread(wh.raw_path):
        again = refresh_checks(wh, now)
    assert [(r.check.name, r.failing_rows, r.status) for r in again.results] == [
        (r.check.name, r.failing_rows, r.status) for r in state.results
    ]


def test_refresh_is_blocked_by_stale_raw_and_keeps_the_marts(spark, wh):
    now = datetime(2026, 9, 10)
    refresh(wh, feed(spark, first_batch()), now=now, as_of=now, start="2026-09-01T00:00:00")
    kept = rows(wh.read(b.BACKLOG))
    late = datetime(2026, 9, 30)
    state = refresh(wh, None, now=late, as_of=late)
    assert state.blocked_by == ["landing_is_recent"] and state.built == []
    assert rows(wh.read(b.BACKLOG)) == kept


def test_a_failed_layer_check_stops_later_layers_and_stores_rows(spark, wh):
    bad = [record(1, "2026-09-12T01:00:00.000Z", latitude="10.0"),
           record(2, "2026-09-12T01:00:00.000Z", status="Closed", closed_date="2026-09-01T00:00:00")]
    state = refresh(wh, feed(spark, bad), now=datetime(2026, 9, 13), as_of=AS_OF,
                    start="2026-09-01T00:00:00")
    name = "within_range_service_requests_latitude"
    assert state.blocked_by == [name] and state.built == ["raw", "staging"]
    stored = spark.read.parquet(wh.path(f"dq/{name}/build={state.build_id}"))
    assert [r["latitude"] for r in stored.collect()] == [10.0]
    warned = {r.check.name: r.status for r in state.results if r.status == "WARN"}
    assert warned == {"closed_not_before_created": "WARN"}
    assert not wh.exists(b.FACT) and wh.exists(b.REQUESTS)


def test_a_check_that_passes_again_leaves_no_rows(spark, wh):
    closed = {"status": "Closed", "closed_date": "2026-09-01T00:00:00"}
    first = [record(2, "2026-09-12T01:00:00.000Z", **closed)]
    state = refresh(wh, feed(spark, first), now=datetime(2026, 9, 13), as_of=AS_OF, start="2026-09-01T00:00:00")
    folder = wh.path("dq/closed_not_before_created")
    assert os.path.isdir(f"{folder}/build={state.build_id}")
    mended = [record(2, "2026-09-13T01:00:00.000Z", **closed | {"closed_date": "2026-09-12T00:00:00"})]
    again = refresh(wh, feed(spark, mended), now=datetime(2026, 9, 13, 2), as_of=AS_OF)
    assert {r.check.name: r.status for r in again.results}["closed_not_before_created"] == "PASS"
    assert not [f for f in os.listdir(folder) if f.startswith("build=")]


def test_an_increment_is_brought_to_its_buckets_once(spark, wh):
    """New rows are ranked and merged in the buckets of their table: one shuffle each, and no sort
    of the rows read before it."""
    raw = normalise(lines(spark, first_batch()), "r1", "r1-0000", "2026-09-10T00:00:00").cache()
    plans, write = [], wh._write

    def seen(name, placed, through):
        plans.append(placed._jdf.queryExecution().executedPlan().toString())
        write(name, placed, through)

    wh._write = seen
    for make in (b.build_requests, b.build_versions):
        for _ in range(2):  # a first build and a merge
            make(wh, raw)
            ranked, *read = plans[-1].split("Exchange hashpartitioning")
            assert len(read) == 1 and "Sort [" in ranked and "Sort [" not in read[0]
    assert same_rows(wh.read(b.REQUESTS), latest_requests(raw))
    assert same_rows(wh.read(b.VERSIONS), request_versions(raw))


def test_newest_of_batches_drops_nothing_that_could_be_newest(spark):
    data = [
        ("a", "2", "1", "x"), ("a", "2", "1", "y"), ("a", None, "9", "z"), ("a", "10", "9", "z"),
        (None, "1", None, "x"), (None, "1", "0", "x"), (None, None, None, None),
        ("", None, None, "q"), ("", None, None, None), ("\u00e9", "1", "1", "1"),
    ]
    schema = "unique_key string, sys_updated_at string, _ingested_at string, sys_id string"
    df = spark.createDataFrame(data, schema)
    expected = latest_per_key(df)
    assert same_rows(newest_of_batches(df.coalesce(1)), expected)
    for n in (2, 7):
        assert same_rows(latest_per_key(newest_of_batches(df.repartition(n))), expected)
    assert newest_of_batches(df.limit(0)).isEmpty()


def test_requests_are_made_of_the_listed_columns(spark):
    """The rows brought to the buckets are narrowed first; typing and ranking need no other column."""
    raw = normalise(lines(spark, first_batch()), "r1", "r1-0000", "2026-09-10T00:00:00")
    assert same_rows(latest_requests(raw.select(*REQUEST_COLUMNS)), latest_requests(raw))
