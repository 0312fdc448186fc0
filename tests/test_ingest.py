from datetime import datetime, timedelta

import pytest
from conftest import lines, record
from pyspark.sql import functions as F

from caseflow.operators import checks
from caseflow.plans.ingest import ingest
from caseflow.plans.store import Warehouse
from caseflow.schema import Settings
from caseflow.sources.runlog import RunLog, WindowRefused, read_watermark, recent_runs

START = "2026-09-01T00:00:00"
NOW = datetime(2026, 9, 20, 12)


class Feed:
    """An in-memory source; ``fail_after`` breaks it after that many frames."""

    def __init__(self, spark, records, per_frame=None, fail_after=None):
        self.spark, self.records = spark, list(records)
        self.per_frame, self.fail_after = per_frame, fail_after

    def __call__(self, lower, upper):
        step = self.per_frame or max(len(self.records), 1)
        for n, i in enumerate(range(0, len(self.records), step)):
            if self.fail_after is not None and n >= self.fail_after:
                raise RuntimeError("boom")
            yield lines(self.spark, self.records[i : i + step])


def ten(spark, **how):
    return Feed(spark, [record(i, f"2026-09-0{1 + i % 5}T10:00:00.000Z") for i in range(10)], **how)


def at(hours):
    t = NOW + timedelta(hours=hours)
    return {"now": t, "clock": lambda: t}


def test_backfill_then_increment_with_overlap(spark, wh):
    feed = ten(spark)
    first = ingest(wh, feed, start=START, page_size=4, **at(0))
    assert (first.rows, first.files) == (10, 3)
    batches = wh.raw().groupBy("_batch_id").count().orderBy("_batch_id").collect()
    assert [r["count"] for r in batches] == [4, 4, 2]
    watermark = read_watermark(wh.raw(), wh.runs.runs())
    assert watermark == first.window[1] == "2026-09-20T12:00:00"

    fresh = "2026-09-20T13:00:00.000Z"
    feed.records += [record(99, fresh), record(3, fresh, status="Closed")]
    second = ingest(wh, feed, page_size=4, **at(2))
    assert second.rows == 2 and second.window[0] == "2026-09-20T11:45:00"
    versions = wh.raw().filter("unique_key = '50003'").orderBy("sys_updated_at")
    assert [r["status"] for r in versions.collect()] == ["Open", "Closed"]
    assert wh.runs.runs().filter("status = 'succeeded'").count() == 2


def test_unpaged_batches_name_task_and_file(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "w"), Settings(rows_per_file=3))
    result = ingest(wh, ten(spark), start=START, **at(0))
    files = wh.raw().select("_batch_id", "_metadata.file_path").distinct()
    assert result.rows == 10
    assert files.count() == files.select("_batch_id").distinct().count() == result.files


def test_batches_of_several_frames_do_not_collide(spark, wh):
    result = ingest(wh, ten(spark, per_frame=4), start=START, **at(0))
    files = wh.raw().select("_batch_id", "_metadata.file_path").distinct()
    assert result.rows == 10 and result.files >= 3
    assert files.count() == files.select("_batch_id").distinct().count() == result.files


def test_broken_lines_go_to_quarantine(spark, wh):
    good = lines(spark, [record(1, "2026-09-02T00:00:00.000Z"), record(2, "2026-09-03T00:00:00.000Z", novel=1)])
    bad = spark.createDataFrame([('{"unique_key":',), ("[1]",), ("",), ("nope",)], "value string")
    result = ingest(wh, lambda lower, upper: [good.unionByName(bad), good.limit(0)], start=START, **at(0))
    assert (result.rows, result.broken, result.unexpected_keys) == (2, 4, ["novel"])
    assert sorted(r.value for r in wh.quarantined().collect()) == ["", "[1]", "nope", '{"unique_key":']
    assert {r.run_id for r in wh.quarantined().collect()} == {result.run_id}
    warned = checks.none_quarantined(wh.quarantined(), wh.runs.runs()).first()
    assert (warned["n_lines"], warned["status"]) == (4, "WARN")
    ingest(wh, lambda lower, upper: good, **at(1))
    assert checks.none_quarantined(wh.quarantined(), wh.runs.runs()).first()["status"] == "PASS"


def test_odd_lines_do_not_stop_runs(spark, wh):
    odd = [
        '{"unique_key":"1","x":{"a":1,"a":2}}',
        '{"unique_key":"1","location":{"a":1,"a":2}}',
        '{"unique_key":"1"} trailing',
        '{"unique_key":"1","unique_key":"2"}',
    ]
    feed = lines(spark, [record(1, "2026-09-02T00:00:00.000Z", novel={"a": 1})])
    feed = feed.unionByName(spark.createDataFrame([(line,) for line in odd], "value string"))
    assert ingest(wh, lambda lower, upper: feed, start=START, dry_run=True, **at(0)).rows == 1
    result = ingest(wh, lambda lower, upper: feed, start=START, **at(0))
    assert (result.rows, result.broken, result.unexpected_keys) == (1, 4, ["novel"])
    assert sorted(r.value for r in wh.quarantined().collect()) == sorted(odd)
    assert wh.runs.runs().first()["status"] == "succeeded"
    assert read_watermark(wh.raw(), wh.runs.runs()) == result.window[1]


def test_a_broken_export_is_refused(spark, wh, tmp_path):
    ingest(wh, ten(spark), start=START, **at(0))
    before = wh.runs.runs().collect()
    whole = '{"run_id":"x","status":"succeeded"}'
    for number, text in enumerate([f'{whole}\n{{"run_id":"y","sta', f'{whole}\n{{"status":"failed"}}']):
        folder = tmp_path / f"export{number}"
        folder.mkdir()
        (folder / "part.json").write_text(text)
        with pytest.raises(Exception):
            wh.runs.import_json(str(folder))
        assert wh.runs.runs().collect() == before


def test_start_is_refused_once_a_watermark_exists(spark, wh):
    feed = Feed(spark, [record(1, "2026-09-02T00:00:00.000Z")])
    ingest(wh, feed, start=START, **at(0))
    with pytest.raises(WindowRefused):
        ingest(wh, feed, start=START, **at(1))
    assert ingest(wh, feed, start=START, force_start=True, **at(1)).rows == 1


def test_failed_run_keeps_files_and_watermark(spark, wh):
    feed = ten(spark, per_frame=4, fail_after=1)
    with pytest.raises(RuntimeError):
        ingest(wh, feed, start=START, page_size=4, **at(0))
    run = wh.runs.runs().first()
    assert (run["status"], run["files_written"], run["rows_fetched"]) == ("failed", 1, 4)
    assert "boom" in run["error"]
    # Only failed runs are logged, so the landed rows must not serve as a watermark either.
    assert read_watermark(wh.raw(), wh.runs.runs()) is None

    feed.fail_after = None
    assert ingest(wh, feed, start=START, page_size=4, **at(1)).rows == 10
    assert wh.raw().count() == 14
    assert wh.raw().select("unique_key").distinct().count() == 10


def test_an_interrupted_run_is_not_a_success(spark, wh):
    def interrupted(lower, upper):
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        ingest(wh, interrupted, start=START, **at(0))
    assert wh.runs.runs().first()["status"] == "failed"


def test_dry_run_writes_nothing(spark, wh):
    feed = Feed(spark, [record(1, "2026-09-02T00:00:00.000Z")])
    result = ingest(wh, feed, start=START, dry_run=True, **at(0))
    assert result.dry_run and result.rows == 1
    assert wh.raw().isEmpty() and wh.runs.runs().isEmpty()


def test_empty_window_is_a_successful_run(spark, wh):
    feed = Feed(spark, [record(1, "2026-09-02T00:00:00.000Z")])
    result = ingest(wh, feed, start="2026-09-10T00:00:00", **at(0))
    assert (result.rows, result.files, result.max_updated_seen) == (0, 0, None)
    assert wh.runs.runs().first()["status"] == "succeeded"


def test_lost_log_rebuilds_the_watermark_from_raw(spark, wh):
    feed = Feed(spark, [record(1, "2026-09-02T00:00:00.000Z"), record(2, "2026-09-03T00:00:00.000Z")])
    ingest(wh, feed, start=START, **at(0))
    wh.runs = RunLog(spark, wh.path("meta/other_log"))
    again = ingest(wh, feed, **at(1))
    assert again.window[0] == "2026-09-02T23:45:00" and again.rows == 1


def test_run_log_records_drift_and_round_trips(spark, wh):
    feed = Feed(spark, [record(1, "2026-09-02T00:00:00.000Z", novel="x")])
    result = ingest(wh, feed, start=START, **at(0))
    assert result.unexpected_keys == ["novel"]
    assert wh.runs.export_json(wh.path("export")) == 1
    other = RunLog(spark, wh.path("meta/copy"))
    assert other.import_json(wh.path("nowhere")) == 0
    assert other.import_json(wh.path("export")) == 1
    assert other.import_json(wh.path("export")) == 1
    assert other.runs().collect() == wh.runs.runs().collect()
    assert recent_runs(other.runs()).first()["unexpected_keys"] == ["novel"]
    assert wh.runs.events().agg(F.count("*")).first()[0] == 2
