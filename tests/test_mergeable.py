"""Merged state equals a rebuild; the backlog of past days equals a plain count."""

from datetime import date, datetime, timedelta

import numpy as np
import pytest
from conftest import same_rows
from pyspark.sql import functions as F

from caseflow.functions.rules import AGE_BUCKETS, OLDEST_BUCKET
from caseflow.plans import backlog_on as past
from caseflow.plans import delta_marts as dm
from caseflow.plans import landing_sketch as ls
from caseflow.plans import resolution_sketch as rs
from caseflow.plans import survival
from caseflow.plans.marts import mart_open_backlog
from caseflow.plans.staging import latest_requests
from caseflow.queries import mergeable
from caseflow.queries import tables as t
from caseflow.session import materialise

WEEK = date(2026, 9, 7)


def timed(spark, rows):
    schema = "unique_key string, week_start date, agency string, minutes long"
    return spark.createDataFrame([(k, WEEK, a, m) for k, a, m in rows], schema)


def counts(state):
    rows = rs.merged(state).collect()
    return {r.agency: (r.n_closed, r.minutes, r.n_within_24h) for r in rows}


def test_only_groups_that_lost_something_are_drawn_anew(spark):
    first = timed(spark, [("a", "X", 10), ("b", "X", 2_000), ("c", "Y", 30), ("d", "Z", 5), (None, "N", 1)])
    second = timed(spark, [("a", "X", 99), ("c", "Y", 30), ("e", "Y", 40), (None, "N", 1)])  # d is open again
    current = timed(spark, [("a", "X", 99), ("b", "X", 2_000), ("c", "Y", 30), ("e", "Y", 40), (None, "N", 1)])
    touched = first.filter("unique_key is null or unique_key <> 'b'")
    added = rs.next_state(touched, second, current, 2).persist()
    assert {(r.agency, r.resets, r.n_closed) for r in added.collect()} == {
        ("X", True, 2),
        ("Y", False, 1),
        ("Z", True, 0),
    }
    state = rs.sketched(first, 1).unionByName(added)
    wanted = {"X": (2, 2_099, 1), "Y": (2, 70, 2), "N": (1, 1, 1)}
    assert counts(state) == wanted
    assert counts(rs.compacted(state, 3)) == wanted
    # The same increment again changes nothing: its rows are already counted as they are.
    again = rs.next_state(second, second, current, 3)
    assert again.isEmpty()


def test_ranks_stay_within_the_error_over_many_merges(spark):
    random = np.random.default_rng(2)
    minutes = random.lognormal(6, 2, 30_000).astype(int).tolist()
    rows = timed(spark, [(str(i), "X" if i % 3 else "Y", m) for i, m in enumerate(minutes)]).persist()
    state = None
    for build in range(6):
        part = rs.sketched(rows.filter(F.col("unique_key").cast("int") % 6 == build), build)
        state = part if state is None else state.unionByName(part)
    errors = rs.rank_errors(state, rows, (0.01, 0.5, 0.9, 0.999)).collect()
    assert len(errors) == 8 and max(r.rank_error for r in errors) <= rs.RANK_ERROR
    assert max(len(r.sketch) for r in rs.merged(state).collect()) < 40_000


def log(spark, rows):
    return spark.createDataFrame(rows, "unique_key string, sys_updated_at string, _ingested_at string")


def test_landing_sketches_know_when_they_are_unsure(spark):
    rows = [(str(i % 5), f"t{i // 5}", "d1") for i in range(100)] + [("0", "t0", "d2")] * 25
    rows += [(None, "t0", "d2"), ("7", None, "d2"), (None, None, "d2")]
    sketches = ls.landing_sketches(log(spark, rows))
    r = ls.duplicate_rate(sketches, 0.2).first()
    assert (r.n_rows, r.n_versions, r.status, r.decided) == (128, 100, "WARN", True)
    assert ls.duplicate_rate(sketches, 0.25).first().status == "PASS"
    assert {(o.landing, o.n_rows, o.n_versions, o.n_again) for o in ls.overlaps(sketches).collect()} == {
        ("d1", 100, 100, 0),
        ("d2", 28, 1, 1),
    }
    assert ls.profile(sketches).first().asDict() == {"n_rows": 128, "n_versions": 100, "n_keys": 6, "n_stamps": 20}


def test_many_versions_are_estimated_within_the_error(spark):
    n = 200_000
    rows = spark.range(n).select(
        (F.col("id") % 1_000).cast("string").alias("unique_key"),
        (F.col("id") % 160_000).cast("string").alias("sys_updated_at"),
        (F.col("id") % 7).cast("string").alias("_ingested_at"),
    )
    sketches = ls.landing_sketches(rows)
    r = ls.duplicate_rate(sketches, 0.2).first()
    assert r.n_rows == n and r.n_versions != 160_000
    assert abs(r.duplicate_rate - 0.2) <= r.rate_error and not r.decided
    assert ls.duplicate_rate(sketches, 0.5).first().decided


def test_no_landings(spark):
    sketches = ls.landing_sketches(log(spark, []))
    r = ls.duplicate_rate(sketches).first()
    assert (r.n_rows, r.n_versions, r.duplicate_rate, r.status, r.decided) == (0, 0, 0.0, "PASS", True)
    assert ls.overlaps(sketches).collect() == []


FACT = (
    "unique_key string, created_at timestamp_ntz, created_date date, agency_key string, "
    "complaint_type_key string, borough string, status string, is_closed boolean, has_geo boolean, "
    "open_age_days double"
)


def facts(spark, states):
    """Fact rows of the requests' states: key, hour of creation, agency, borough, status, age."""
    rows = []
    for key, hours, agency, borough, status, age in states:
        at = None if hours is None else datetime(2026, 9, 1) + timedelta(hours=hours)
        day = at and at.date()
        rows.append((key, at, day, agency, f"c{len(agency or '')}", borough, status, status == "Closed", bool(borough), age))
    return spark.createDataFrame(rows, FACT)


def random_states(random, keys):
    def one(key):
        pick = lambda some: some[int(random.integers(len(some)))]
        hours, age = pick([None, *range(60)]), pick([None, 0.5, 3.0, 8.25, 100.0])
        return (key, hours, pick(["DOT", "X", None]), pick(["BRONX", None]), pick(["Open", "Closed"]), age)

    return {key: one(key) for key in keys}


@pytest.mark.parametrize("start", [datetime(2026, 9, 2), datetime(2026, 9, 2, 7, 30), None])
def test_marts_of_deltas_equal_a_rebuild(spark, start):
    random = np.random.default_rng(7)
    known, volume, backlog = {}, None, None
    for build in range(4):
        keys = [None, *(str(i) for i in range(build * 9, 30))] if build % 2 else [str(i) for i in range(40)]
        fresh = random_states(random, keys)
        old = facts(spark, [known[k] for k in fresh if k in known]) if known else None
        known |= fresh
        new = facts(spark, fresh.values())
        volume = dm.fold_volume(volume, old, new)
        backlog = dm.fold_backlog(backlog, old, new)
    whole = facts(spark, known.values()).persist()
    wanted = dm.covered(dm.fold_volume(None, None, whole), start, whole)
    mine = dm.covered(volume, start, whole)
    assert same_rows(mine, wanted)
    plain = whole.filter(F.col("created_at") >= F.lit(start)) if start else whole.limit(0)
    assert mine.agg(F.coalesce(F.sum("n_requests"), F.lit(0))).first()[0] == plain.count()
    assert same_rows(dm.backlog_of_state(backlog, "2026-09-15"), mart_open_backlog(whole, "2026-09-15"))


def test_the_largest_age_is_taken_back(spark):
    old = facts(spark, [("a", 1, "X", "BRONX", "Open", 80.0), ("b", 1, "X", "BRONX", "Open", 40.0)])
    state = dm.fold_backlog(None, None, old)
    closed = facts(spark, [("a", 1, "X", "BRONX", "Closed", None)])
    after = dm.fold_backlog(state, old.filter("unique_key = 'a'"), closed)
    r = dm.backlog_of_state(after, "2026-09-15").collect()
    assert [(x.n_open, x.avg_age_days, x.max_age_days) for x in r] == [(1, 40.0, 40.0)]
    gone = dm.fold_backlog(after, old.filter("unique_key = 'b'"), closed.limit(0))
    assert gone.isEmpty()


def test_an_increment_does_not_read_the_fact(spark, tmp_path):
    facts(spark, [("a", 1, "X", "BRONX", "Open", 80.0)]).write.parquet(f"{tmp_path}/fact")
    fact = spark.read.parquet(f"{tmp_path}/fact")
    dm.fold_volume(None, None, fact).write.parquet(f"{tmp_path}/state")
    state = spark.read.parquet(f"{tmp_path}/state")
    mart = dm.covered(dm.fold_volume(state, None, facts(spark, [])), datetime(2026, 9, 1), fact)
    plan = mart._jdf.queryExecution().executedPlan().toString()
    assert f"{tmp_path}/state" in plan and f"{tmp_path}/fact" not in plan


# --- backlog of past days ----------------------------------------------------------------------

HISTORY = "unique_key string, source_updated_at timestamp_ntz, status string, agency string, version_no long"


def bucket(age):
    if age is None:
        return OLDEST_BUCKET
    return next((label for bound, label in AGE_BUCKETS if age < bound), OLDEST_BUCKET)


def plain_backlog(history, created, dates):
    out = {}
    by_key = {}
    for key, at, status, agency, no in history:
        by_key.setdefault(key, []).append((no, at, status, agency))
    for day in {d for d in dates if d}:
        for key, versions in by_key.items():
            versions = sorted(versions)
            for (_, at, status, agency), after in zip(versions, [*versions[1:], None], strict=True):
                end = after[1].date() if after and after[1] else date.max
                if at is None or not at.date() <= day < end or status.strip().upper() == "CLOSED":
                    continue
                age = (day - created[key]).days if created.get(key) else None
                k = (day, agency, "Open" if status.strip().upper() == "OPEN" else "Unspecified", bucket(age))
                out[k] = out.get(k, 0) + 1
    return out


def backlog_rows(spark, history, created, dates):
    found = past.backlog_on(
        spark.createDataFrame(history, HISTORY),
        spark.createDataFrame(list(created.items()), "unique_key string, created_date date"),
        spark.createDataFrame([(d,) for d in dates], "on_date date"),
    )
    return {(r.on_date, r.agency, r.status, r.age_bucket): r.n_open for r in found.collect()}


def test_backlog_of_past_days_against_a_plain_count(spark):
    random = np.random.default_rng(11)
    start, history, created = datetime(2020, 2, 20), [], {}
    for key in [None, *map(str, range(60))]:
        created[key] = (start + timedelta(days=int(random.integers(0, 300)))).date() if random.random() < 0.9 else None
        at = start + timedelta(days=int(random.integers(0, 200)))
        for no in range(1, int(random.integers(2, 6))):
            status = str(random.choice(["Open", "closed", " OPEN ", "odd"]))
            history.append((key, at, status, str(random.choice(["A", "B"])), no))
            at += timedelta(hours=int(random.choice([1, 5, 24, 100, 3_000])))
    history.append(("late", None, "Open", "A", 1))
    dates = [(start + timedelta(days=int(d))).date() for d in random.integers(-5, 700, 40)] + [None]
    wanted = plain_backlog(history, created, dates)
    assert len(wanted) > 100 and backlog_rows(spark, history, created, dates) == wanted
    for few in ([dates[0]], [dates[0], dates[1]], dates[:3] * 2):
        assert backlog_rows(spark, history, created, few) == plain_backlog(history, created, few)
    assert backlog_rows(spark, history, created, []) == {}
    assert backlog_rows(spark, [], created, dates) == {}


@pytest.mark.parametrize("span", [1, 2, 3, 7, 8, 13])
def test_blocks_cover_every_interval_once(spark, span):
    levels = span.bit_length()
    pairs = [(f, e) for f in range(span) for e in range(f + 1, span + 1)]
    rows = spark.createDataFrame(pairs, "f int, e int").select(
        "f", "e", F.inline(past._blocks(F.col("f"), F.col("e"), levels))
    )
    days = {}
    for r in rows.collect():
        block = range(r.block << r.level, (r.block + 1) << r.level)
        days.setdefault((r.f, r.e), []).extend(block)
    assert {k: sorted(v) for k, v in days.items()} == {(f, e): list(range(f, e)) for f, e in pairs}


def test_no_join_on_a_range(spark):
    found = past.backlog_on(
        spark.createDataFrame([], HISTORY),
        spark.createDataFrame([], "unique_key string, created_date date"),
        spark.createDataFrame([(WEEK,)], "on_date date"),
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


# --- survival ----------------------------------------------------------------------------------


def test_open_requests_are_censored(spark):
    day = survival.DAY
    rows = [("A", 60, 2, 0), ("A", 2 * day, 1, 1), ("A", 8 * day, 0, 2), ("A", 40 * day, 1, 0), ("B", 5, 0, 3)]
    counts = spark.createDataFrame(rows, "agency string, minutes long, n_closed long, n_open long")
    found = {r.agency: r for r in survival.close_survival(counts).collect()}
    a, b = found["A"], found["B"]
    # Of 7: 2 close within the hour, then 1 of the 5 left; at day 40 the only one left closes.
    assert (a.n_closed, a.n_open) == (4, 3)
    assert [a.share_open_after_1d, a.share_open_after_7d, a.share_open_after_30d] == [
        round(5 / 7, 9),
        round(5 / 7 * 4 / 5, 9),
        round(5 / 7 * 4 / 5, 9),
    ]
    assert a.share_open_after_90d == 0.0 and a.median_hours_to_close == 40 * 24.0
    assert (b.n_closed, b.share_open_after_90d, b.median_hours_to_close) == (0, 1.0, None)
    assert survival.close_survival(counts.limit(0)).collect() == []


def test_at_risk_is_no_sum_over_the_rest_for_every_row(spark):
    rows = [("A", m, m % 3, m % 2) for m in range(50)] + [("B", 7, 1, 4)]
    counts = spark.createDataFrame(rows, "agency string, minutes long, n_closed long, n_open long")
    curve = survival.survival_curve(counts)
    plan = curve._jdf.queryExecution().executedPlan().toString().lower()
    assert "currentrow$(), unboundedfollowing$()" not in plan
    later = lambda a, m: sum(c + o for b, n, c, o in rows if b == a and n >= m)
    assert {(r.agency, r.minutes): r.n_at_risk for r in curve.collect()} == {
        (a, m): later(a, m) for a, m, _, _ in rows
    }


# --- the builds over the given tables ----------------------------------------------------------


@pytest.fixture
def small_tables(spark, tmp_path):
    """Ten orders of three lines each; one line without an order, one order without a customer."""
    day = "timestamp '1998-03-01'"
    lines = spark.range(30).selectExpr(
        "id % 10 as l_orderkey", "cast(id div 10 + 1 as int) as l_linenumber", "id as l_partkey",
        "id as l_suppkey", "'N' as l_returnflag", "if(id % 2 = 0, 'F', 'O') as l_linestatus",
        f"{day} + make_dt_interval(cast(id as int)) as l_shipdate",
    )
    lost = lines.limit(1).withColumn("l_orderkey", F.lit(99).cast("long"))
    lines.unionByName(lost).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = "id as o_orderkey", "id % 4 as o_custkey", f"{day} as o_orderdate", "'1-URGENT' as o_orderpriority"
    spark.range(10).selectExpr(*orders).write.parquet(f"{tmp_path}/orders.parquet")
    customers = "id as c_custkey", "cast(id as int) as c_nationkey", "'BUILDING' as c_mktsegment"
    spark.range(3).selectExpr(*customers).write.parquet(f"{tmp_path}/customer.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield str(tmp_path)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_landed_lines_lie_by_their_key(spark, small_tables):
    for made in (t.requests(spark, small_tables), t.versions(spark, small_tables)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        above = plan[: plan.index("SortMergeJoin")]
        assert "Window" in above and "Exchange" not in above
    assert t.requests(spark, small_tables).count() == 8
    assert t.versions(spark, small_tables).count() == 24


def test_versions_are_ranked_before_their_text_is_made(spark, small_tables):
    made = t.requests(spark, small_tables)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "Main Street" in plan[: plan.index("Window ")]
    assert "Main Street" not in plan[plan.index("Window ") :]
    assert same_rows(made, latest_requests(t.raw_requests(spark, small_tables)))


def test_builds_read_the_landed_lines_once_each(spark, small_tables):
    done = mergeable.builds(spark, small_tables)
    for build in done:
        for rows in (build.fact, build.old, build.new):
            assert rows is None or not any("lineitem" in file for file in rows.inputFiles())
    assert [b.old.count() if b.old else None for b in done] == [None, 8, 0]
    assert [b.new.count() for b in done] == [8, 8, 0]


def test_scratch_tables_are_packed(spark, tmp_path):
    written = materialise(spark.range(5), "packed")
    assert all(".zstd." in f for f in written.inputFiles()) and written.count() == 5
