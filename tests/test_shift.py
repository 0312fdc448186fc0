"""Distances between landings against plain counts; all levels of the volume report in one pass."""

import math
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from caseflow.plans import profile_shift as ps
from caseflow.plans import reports as r

SCHEMA = "landing string, state string, size string"
EDGES = [1.0, 10.0]


def found(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    bins = {"state": F.col("state"), "size": ps.numeric_bin(F.col("size"), EDGES)}
    return {
        (x.landing, x["column"]): x
        for x in ps.shifts(ps.profile(frame, F.col("landing"), bins)).collect()
    }


def plain_psi(now, then):
    a, b = Counter(now), Counter(then)
    bins = a.keys() | b.keys()
    total = 0.0
    for x in bins:
        p, q = ((c[x] + 0.5) / (sum(c.values()) + 0.5 * len(bins)) for c in (a, b))
        total += (p - q) * math.log(p / q)
    return total


def test_shifts_against_plain_counts(spark):
    rows = [("1", s, n) for s, n in [("a", "0"), ("b", "5"), ("a", "1d"), (None, "NaN")] * 25]
    rows += [("2", s, n) for s, n in [("a", "1"), ("b", "5"), ("a", "x"), (None, None)] * 25]
    rows += [("3", s, n) for s, n in [("c", "10"), ("(null)", "99"), (None, "7")] * 40]
    rows += [(None, "a", "1")] * 500
    got = found(spark, rows)
    assert set(got) == {(m, c) for m in "23" for c in ("state", "size")}
    for now, then in (("2", "1"), ("3", "2")):
        mine, before = ([s if s is not None else 0 for m, s, _ in rows if m == x] for x in (now, then))
        row = got[now, "state"]
        assert row.psi == pytest.approx(plain_psi(mine, before), abs=1e-6) and row.previous == then
        assert row.null_rate == pytest.approx(mine.count(0) / len(mine), abs=1e-6)
        assert row.n_rows == len(mine) and row.n_bins == len(set(mine) | set(before))
    assert got["2", "state"].status == "PASS" and got["2", "state"].largest_gap == 0
    assert got["3", "state"].status == "ERROR"
    # "0" moved to "1": from below the first edge to above it.
    assert got["2", "size"].status == "ERROR" and got["2", "size"].null_rate == 0.5


def test_shifts_of_nothing(spark):
    assert found(spark, []) == {} and found(spark, [("1", "a", "1")] * 3) == {}
    bins = spark.range(1_000).select(ps.hashed_bin(F.col("id").cast("string"), 8).alias("b"))
    assert bins.distinct().count() == 8
    assert spark.sql("select cast(null as string) as v").select(ps.hashed_bin(F.col("v"))).first()[0] is None


def test_volume_levels(spark):
    day = date(2026, 9, 7)
    rows = [
        (day, "X", "noise", "A", 4, 2, 4),
        (day, "Y", "noise", None, 6, 0, 3),
        (date(2026, 9, 8), "X", "water", "A", 10, 10, 10),
    ]
    schema = """created_date date, borough string, complaint_family string, agency string,
        n_requests long, n_closed long, n_with_geo long"""
    selection = spark.createDataFrame(rows, schema)
    levels = r.volume_levels(selection)
    got = {
        (x.level, x.created_date, x.complaint_family, x.borough, x.agency): x.n_requests
        for x in levels.collect()
    }
    assert got["headline", None, None, None, None] == 20
    assert got["family", None, "noise", None, None] == 10
    # A group without an agency is not taken for the headline.
    assert got["agency", None, None, None, None] == 6 and got["agency", None, None, None, "A"] == 14
    assert got["day_family", day, "noise", None, None] == 10 and got["day_borough", day, None, "Y", None] == 6
    assert len(got) == 1 + 2 + 2 + 2 + 2 + 2 + 3
    head = levels.filter("level = 'headline'").first()
    plain = r.volume_headline(selection).first()
    assert (head.n_requests, head.share_closed, head.share_without_geo) == tuple(plain)
    assert r.volume_levels(selection.limit(0)).collect() == []
    plan = levels._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("Scan") == 1
