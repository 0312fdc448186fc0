from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from caseflow.operators import checks as c
from caseflow.schema import RUN_SCHEMA

NOW = datetime(2026, 9, 20)


def raw(spark, *hours_ago):
    stamps = [((NOW - timedelta(hours=h)).isoformat() + "Z",) for h in hours_ago]
    return spark.createDataFrame(stamps, "sys_updated_at string")


@pytest.mark.parametrize(
    ("ages", "status"), [((50, 10), "PASS"), ((50,), "WARN"), ((100,), "ERROR"), ((), "ERROR")]
)
def test_freshness(spark, ages, status):
    row = c.raw_freshness(raw(spark, *ages), NOW).first()
    assert row["status"] == status
    if ages:
        assert row["hours_since_update"] == pytest.approx(min(ages))


def runs(spark, *entries):
    data = []
    for i, (status, keys) in enumerate(entries):
        at = NOW + timedelta(hours=i)
        error = "boom" if status == "failed" else None
        data.append((f"run{i}", at, at, status, "a", "b", 1, 1, None, keys, error))
    return spark.createDataFrame(data, RUN_SCHEMA)


def test_schema_drift_of_the_last_run(spark):
    assert c.schema_stable(runs(spark, ("succeeded", ["x"]), ("succeeded", []))).first()["status"] == "PASS"
    row = c.schema_stable(runs(spark, ("succeeded", []), ("succeeded", ["brand_new_col"]))).first()
    assert (row["status"], row["unexpected_keys"]) == ("WARN", ["brand_new_col"])


def test_last_run(spark):
    assert c.last_run_succeeded(runs(spark, ("failed", []), ("succeeded", []))).first()["status"] == "PASS"
    row = c.last_run_succeeded(runs(spark, ("succeeded", []), ("failed", []))).first()
    assert (row["status"], row["error"]) == ("ERROR", "boom")
    assert c.last_run_succeeded(runs(spark).limit(0)).first()["status"] == "ERROR"


def test_duplicate_rate(spark):
    one = spark.range(10).select(
        F.col("id").cast("string").alias("unique_key"), F.lit("t").alias("sys_updated_at")
    )
    assert c.duplicate_rate(one).first()["status"] == "PASS"
    row = c.duplicate_rate(one.union(one).union(one)).first()
    assert row["status"] == "WARN" and row["duplicate_rate"] > 0.6
    assert c.duplicate_rate(one.limit(0)).first()["status"] == "PASS"


def test_policy():
    p = c.CLOSED_BEFORE_CREATED
    assert [p.status(n) for n in (0, 1, 5000, 5001)] == ["PASS", "WARN", "WARN", "ERROR"]
    assert [c.FAIL_ON_ANY.status(n) for n in (0, 1)] == ["PASS", "ERROR"]


def test_relationship_counts_child_rows(spark):
    child = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "k string")
    parent = spark.createDataFrame([("a",)], "p string")
    assert [tuple(r) for r in c.relationships(child, "k", parent, "p").collect()] == [("x", 2)]


def test_evaluate_counts_row_checks_in_one_scan(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (7, "b")], "n int, s string")
    checks = [
        c.Check("n_null", "t", predicate=F.col("n").isNull()),
        c.Check("n_range", "t", predicate=c.is_outside("n", 0, 5), columns=("n",)),
        c.Check("s_unique", "t", failing=lambda tables: c.unique(tables("t"), F.col("s"))),
    ]
    results = c.evaluate(spark, checks, lambda name: df)
    assert {r.check.name: r.failing_rows for r in results} == {"n_null": 1, "n_range": 1, "s_unique": 1}
    assert [r["n"] for r in checks[1].failing_rows(lambda name: df).collect()] == [7]
