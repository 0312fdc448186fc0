from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from caseflow import functions as fn
from caseflow.functions.dates import as_ntz
from caseflow.operators.quantiles import quantile_of_ranked, ranked_counts, value_counts
from caseflow.plans.core import day_series


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2026-09-01T10:00:00.000", datetime(2026, 9, 1, 10)),
        ("2026-09-01T10:00:00.123Z", datetime(2026, 9, 1, 10, 0, 0, 123000)),
        ("2026-09-01", datetime(2026, 9, 1)),
        ("2026-9-1 1:2:3", datetime(2026, 9, 1, 1, 2, 3)),
        ("2026/09/01", datetime(2026, 9, 1)),
        ("2026-03-08T02:30:00", datetime(2026, 3, 8, 2, 30)),
        ("2026", None),
        ("2026-09", None),
        ("now", None),
        (" 2026-09-01 ", None),
        ("2026-09-01T", None),
        ("2026-09-01 10", None),
        ("2026-02-30", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_ts(spark, text, expected):
    assert one(spark, fn.parse_ts, text) == expected


def test_timestamps_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.range(1).select(
            as_ntz("2026-03-08 01:59:30").alias("a"), as_ntz("2026-03-08 03:00:10").alias("b")
        )
        row = df.select(
            fn.minutes_between("a", "b"),
            fn.hours_between("a", "b"),
            fn.days_between("b", "a"),
            fn.elapsed_hours("a", "b"),
            fn.iso_text("b"),
        ).first()
        assert tuple(row) == (61, 2, 0, pytest.approx(1 + 40 / 3600), "2026-03-08T03:00:10")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    ("text", "expected"),
    [("10001", "10001"), (" 10001 ", "10001"), ("10001\n", None), ("1000", None), ("100011", None)],
)
def test_zip(spark, text, expected):
    assert one(spark, fn.clean_zip, text) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [("40.7", 40.7), (" 40.7 ", 40.7), ("40.7d", None), ("40.7F", None), ("0x1p3", None),
     ("1e2", 100.0), ("inf", float("inf")), ("n/a", None), ("", None)],
)
def test_to_double(spark, text, expected):
    assert one(spark, fn.to_double, text) == expected


def test_clean_text_strips_space_separators_only(spark):
    assert one(spark, fn.clean_text, "  　a b\t  ") == "a b\t"


@pytest.mark.parametrize(
    ("text", "family"),
    [("Noise - Street/Sidewalk", "Noise"), ("HEAT/HOT WATER", "Heat / Hot Water"),
     ("Theater", "Heat / Hot Water"), ("Water System", "Water / Sewer"),
     ("Outdoor Dining", "Housing Maintenance"), ("Damaged Tree", "Trees / Parks"),
     ("Something", "Other"), (None, "Other")],
)
def test_complaint_family_first_rule_wins(spark, text, family):
    assert one(spark, fn.complaint_family, text) == family


@pytest.mark.parametrize(
    ("text", "status"),
    [(" closed ", "Closed"), ("started", "In Progress"), ("odd", "Unspecified"), (None, "Unspecified")],
)
def test_status(spark, text, status):
    assert one(spark, fn.normalise_status, text) == status


def test_age_bucket_puts_null_last(spark):
    assert one(spark, fn.age_bucket, None, "double") == "4. > 90 days"
    assert one(spark, fn.age_bucket, 6.99, "double") == "1. 1-7 days"


def test_composite_key_keeps_positions(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    keys = [r[0] for r in df.select(fn.composite_key("x", "y")).collect()]
    assert len(set(keys)) == 2 and all(keys)


def test_day_series_is_closed_and_may_be_empty(spark):
    days = [r[0] for r in day_series(spark, date(2026, 2, 27), date(2026, 3, 1)).collect()]
    assert days == [date(2026, 2, 27), date(2026, 2, 28), date(2026, 3, 1)]
    assert day_series(spark, date(2026, 3, 2), date(2026, 3, 1)).isEmpty()


def test_quantiles_equal_the_built_in(spark):
    df = spark.range(500).select(
        (F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 97 / 4.0).alias("v")
    )
    ranked = ranked_counts(value_counts(df, ["g"], "v"), ["g"], "v")
    ours = ranked.groupBy("g").agg(
        quantile_of_ranked("v", 0.5).alias("m"), quantile_of_ranked("v", 0.9).alias("p")
    )
    theirs = df.groupBy("g").agg(
        F.expr("percentile(v, 0.5)").alias("m"), F.expr("percentile(v, 0.9)").alias("p")
    )
    for a, b in zip(ours.orderBy("g").collect(), theirs.orderBy("g").collect(), strict=True):
        assert a["m"] == pytest.approx(b["m"]) and a["p"] == pytest.approx(b["p"])
