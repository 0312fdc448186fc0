import json

import pytest
from conftest import lines, record
from pyspark.sql import functions as F

from caseflow.operators.paging import assign_pages, in_range_order, keyset_page
from caseflow.schema import LANDING_SCHEMA, RAW_COLUMNS
from caseflow.sources.landing import (
    normalise,
    read_lines,
    split_records,
    read_landing,
    unexpected_key_list,
    window_count,
    window_slice,
    write_batch,
)

STAMP = "2026-09-06T00:00:00"


def landed(spark, *records):
    return normalise(lines(spark, records), "run", "batch", STAMP)


def test_fixed_columns_nested_values_and_drift(spark):
    r = record(
        1,
        "2026-09-05T01:00:00.000Z",
        location={"type": "Point", "coordinates": [-73.9, 40.7]},
        brand_new_col="x",
        count=3,
        **{":@computed_region_f5dn_yrer": "7"},
    )
    df = landed(spark, r)
    assert df.columns == RAW_COLUMNS and len(RAW_COLUMNS) == 56
    row = df.first()
    assert row["sys_id"] == "row-0001" and row["closed_date"] is None
    assert json.loads(row["location"]) == {"type": "Point", "coordinates": [-73.9, 40.7]}
    assert json.loads(row["_extra"]) == {"brand_new_col": "x", "count": 3}
    assert row["sys_computed_region_f5dn_yrer"] == "7"
    assert (row["_run_id"], row["_batch_id"], row["_ingested_at"]) == ("run", "batch", STAMP)


def test_no_drift_is_null_and_keys_are_sorted_over_the_run(spark):
    plain = record(1, "2026-09-05T01:00:00Z")
    df = landed(spark, plain, {**plain, "b": 1, "a": None}, {**plain, "b": 2})
    assert [r["_extra"] for r in df.collect()].count(None) == 1
    assert unexpected_key_list(df).first()[0] == ["a", "b"]


def test_a_broken_record_fails_the_job(spark):
    broken = spark.createDataFrame([('{"unique_key": "1",',)], "value string")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        normalise(broken, "run", "batch", STAMP).collect()


ODD = {
    '{"unique_key":"1","x":{"a":1,"a":2}}': True,
    '{"unique_key":"1","location":{"a":1,"a":2}}': True,
    '{"unique_key":"1","unique_key":"2"}': True,
    '{"unique_key":"1"} trailing': True,
    '{"unique_key":"1"} {"unique_key":"2"}': True,
    '{"unique_key":"1"},{"unique_key":"2"}': True,
    '{"unique_key":"1"}]': True,
    '{"unique_key":"1"}],[{"unique_key":"1"}': True,
    '{"unique_key":"1"},"x":{"b":2}': True,
    '{"unique_key":"1"},{"end of line":"1"}] junk': True,
    '{"unique_key":"1"': True,
    '{"unique_key":"1","x":{"a":': True,
    "{'unique_key':'1'}": True,
    '{"latitude":NaN}': True,
    "null": True,
    "[]": True,
    "": True,
    None: True,
    "{}": False,
    ' {"unique_key":"1"}\r\n': False,
    '{"unique_key":"{[","x":"}]"}': False,
    '{"unique_key":1.5,"x":{"y":[1,{"z":null}]}}': False,
    '{"end of line":"x"}': False,
}


def test_odd_lines_never_fail(spark):
    df = spark.createDataFrame([(line,) for line in ODD], "value string")
    rows = read_lines(df).collect()
    assert {r["value"]: r["_broken"] for r in rows} == ODD
    read = {r["value"]: (r["_r"]["unique_key"], r["_extra"]) for r in rows if not r["_broken"]}
    assert read['{"unique_key":"{[","x":"}]"}'] == ("{[", '{"x":"}]"}')
    assert read['{"unique_key":1.5,"x":{"y":[1,{"z":null}]}}'] == ("1.5", '{"x":{"y":[1,{"z":null}]}}')
    assert read['{"end of line":"x"}'] == (None, '{"end of line":"x"}')


def test_a_line_is_parsed_once(spark):
    df = spark.createDataFrame([("{}",)], "value string")
    records, _ = split_records(df)
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 2  # the record, and the members with their types if asked for


def test_landing_is_append_only_and_typed(spark, tmp_path):
    root = str(tmp_path / "raw")
    assert read_landing(spark, root).isEmpty()
    assert read_landing(spark, root, merge_schema=True).schema == LANDING_SCHEMA
    df = landed(spark, record(1, "2026-09-05T01:00:00Z"))
    write_batch(df, root, "2026-09-06", 10)
    write_batch(df.withColumn("added", F.lit("n")), root, "2026-09-07", 10)
    both = read_landing(spark, root)
    assert both.columns == [*RAW_COLUMNS, "ingest_date"] and both.count() == 2
    merged = read_landing(spark, root, merge_schema=True)
    assert {r["added"] for r in merged.collect()} == {None, "n"}


def test_files_roll_over(spark, tmp_path):
    root = str(tmp_path / "raw")
    df = landed(spark, *[record(i, "2026-09-05T01:00:00Z") for i in range(25)]).coalesce(1)
    write_batch(df, root, "2026-09-06", 10)
    files = read_landing(spark, root).select("_metadata.file_path").distinct().count()
    assert files == 3


def test_window_bounds(spark):
    df = landed(
        spark,
        record(1, "2026-09-05T00:00:00.000Z"),
        record(2, "2026-09-05T00:00:01.000Z"),
        record(3, "2026-09-06T00:00:00.000Z"),
        record(4, "2026-09-06T00:00:00.001Z"),
    )
    got = window_slice(df, "2026-09-05T00:00:00", "2026-09-06T00:00:00")
    assert [r["sys_id"] for r in got.collect()] == ["row-0002", "row-0003"]
    assert window_count(df, "2026-09-05T00:00:00", "2026-09-06T00:00:00").first()[0] == 2


def tied(spark):
    updates = ["2026-09-05 01:00:00"] * 20 + [f"2026-09-05 02:00:0{i}" for i in range(5)]
    data = [(u, f"row-{i:04d}") for i, u in enumerate(updates)]
    return spark.createDataFrame(data, "ts string, id string").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz")
    )


def test_keyset_pages_walk_through_ties(spark):
    df, seen, sizes, cursor = tied(spark), [], [], None
    while True:
        page = keyset_page(df, "ts", "id", 7, cursor).collect()
        if not page:
            break
        sizes.append(len(page))
        seen += [r["id"] for r in page]
        last = page[-1]
        cursor = (F.lit(str(last["ts"])).cast("timestamp_ntz"), F.lit(last["id"]))
    assert sizes == [7, 7, 7, 4]
    assert seen == sorted(seen) and len(set(seen)) == 25


@pytest.mark.parametrize("unique", [True, False])
def test_assigned_pages_are_exact_under_ties(spark, uncoalesced, unique):
    paged = assign_pages(tied(spark).repartition(5), "ts", "id", 7, unique).orderBy("row_no")
    got = paged.collect()
    assert [r["row_no"] for r in got] == list(range(25))
    assert [r["id"] for r in got] == [f"row-{i:04d}" for i in range(25)]
    assert [r["page_no"] for r in got] == [i // 7 for i in range(25)]


def test_equal_rows_are_spread_over_range_partitions(spark, uncoalesced):
    df = spark.range(4000).select(F.lit(1).alias("ts"), F.lit("same").alias("id"))
    sizes = in_range_order(df, ["ts", "id"]).groupBy("_pid").count().collect()
    assert len(sizes) > 1 and sum(r["count"] for r in sizes) == 4000
