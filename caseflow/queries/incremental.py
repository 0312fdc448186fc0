"""Increments, dedupe, upserts: as frames and as stored tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from caseflow.operators import incremental as inc
from caseflow.operators.sequence import number_versions
from caseflow.plans import build as b
from caseflow.plans.store import Warehouse
from caseflow.queries import tables as t
from caseflow.schema import Settings
from caseflow.session import materialise, scratch_path
from caseflow.sources.landing import fixed_columns, write_batch
from caseflow.streaming.landing_stream import run_available

CUT = "2024-01-20T00:00:00"
SMALL = Settings(buckets=8)
# Two landings of the requests that overlap in lines 3 and 4.
FIRST, SECOND = "sys_version <= 'v4'", "sys_version >= 'v3'"


def log(spark, sf_dir):
    return t.event_versions(spark, sf_dir)


def from_log(select: str) -> str:
    return t.with_ctes(select, t.EVENT_VERSIONS_SQL)


def d1(spark, sf_dir):
    rows = log(spark, sf_dir)
    target = rows.filter(F.col("_ingested_at") <= CUT)
    return inc.increment(rows, target)


def d2(spark, sf_dir):
    return inc.latest_per_key(log(spark, sf_dir))


D2_SQL = from_log(
    """select unique_key, max(sys_updated_at) as sys_updated_at,
    arg_max(sys_id, (sys_updated_at, _ingested_at, sys_id)) as sys_id,
    arg_max(status, (sys_updated_at, _ingested_at, sys_id)) as status,
    arg_max(_extra, (sys_updated_at, _ingested_at, sys_id)) as _extra,
    arg_max(_ingested_at, (sys_updated_at, _ingested_at, sys_id)) as _ingested_at
    from log group by unique_key"""
)


def d2_lines(spark, sf_dir):
    """Dedupe line items on their natural key, all other columns breaking ties."""
    li = t.table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    return inc.latest_per_key(li, keys, [c for c in li.columns if c not in keys])


D2_LINES_SQL = """
select distinct on (l_orderkey, l_linenumber) * from lineitem
order by l_orderkey, l_linenumber, l_partkey desc, l_suppkey desc, l_quantity desc,
    l_extendedprice desc, l_discount desc, l_tax desc, l_returnflag desc, l_linestatus desc,
    l_shipdate desc"""


def d3(spark, sf_dir):
    return inc.first_per_version(log(spark, sf_dir))


D3_SQL = from_log(
    """select distinct on (unique_key, sys_updated_at) * from log
    order by unique_key, sys_updated_at, _ingested_at, sys_id"""
)


def halves(spark, sf_dir):
    rows = log(spark, sf_dir)
    early = inc.latest_per_key(rows.filter(F.col("_ingested_at") <= CUT))
    late = inc.latest_per_key(rows.filter(F.col("_ingested_at") > CUT))
    return early, late


def d4(spark, sf_dir):
    early, late = halves(spark, sf_dir)
    return inc.upsert(early, late, ["unique_key"])


D4_SQL = from_log(
    f"""select distinct on (unique_key) * from log order by unique_key, _ingested_at > '{CUT}' desc,
    sys_updated_at desc, _ingested_at desc, sys_id desc"""
)


def d4_newest(spark, sf_dir):
    """Replay the old half over the new one: nothing changes."""
    early, late = halves(spark, sf_dir)
    order = ["sys_updated_at", "_ingested_at", "sys_id"]
    return inc.merge_latest(late, early, ["unique_key"], order)


def d5(spark, sf_dir):
    rows = log(spark, sf_dir)
    keys = ["unique_key", "sys_updated_at"]
    early = inc.first_per_version(rows.filter(F.col("_ingested_at") <= CUT))
    late = inc.first_per_version(rows.filter(F.col("_ingested_at") > CUT))
    return inc.upsert(early, late, keys)


D5_SQL = from_log(
    f"""select distinct on (unique_key, sys_updated_at) * from log
    order by unique_key, sys_updated_at, _ingested_at > '{CUT}' desc, _ingested_at"""
)


def d6(spark, sf_dir):
    early, late = halves(spark, sf_dir)
    return inc.upsert(early.drop("_extra"), late, ["unique_key"])


D6_SQL = from_log(
    f"""select * replace (case when _ingested_at > '{CUT}' then _extra end as _extra) from (
    select distinct on (unique_key) * from log order by unique_key, _ingested_at > '{CUT}' desc,
    sys_updated_at desc, _ingested_at desc, sys_id desc)"""
)


def d7(spark, sf_dir):
    """Sequences of the requests with a version landed after the cut."""
    rows = inc.first_per_version(log(spark, sf_dir))
    changed = rows.filter(F.col("_ingested_at") > CUT).select("unique_key").distinct()
    seq = inc.touched(rows, changed).withColumn(
        "source_updated_at", F.translate("sys_updated_at", "Z", "").cast("timestamp_ntz")
    )
    return number_versions(seq, "unique_key").select(
        "unique_key", "sys_updated_at", "version_no", "previous_status"
    )


D7_SQL = from_log(
    f"""select unique_key, sys_updated_at, row_number() over w as version_no,
    lag(status) over w as previous_status
    from (select distinct on (unique_key, sys_updated_at) * from log
          order by unique_key, sys_updated_at, _ingested_at)
    where unique_key in (
        select unique_key from log group by unique_key, sys_updated_at
        having min(_ingested_at) > '{CUT}')
    window w as (partition by unique_key order by sys_updated_at)"""
)


def late_partition(spark, sf_dir):
    """The log landed under the day before its stamp, as by a run that began before midnight."""
    root = scratch_path(spark, "landing")
    day = F.date_sub(F.substring("_ingested_at", 1, 10).cast("date"), 2)
    log(spark, sf_dir).withColumn("ingest_date", day).write.partitionBy("ingest_date").parquet(root)
    return spark.read.parquet(root).drop("ingest_date")


def d1_partitions(spark, sf_dir):
    """The stamp alone decides, whatever partition a file lies in."""
    return inc.increment(late_partition(spark, sf_dir), CUT)


def d5_replayed(spark, sf_dir):
    """Stored versions after a replay: users divisible by 7 have lost their key, every fifth
    event its stamp, and null is a value like any other."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"), SMALL)
    rows = log(spark, sf_dir).withColumns(
        {
            "unique_key": F.when(F.col("unique_key").cast("int") % 7 != 0, F.col("unique_key")),
            "sys_updated_at": F.when(F.col("sys_id").cast("int") % 5 != 0, F.col("sys_updated_at")),
        }
    )
    keys = ["unique_key", "sys_updated_at"]
    for part in (rows.filter(F.col("_ingested_at") <= CUT), rows, rows):
        new = inc.first_per_version(part)
        wh.append_unseen(b.VERSIONS, new, keys, None)
    return wh.read(b.VERSIONS).groupBy(*keys).agg(F.count("*").alias("n"))


D5_REPLAYED_SQL = from_log(
    """select case when unique_key::int % 7 <> 0 then unique_key end as unique_key,
    case when sys_id::int % 5 <> 0 then sys_updated_at end as sys_updated_at, 1::bigint as n
    from log group by 1, 2"""
)


def d11_same_stamp(spark, sf_dir):
    """Two micro-batches of one stamp with a core and mart build after each."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"), SMALL)
    raw = fixed_columns(t.raw_requests(spark, sf_dir))
    stamped = raw.withColumn("_ingested_at", F.lit("2001-12-01T00:00:00"))
    as_of = datetime.fromisoformat(t.REQUESTS_AS_OF)
    checkpoint = scratch_path(spark, "stream")
    for number in (0, 1):
        half = F.pmod(F.xxhash64("unique_key"), F.lit(2)) == number
        write_batch(stamped.filter(half), wh.raw_path, "2001-12-01", 1_000_000)
        run_available(wh, as_of, checkpoint)
        b.build_core(wh, as_of)
        b.build_marts(wh, as_of)
    return wh.read(b.AGENCIES)


def d9(spark, sf_dir):
    return t.requests(spark, sf_dir)


def d10(spark, sf_dir):
    return t.versions(spark, sf_dir)


def built(spark, sf_dir) -> Warehouse:
    """Land and build the requests in two overlapping batches."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"), SMALL)
    raw = fixed_columns(t.raw_requests(spark, sf_dir))
    for part in (FIRST, SECOND):
        batch = materialise(raw.filter(part), "landed")
        b.build_requests(wh, batch)
        b.build_versions(wh, batch)
        keys = batch.select("unique_key").distinct()
        b.build_fact(wh, t.REQUESTS_AS_OF, keys)
        b.build_history(wh, keys)
    return wh


def d4_stored(spark, sf_dir):
    return built(spark, sf_dir).read(b.REQUESTS)


def d5_stored(spark, sf_dir):
    versions = built(spark, sf_dir).read(b.VERSIONS)
    return versions.select("unique_key", "sys_updated_at", "source_updated_at")


def d7_stored(spark, sf_dir):
    history = built(spark, sf_dir).read(b.HISTORY)
    return history.select("unique_key", "sys_updated_at", "version_no", "previous_updated_at")


def d8(spark, sf_dir):
    """Replace a table twice; only the last content remains."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"), SMALL)
    agencies = t.agencies(spark, sf_dir)
    wh.replace(b.AGENCIES, agencies.withColumn("n_requests_seen", F.lit(0).cast("long")))
    wh.replace(b.AGENCIES, agencies)
    return wh.read(b.AGENCIES)


def d11(spark, sf_dir):
    """The same landings as a stream of files; the fact must equal the batch fact."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"), SMALL)
    raw = fixed_columns(t.raw_requests(spark, sf_dir))
    write_batch(raw.filter(FIRST), wh.raw_path, "2001-12-01", 1_000_000)
    checkpoint = scratch_path(spark, "stream")
    run_available(wh, t.REQUESTS_AS_OF, checkpoint)
    write_batch(raw.filter(SECOND), wh.raw_path, "2001-12-02", 1_000_000)
    run_available(wh, t.REQUESTS_AS_OF, checkpoint)
    return wh.read(b.FACT)


def d12(spark, sf_dir):
    """Column descriptions travel with the stored table."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"), SMALL)
    staged = b.documented(t.requests(spark, sf_dir), b.REQUEST_COMMENTS)
    wh.create(b.REQUESTS, staged, None)
    stored = spark.read.parquet(wh.path(wh.build_mark(b.REQUESTS)["path"]))
    comment = stored.schema["status"].metadata["comment"]
    return stored.groupBy("status").agg(F.count("*").alias("n")).withColumn(
        "comment", F.lit(comment)
    )


D12_SQL = t.over_staged(
    """select status, count(*) as n,
    'One of the listed states, Unspecified for any other spelling.' as comment
    from requests group by all"""
)

QUERIES = {
    "d1_increment": (d1, from_log(f"select * from log where _ingested_at > '{CUT}'")),
    "d2_latest_per_key": (d2, D2_SQL),
    "d2_latest_line_items": (d2_lines, D2_LINES_SQL),
    "d3_first_per_version": (d3, D3_SQL),
    "d4_upsert": (d4, D4_SQL),
    "d4_merge_latest": (d4_newest, D2_SQL),
    "d4_upsert_stored": (d4_stored, t.over_staged("select * from requests")),
    "d1_increment_pruned": (d1_partitions, from_log(f"select * from log where _ingested_at > '{CUT}'")),
    "d5_replayed": (d5_replayed, D5_REPLAYED_SQL),
    "d11_same_stamp": (d11_same_stamp, t.over_core("select * from agencies")),
    "d5_upsert_versions": (d5, D5_SQL),
    "d5_versions_stored": (
        d5_stored,
        t.over_versions("select unique_key, sys_updated_at, source_updated_at from versions"),
    ),
    "d6_append_new_columns": (d6, D6_SQL),
    "d7_touched_keys": (d7, D7_SQL),
    "d7_history_stored": (
        d7_stored,
        t.over_history(
            "select unique_key, sys_updated_at, version_no, previous_updated_at from history"
        ),
    ),
    "d8_full_rebuild": (d8, t.over_core("select * from agencies")),
    "d9_staged_requests": (d9, t.over_staged("select * from requests")),
    "d10_staged_versions": (d10, t.over_versions("select * from versions")),
    "d11_stream": (d11, t.over_core("select * from fact")),
    "d12_document": (d12, D12_SQL),
}
