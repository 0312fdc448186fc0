"""The open backlog on any past day, from the validity of the observed versions.

A version holds from its day to the day of the next one; a day counts what holds at its end. The
intervals of open versions are cut at the ages where a bucket ends and into blocks of 1, 2, 4, ...
days that start at multiples of their size: few per interval, however long it is. Blocks are counted
per group before they meet the days that lie in them, by equality of block and size: no condition
on a range is left in the join, and no row is repeated per day.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.functions import normalise_status
from caseflow.functions.rules import AGE_BUCKETS, OLDEST_BUCKET

OPEN_END = 1 << 30


def validity(history: DataFrame) -> DataFrame:
    """Every version with the days ``[first_day, end_day)`` at whose end it holds.

    The next version is found by its number, so the versions of one key, however many, are spread.
    A version without a time holds nowhere, and so does one that is followed within its day. The
    last version holds on. Null is a key like any other.
    """
    following = history.select(
        F.col("unique_key").alias("_key"),
        (F.col("version_no") - 1).alias("_no"),
        F.unix_date(F.to_date("source_updated_at")).alias("_until"),
    )
    same = F.col("unique_key").eqNullSafe(F.col("_key")) & (F.col("version_no") == F.col("_no"))
    return (
        history.filter(F.col("source_updated_at").isNotNull())
        .join(following, same, "left")
        .withColumns(
            {
                "first_day": F.unix_date(F.to_date("source_updated_at")),
                "end_day": F.coalesce("_until", F.lit(OPEN_END)),
            }
        )
        .filter("first_day < end_day")
        .drop("_key", "_no", "_until")
    )


def _by_age(first: Column, end: Column, created: Column) -> Column:
    """The days of an interval by age bucket; a null age is the oldest, one below zero the youngest."""
    bounds = [*[b for b, _ in AGE_BUCKETS], None]
    labels = [*[label for _, label in AGE_BUCKETS], OLDEST_BUCKET]
    parts, low = [], None
    for bound, label in zip(bounds, labels, strict=True):
        lower = first if low is None else F.greatest(first, created + low)
        upper = end if bound is None else F.least(end, created + bound)
        # greatest and least skip nulls: without a creation only the last bucket is left.
        known = F.lit(True) if bound is None else created.isNotNull()
        parts.append(
            F.when(
                known & (lower < upper),
                F.struct(lower.alias("first"), upper.alias("end"), F.lit(label).alias("age_bucket")),
            )
        )
        low = bound
    return F.array_compact(F.array(*parts))


def _blocks(first: Column, end: Column, levels: int) -> Column:
    """The days ``[first, end)`` from zero as blocks ``(level, block)``: at most two of each size.

    At a level, an odd block at either side is no half of a larger one that fits, so it stands
    here; the rest is left to the next level. The top level takes all that is left.
    """
    none = F.array().cast("array<int>")

    def placed(level: int, blocks: Column) -> Column:
        at = F.coalesce(blocks, none)
        return F.transform(at, lambda b: F.struct(F.lit(level).alias("level"), b.alias("block")))

    found = []
    for level in range(levels):
        size = 1 << level
        low = F.floor((first + (size - 1)) / size).cast("int")
        high = F.floor(end / size).cast("int")
        some = low < high
        if level == levels - 1:
            found.append(placed(level, F.when(some, F.sequence(low, high - 1))))
        else:
            found.append(placed(level, F.when(some & (low % 2 == 1), F.array(low))))
            found.append(placed(level, F.when(some & (high % 2 == 1), F.array(high - 1))))
    return F.flatten(F.array(*found))


def backlog_on(history: DataFrame, created: DataFrame, dates: DataFrame) -> DataFrame:
    """``on_date, agency, status, age_bucket, n_open`` at the end of every day of ``dates``.

    ``history`` are the numbered versions (E6), ``created`` gives ``unique_key, created_date`` of
    the requests, ``dates`` a column ``on_date`` (repeats and null count once and not at all).
    Requests unknown to ``created`` have no age and are in the last bucket.
    """
    days = dates.select(F.col("on_date").cast("date").alias("on_date")).dropna().distinct()
    bounds = days.agg(F.min("on_date").alias("a"), F.max("on_date").alias("b")).first()
    first = bounds["a"] or date(1970, 1, 1)
    span = (bounds["b"] - first).days + 1 if bounds["a"] else 1
    levels = span.bit_length()
    zero = F.unix_date(F.lit(first))

    # Numbering keeps one row of a key here, so the join repeats nothing.
    births = created.select(F.col("unique_key").alias("_born"), "created_date")
    versions = validity(history).withColumn("status", normalise_status("status"))
    versions = versions.filter(F.col("status") != "Closed")
    dated = versions.join(births, F.col("unique_key").eqNullSafe(F.col("_born")), "left").select(
        "agency",
        "status",
        F.greatest(F.col("first_day") - zero, F.lit(0)).alias("f"),
        F.least(F.col("end_day") - zero, F.lit(span)).alias("e"),
        (F.unix_date("created_date") - zero).alias("c"),
    )
    aged = dated.filter("f < e").select(
        "agency", "status", F.inline(_by_age(F.col("f"), F.col("e"), F.col("c")))
    )
    counts = (
        aged.select("agency", "status", "age_bucket", F.inline(_blocks(F.col("first"), F.col("end"), levels)))
        .groupBy("level", "block", "agency", "status", "age_bucket")
        .agg(F.count("*").alias("n"))
    )
    day = (F.unix_date("on_date") - zero).alias("day")
    lies_in = F.transform(
        F.sequence(F.lit(0), F.lit(levels - 1)),
        lambda level: F.struct(
            level.alias("level"), F.call_function("shiftright", F.col("day"), level).alias("block")
        ),
    )
    places = days.select("on_date", day).select("on_date", F.inline(lies_in))
    return (
        places.join(counts, ["level", "block"])
        .groupBy("on_date", "agency", "status", "age_bucket")
        .agg(F.sum("n").alias("n_open"))
    )
