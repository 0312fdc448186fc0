"""Keyset pages and distributed numbering of a total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseflow.session import materialise

# monotonically_increasing_id(): partition in the upper bits, position in the lower 33.
POSITION_BITS = 33
POSITION_MASK = (1 << POSITION_BITS) - 1


def keyset_page(
    df: DataFrame, ts: str, row_id: str, n: int, cursor: tuple[Column, Column] | None = None
) -> DataFrame:
    """The next ``n`` rows after ``cursor`` in ``(ts, row_id)`` order: stable under ties."""
    if cursor is not None:
        last_ts, last_id = cursor
        df = df.filter(
            (F.col(ts) > last_ts) | ((F.col(ts) == last_ts) & (F.col(row_id) > last_id))
        )
    return df.orderBy(F.col(ts).asc(), F.col(row_id).asc()).limit(n)


def in_range_order(df: DataFrame, order: list[str], unique: bool = False) -> DataFrame:
    """Range-partition, sort and write ``df``; ``_pid`` and ``_pos`` give each row's place.

    The frame is written to the shared folder, so that both passes over it see the same
    partitions even after executors were lost. Range bounds are composite: a value of the first
    column that holds most rows is still split by the next one. Unless the order is ``unique``,
    rows are first given a stored sequence number, so that equal rows can be split as well.
    """
    keys = [F.col(c).asc_nulls_last() for c in order]
    if not unique:
        df = materialise(df.withColumn("_seq", F.monotonically_increasing_id()), "sequence")
        keys.append(F.col("_seq").asc())
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_seq")
    placed = materialise(ranged.withColumn("_place", F.monotonically_increasing_id()), "ranged")
    return placed.withColumns(
        {
            "_pid": F.shiftright("_place", POSITION_BITS),
            "_pos": F.col("_place").bitwiseAND(F.lit(POSITION_MASK)),
        }
    ).drop("_place")


def number_rows(df: DataFrame, order: list[str], name: str, unique: bool = False) -> DataFrame:
    """Add the 0-based position of every row in the order as ``name``, without a global window."""
    placed = in_range_order(df, order, unique)
    counts = placed.groupBy("_pid").agg(F.count("*").alias("n"))
    # One row per partition, so this window and the broadcast stay as small as the task list.
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    return (
        placed.join(F.broadcast(offsets), "_pid")
        .withColumn(name, F.col("_offset") + F.col("_pos"))
        .drop("_pid", "_pos", "_offset")
    )


def assign_pages(
    df: DataFrame, ts: str, row_id: str, n: int, unique: bool = False
) -> DataFrame:
    """Cut the frame into numbered pages of ``n`` rows in ``(ts, row_id)`` order; last one short."""
    numbered = number_rows(df, [ts, row_id], "row_no", unique)
    return numbered.withColumn("page_no", F.floor(F.col("row_no") / F.lit(n)).cast("long"))
