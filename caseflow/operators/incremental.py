"""Increments, deduplication and upserts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

INGESTED = "_ingested_at"
EPOCH_TEXT = "1900-01-01"


def increment(
    src: DataFrame,
    since: DataFrame | str | None,
    column: str = INGESTED,
    through: str | None = None,
) -> DataFrame:
    """Rows landed after ``since``: a stamp, or a target frame whose newest stamp counts.

    The stamp alone decides, whatever partition a file was landed under; the filter reaches the
    scan, so files and row groups of older stamps are skipped by their statistics. A target frame
    becomes a scalar subquery in it; one that is empty, and ``None``, mean everything.
    """
    stamp = F.col(column)
    if isinstance(since, DataFrame):
        since = since.agg(F.coalesce(F.max(column), F.lit(EPOCH_TEXT)).alias("m")).scalar()
    if since is not None:
        src = src.filter(stamp > since)
    return src if through is None else src.filter(stamp <= through)


def on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join in which null keys equal each other."""
    other = right.select(*[F.col(k).alias(f"_other_{k}") for k in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_other_{k}")) for k in keys])
    return left.join(other, same, how)


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the order.

    The rank limit is applied inside every map task before the shuffle, so a key with very many
    copies sends one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str] = ("unique_key",),
    order: Sequence[str] = ("sys_updated_at", INGESTED, "sys_id"),
) -> DataFrame:
    """The newest version of every key."""
    return first_by(df, keys, [F.col(c).desc_nulls_last() for c in order])


def newest_of_batches(
    df: DataFrame, key: str = "unique_key", order: Sequence[str] = ("sys_updated_at", INGESTED, "sys_id")
) -> DataFrame:
    """What ``latest_per_key`` can drop before a shuffle: of every batch of rows the newest of each key.

    A batch is sorted by its narrow columns only, so no task sorts or spills the rows it reads.
    """
    by = [(key, "ascending"), *[(c, "descending") for c in order]]

    def newest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = pc.sort_indices(batch.select([c for c, _ in by]), by, null_placement="at_end")
                keys = batch.column(key).take(at).dictionary_encode(null_encoding="encode").indices
                changes = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1))
                first = pa.concat_arrays([pa.array([True]), changes])
                yield batch.take(at.filter(first))

    return df.mapInArrow(newest, df.schema)


def first_per_version(
    df: DataFrame,
    keys: Sequence[str] = ("unique_key", "sys_updated_at"),
    order: Sequence[str] = (INGESTED, "sys_id"),
) -> DataFrame:
    """Collapse copies of one version to the copy that landed first."""
    return first_by(df, keys, [F.col(c).asc_nulls_last() for c in order])


def upsert(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete and insert: target rows whose key is in ``new`` are replaced by the new rows.

    Columns only one side has are kept and null on the other side. Null keys equal each other.
    """
    kept = on_keys(target, new, keys, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def merge_latest(
    target: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Upsert in which the newest version wins, so a replayed old version replaces nothing."""
    return latest_per_key(target.unionByName(new, allowMissingColumns=True), keys, order)


def unseen(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The new rows whose key the target does not hold yet."""
    return on_keys(new, target, keys, "left_anti")


def touched(df: DataFrame, changed: DataFrame, key: str = "unique_key") -> DataFrame:
    """All rows of the keys that occur in ``changed``; null is a key like any other."""
    return on_keys(df, changed, [key], "left_semi")
