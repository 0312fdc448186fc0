"""Exact quantiles per group without holding a group in memory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def round1(c: Column) -> Column:
    """One decimal, halves away from zero, on the scaled double (not on its decimal spelling)."""
    return F.round(c * F.lit(10.0), 0) / F.lit(10.0)


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Occurrences per group and value: combined in the map tasks, so repeated values cost little."""
    return df.groupBy(*keys, value).agg(F.count("*").alias("_n"))


def ranked_counts(counts: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Add the running count ``_upto`` and the group's ``_total``; streams through one sort."""
    w = Window.partitionBy(*keys).orderBy(value)
    everything = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    up_to_here = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumns(
        {"_upto": F.sum("_n").over(up_to_here), "_total": F.sum("_n").over(everything)}
    )


def quantile_of_ranked(value: str, p: float) -> Column:
    """Aggregate over ranked counts: the interpolated quantile (``percentile_cont``)."""
    rank = F.lit(float(p)) * (F.col("_total") - 1)

    def at(index: Column) -> Column:
        hit = (F.col("_upto") > index) & (F.col("_upto") - F.col("_n") <= index)
        return F.max(F.when(hit, F.col(value)))

    low, high = at(F.floor(rank)), at(F.ceil(rank))
    share = F.max(rank - F.floor(rank))
    return low * (F.lit(1.0) - share) + high * share
