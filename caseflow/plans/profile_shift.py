"""Change detection between landings: distances of binned columns, and of their null rates.

A landing's profile is a row per column and bin with its count. Profiles are small, can be kept per
landing and are compared without the landed rows: each landing with the one before it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseflow.functions import to_double
from caseflow.operators.checks import Policy

NULL_BIN = "(null)"
# The usual bounds of the population stability index: slight change, and large.
SHIFT = Policy(warn_over=0.1, error_over=0.25)
# Half a row per bin, so that a bin that is empty on one side has a finite distance.
SMOOTHING = 0.5
DIGITS = 6


def numeric_bin(value: Column, edges: Sequence[float]) -> Column:
    """The number of ``edges`` at or below a number, as text; null for what is no number."""
    number = to_double(value)
    below = sum((F.when(number >= edge, 1).otherwise(0) for edge in edges), F.lit(0))
    return F.when(number.isNotNull() & ~F.isnan(number), below.cast("string"))


def hashed_bin(value: Column, bins: int = 64) -> Column:
    """One of ``bins`` bins for texts of any number of values."""
    return F.when(value.isNotNull(), F.pmod(F.xxhash64(value), F.lit(bins)).cast("string"))


def profile(rows: DataFrame, landing: Column, bins: Mapping[str, Column]) -> DataFrame:
    """``landing``, ``column``, ``bin`` and ``n``: counts of every landing's bins.

    ``bins`` gives the bin of a row by column; null is a bin of its own. The expressions must have
    few values: see ``numeric_bin`` and ``hashed_bin`` for others. Rows without a landing are left
    out; an empty table has no profiles. One scan, counted before it is shuffled.
    """
    cells = F.array(
        *[
            F.struct(
                F.lit(name).alias("column"),
                F.coalesce(bin_of.cast("string"), F.lit(NULL_BIN)).alias("bin"),
                bin_of.isNull().alias("is_null"),
            )
            for name, bin_of in bins.items()
        ]
    )
    unfolded = rows.select(landing.alias("landing"), F.explode(cells).alias("cell"))
    known = unfolded.filter(F.col("landing").isNotNull()).select("landing", "cell.*")
    # A text that reads like the null bin stays apart from it.
    return known.groupBy("landing", "column", "bin", "is_null").agg(F.count("*").alias("n"))


def neighbours(profiles: DataFrame) -> DataFrame:
    """Every landing with the one before; a row per landing, thin and few."""
    landings = profiles.select("landing").distinct()
    before = F.lag("landing").over(Window.orderBy("landing"))
    return landings.select("landing", before.alias("previous")).filter("previous is not null")


def shifts(profiles: DataFrame, policy: Policy = SHIFT) -> DataFrame:
    """For each landing but the first and each column: the population stability index ``psi`` and the
    ``largest_gap`` between the shares of a bin against the landing before, both null rates, and the
    status of ``psi`` by ``policy``.

    Shares are smoothed over the bins that either landing has. A column that only one of the two
    landings was profiled for is left out: it has nothing to be compared with.
    """
    pairs = neighbours(profiles)
    key = ["landing", "previous", "column", "bin", "is_null"]
    now = profiles.join(pairs, "landing").select(*key, "n", F.lit(0).cast("long").alias("n_before"))
    then = (
        profiles.withColumnsRenamed({"landing": "previous", "n": "n_before"})
        .join(pairs, "previous")
        .select(*key, F.lit(0).cast("long").alias("n"), "n_before")
    )
    cells = now.unionByName(then).groupBy(*key).agg(F.sum("n").alias("n"), F.sum("n_before").alias("n_before"))
    # A window of one pair of landings and one column: as many rows as there are bins.
    column = Window.partitionBy("landing", "previous", "column")
    added = SMOOTHING * F.count("*").over(column)
    cells = cells.select(
        *key,
        "n",
        "n_before",
        F.sum("n").over(column).alias("rows"),
        F.sum("n_before").over(column).alias("rows_before"),
        added.alias("added"),
    ).filter("rows > 0 and rows_before > 0")
    p = (F.col("n") + SMOOTHING) / (F.col("rows") + F.col("added"))
    q = (F.col("n_before") + SMOOTHING) / (F.col("rows_before") + F.col("added"))
    gap = F.abs(F.col("n") / F.col("rows") - F.col("n_before") / F.col("rows_before"))

    def null_rate(n: str, rows: str) -> Column:
        return F.round(F.sum(F.when(F.col("is_null"), F.col(n)).otherwise(0)) / F.max(rows), DIGITS)

    found = cells.groupBy("landing", "previous", "column").agg(
        F.max("rows").alias("n_rows"),
        F.count("*").alias("n_bins"),
        null_rate("n", "rows").alias("null_rate"),
        null_rate("n_before", "rows_before").alias("previous_null_rate"),
        F.round(F.max(gap), DIGITS).alias("largest_gap"),
        # The rounding drops what the order of the additions leaves behind.
        F.round(F.sum((p - q) * F.log(p / q)), DIGITS).alias("psi"),
    )
    return found.withColumn("status", policy.status_column(F.col("psi")))
