"""Landings as set sketches: duplicates and overlaps without a distinct over the landing zone.

A landing is summed up once, by theta sketches of its versions, keys and update stamps; it never
changes afterwards. Rates over any choice of landings are unions of these small rows. An estimate
of n is exact up to ``2 ** LOG_ENTRIES`` distinct values and off by ``ERROR`` of n beyond, three
times the standard error. A check whose answer lies within the error says so, and is then to be
decided by the exact one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseflow.operators.checks import PASS, WARN

LOG_ENTRIES = 14
ERROR = 3 / (2**LOG_ENTRIES) ** 0.5
LANDING = "_ingested_at"
KEY, STAMP = "unique_key", "sys_updated_at"


def version_identity() -> Column:
    """Key and stamp as one text in which the border shows; null if either is."""
    return F.concat(F.length(KEY).cast("string"), F.lit(":"), F.col(KEY), F.col(STAMP))


def landing_sketches(raw: DataFrame, landing: str = LANDING) -> DataFrame:
    """``landing, n_rows, versions, keys, stamps``: one row per landing, combined in the map tasks.

    Null keys and stamps are in no set, as in the exact checks.
    """
    sketch = lambda c: F.theta_sketch_agg(c, LOG_ENTRIES)
    return raw.groupBy(F.col(landing).alias("landing")).agg(
        F.count("*").alias("n_rows"),
        sketch(version_identity()).alias("versions"),
        sketch(F.col(KEY)).alias("keys"),
        sketch(F.col(STAMP)).alias("stamps"),
    )


def distinct_of(sketch: str) -> Column:
    """Aggregate: distinct values in the union of a column of sketches."""
    return F.theta_sketch_estimate(F.theta_union_agg(sketch, LOG_ENTRIES))


def duplicate_rate(sketches: DataFrame, limit: float = 0.20) -> DataFrame:
    """Share of landed rows that are further copies of a version, and whether it is sure.

    ``rate_error`` bounds the rate's error; ``decided`` is false when the limit lies within it.
    """
    counts = sketches.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.coalesce(distinct_of("versions"), F.lit(0)).alias("n_versions"),
    )
    n, versions = F.col("n_rows").cast("double"), F.col("n_versions")
    rate = F.when(n > 0, F.greatest(n - versions, F.lit(0.0)) / n).otherwise(0.0)
    error = F.when((n > 0) & (versions > 2**LOG_ENTRIES), ERROR * versions / n).otherwise(0.0)
    return counts.select(
        "*",
        rate.alias("duplicate_rate"),
        error.alias("rate_error"),
        F.when(rate > limit, WARN).otherwise(PASS).alias("status"),
        ((error == 0) | (F.abs(rate - limit) > error)).alias("decided"),
    )


def profile(sketches: DataFrame) -> DataFrame:
    """Rows, versions, requests and distinct update stamps of the landings, all estimates but the rows."""
    return sketches.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        *[
            F.coalesce(distinct_of(c), F.lit(0)).alias(f"n_{c}")
            for c in ("versions", "keys", "stamps")
        ],
    )


def overlaps(sketches: DataFrame) -> DataFrame:
    """``landing, n_rows, n_versions, n_again``: how much of a landing the one before had already.

    Only names of landings are put in order; two neighbours meet in a join.
    """
    order = sketches.select("landing", F.lag("landing").over(Window.orderBy("landing")).alias("before"))
    earlier = sketches.select(F.col("landing").alias("before"), F.col("versions").alias("known"))
    pairs = sketches.join(order, "landing").join(earlier, "before", "left")
    again = F.theta_sketch_estimate(F.theta_intersection("versions", "known"))
    return pairs.select(
        "landing",
        "n_rows",
        F.theta_sketch_estimate("versions").alias("n_versions"),
        F.coalesce(F.when(F.col("known").isNotNull(), again), F.lit(0)).alias("n_again"),
    )
