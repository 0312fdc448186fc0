"""Time to close with open requests counted as censored: Kaplan-Meier over counts per duration.

Time to resolution leaves out what is still open, and so makes slow agencies look fast. Here an open
request says that it took longer than its age. Requests are counted per agency and duration first
(whole minutes), so a curve is a running product over distinct durations, however many requests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseflow.plans.marts import created_in_coverage

DAY = 24 * 60
HORIZONS = (1, 7, 30, 90)


def durations(fact: DataFrame, runs: DataFrame) -> DataFrame:
    """``agency, minutes, n_closed, n_open``: requests of complete cohorts by how long they took, or
    have taken so far. A request without a usable duration, or of no agency, is left out."""
    rows = created_in_coverage(fact, runs).filter(F.col("agency_key").isNotNull())
    closed = F.col("is_closed") & F.col("hours_to_close").isNotNull()
    still_open = ~F.col("is_closed") & (F.col("open_age_days") >= 0)
    minutes = F.when(closed, F.round(F.col("hours_to_close") * 60)).when(
        still_open, F.round(F.col("open_age_days") * DAY)
    )
    timed = rows.select(F.col("agency_key").alias("agency"), minutes.cast("long").alias("minutes"), "is_closed")
    return (
        timed.filter("minutes is not null")
        .groupBy("agency", "minutes")
        .agg(
            F.count_if(F.col("is_closed")).alias("n_closed"),
            F.count_if(~F.col("is_closed")).alias("n_open"),
        )
    )


def survival_curve(counts: DataFrame) -> DataFrame:
    """Add ``n_at_risk`` (took at least as long) and ``share_open`` (open beyond that duration)."""
    upward = Window.partitionBy("agency").orderBy("minutes")
    everything = upward.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = upward.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Not a sum over the rows that follow: Spark adds those up anew for every row.
    n = F.col("n_closed") + F.col("n_open")
    at_risk = counts.withColumn("n_at_risk", F.sum(n).over(everything) - F.sum(n).over(upto) + n)
    stays = F.lit(1.0) - F.col("n_closed") / F.col("n_at_risk")
    return at_risk.withColumn("share_open", F.product(stays).over(upto))


def close_survival(counts: DataFrame) -> DataFrame:
    """One row per agency: closed and open requests, the share still open after some days, and the
    median time to close in hours (null while over half are open beyond every duration seen).

    After the longest duration seen of an agency its share stays what it was there.
    """
    curve = survival_curve(counts)

    def open_after(days: int) -> Column:
        # Shares only fall, so the last one within the horizon is the smallest.
        least = F.min(F.when(F.col("minutes") <= days * DAY, F.col("share_open")))
        return F.round(F.coalesce(least, F.lit(1.0)), 9).alias(f"share_open_after_{days}d")

    median = F.min(F.when(F.col("share_open") <= 0.5, F.col("minutes"))) / F.lit(60.0)
    return curve.groupBy("agency").agg(
        F.sum("n_closed").alias("n_closed"),
        F.sum("n_open").alias("n_open"),
        *map(open_after, HORIZONS),
        F.round(median, 6).alias("median_hours_to_close"),
    )
