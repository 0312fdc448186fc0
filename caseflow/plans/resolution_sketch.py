"""Time to resolution from mergeable state: a KLL sketch per creation week, agency and build.

Every build adds the sketches of the durations it has seen first, and nothing is rescanned to merge
them. A sketch cannot forget, so a group in which a counted duration has changed or gone is drawn
anew from the fact, for that group alone; its row ``resets`` what earlier builds said of the group.
Counts, sums and the share within a day are exact; quantiles are off by ``RANK_ERROR`` at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseflow.functions.dates import week_start
from caseflow.operators.incremental import on_keys
from caseflow.operators.quantiles import round1
from caseflow.plans.marts import created_in_coverage
from caseflow.session import materialise

KEYS = ["week_start", "agency"]
K = 800
# Three times the normalised rank error of one quantile at this K, which holds for 99 in 100.
RANK_ERROR = 0.012
DAY = 24 * 60
EMPTY = {"n_closed": 0, "minutes": 0, "n_within_24h": 0}


def durations(fact: DataFrame, runs: DataFrame) -> DataFrame:
    """``unique_key, week_start, agency, minutes`` of the requests that time to resolution counts."""
    closed = created_in_coverage(fact, runs).filter(
        F.col("is_closed") & F.col("hours_to_close").isNotNull() & F.col("agency_key").isNotNull()
    )
    return closed.select(
        "unique_key",
        week_start("created_date").alias("week_start"),
        F.col("agency_key").alias("agency"),
        F.round(F.col("hours_to_close") * 60).cast("long").alias("minutes"),
    )


def sketched(rows: DataFrame, build: int, resets: bool = False) -> DataFrame:
    """One row of state per group of ``rows``; sketches combine in the map tasks."""
    return (
        rows.groupBy(*KEYS)
        .agg(
            F.kll_sketch_agg_bigint("minutes", K).alias("sketch"),
            F.count("*").alias("n_closed"),
            F.sum("minutes").alias("minutes"),
            F.count_if(F.col("minutes") <= DAY).alias("n_within_24h"),
        )
        .withColumns({"resets": F.lit(resets), "build": F.lit(build)})
    )


def next_state(before: DataFrame, after: DataFrame, current: DataFrame, build: int) -> DataFrame:
    """The rows a build adds to the state.

    ``before`` and ``after`` are the durations of the requests it touched, as they were counted and
    as they are now; ``current`` those of the whole fact, of which only the groups that lost
    something are read. Null keys equal each other.
    """
    same = ["unique_key", *KEYS, "minutes"]
    # Written, as its inputs would be computed again for each of its uses.
    lost = materialise(on_keys(before, after, same, "left_anti").select(*KEYS).distinct(), "lost")
    fresh = on_keys(on_keys(after, before, same, "left_anti"), lost, KEYS, "left_anti")
    drawn = sketched(on_keys(current, lost, KEYS, "left_semi"), build, resets=True)
    # A group that has lost its last request is reset to nothing.
    anew = lost.join(drawn.drop("resets", "build"), KEYS, "left")
    anew = anew.fillna(EMPTY).withColumns({"resets": F.lit(True), "build": F.lit(build)})
    return sketched(fresh, build).unionByName(anew)


def merged(state: DataFrame) -> DataFrame:
    """One row per group: the sketches since its last reset in one. Groups of no request are gone."""
    # As many rows in a group as there are builds.
    last = F.max(F.when(F.col("resets"), F.col("build"))).over(Window.partitionBy(*KEYS))
    valid = state.withColumn("_last", last).filter("_last is null or build >= _last")
    return (
        valid.groupBy(*KEYS)
        .agg(
            F.kll_merge_agg_bigint("sketch", K).alias("sketch"),
            *[F.sum(c).alias(c) for c in EMPTY],
        )
        .filter("n_closed > 0")
    )


def compacted(state: DataFrame, build: int) -> DataFrame:
    """The whole state as the rows of one build, so that many small builds need not be merged again."""
    return merged(state).withColumns({"resets": F.lit(True), "build": F.lit(build)})


def resolution_of_sketches(state: DataFrame, agencies: DataFrame) -> DataFrame:
    """The columns of the exact mart, from the state alone."""

    def hours(p: float):
        return round1(F.kll_sketch_get_quantile_bigint("sketch", F.lit(p)) / F.lit(60.0))

    n = F.col("n_closed")
    stats = merged(state).select(
        *KEYS,
        "n_closed",
        hours(0.5).alias("median_hours_to_close"),
        hours(0.9).alias("p90_hours_to_close"),
        round1(F.col("minutes") / (F.lit(60.0) * n)).alias("mean_hours_to_close"),
        (F.col("n_within_24h") / n.cast("double")).alias("share_closed_within_24h"),
    )
    names = agencies.select(F.col("agency_key").alias("agency"), "agency_name")
    return stats.join(names, "agency").select(
        *KEYS,
        "agency_name",
        "n_closed",
        "median_hours_to_close",
        "p90_hours_to_close",
        "mean_hours_to_close",
        "share_closed_within_24h",
    )


def rank_errors(state: DataFrame, rows: DataFrame, quantiles: tuple[float, ...] = (0.5, 0.9)) -> DataFrame:
    """Per group and quantile how far the sketch's value is off in rank, against the durations."""
    asked = merged(state).select(
        *KEYS,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(p).alias("quantile"),
                        F.kll_sketch_get_quantile_bigint("sketch", F.lit(p)).alias("value"),
                    )
                    for p in quantiles
                ]
            )
        ),
    )
    counts = rows.groupBy(*KEYS, "minutes").agg(F.count("*").alias("n"))
    n = F.sum("n").cast("double")
    ranks = (
        asked.join(counts, KEYS)
        .groupBy(*KEYS, "quantile")
        .agg(
            (F.sum(F.when(F.col("minutes") < F.col("value"), F.col("n")).otherwise(0)) / n).alias("below"),
            (F.sum(F.when(F.col("minutes") <= F.col("value"), F.col("n")).otherwise(0)) / n).alias("upto"),
        )
    )
    p = F.col("quantile")
    off = F.greatest(F.lit(0.0), F.col("below") - p, p - F.col("upto"))
    return ranks.select(*KEYS, "quantile", off.alias("rank_error"))
