"""Marts kept by signed deltas: retract the old fact rows of a build, add the new ones.

The state of a mart is a table of counts at the grain of the fact's own columns. A build takes the
rows of the requests it touched as they were (-1) and as they are (+1), sums the signs per group and
adds that to the state; what is left at zero goes. The fact itself is not read. A maximum cannot be
retracted, so the backlog keeps counts per age and takes the largest that is left.
"""

from __future__ import annotations

from datetime import datetime, time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.functions import age_bucket, as_ntz, or_unknown
from caseflow.plans.marts import backlog_measures, volume_of_counts

SIGN = "_sign"
VOLUME_GRAIN = ["created_date", "borough", "complaint_type_key", "agency"]
VOLUME_COUNTS = ["n_requests", "n_closed", "n_with_geo"]
BACKLOG_GRAIN = ["agency", "borough", "status", "open_age_days"]
BACKLOG_COUNTS = ["n_open"]


def signed(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """Fact rows with the sign they count by: those of ``old`` are taken back."""
    added = new.withColumn(SIGN, F.lit(1))
    if old is None:
        return added
    return old.withColumn(SIGN, F.lit(-1)).unionByName(added, allowMissingColumns=True)


def _sum_signs(condition: Column | None = None) -> Column:
    sign = F.col(SIGN) if condition is None else F.when(condition, F.col(SIGN)).otherwise(0)
    return F.coalesce(F.sum(sign), F.lit(0)).cast("long")


def volume_delta(rows: DataFrame) -> DataFrame:
    """Changes of the volume counts; requests without a creation time are in no cohort."""
    return (
        rows.filter(F.col("created_date").isNotNull())
        .groupBy(
            "created_date",
            or_unknown("borough").alias("borough"),
            "complaint_type_key",
            F.col("agency_key").alias("agency"),
        )
        .agg(
            _sum_signs().alias("n_requests"),
            _sum_signs(F.col("is_closed")).alias("n_closed"),
            _sum_signs(F.col("has_geo")).alias("n_with_geo"),
        )
    )


def backlog_delta(rows: DataFrame) -> DataFrame:
    """Changes of the counts of open requests per age."""
    return (
        rows.filter(~F.col("is_closed"))
        .groupBy(
            F.col("agency_key").alias("agency"),
            or_unknown("borough").alias("borough"),
            "status",
            "open_age_days",
        )
        .agg(_sum_signs().alias("n_open"))
    )


def folded(state: DataFrame | None, delta: DataFrame, grain: list[str], counts: list[str]) -> DataFrame:
    """The state after a delta. Groups that no request is left in are dropped."""
    both = delta if state is None else state.unionByName(delta)
    sums = both.groupBy(*grain).agg(*[F.sum(c).alias(c) for c in counts])
    return sums.filter(" or ".join(f"{c} <> 0" for c in counts))


def fold_volume(state: DataFrame | None, old: DataFrame | None, new: DataFrame) -> DataFrame:
    return folded(state, volume_delta(signed(old, new)), VOLUME_GRAIN, VOLUME_COUNTS)


def fold_backlog(state: DataFrame | None, old: DataFrame | None, new: DataFrame) -> DataFrame:
    return folded(state, backlog_delta(signed(old, new)), BACKLOG_GRAIN, BACKLOG_COUNTS)


def covered(state: DataFrame, start: datetime | None, fact: DataFrame | None = None) -> DataFrame:
    """The volume counts since the coverage start; none before the first success.

    A start within a day cuts that day's counts: they, and no others, are taken from the fact.
    """
    if start is None:
        return state.limit(0)
    day = F.lit(start.date())
    if start.time() == time.min:
        return state.filter(F.col("created_date") >= day)
    if fact is None:
        raise ValueError("a coverage start within a day needs the fact's rows of that day")
    cut = fact.filter((F.col("created_date") == day) & (F.col("created_at") >= as_ntz(start)))
    return state.filter(F.col("created_date") > day).unionByName(volume_delta(signed(None, cut)))


def volume_of_state(
    state: DataFrame,
    complaint_types: DataFrame,
    calendar: DataFrame,
    start: datetime | None,
    fact: DataFrame | None = None,
) -> DataFrame:
    """The daily-volume mart from its counts."""
    return volume_of_counts(covered(state, start, fact), complaint_types, calendar)


def backlog_of_state(state: DataFrame, as_of) -> DataFrame:
    """The open-backlog mart from its counts."""
    return (
        state.groupBy("agency", "borough", "status", age_bucket("open_age_days").alias("age_bucket"))
        .agg(*backlog_measures(F.col("n_open")))
        .withColumn("as_of", as_ntz(as_of))
    )
