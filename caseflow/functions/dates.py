"""Zone-free timestamps: parsing, boundary counts and calendar parts.

Everything works on TIMESTAMP_NTZ and DATE, never through the session time zone, so a daylight
saving gap in the cluster's zone cannot move a value.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseflow.functions.text import ColumnLike, column

# What the source sends: a full date, then optionally hour:minute[:second[.fraction]][offset].
TIMESTAMP_TEXT = (
    r"^\d{4}-\d{1,2}-\d{1,2}([T ]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d*)?)?([+-]\d{2}:\d{2})? *)?\z"
)
# Rarer spellings: one other separator throughout, more blanks, short offsets, UTC, midnight as 24.
RARE_TEXT = (
    r"^ *(\d{4})([-/ \\])(\d{1,2})\2(\d{1,2})"
    r"(?:(?:T| +)(\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d*)?)?)(?: ?[+-]\d{2}(?::?\d{2})?| +(?i:utc))? *)?\z"
)
MIDNIGHT = r" 24:00(:00(\.0*)?)?\z"


def parse_ts(c: ColumnLike) -> Column:
    """Naive timestamp from source text, every ``Z`` and offset dropped; null where it does not parse.

    The guards refuse the spellings only Spark reads: a bare year or month, ``now``, padding.
    """
    text = F.translate(column(c), "Z", "")
    rare = F.regexp_replace(text, RARE_TEXT, "$1-$3-$4 $5")
    midnight = F.regexp_replace(rare, MIDNIGHT, "").try_cast("timestamp_ntz")
    return (
        F.when(text.rlike(TIMESTAMP_TEXT) & ~text.contains("24:00"), text.try_cast("timestamp_ntz"))
        .when(
            text.rlike(RARE_TEXT),
            F.when(rare.rlike(MIDNIGHT), midnight + F.expr("interval 1 day")).otherwise(
                rare.try_cast("timestamp_ntz")
            ),
        )
    )


def as_ntz(value: Column | datetime | date | str) -> Column:
    """A naive timestamp column from a column, a Python value or ISO text."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            raise ValueError("pass a naive timestamp: the clock of as_of is the caller's choice")
        value = value.isoformat(sep=" ")
    return F.lit(str(value).replace("T", " ")).cast("timestamp_ntz")


def iso_text(c: ColumnLike) -> Column:
    """``2026-09-01T10:00:00[.ffffff]``; the cast keeps naive timestamps zone-free."""
    return F.translate(column(c).cast("timestamp_ntz").cast("string"), " ", "T")


def days_between(start: ColumnLike, end: ColumnLike) -> Column:
    """Day boundaries crossed from start to end (negative backwards)."""
    return F.datediff(column(end), column(start)).cast("long")


def hours_between(start: ColumnLike, end: ColumnLike) -> Column:
    """Hour boundaries crossed: 10:59 to 11:00 counts one."""
    start, end = column(start), column(end)
    return days_between(start, end) * 24 + (F.hour(end) - F.hour(start))


def minutes_between(start: ColumnLike, end: ColumnLike) -> Column:
    """Minute boundaries crossed: 10:00:59 to 10:01:00 counts one."""
    start, end = column(start), column(end)
    return hours_between(start, end) * 60 + (F.minute(end) - F.minute(start))


def elapsed_hours(start: ColumnLike, end: ColumnLike) -> Column:
    """Real elapsed hours, with fraction."""
    start, end = column(start), column(end)
    gap = end - start
    return (
        F.extract(F.lit("DAY"), gap).cast("double") * 24
        + F.extract(F.lit("HOUR"), gap).cast("double")
        + F.extract(F.lit("MINUTE"), gap).cast("double") / 60
        + F.extract(F.lit("SECOND"), gap).cast("double") / 3600
    )


def week_start(c: ColumnLike) -> Column:
    """Monday of the week, as a date."""
    day = F.to_date(column(c))
    return F.date_sub(day, F.weekday(day))


def date_parts(c: ColumnLike) -> dict[str, Column]:
    """Calendar attributes of a date; day_of_week counts from 0 = Sunday."""
    day = column(c)
    sunday_based = F.dayofweek(day) - 1
    return {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "year_month": F.date_format(day, "yyyy-MM"),
        "iso_week": F.weekofyear(day),
        "week_start": week_start(day),
        "day_of_week": sunday_based,
        "day_name": F.date_format(day, "E"),
        "is_weekend": sunday_based.isin(0, 6),
    }
