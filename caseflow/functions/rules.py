"""Business rules held as data: status names, complaint families, age buckets, freshness."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseflow.functions.text import ColumnLike, clean_code, column

# Boroughs on the allow-list.
BOROUGHS = ["BRONX", "BROOKLYN", "MANHATTAN", "QUEENS", "STATEN ISLAND"]

# Normalised status names.
STATUSES = ["Closed", "Open", "In Progress", "Assigned", "Pending", "Unspecified"]

# Source spelling (upper case) to normalised status.
STATUS_NAMES = {
    "CLOSED": "Closed",
    "OPEN": "Open",
    "IN PROGRESS": "In Progress",
    "STARTED": "In Progress",
    "ASSIGNED": "Assigned",
    "PENDING": "Pending",
}

# Complaint families and their case-insensitive LIKE patterns; the first hit wins.
COMPLAINT_FAMILIES = [
    ("Noise", ["noise%"]),
    ("Heat / Hot Water", ["%heat%", "%hot water%"]),
    ("Parking / Vehicles", ["%parking%", "%vehicle%"]),
    ("Water / Sewer", ["%water%", "%sewer%"]),
    ("Street / Sidewalk", ["%street%", "%sidewalk%"]),
    ("Sanitation", ["%sanitation%", "%dirty%", "%litter%", "%graffiti%"]),
    ("Pests / Unsanitary", ["%unsanitary%", "%rodent%", "%pest%"]),
    ("Housing Maintenance", ["%plumbing%", "%paint%", "%door%", "%electric%"]),
    ("Homeless Assistance", ["%homeless%", "%encampment%"]),
    ("Trees / Parks", ["%tree%"]),
]
OTHER_FAMILY = "Other"

# Upper bounds in days of the age buckets; anything else, null too, is the last.
AGE_BUCKETS = [
    (1, "0. < 1 day"),
    (7, "1. 1-7 days"),
    (30, "2. 7-30 days"),
    (90, "3. 30-90 days"),
]
OLDEST_BUCKET = "4. > 90 days"


def normalise_status(c: ColumnLike) -> Column:
    code = clean_code(c)
    chain: Column | None = None
    for spelling, name in STATUS_NAMES.items():
        hit = code == spelling
        chain = F.when(hit, name) if chain is None else chain.when(hit, name)
    return chain.otherwise("Unspecified")


def classify(c: ColumnLike, rules: list[tuple[str, list[str]]], default: str) -> Column:
    """Label of the first rule one of whose patterns matches; ``default`` for none and for null."""
    # Lower-case once: plain LIKE patterns compile to contains/startsWith, ILIKE to a regex.
    text = F.lower(column(c))
    chain: Column | None = None
    for label, patterns in rules:
        hit = F.lit(False)
        for pattern in patterns:
            hit = hit | text.like(pattern.lower())
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    return chain.otherwise(default)


def complaint_family(c: ColumnLike) -> Column:
    return classify(c, COMPLAINT_FAMILIES, OTHER_FAMILY)


def age_bucket(days: ColumnLike) -> Column:
    chain: Column | None = None
    for bound, label in AGE_BUCKETS:
        hit = column(days) < bound
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    return chain.otherwise(OLDEST_BUCKET)


def freshness_label(hours: ColumnLike, warn: float = 36, error: float = 72) -> Column:
    h = column(hours)
    return F.when(h > error, "STALE").when(h > warn, "LATE").otherwise("FRESH")
