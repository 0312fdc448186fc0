"""Column functions shared by the plans. All are built-in expressions: no Python per row."""

from caseflow.functions.dates import (
    as_ntz,
    date_parts,
    days_between,
    elapsed_hours,
    hours_between,
    iso_text,
    minutes_between,
    parse_ts,
)
from caseflow.functions.rules import (
    BOROUGHS,
    COMPLAINT_FAMILIES,
    STATUSES,
    age_bucket,
    classify,
    complaint_family,
    freshness_label,
    normalise_status,
)
from caseflow.functions.text import (
    allowed,
    clean_code,
    clean_text,
    clean_zip,
    composite_key,
    concat_key,
    or_unknown,
    to_double,
)

__all__ = [
    "BOROUGHS",
    "COMPLAINT_FAMILIES",
    "STATUSES",
    "age_bucket",
    "allowed",
    "as_ntz",
    "classify",
    "clean_code",
    "clean_text",
    "clean_zip",
    "complaint_family",
    "composite_key",
    "concat_key",
    "date_parts",
    "days_between",
    "elapsed_hours",
    "freshness_label",
    "hours_between",
    "iso_text",
    "minutes_between",
    "normalise_status",
    "or_unknown",
    "parse_ts",
    "to_double",
]
