"""Text cleaning, guarded casts and keys."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# Every character of Unicode class Zs (space separators).
SPACES = "".join(
    map(chr, [0x20, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000])
)


def column(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: ColumnLike) -> Column:
    """Strip space separators from both ends; tabs and newlines stay.

    Text of ASCII alone, which has as many bytes as characters, can only hold one of them, and is
    stripped of it without a look at every character.
    """
    text = column(c)
    narrow = F.octet_length(text) == F.length(text)
    return F.when(narrow, F.trim(text)).otherwise(F.trim(text, F.lit(SPACES)))


def clean_code(c: ColumnLike) -> Column:
    return F.upper(clean_text(c))


def is_zip(c: ColumnLike) -> Column:
    # \z, not $: Java's $ also matches before a final newline.
    return column(c).rlike(r"^[0-9]{5}\z")


def clean_zip(c: ColumnLike) -> Column:
    """The trimmed text where it is exactly five digits, else null."""
    text = clean_text(c)
    return F.when(is_zip(text), text)


def allowed(c: ColumnLike, values: Iterable[str]) -> Column:
    """The cleaned code where it is on the list, else null."""
    code = clean_code(c)
    return F.when(code.isin(list(values)), code)


def to_double(c: ColumnLike) -> Column:
    """Double or null; Java-only spellings (``1d``, ``1f``, hex) count as bad values."""
    text = column(c)
    return F.when(~text.rlike(r"[0-9.][dDfF]\s*$|[xX]"), text.try_cast("double"))


def composite_key(*parts: ColumnLike) -> Column:
    """md5 over the parts with null read as empty text."""
    texts = [F.coalesce(column(p), F.lit("")) for p in parts]
    joined = texts[0]
    for text in texts[1:]:
        joined = F.concat(joined, F.lit("|"), text)
    return F.md5(joined)


def concat_key(*parts: ColumnLike, sep: str = "") -> Column:
    """Concatenation that is null as soon as one part is null."""
    out: list[Column] = []
    for i, part in enumerate(parts):
        if i and sep:
            out.append(F.lit(sep))
        out.append(column(part).cast("string"))
    return F.concat(*out)


def or_unknown(c: ColumnLike) -> Column:
    return F.coalesce(column(c), F.lit("UNKNOWN"))
