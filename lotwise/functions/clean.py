"""Text normalisers and casts that turn unreadable text into NULL."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Integer text. Checked before any cast: a failing cast costs far more than the check.
INTEGER = r"^\s*[+-]?\d+\s*$"
# Plain decimal text, with or without an exponent.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# A calendar day, alone or followed by a time of day and a zone.
DAY = (
    r"^\s*(\d{4,5})([-/ ])(\d{1,2})\2(\d{1,2})"
    r"([T ]([01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d+)?)?(?:Z|[+-]\d{2}(?::?\d{2})?)?)?\s*$"
)
NO_DIRECTION = ["", "NONE"]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def street_number(c: Column | str) -> Column:
    return F.trim(col(c))


def street_text(c: Column | str) -> Column:
    return F.upper(F.trim(col(c)))


def street_direction(c: Column | str) -> Column:
    """Missing, blank and 'none' all mean that the street has no direction."""
    cleaned = F.coalesce(street_text(c), F.lit(""))
    return F.when(cleaned.isin(NO_DIRECTION), F.lit("")).otherwise(cleaned)


def whole_number(c: Column | str, kind: str = "int") -> Column:
    """Integer text as it is; decimal or exponent text rounded half away from zero."""
    c = col(c)
    rounded = F.round(c.try_cast("decimal(38,18)"), 0).try_cast(kind)
    return F.when(c.rlike(INTEGER), c.try_cast(kind)).when(c.rlike(NUMBER), rounded)


def day(c: Column | str) -> Column:
    """The date of a text; years of more than four digits are taken for typing errors: NULL."""
    c = col(c)
    found = F.when(c.rlike(DAY), F.regexp_replace(c, DAY, "$1-$3-$4").try_cast("date"))
    return F.when(F.year(found) <= 9999, found)


def moment(c: Column | str) -> Column:
    c = col(c)
    return F.when(c.rlike(DAY), F.regexp_replace(c, DAY, "$1-$3-$4$5").try_cast("timestamp"))


def text_digest(c: Column | str) -> Column:
    """The identity of a description: both cache sides and every run use this one."""
    return F.md5(F.trim(col(c)))


def has_text(c: Column | str) -> Column:
    return F.coalesce(F.trim(col(c)), F.lit("")) != ""
