"""Cleaning rules for click fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_long(c: Column | str, default: int | None = None) -> Column:
    """Any numeric text to a truncated long ("1.4E9" too); else the default."""
    number = _col(c).try_cast("double")
    # doubles hold whole numbers exactly up to 2^53; beyond, the text is cast
    # itself.  Not first of all: a failed integer cast is slow.
    exact = F.coalesce(_col(c).try_cast("bigint"), number.try_cast("bigint"))
    value = F.when(F.abs(number) < float(1 << 53), number.cast("bigint")).when(
        number.isNotNull(), exact
    )
    return value if default is None else F.coalesce(value, F.lit(default).cast("bigint"))


def to_flag(c: Column | str) -> Column:
    """True only for the word "true" in any case."""
    return F.coalesce(F.lower(_col(c)) == "true", F.lit(False))


def clean_tags(tags: Column | str) -> Column:
    """Distinct tags without nulls and empty strings; null becomes an empty list."""
    kept = F.array_distinct(
        F.filter(_col(tags), lambda t: t.isNotNull() & (t != ""))
    )
    return F.coalesce(kept, F.array().cast("array<string>"))


def default_referer(referer: Column | str) -> Column:
    """Null or empty referer is "none"."""
    return F.coalesce(F.nullif(_col(referer), F.lit("")), F.lit("none"))


def is_error_doc(*keys: str, empty_too: bool = False) -> Column:
    """True where a key is null (or, with ``empty_too``, an empty string)."""
    flag = F.lit(False)
    for key in keys:
        missing = F.col(key).isNull()
        if empty_too:
            missing = missing | (F.col(key).cast("string") == "")
        flag = flag | missing
    return flag


def is_desktop(device_category: Column | str) -> Column:
    """0 for phones and tablets by category name (case matters), else 1."""
    small = _col(device_category).rlike("phone|mobile|Tab|tab")
    return F.when(small, 0).otherwise(1)
