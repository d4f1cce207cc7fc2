"""Rollups by category, each with "All" totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickroll.operators.filters import CATEGORY_LIMIT, in_hosts, min_count

ALL = "All"


def with_totals(rows: DataFrame, keys: list[str], totalled: list[str],
                sums: list[str]) -> DataFrame:
    """Sums per ``keys`` and every combination of ``totalled`` columns and "All".

    The rows are summed to their finest grain first.  The cube multiplies rows,
    and behind that first sum it multiplies only a handful.  ``grouping`` tells
    a total from a group whose value is null, so both stay.
    """
    fine = rows.groupBy(*keys, *totalled).agg(*[F.sum(s).alias(s) for s in sums])
    sets = [[]]
    for column in totalled:
        sets = [*sets, *[[*s, column] for s in sets]]
    named = [
        F.when(F.grouping(c) == 1, F.lit(ALL)).otherwise(F.col(c).cast("string")).alias(f"_{c}")
        for c in totalled
    ]
    grouped = fine.groupingSets(
        [[F.col(c) for c in [*keys, *s]] for s in sets],
        *[F.col(c) for c in [*keys, *totalled]],
    ).agg(*[F.sum(s).alias(f"_{s}") for s in sums], *named)
    return grouped.select(
        *keys,
        *[F.col(f"_{c}").alias(c) for c in totalled],
        *[F.col(f"_{s}").alias(s) for s in sums],
    )


def clicks_by_cat(hourly: DataFrame, hosts: DataFrame, least: int = CATEGORY_LIMIT) -> DataFrame:
    """Clicks per host and category, of hourly article rows of listed hosts."""
    rows = in_hosts(min_count(hourly, least), hosts)
    return with_totals(rows, ["slice", "host"], ["cat"], ["count"])


def location_by_cat(locations: DataFrame) -> DataFrame:
    """Clicks per host and country flag, by category and location."""
    return with_totals(locations, ["slice", "host", "is_india"], ["cat", "location"], ["count"])


def referer_by_cat(referers: DataFrame) -> DataFrame:
    """Clicks per host and referer, by category."""
    return with_totals(referers, ["slice", "host", "referer"], ["cat"], ["count"])


def response_by_cat(responses: DataFrame) -> DataFrame:
    """Clicks and total download time per host and response group, by category."""
    return with_totals(responses, ["slice", "host", "grp"], ["cat"], ["count", "tot_tm"])
