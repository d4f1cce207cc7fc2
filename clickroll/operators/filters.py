"""Row filters of the jobs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The limit of the category rollups, and of the month trend for big hosts.
CATEGORY_LIMIT = 5
BIG_HOST_NOISE = 2


def in_hosts(rows: DataFrame, hosts: DataFrame) -> DataFrame:
    """Rows whose host is in the allow-list.

    The list is a table with a ``host`` column.  No hint is given: Spark
    broadcasts it while it is under the broadcast threshold and shuffles both
    sides, splitting hot hosts, when it is not.
    """
    return rows.join(hosts.select("host"), "host", "left_semi")


def min_count(rows: DataFrame, least: int, count: str = "count") -> DataFrame:
    """Rows counted at least ``least`` times."""
    return rows.where(F.col(count) >= least)


def drop_big_host_noise(rows: DataFrame, hosts: DataFrame,
                        least: int = BIG_HOST_NOISE) -> DataFrame:
    """Drop rows of big hosts under ``least``; ``hosts`` carries ``is_big``."""
    big = hosts.where("is_big").select("host", F.lit(True).alias("_big")).dropDuplicates(["host"])
    noise = F.coalesce("_big", F.lit(False)) & (F.col("count") < least)
    return rows.join(big, "host", "left").where(~noise).select(*rows.columns)


def instant(when: datetime | Column) -> Column:
    """A date-time without zone as a timestamp of the session zone."""
    if isinstance(when, Column):
        return when
    return F.lit(when.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def time_range(rows: DataFrame, ts_col: str, start: datetime | Column, end: datetime | Column,
               ends: str = "[)") -> DataFrame:
    """Rows in a time range; ``ends`` is ``[)`` or ``(]``."""
    ts = F.col(ts_col)
    lo, hi = instant(start), instant(end)
    if ends == "[)":
        return rows.where((ts >= lo) & (ts < hi))
    if ends == "(]":
        return rows.where((ts > lo) & (ts <= hi))
    raise ValueError(f"ends must be [) or (], not {ends}")


def host_with_count(rows: DataFrame, host: str, count: int) -> DataFrame:
    """Rows of one host with exactly this count."""
    return rows.where((F.col("host") == host) & (F.col("count") == count))
