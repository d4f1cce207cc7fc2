"""Table scans of the batch jobs.

Every scan is a filter on a DataFrame: Spark pushes it into Parquet, and where
the table is partitioned by ``dt`` it prunes whole days.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickroll.functions.slices import SCAN_LOOKBACK, SHARD_LOOKBACK
from clickroll.operators.filters import in_hosts, instant, min_count, time_range


def _days(start: datetime, end: datetime) -> list[str]:
    days = (end.date() - start.date()).days
    return [(start + timedelta(days=d)).strftime("%Y%m%d") for d in range(days + 1)]


def prune_days(table: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Keep the day partitions a time range can touch, if the table has them."""
    if "dt" not in table.columns:
        return table
    return table.where(F.col("dt").cast("string").isin(_days(start, end)))


def interval_scan(
    table: DataFrame,
    current: datetime,
    interval: str,
    ts_col: str = "ts",
    lookback: timedelta | None = None,
) -> DataFrame:
    """Rows in ``[current - lookback, current)``.

    The default look-back is the jobs' own: five minutes for MINUTE, half the
    interval for the others.
    """
    back = lookback or timedelta(seconds=SCAN_LOOKBACK[interval])
    start = current - back
    return time_range(prune_days(table, start, current), ts_col, start, current, "[)")


def hourly_articles(table: DataFrame, current: datetime, hosts: DataFrame,
                    ts_col: str = "slice") -> DataFrame:
    """5-minute rows of the hour that ends at ``current``: ``(current - 1 h, current]``."""
    start = current - timedelta(hours=1)
    rows = time_range(prune_days(table, start, current), ts_col, start, current, "(]")
    return in_hosts(rows, hosts)


def daily_articles(table: DataFrame, start: datetime, midnight: datetime, hosts: DataFrame,
                   least: int = 1, ts_col: str = "slice") -> DataFrame:
    """Hourly rows of the day that ends at ``midnight``: ``(start, midnight]``."""
    rows = time_range(prune_days(table, start, midnight), ts_col, start, midnight, "(]")
    return in_hosts(min_count(rows, least), hosts)


def hourly_tags(table: DataFrame, current: datetime, ts_col: str = "slice") -> DataFrame:
    """5-minute tag rows of an hour: ``[current - 1 h, current)``."""
    start = current - timedelta(hours=1)
    return time_range(prune_days(table, start, current), ts_col, start, current, "[)")


def hour_rows(table: DataFrame, hour: datetime, ts_col: str = "slice") -> DataFrame:
    """Rows of exactly one hour stamp, in the day shard half an hour before it or its own."""
    start = hour - timedelta(seconds=SHARD_LOOKBACK["HOUR"])
    return prune_days(table, start, hour).where(F.col(ts_col) == instant(hour))


def pushdown_scan(table: DataFrame, columns: list[str], predicate: Column,
                  limit: int | None = None, order: list[str] | None = None) -> DataFrame:
    """Column list and predicate, handed to the source; of the rows the first ``limit`` by ``order``."""
    rows = table.where(predicate).select(*columns)
    if order:
        rows = rows.orderBy(*order)
    return rows if limit is None else rows.limit(limit)


def load_lookup(table: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One row per key; of duplicates the last loaded wins."""
    return (
        table.groupBy(key)
        .agg(F.max(F.struct(F.col(order), F.struct(value).alias("v"))).alias("_last"))
        .select(key, F.col("_last.v")[value].alias(value))
    )
