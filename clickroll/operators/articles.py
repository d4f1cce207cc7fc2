"""Clicks per article: 5 minutes, hour, day, week, month.

Each level is the same merge over the level below it: counts add up, tags are
united, and the attributes are those of the earliest event (the smallest
attributes, should two events share the microsecond).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickroll.functions.clean import clean_tags
from clickroll.functions.slices import slice_start
from clickroll.operators.filters import drop_big_host_noise
from clickroll.schemas import ARTICLE_ATTRS, ARTICLE_KEYS


def _present(df: DataFrame) -> list[str]:
    return [a for a in ARTICLE_ATTRS if a in df.columns]


def as_counts(clicks: DataFrame) -> DataFrame:
    """A click as the smallest article row: count 1, first seen at its own time."""
    return clicks.select(
        *ARTICLE_KEYS, *_present(clicks), "tags", "ts",
        F.lit(1).cast("bigint").alias("count"),
        F.col("ts").alias("first_ts"),
    )


def merge_article_rows(rows: DataFrame, *slices: Column) -> DataFrame:
    """Merge article rows per slice and article key.

    The tags are exploded, so a partial buffer holds each distinct tag once
    however many rows an article has.  Count and attributes are taken from the
    first of the exploded rows only.  One shuffle, with partial buffers made before it.
    """
    attrs = _present(rows)
    keys = (["slice"] if slices else []) + ARTICLE_KEYS
    by_tag = rows.select(
        *[s.alias("slice") for s in slices],
        *ARTICLE_KEYS, "count", F.struct("first_ts", *attrs).alias("_first"), clean_tags("tags").alias("_tags"),
    ).select(*keys, "count", "_first", F.posexplode_outer("_tags").alias("_pos", "_tag"))
    once = F.coalesce(F.col("_pos"), F.lit(0)) == 0
    # nulled before the aggregate: the wide attributes are sorted once for a row, not once for a tag
    narrow = by_tag.select(
        *keys, "_tag", F.when(once, F.col("count")).alias("count"), F.when(once, F.col("_first")).alias("_first")
    )
    return (
        narrow.groupBy(*keys)
        .agg(
            F.sum("count").alias("count"),
            F.sort_array(F.collect_set("_tag")).alias("tags"),
            F.min("_first").alias("_first"),
        )
        .select(*keys, "count", "tags", "_first.*")
    )


def article_5min(clicks: DataFrame, tz: str | None = None) -> DataFrame:
    """Clicks per article, host and app flag in 5-minute slices.

    Clicks are first counted per whole attribute and tag list.  That pass sees
    every click, and it is a plain hash aggregate inside whole-stage code; the
    merge behind it works on what is left.
    """
    attrs = _present(clicks)
    counted = (
        clicks.groupBy(
            slice_start("min5", "ts", tz=tz).alias("slice"),
            *ARTICLE_KEYS, *attrs, "tags",
        )
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.min("ts").alias("first_ts"),
        )
    )
    return merge_article_rows(counted, F.col("slice"))


def article_hourly(rows: DataFrame, ts_col: str = "slice", tz: str | None = None) -> DataFrame:
    """5-minute rows merged per hour."""
    return merge_article_rows(rows, slice_start("hour", ts_col, tz=tz))


def article_daily(rows: DataFrame, ts_col: str = "slice", tz: str | None = None) -> DataFrame:
    """Hourly rows merged per day; the slice is the start of the day."""
    return merge_article_rows(rows, slice_start("day", ts_col, tz=tz))


def month_deltas(daily: DataFrame, hosts: DataFrame, tz: str | None = None) -> DataFrame:
    """What a day adds to the month rows: big-host noise left out.

    The month is that of the row's own day, so the run on the 1st adds
    yesterday to the month that ended.
    """
    kept = drop_big_host_noise(daily, hosts)
    return merge_article_rows(kept, slice_start("month", "slice", tz=tz))


def week_deltas(daily: DataFrame, tz: str | None = None) -> DataFrame:
    """What a day adds to the week rows; weeks start on Sunday."""
    return merge_article_rows(daily, slice_start("week", "slice", tz=tz))
