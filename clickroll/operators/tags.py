"""Clicks per tag, with the articles behind them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickroll.functions.clean import clean_tags
from clickroll.functions.hashing import java_string_hash
from clickroll.functions.slices import slice_start
from clickroll.schemas import TAG_ATTRS

PARTS = 64
"""Rows of a tag in the nested form: articles are dealt into them by hash, at every size."""

_GROUP = ["slice", "host", "tag"]


def _present(df: DataFrame) -> list[str]:
    return [a for a in TAG_ATTRS if a in df.columns]


def explode_tags(clicks: DataFrame) -> DataFrame:
    """One row per click and distinct, non-empty tag."""
    rest = [c for c in clicks.columns if c != "tags"]
    return clicks.select(*rest, F.explode(clean_tags("tags")).alias("tag"))


def tag_article_5min(clicks: DataFrame, tz: str | None = None) -> DataFrame:
    """Long form: clicks per slice, host, tag and article.

    Clicks are counted per article and whole tag list first, by a hash aggregate
    that also keys on the attributes.  Only its result is exploded into tags.
    """
    attrs = _present(clicks)
    counted = (
        clicks.groupBy(slice_start("min5", "ts", tz=tz).alias("slice"),
                       "host", "article_id", *attrs, "tags")
        .agg(F.count(F.lit(1)).alias("count"), F.min("ts").alias("first_ts"))
    )
    return _merge_long(explode_tags(counted), F.col("slice"), attrs)


def _merge_long(rows: DataFrame, slice_col: Column, attrs: list[str]) -> DataFrame:
    keys = [*_GROUP, "article_id"]
    return (
        rows.withColumn("slice", slice_col)
        .groupBy(*keys)
        .agg(F.sum("count").alias("count"),
             F.min(F.struct("first_ts", *attrs)).alias("_first"))
        .select(*keys, "count", "_first.*")
    )


def tag_totals(long: DataFrame) -> DataFrame:
    """Clicks and articles per slice, host and tag, with the attributes of the earliest click."""
    attrs = _present(long)
    return (
        long.groupBy(*_GROUP)
        .agg(
            F.sum("count").alias("count"),
            F.count(F.lit(1)).alias("articles"),
            F.min(F.struct("first_ts", *attrs)).alias("_first"),
        )
        .select(*_GROUP, "count", "articles", java_string_hash("tag").alias("c_tag"), "_first.*")
        .withColumns(
            {"cat_id_hash": F.coalesce("cat_id_hash", F.lit(0).cast("bigint"))}
            if "cat_id_hash" in attrs else {}
        )
    )


def nest_articles(long: DataFrame, parts: int = PARTS) -> DataFrame:
    """Long form to lists of (article_id, count), for readers that want them.

    A tag has up to ``parts`` rows; ``part`` is the hash of the articles it
    lists and belongs to the key.  ``count`` is that of the part, ``total`` that of the tag.
    """
    attrs = _present(long)
    part = F.pmod(F.xxhash64("article_id"), F.lit(parts)).cast("int")
    listed = long.groupBy(*_GROUP, part.alias("part")).agg(
        F.sum("count").alias("count"),
        F.sort_array(F.collect_list(F.struct("article_id", "count"))).alias("articles"),
        F.min(F.struct("first_ts", *attrs)).alias("_part_first"),
    )
    # at most ``parts`` rows a tag from here on
    totals = listed.groupBy(*[F.col(k).alias(f"_{k}") for k in _GROUP]).agg(
        F.sum("count").alias("total"), F.min("_part_first").alias("_first"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in _GROUP]
    return (
        listed.join(totals, same)
        .select(*_GROUP, "part", "count", "total", "articles", java_string_hash("tag").alias("c_tag"), "_first.*")
        .withColumns(
            {"cat_id_hash": F.coalesce("cat_id_hash", F.lit(0).cast("bigint"))}
            if "cat_id_hash" in attrs else {}
        )
    )


def unnest_articles(rows: DataFrame) -> DataFrame:
    """Back to long form: one row per listed article."""
    keep = [c for c in (*_GROUP, "first_ts", *TAG_ATTRS) if c in rows.columns]
    return rows.select(*keep, F.inline("articles"))


def tag_article_hourly(rows: DataFrame, tz: str | None = None) -> DataFrame:
    """5-minute tag rows (long, or listed) merged per hour, in long form."""
    long = unnest_articles(rows) if "articles" in rows.columns else rows
    return _merge_long(long, slice_start("hour", "slice", tz=tz), _present(long))
