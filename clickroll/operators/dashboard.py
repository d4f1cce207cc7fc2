"""Live dashboard counters: referers, response groups, locations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickroll.functions.clean import default_referer
from clickroll.functions.slices import seconds, slice_start
from clickroll.schemas import DASHBOARD_KEYS


def dashboard_counts(clicks: DataFrame, tz: str | None = None) -> DataFrame:
    """Clicks per hour, the six dashboard keys and the category: what all counters add up.

    A hash aggregate; the merges behind it see only its result.
    """
    return (
        clicks.groupBy(slice_start("hour", "ts", tz=tz).alias("slice"), *DASHBOARD_KEYS, "cat")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.sum("dnld_time").alias("tot_tm"),
            F.min("ts").alias("first_ts"),
        )
    )


def dashboard_keys(clicks: DataFrame, tz: str | None = None) -> DataFrame:
    """Clicks per hour and the six dashboard keys, with the category of the earliest click."""
    return _first_cat(dashboard_counts(clicks, tz), ["slice", *DASHBOARD_KEYS])


def _first_cat(rows: DataFrame, keys: list[str]) -> DataFrame:
    merged = rows.groupBy(*keys).agg(
        F.sum("count").alias("count"),
        F.sum("tot_tm").alias("tot_tm"),
        F.min(F.struct("first_ts", "cat")).alias("_first"),
    )
    return merged.select("*", "_first.*").drop("_first")


def _hour_end(rows: DataFrame) -> DataFrame:
    # counters are stamped with the end of the hour
    return rows.withColumn("slice", F.col("slice") + seconds(3600))


def referer_counts(keyed: DataFrame) -> DataFrame:
    """From dashboard rows, with or without their category merged: per hour end, article, host and referer; a missing referer is "none"."""
    rows = _hour_end(keyed.withColumn("referer", default_referer("referer")))
    return _first_cat(rows, ["slice", "article_id", "host", "referer"])


def response_counts(keyed: DataFrame) -> DataFrame:
    """Per hour end, article, host and response group."""
    return _first_cat(_hour_end(keyed), ["slice", "article_id", "host", "grp"])


def location_counts(keyed: DataFrame) -> DataFrame:
    """Per hour end, article, host, country flag and location."""
    rows = _hour_end(keyed).withColumnRenamed("geo_location", "location")
    return _first_cat(rows, ["slice", "article_id", "host", "is_india", "location"])


# Output codes of the dashboard job.
OUTPUTS = {1: "referer", 2: "response", 3: "location"}

COUNTERS = {
    "referer": (referer_counts, ["slice", "article_id", "host", "referer"]),
    "response": (response_counts, ["slice", "article_id", "host", "grp"]),
    "location": (location_counts, ["slice", "article_id", "host", "is_india", "location"]),
}
