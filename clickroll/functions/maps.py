"""Article-count maps and lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def merge_count_maps(left: Column, right: Column) -> Column:
    """Union of two article-to-count maps, counts of shared articles added."""
    zero = F.lit(0).cast("bigint")
    empty = F.create_map().cast("map<string,bigint>")
    return F.map_zip_with(
        F.coalesce(left, empty),
        F.coalesce(right, empty),
        lambda _, a, b: F.coalesce(a, zero) + F.coalesce(b, zero),
    )


def map_to_list(counts: Column) -> Column:
    """Map back to a sorted list of (article_id, count) structs."""
    return F.sort_array(
        F.transform(
            F.map_entries(counts),
            lambda e: F.struct(e["key"].alias("article_id"), e["value"].alias("count")),
        )
    )
