"""Aggregate a table, batch or stream, by a time slice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from clickroll.functions.slices import slice_start


def rollup_by_slice(
    df: DataFrame,
    ts_col: str,
    slice_name: str,
    keys: list[str],
    aggs: list[Column],
    n: int = 5,
    back: int = 0,
    tz: str | None = None,
) -> DataFrame:
    """Group by slice start and ``keys``; the slice comes out as ``slice``."""
    start = slice_start(slice_name, ts_col, n=n, back=back, tz=tz)
    return df.groupBy(start.alias("slice"), *keys).agg(*aggs)
