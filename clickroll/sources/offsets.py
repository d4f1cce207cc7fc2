"""Offsets of earlier runs, from the ledger the sinks keep."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_offsets(ledger: DataFrame) -> DataFrame:
    """Last committed end offset per topic and partition."""
    return ledger.groupBy("topic", "partition").agg(
        F.max_by("until_offset", F.struct("committed_at", "until_offset")).alias("until_offset")
    )


def starting_offsets(ledger: DataFrame) -> DataFrame:
    """One row per topic: the ``{"partition": offset}`` text a stream can start from."""
    entries = F.sort_array(
        F.collect_list(F.struct(F.col("partition").cast("string").alias("key"),
                                F.col("until_offset").alias("value")))
    )
    return (
        last_offsets(ledger)
        .groupBy("topic")
        .agg(F.to_json(F.map_from_entries(entries)).alias("starting_offsets"))
    )


def resume_offsets(ledger: DataFrame, topic: str) -> str:
    """``startingOffsets`` of one topic; ``earliest`` where the ledger has none."""
    rows = starting_offsets(ledger.where(F.col("topic") == topic)).take(1)
    if not rows:
        return "earliest"
    return '{"%s":%s}' % (topic, rows[0]["starting_offsets"])


def sort_latest(ledger: DataFrame) -> DataFrame:
    """Ledger rows, latest first."""
    return ledger.orderBy(F.desc("committed_at"), F.asc("topic"), F.asc("partition"))
