"""Offset and run ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def offset_ranges(batch: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Offset range of each topic and partition a batch holds."""
    keys = keys or ["topic", "partition"]
    return batch.groupBy(*keys).agg(
        F.min("offset").alias("from_offset"),
        (F.max("offset") + 1).alias("until_offset"),
    ).withColumn(
        "description",
        F.concat_ws(" ", F.col("topic"), F.col("partition"), F.col("from_offset"),
                    F.col("until_offset")),
    )


def latest_ranges(ledger: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """Ledger as a table: the range of the last batch per topic and partition."""
    last = F.max_by(
        F.struct("from_offset", "until_offset", "description"), F.col(batch_col)
    ).alias("_r")
    return ledger.groupBy("topic", "partition").agg(last).select("topic", "partition", "_r.*")


def log_runs(done: DataFrame, path: str) -> None:
    """Note the ``(job, exec_ts)`` of finished runs; noting one again does no harm."""
    done.select("job", "exec_ts").write.mode("append").parquet(path)


def runs(ledger: DataFrame) -> DataFrame:
    """Each job run once, however often it was noted."""
    return ledger.select("job", "exec_ts").dropDuplicates()
