"""Plain appends that survive a retry."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clickroll.functions.slices import day_key
from clickroll.sinks import files
from clickroll.sinks.commits import CommitLog, Kind


ROWS = "rows"
"""Name of the one table in the log of an appended table."""


def run_of(batch: DataFrame) -> str:
    """The run of a micro-batch: the id its checkpoint gave the stream, the same after a restart."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "0"


def _partitions(ts_col: str | Column, tz: str | None, hourly: bool) -> dict[str, Column]:
    by = {"dt": day_key(ts_col, tz)}
    if hourly:
        by["hr"] = day_key(ts_col, tz, "HH")
    return by


def write_partitions(df: DataFrame, path: str, ts_col: str = "slice",
                     tz: str | None = None, hourly: bool = False) -> None:
    """Write a batch result into day (or hour) partitions; those it has rows for are replaced.

    Rows are brought together by partition first, so each gets few files; AQE
    splits the ones that are too big for one task.
    """
    by = _partitions(ts_col, tz, hourly)
    (
        df.withColumns(by)
        .hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def slice_folder(path: str, start: datetime, hourly: bool = False) -> str:
    """Folder of the day (or hour) that begins at ``start``, a wall-clock time of the table's zone."""
    return f"{path}/dt={start:%Y%m%d}" + (f"/hr={start:%H}" if hourly else "")


def write_slice(df: DataFrame, path: str, start: datetime, hourly: bool = False) -> None:
    """Write the rows of one day (or hour) into its folder; with no rows it is empty from then on."""
    df.hint("rebalance").write.mode("overwrite").parquet(slice_folder(path, start, hourly))


def read_slices(spark: SparkSession, path: str, starts: list[datetime], schema: T.StructType,
                hourly: bool = False) -> DataFrame:
    """The given days (or hours) of a table; only their folders are listed."""
    held = [f for s in starts if files.exists(spark, f := slice_folder(path, s, hourly))]
    if not held:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*held)


def append_log(path: str, zone: str | None = None) -> CommitLog:
    """A table that batches are appended to."""
    return CommitLog(path, {ROWS: Kind(zone)})


def read_appended(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of such a table."""
    return append_log(path).read(spark, ROWS, schema)


def append_stream(stream: DataFrame, path: str, checkpoint: str, transform=None,
                  trigger: dict | None = None) -> StreamingQuery:
    """Start a stream that appends each micro-batch, after ``transform``, to a table."""
    log = append_log(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        log.write(batch.sparkSession, {ROWS: transform(batch) if transform else batch}, batch_id, run_of(batch))

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def console(stream: DataFrame, rows: int = 20, checkpoint: str | None = None,
            trigger: dict | None = None) -> StreamingQuery:
    """Print the first rows of each micro-batch."""
    writer = stream.writeStream.format("console").option("numRows", rows)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def with_partition(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """Kafka sink rows with the partition their key belongs to."""
    from clickroll.functions.hashing import octet_partition

    return df.withColumn("partition", octet_partition(key, partitions))


def observed(df: DataFrame, name: str) -> DataFrame:
    """Row count of a written batch, collected while it is written."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"))
