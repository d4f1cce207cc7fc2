"""Structured Streaming versions of the jobs.

Two ways are offered for counts.  Where a batch's counts simply add up, each
micro-batch writes its own aggregate: no state, no watermark, no late data lost.  Where results per window must stand on their
own, the stream keeps state under a watermark and every change of a row is
written with its batch number; the table is the last version of each row
(``latest_stream``).
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clickroll.operators.articles import as_counts, merge_article_rows
from clickroll.operators.dashboard import COUNTERS, OUTPUTS, dashboard_counts
from clickroll.session import large_state, state_partitions
from clickroll.sinks.append import ROWS, observed, run_of
from clickroll.sinks.commits import CommitLog, Kind
from clickroll.sinks.ledgers import offset_ranges
from clickroll.sinks.upserts import UpsertTable

# Seconds between micro-batches, per job interval.
TRIGGER_SECONDS = {"MINUTE": 20, "HOUR": 3600, "WEEK": 604800, "MONTH": 2592000}


def trigger_for(interval: str | None) -> dict:
    """Trigger of a job interval; none means "what is there now, then stop"."""
    if interval is None:
        return {"availableNow": True}
    return {"processingTime": f"{TRIGGER_SECONDS[interval]} seconds"}


def latest_log(path: str, keys: list[str]) -> CommitLog:
    """A table of versions of rows, of which the last one of each key counts."""
    def merge(entries: DataFrame) -> DataFrame:
        values = [c for c in entries.columns if c not in (*keys, "_batch")]
        last = F.max(F.struct("_batch", *values)).alias("_v")
        if any(isinstance(entries.schema[c].dataType, T.MapType) for c in values):
            last = F.max_by(F.struct("_batch", *values), "_batch").alias("_v")
        return entries.groupBy(*keys).agg(last).select(*keys, *[F.col("_v")[c].alias(c) for c in (*values, "_batch")])

    return CommitLog(path, {ROWS: Kind(
        # a seed comes before all batches
        entry=lambda rows, run, batch: rows.withColumn("_batch", F.lit(-1 if run == SEED else batch).cast("bigint")),
        merge=merge, rows=lambda entries: merge(entries).drop("_batch"))})


def latest_stream(rows: DataFrame, path: str, checkpoint: str, keys: list[str], mode: str = "update",
                  trigger: dict | None = None, partitions: int | None = None, fold_at: int = 32,
                  log: CommitLog | None = None) -> StreamingQuery:
    """Write every changed row of a stateful stream as a version of its key, or as an entry of ``log``.

    ``partitions`` is the number of its state partitions, which it keeps for good.  The
    table holds the changes of one run: on a new checkpoint the state starts anew,
    and so should the table.  Every ``fold_at`` batches old versions are folded away, so
    the table grows with its keys and not with its batches.
    """
    log = log or latest_log(path, keys)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        log.write(spark, {ROWS: batch}, batch_id, run_of(batch))
        if batch_id % fold_at == fold_at - 1:
            log.fold(spark, keep=1)

    with state_partitions(rows.sparkSession, partitions):
        return (
            rows.writeStream.outputMode(mode)
            .foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or trigger_for(None)))
            .start()
        )


def read_latest(spark: SparkSession, path: str, keys: list[str], schema) -> DataFrame:
    """Last version of each row that ``latest_stream`` wrote."""
    names = [f.name for f in schema.fields]
    return latest_log(path, keys).read(spark, ROWS, schema).select(*names)


def article_5min_stream(clicks: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Clicks per article in 5-minute event-time windows, as a stateful stream."""
    rows = as_counts(clicks.withWatermark("ts", delay))
    merged = merge_article_rows(rows, F.window("ts", "5 minutes"))
    return merged.withColumn("slice", F.col("slice.start"))


def windowed_word_count(words: DataFrame, ts_col: str, length: str, step: str | None = None,
                        delay: str = "1 minute") -> DataFrame:
    """Words counted in event-time windows."""
    timed = words.withWatermark(ts_col, delay) if words.isStreaming else words
    window = F.window(ts_col, length, step) if step else F.window(ts_col, length)
    counted = timed.groupBy(window.alias("window"), "word").agg(F.count(F.lit(1)).alias("count"))
    return counted.select(F.col("window.start").alias("slice"), "word", "count")


def running_count(words: DataFrame, seed: DataFrame) -> DataFrame:
    """Running count per word over all batches, on top of a seed of counted words.

    The seed is a stream too, so its counts begin the state of its words with the first micro-batch; a restart
    has read them already.  A word of a batch is one row before the shuffle.  Use update mode, and start the stream
    within ``large_state``.
    """
    said = words.select("word", F.lit(1).cast("bigint").alias("count"))
    return said.unionByName(seed.select("word", "count")).groupBy("word").agg(F.sum("count").alias("count"))


SEED = "seed"
"""Run under which the seed of a table is committed."""


def running_count_stream(words: DataFrame, seed: DataFrame, path: str, checkpoint: str,
                         trigger: dict | None = None, partitions: int | None = None) -> StreamingQuery:
    """Running counts on top of a seed: the table (``read_latest``) has every word of either.

    The seed is aggregated and stored once; it is the first version of its words, and what the state
    begins with.  A restart finds both.  It has a folder of its own, which folds leave alone, since the stream
    goes on from it as from any source.
    """
    spark, log, folder = words.sparkSession, latest_log(path, ["word"]), f"{path}/seed"
    schema = "word string, count bigint"
    state = log.state(spark)
    if not state.folded(SEED, 0, 0) and not any(b["run"] == SEED for b in state.batches):
        # no stream starts before the record is there, so a folder without one is written anew
        seed.groupBy("word").agg(F.sum("count").alias("count")).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").parquet(folder)
        log.write(spark, {ROWS: spark.read.schema(schema).parquet(folder)}, 0, SEED)
    begun = spark.readStream.schema(schema).parquet(folder)
    with large_state(spark):
        return latest_stream(running_count(words, begun), path, checkpoint, ["word"], "update", trigger, partitions)


def counter_schema(output: str, flag: str = "int") -> str:
    """Columns of a dashboard counter table; ``flag`` is the type of its country flag."""
    keys = ", ".join(f"{k} {flag if k == 'is_india' else 'string'}" for k in COUNTERS[output][1][1:])
    return f"slice timestamp, {keys}, count bigint, tot_tm bigint, cat string"


def counter_table(output: str) -> UpsertTable:
    """A dashboard counter: what its entries are keyed by, add up, and are pruned by."""
    _, keys = COUNTERS[output]
    return UpsertTable("", keys, ["count", "tot_tm"], ["cat"], order="first_ts", zone="slice")


def counter_log(path: str, outputs: list[str] | None = None, **more: Kind) -> CommitLog:
    """Dashboard counters below one path, committed together."""
    return CommitLog(path, {**{o: counter_table(o).kind for o in outputs or COUNTERS}, **more})


def counter_frames(keyed: DataFrame, outputs: list[str]) -> dict[str, DataFrame]:
    """What dashboard rows add to each counter."""
    return {o: COUNTERS[o][0](keyed) for o in outputs}


def read_counter(spark: SparkSession, log: CommitLog, output: str, start: datetime | None = None,
                 end: datetime | None = None, flag: str = "int") -> DataFrame:
    """A counter table, or those of its hours that begin from ``start`` to before ``end`` (UTC).

    Rows carry the end of their hour; only batches with rows of these hours are opened.
    """
    schema = T.StructType.fromDDL(counter_schema(output, flag))
    hour = timedelta(hours=1)
    return log.read(spark, output, schema, start and start + hour, end and end + hour)


def dashboard_stream(clicks: DataFrame, path: str, checkpoint: str, outputs: list[int],
                     trigger: dict | None = None, tz: str | None = None, fold_at: int = 32) -> StreamingQuery:
    """One keyed pre-aggregate per micro-batch, added to each chosen counter table with one commit."""
    chosen = [OUTPUTS[o] for o in outputs]
    log = counter_log(path, chosen)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        keyed = observed(dashboard_counts(batch, tz), "dashboard_rows").persist()
        try:
            log.write(spark, counter_frames(keyed, chosen), batch_id, run_of(batch))
        finally:
            keyed.unpersist()
        if batch_id % fold_at == fold_at - 1:
            log.fold(spark, keep=1)

    return (
        clicks.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or trigger_for(None)))
        .start()
    )


def noted_offsets(batch: DataFrame) -> list[dict]:
    """Offset range of each topic and partition that a batch of messages holds: one row per partition."""
    return [r.asDict() for r in offset_ranges(batch).collect()] if "offset" in batch.columns else []


def offset_stream(messages: DataFrame, path: str, checkpoint: str,
                  trigger: dict | None = None) -> StreamingQuery:
    """Note the offset range of every micro-batch in its commit record; the checkpoint stays the truth."""
    log = CommitLog(path, {})

    def write(batch: DataFrame, batch_id: int) -> None:
        log.write(batch.sparkSession, {}, batch_id, run_of(batch), offsets=noted_offsets(batch))

    return (
        messages.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or trigger_for(None)))
        .start()
    )
