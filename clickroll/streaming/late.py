"""Counts per event-time window that keep the rows behind the watermark.

The count of a window is state until the watermark has passed the window's end; a timer then frees
it.  Rows that come later meet no state: what they add is a correction, written with the
batch they came in.  The count in the table is the last version of the state plus all corrections,
so it is that of all rows, in whatever order they come, while the state stays as small as
the watermark makes it.  Both come from one stream and one commit per batch: a
batch that is run again replaces its versions and its corrections together.

Defined cases: rows without a time or a word are in no window; a row that is late for some of the windows it
lies in and not for others corrects the former alone; in the first batch there is no watermark, so nothing is late.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from clickroll.session import large_state
from clickroll.sinks.append import ROWS
from clickroll.sinks.commits import CommitLog, Kind
from clickroll.streaming.jobs import latest_stream

COUNTED = "begins bigint, ends bigint, word string, count bigint"


def _summed(rows: DataFrame) -> DataFrame:
    """Words of windows with the counts of each Arrow batch: what is shuffled to the state is summed before."""
    import pyarrow as pa

    keys = ["begins", "ends", "word"]
    schema = pa.schema([("begins", pa.int64()), ("ends", pa.int64()), ("word", pa.string()), ("count", pa.int64())])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = pa.Table.from_batches([batch]).group_by(keys).aggregate([([], "count_all")])
            yield from counted.rename_columns([*keys, "count"]).cast(schema).to_batches()

    # the columns behind this have no event time of their own, so Spark leaves late rows in
    return rows.select(*keys).mapInArrow(partial, COUNTED)


class WindowCount(StatefulProcessor):
    """The count of a window as state until its end, and corrections behind it."""

    def init(self, handle) -> None:
        self.handle = handle
        self.total = handle.getValueState("total", "total bigint")

    def handleInputRows(self, key, rows, timerValues):
        begins, ends, word = key
        added = sum(r["count"] for r in rows)
        if ends <= timerValues.getCurrentWatermarkInMs():
            yield Row(begins=begins, word=word, count=None, late=added)
            return
        if self.total.exists():
            added += self.total.get()[0]
        else:
            self.handle.registerTimer(ends)
        self.total.update((added,))
        yield Row(begins=begins, word=word, count=added, late=None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.total.clear()
        return iter(())

    def close(self) -> None:
        pass


def corrected_word_count(words: DataFrame, ts_col: str, length: str, step: str | None = None,
                         delay: str = "1 minute") -> DataFrame:
    """Changes of the words counted in event-time windows: versions (``count``) and corrections (``late``)."""
    window = F.window(ts_col, length, step) if step else F.window(ts_col, length)
    timed = words.where(F.col("word").isNotNull()).withWatermark(ts_col, delay).select(window.alias("w"), "word")
    bounds = timed.select(F.unix_millis("w.start").alias("begins"), F.unix_millis("w.end").alias("ends"), "word")
    changes = _summed(bounds).groupBy("begins", "ends", "word").transformWithState(
        WindowCount(), "begins bigint, word string, count bigint, late bigint", "Update", "EventTime")
    return changes.select(F.timestamp_millis("begins").alias("slice"), "word", "count", "late")


def corrected_log(path: str, keys: list[str]) -> CommitLog:
    """A table whose counts are the last version of each key plus its corrections."""
    def merge(entries: DataFrame) -> DataFrame:
        version = F.max(F.when(F.col("count").isNotNull(), F.struct("_batch", "count")))
        merged = entries.groupBy(*keys).agg(version.alias("_v"), F.sum("late").alias("late"))
        return merged.select(*keys, F.col("_v.count").alias("count"), "late", F.col("_v._batch").alias("_batch"))

    def shown(entries: DataFrame) -> DataFrame:
        late = F.coalesce("late", F.lit(0))
        return merge(entries).select(*keys, (F.coalesce("count", F.lit(0)) + late).alias("count"), late.alias("late"))

    return CommitLog(path, {ROWS: Kind(
        entry=lambda rows, run, batch: rows.withColumn("_batch", F.lit(batch).cast("bigint")), merge=merge, rows=shown)})


def corrected_stream(changes: DataFrame, path: str, checkpoint: str, keys: list[str], trigger: dict | None = None,
                     partitions: int | None = None, fold_at: int = 32) -> StreamingQuery:
    """Write the changes of ``corrected_word_count``, each batch with one commit; read them by ``read_corrected``."""
    with large_state(changes.sparkSession):
        return latest_stream(changes, path, checkpoint, keys, "update", trigger, partitions, fold_at,
                             log=corrected_log(path, keys))


def read_corrected(spark: SparkSession, path: str, keys: list[str], schema: T.StructType) -> DataFrame:
    """Keys with the count of all their rows, and how many of these came late."""
    return corrected_log(path, keys).read(spark, ROWS, schema).select(*keys, "count", "late")
