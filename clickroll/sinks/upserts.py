"""Counters with insert-or-add semantics, kept as a log of deltas.

A micro-batch writes what it adds to the counters as a batch of a commit log.  The table is
the sum over all entries: counts add up, tag lists unite, and the attributes are those of
the earliest entry.  A batch that is retried replaces what it wrote, so nothing is counted twice, and no
row is ever updated in place.  A run is what shares a checkpoint: a stream on a new checkpoint
counts its batches from 0 again and is another run.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickroll.sinks.commits import CommitLog, Kind

ROWS = "rows"
"""Name of the one table in the log of an upsert table."""


@dataclass(frozen=True)
class UpsertTable:
    """A counter table: its keys, added columns, united columns, first-seen ones.

    ``order`` is the column first-seen is decided by; the log adds run and batch
    number where a table has none.  ``zone`` is a key that holds times, by which readers prune.
    """

    path: str
    keys: list[str]
    sums: list[str]
    firsts: list[str] = field(default_factory=list)
    sets: list[str] = field(default_factory=list)
    order: str | None = None
    zone: str | None = None
    lookup: str | None = None
    """Text key with a Bloom filter for each folder (see ``CommitLog.find``)."""

    # --- entries -------------------------------------------------------
    def _fold(self, entries: DataFrame) -> DataFrame:
        # Entries are aggregated rows.  Set columns are exploded on the way, as
        # in the article merge, so a buffer holds each element once.
        aggs = []
        rows = entries
        if self.sets:
            (tags,) = self.sets
            rows = rows.select(
                *self.keys, *self.sums, "_order", *self.firsts,
                F.posexplode_outer(tags).alias("_pos", "_item"),
            )
            once = F.coalesce(F.col("_pos"), F.lit(0)) == 0
            aggs += [F.sum(F.when(once, F.col(s))).alias(s) for s in self.sums]
            aggs.append(F.sort_array(F.collect_set("_item")).alias(tags))
        else:
            aggs += [F.sum(s).alias(s) for s in self.sums]
        aggs.append(F.min(F.struct("_order", *self.firsts)).alias("_first"))
        folded = rows.groupBy(*self.keys).agg(*aggs)
        return folded.select(*self.keys, *self.sums, *self.sets, "_first.*")

    def _entry(self, deltas: DataFrame, run: str, batch_id: int) -> DataFrame:
        order = F.col(self.order) if self.order else F.lit(None)
        return deltas.select(
            *self.keys, *self.sums, *self.sets, *self.firsts,
            F.struct(F.coalesce(order.cast("timestamp"), F.lit("1970-01-01").cast("timestamp"))
                     .alias("seen"),
                     F.lit(run).alias("run"), F.lit(batch_id).cast("bigint").alias("batch")).alias("_order"),
        )

    @property
    def kind(self) -> Kind:
        """The table as one of several of a commit log."""
        return Kind(self.zone, entry=self._entry, merge=self._fold, rows=lambda entries: self._fold(entries).drop("_order"),
                    lookup=self.lookup)

    @property
    def log(self) -> CommitLog:
        return CommitLog(self.path, {ROWS: self.kind})

    # --- public --------------------------------------------------------
    def upsert(self, deltas: DataFrame, batch_id: int, run: str = "0", last: int | None = None) -> None:
        """Add a batch's deltas, or those of the batches from ``batch_id`` to ``last`` as one.

        A batch that was folded cannot be written again: an error.
        """
        self.log.write(deltas.sparkSession, {ROWS: deltas}, batch_id, run, last)

    def read(self, spark: SparkSession, before: int | None = None, empty: T.StructType | None = None, run: str = "0",
             start: datetime | None = None, end: datetime | None = None) -> DataFrame:
        """Current rows of the table, or those without the batches of ``run`` from ``before`` on.

        ``empty`` is the schema to return no rows with while nothing is written.  With ``start``
        and ``end`` (UTC) only folders with rows of that time are opened.
        """
        return self.log.read(spark, ROWS, empty, start, end, before, run)

    def compact(self, spark: SparkSession, everything: bool = False, keep: int = 0) -> int | None:
        """Fold the open batches into a segment; how many entries went in, if any did."""
        return self.log.fold(spark, keep, everything)
