"""Tables that micro-batches write, with one commit record per batch.

A batch writes each of its tables to one folder of its own, whatever hours its rows are of, and
then, last, one small record: its run and number, the folder of each table with the smallest
and largest slice in it, and the offsets it has read.  Readers take what records
name, so a batch counts with all its tables and offsets or not at all.  A batch that is written again
gets new folders and a new record, and the newest record holds: what the first
attempt wrote, also of hours that the second has no rows for, is not read any more.

The slices in the records are the zone map: a reader of some hours opens the folders that hold
some of them, and inside, rows are sorted by slice, so row groups are skipped.

``fold`` merges open batches into a segment, and segments of one level into one of the next, so a row is
rewritten once a level.  A fold record replaces all before it: the segments there are, the
numbers of folded batches as ranges per run, and the last offsets.  Folded records are
removed, so a writer lists and reads as much after a year as after an hour.  ``vacuum``
removes folders that nothing names.

A log that ``owns`` its times is for jobs that are run for a stretch of time and replace it: a batch is
numbered by the microseconds it is for, and of batches that overlap the newest one
holds, also against what is folded, be it with no rows at all.

One writer folds a log at a time.  A run is what shares a checkpoint.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickroll.sinks import bloom, files
from clickroll.sinks.intervals import Ranges, added, meets

FANOUT = 8
"""Segments of a level that are merged into one of the next."""

_BATCH = re.compile(r"b\.(\d{19})\.(\d+)\.(\d+)\.(.+)\.json")
_FOLD = re.compile(r"f\.(\d{12})\.json")


Rows = DataFrame | Callable[[], DataFrame | None]


@dataclass(frozen=True)
class Kind:
    """How entries of a table are made, merged and shown; by default they are the rows themselves."""

    zone: str | None = None
    """Timestamp column that folders are pruned by."""
    sort: tuple[str, ...] = ()
    """Columns a file is sorted by, if not by its zone: scans for some of their values skip row groups."""
    bloom: tuple[str, ...] = ()
    """Columns with a Parquet Bloom filter in each row group, for scans of single values."""
    lookup: str | None = None
    """Text column with a Bloom filter for each folder, so that a lookup opens only folders that can have its keys."""
    entry: Callable[[DataFrame, str, int], DataFrame] = lambda rows, run, batch: rows
    merge: Callable[[DataFrame], DataFrame] = lambda entries: entries
    rows: Callable[[DataFrame], DataFrame] = lambda entries: entries


@dataclass
class Part:
    """A folder of a table, and the slices in it (microseconds since 1970; none if it has no rows)."""

    folder: str
    lo: int | None
    hi: int | None
    schema: str
    level: int = -1
    gone: Ranges = field(default_factory=list)
    """Slices that newer batches own."""
    filter: str | None = None
    """File with the Bloom filter of the looked-up column."""

    def holds(self, start: int | None, end: int | None) -> bool:
        """Whether it can have rows of ``[start, end)``; a table without zone always can."""
        if self.lo is None:
            return self.hi is None and start is None and end is None
        return (end is None or self.lo < end) and (start is None or self.hi >= start)


@dataclass
class State:
    """What a log holds: the last fold and the batches behind it."""

    seq: int = -1
    until: int = -1
    ranges: dict[str, Ranges] = field(default_factory=dict)
    segments: dict[str, list[Part]] = field(default_factory=dict)
    offsets: list[dict] = field(default_factory=list)
    batches: list[dict] = field(default_factory=list)

    def folded(self, run: str, first: int, last: int) -> bool:
        return meets(self.ranges.get(run, []), first, last)


def _stamp(name: str) -> int:
    """When an attempt was recorded."""
    return int(_BATCH.fullmatch(name)[1])


def _micros(value: datetime | None) -> int | None:
    if value is None:
        return None
    whole = value.replace(tzinfo=timezone.utc) if value.tzinfo is None else value
    return int(whole.timestamp()) * 1_000_000 + whole.microsecond


def latest_offsets(noted: list[dict], more: list[dict]) -> list[dict]:
    """The last range of each topic and partition."""
    last = {(o["topic"], o["partition"]): o for o in noted}
    for o in more:
        held = last.get((o["topic"], o["partition"]))
        if held is None or o["until_offset"] >= held["until_offset"]:
            last[o["topic"], o["partition"]] = o
    return [last[k] for k in sorted(last)]


@dataclass(frozen=True)
class CommitLog:
    """The tables of one job below ``path``, by name."""

    path: str
    tables: dict[str, Kind]
    owns: bool = False

    # --- records -------------------------------------------------------
    def _log(self, name: str) -> str:
        return f"{self.path}/log/{name}"

    def _names(self, spark: SparkSession) -> tuple[str | None, dict[tuple[str, int, int], list[str]]]:
        """The last fold record, and the batch records by run and numbers, oldest attempt first."""
        fold, batches = None, {}
        for name, _ in files.names(spark, f"{self.path}/log"):
            if _FOLD.fullmatch(name):
                fold = name
            elif m := _BATCH.fullmatch(name):
                batches.setdefault((m[4], int(m[2]), int(m[3])), []).append(name)
        return fold, batches

    def state(self, spark: SparkSession, batches: bool = True) -> State:
        """The log as of now; without ``batches`` only what is folded, from one small file."""
        fold, names = self._names(spark)
        state = State()
        if fold:
            noted = files.read_json(spark, self._log(fold))
            state = State(noted["seq"], noted["until"], noted["ranges"], {t: [Part(**p) for p in parts] for t, parts in noted["segments"].items()},
                          noted["offsets"])
        if batches and self.owns:
            every = sorted(n for attempts in names.values() for n in attempts if _stamp(n) > state.until)
            state.batches = [files.read_json(spark, self._log(n)) | {"stamp": _stamp(n)} for n in every]
        elif batches:
            for (run, first, last), attempts in sorted(names.items()):
                if not state.folded(run, first, last):
                    state.batches.append(files.read_json(spark, self._log(attempts[-1])))
        return state

    # --- writing -------------------------------------------------------
    def _store(self, rows: DataFrame, name: str, folder: str) -> Part:
        zone, seen = self.tables[name].zone, Observation()
        ends = [F.min(zone).alias("lo"), F.max(zone).alias("hi")] if zone else []
        watched = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *ends)
        path = f"data/{name}/{folder}"
        kind = self.tables[name]
        order = kind.sort or ((zone,) if zone else ())
        options = {f"parquet.bloom.filter.enabled#{c}": "true" for c in kind.bloom}
        (watched.sortWithinPartitions(*order) if order else watched).write.options(**options).parquet(f"{self.path}/{path}")
        got = seen.get
        # a table without zone holds rows of any time
        lo, hi = (_micros(got["lo"]), _micros(got["hi"])) if zone else (None, None)
        part = Part(path, lo if got["rows"] else None, hi if got["rows"] else None, rows.schema.json())
        if kind.lookup:
            part.filter = f"data/{name}/{folder}.bloom"
            held = self._load(rows.sparkSession, name, [part])
            files.write_bytes(rows.sparkSession, f"{self.path}/{part.filter}", bloom.built(held, kind.lookup, got["rows"]))
        return part

    def write(self, spark: SparkSession, frames: dict[str, Rows], batch_id: int, run: str = "0",
              last: int | None = None, offsets: list[dict] | None = None) -> None:
        """Write the tables of a batch, in order, then its record.

        A table may be given as a function, called when those before it are written; none means no rows.
        With ``last``, the batch stands for the numbers from ``batch_id`` to it.  A batch that is folded,
        or that another one shares a part of its numbers with, cannot be written: an error.
        """
        last = batch_id if last is None else last
        fold, names = self._names(spark)
        if not self.owns and fold and meets(files.read_json(spark, self._log(fold))["ranges"].get(run, []), batch_id, last):
            raise ValueError(f"batch {batch_id} of run {run} was folded already in {self.path}")
        if not self.owns and any(r == run and a <= last and b >= batch_id and (a, b) != (batch_id, last) for r, a, b in names):
            raise ValueError(f"another batch of run {run} has some of {batch_id} to {last} in {self.path}")
        folder = f"b-{batch_id}-{uuid.uuid4().hex[:12]}"
        parts = {}
        for name, given in frames.items():
            rows = given() if callable(given) else given
            if rows is not None:
                parts[name] = self._store(self.tables[name].entry(rows, run, batch_id), name, folder).__dict__
        record = {"run": run, "first": batch_id, "last": last, "tables": parts, "offsets": offsets or []}
        files.write_json(spark, self._log(f"b.{time.time_ns():019d}.{batch_id}.{last}.{run}.json"), record)

    # --- reading -------------------------------------------------------
    def parts(self, state: State, name: str, start: datetime | None = None, end: datetime | None = None,
              before: int | None = None, run: str = "0") -> list[Part]:
        """Folders of a table with rows of ``[start, end)``, or without the batches of ``run`` from ``before`` on."""
        if before is not None and state.folded(run, before, 1 << 62):
            raise ValueError(f"batches of run {run} from {before} on were folded already in {self.path}")
        found = self._held(state.segments.get(name, []), state.batches)
        for i, b in enumerate(state.batches):
            if name in b["tables"] and (before is None or b["run"] != run or b["first"] < before):
                found += self._held([Part(**b["tables"][name])], state.batches[i + 1:])
        if self.tables[name].zone is None:
            return found
        lo, hi = _micros(start), _micros(end)
        return [p for p in found if p.holds(lo, hi)]

    def _held(self, parts: list[Part], newer: list[dict]) -> list[Part]:
        """Parts without the slices that newer batches own; those with nothing left are left out."""
        if not self.owns:
            return list(parts)
        out = []
        for p in parts:
            gone = p.gone
            for b in newer:
                if p.lo is not None and b["first"] <= p.hi and b["last"] >= p.lo:
                    gone = added(gone, b["first"], b["last"])
            if p.lo is not None and not any(a <= p.lo and b >= p.hi for a, b in gone):
                out.append(replace(p, gone=gone))
        return out

    def _load(self, spark: SparkSession, name: str, parts: list[Part]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(parts[0].schema))
        whole = [f"{self.path}/{p.folder}" for p in parts if not p.gone]
        frames = [spark.read.schema(schema).parquet(*whole)] if whole else []
        for p in parts:
            if p.gone:
                zone = self.tables[name].zone
                held = " AND ".join(f"NOT ({zone} BETWEEN timestamp_micros({a}) AND timestamp_micros({b}))" for a, b in p.gone)
                frames.append(spark.read.schema(schema).parquet(f"{self.path}/{p.folder}").where(held))
        return reduce(DataFrame.unionByName, frames)

    def read(self, spark: SparkSession, name: str, empty: T.StructType | None = None, start: datetime | None = None,
             end: datetime | None = None, before: int | None = None, run: str = "0") -> DataFrame:
        """Rows of a table, those of ``[start, end)`` (UTC) if given; ``empty`` is the schema while there are none."""
        kind = self.tables[name]
        parts = self.parts(self.state(spark), name, start, end, before, run)
        if not parts:
            if empty is None:
                raise ValueError(f"no batch of {name} in {self.path}")
            return spark.createDataFrame([], empty)
        entries = self._load(spark, name, parts)
        for bound, sign in ((start, ">="), (end, "<")):
            if bound is not None:
                entries = entries.where(f"{kind.zone} {sign} timestamp_micros({_micros(bound)})")
        return kind.rows(entries)

    def read_run(self, spark: SparkSession, name: str, run: str, schema: T.StructType) -> DataFrame:
        """What one run wrote to a table, while it is not folded; none behind that."""
        parts = [Part(**b["tables"][name]) for b in self.state(spark).batches if b["run"] == run and name in b["tables"]]
        if not parts:
            return spark.createDataFrame([], schema)
        return self._load(spark, name, parts).select(*schema.names)

    def offsets(self, spark: SparkSession) -> list[dict]:
        """The last offset range of each topic and partition that a committed batch has read."""
        state = self.state(spark)
        noted = state.offsets
        for b in state.batches:
            noted = latest_offsets(noted, b["offsets"])
        return noted

    def write_span(self, rows: DataFrame, start: datetime, end: datetime) -> None:
        """Replace what an owning log of one table holds of ``[start, end)`` (UTC), also by no rows."""
        (name,) = self.tables
        self.write(rows.sparkSession, {name: rows}, _micros(start), "span", _micros(end) - 1)

    def find(self, spark: SparkSession, name: str, keys: DataFrame, empty: T.StructType, before: int | None = None,
             run: str = "0") -> tuple[DataFrame, DataFrame]:
        """Rows of a table from the folders that may hold some of ``keys``, and the keys that no folder holds for sure.

        ``keys`` has one column, the looked-up one, and is small enough to be kept; the folders'
        Bloom filters say no only where a key is not there, so none is lost.
        """
        parts = [p for p in self.parts(self.state(spark), name, before=before, run=run) if p.filter]
        tests = [bloom.holds(F.col(keys.columns[0]), files.read_bytes(spark, f"{self.path}/{p.filter}")) for p in parts]
        if not parts:
            return spark.createDataFrame([], empty), keys
        hits = keys.agg(*[F.count_if(t).alias(f"p{i}") for i, t in enumerate(tests)]).first()
        opened = [p for i, p in enumerate(parts) if hits[i]]
        nowhere = keys.where(~reduce(lambda a, b: a | b, tests))
        if not opened:
            return spark.createDataFrame([], empty), nowhere
        return self.tables[name].rows(self._load(spark, name, opened)), nowhere

    def span(self, spark: SparkSession, name: str) -> tuple[datetime, datetime] | None:
        """The smallest and the largest slice (UTC) of a table with a zone, from the records alone."""
        parts = [p for p in self.parts(self.state(spark), name) if p.lo is not None]
        if not parts:
            return None
        at = lambda micros: datetime(1970, 1, 1) + timedelta(microseconds=micros)
        return at(min(p.lo for p in parts)), at(max(p.hi for p in parts))

    # --- folding -------------------------------------------------------
    def fold(self, spark: SparkSession, keep: int = 0, everything: bool = False, least: int = 2) -> int | None:
        """Merge open batches, and full levels; how many folders went in, if any did.

        The newest ``keep`` batches of each run stay open, since a stream may have to write its
        last one again.  With ``everything`` all segments become one.
        """
        state = self.state(spark)
        newest: dict[str, list[int]] = {}
        for b in state.batches:
            newest.setdefault(b["run"], []).append(b["first"])
        open_ = [b for b in state.batches if b["first"] not in (sorted(newest[b["run"]])[-keep:] if keep else [])]
        if self.owns:
            open_ = state.batches[:len(state.batches) - keep] if keep else state.batches
        old = max((len(s) for s in state.segments.values()), default=0) if everything else 0
        if len(open_) + old < least:
            return None
        seq, ranges, offsets = state.seq + 1, dict(state.ranges), state.offsets
        for b in open_:
            ranges[b["run"]] = added(ranges.get(b["run"], []), b["first"], b["last"])
            offsets = latest_offsets(offsets, b["offsets"])
        segments, stamp = {}, uuid.uuid4().hex[:12]
        for name in self.tables:
            held = self._held(state.segments.get(name, []), open_)
            fresh = [p for i, b in enumerate(open_) if name in b["tables"]
                     for p in self._held([Part(**b["tables"][name])], open_[i + 1:])]
            level = max([p.level for p in held], default=-1) + 1 if everything else 0
            merged, rest = (fresh + held, []) if everything else (fresh, held)
            while merged and len(same := [p for p in rest if p.level == level]) + 1 >= FANOUT:
                merged, rest, level = merged + same, [p for p in rest if p.level != level], level + 1
            if merged:
                part = self._store(self.tables[name].merge(self._load(spark, name, merged)), name, f"s-{seq}-{level}-{stamp}")
                part.level = level
                rest = [*rest, part]
            segments[name] = [p.__dict__ for p in rest]
        files.write_json(spark, self._log(f"f.{seq:012d}.json"), {
            "seq": seq, "until": max([state.until, *(b["stamp"] for b in open_)]) if self.owns else -1, "ranges": ranges, "segments": segments, "offsets": offsets})
        self._forget(spark)
        return len(open_) + old

    def _forget(self, spark: SparkSession) -> None:
        """Remove records that newer ones replace."""
        state = self.state(spark, batches=False)
        fold, names = self._names(spark)
        gone = [n for n, _ in files.names(spark, f"{self.path}/log") if _FOLD.fullmatch(n) and n != fold]
        for (run, first, last), attempts in names.items():
            if self.owns:
                gone += [n for n in attempts if _stamp(n) <= state.until]
            else:
                gone += attempts if state.folded(run, first, last) else attempts[:-1]
        for name in gone:
            files.remove(spark, self._log(name))

    def vacuum(self, spark: SparkSession, age: float = 86_400.0) -> int:
        """Remove data folders that no record names and that are older than ``age`` seconds; how many.

        The age spares batches that are being written and readers that have listed before a fold.
        """
        state = self.state(spark)
        named = {p.folder for parts in state.segments.values() for p in parts}
        named |= {p["folder"] for b in state.batches for p in b["tables"].values()}
        until, gone = (time.time() - age) * 1000, 0
        for table, _ in files.names(spark, f"{self.path}/data"):
            for folder, written in files.names(spark, f"{self.path}/data/{table}"):
                if f"data/{table}/{folder.removesuffix('.bloom')}" not in named and written < until:
                    files.remove(spark, f"{self.path}/data/{table}/{folder}")
                    gone += 1
        return gone
