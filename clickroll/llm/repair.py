"""Conversation structure repair: cheapest edits by a parallel Viterbi with rank convergence.

The turns of a conversation must read ``(s?(ua)+)?`` by the initials of their roles.  Rows
are kept, given another role, deleted, and empty turns are inserted; the cheapest edits are a
path through four states (nothing yet, behind s, u or a), found by costs from the end
backwards and traced from the start, among equal costs by the least letters.

Turns are sorted by ranges, not by conversation, so a long conversation lies in many tasks,
as chunks of consecutive turns.  Each chunk starts from a cost vector that is known only for
the last one and a guess for the others.  Fix-up passes run the chunks again whose right
neighbour came to another vector, and stop early: once old and new costs differ by a
constant alone, so do all before.  They end when no chunk differs.  The chunks' own traces
say which state each state leads to; chained, they give each chunk its first state, and
the edits are traced in all chunks at once.

Defined cases: turns come in order, without number first, then by role and hash of the text
where numbers repeat; null role or text is one blank; a null conversation is one of its own; a role
that does not begin with s, u or a cannot be kept; equal rows beyond the first are
duplicates; an empty table has no conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickroll.llm.common import query, rows_of, table
from clickroll.session import stored

CHUNK_BITS = 12
"""A chunk has 4,096 turns at most."""
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
"""Costs of edits; a truncated row that is not deleted adds the last."""
ENDS = ".!?"
BLANKS = " \t\n\x0b\x0c\r"

_INITIALS = "sua"
_SAY = (("u", 2), ("u", 2), ("a", 3), ("u", 2))
"""By state: the role that an inserted or renamed turn gets, and the state behind it."""
_KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_LAST = (0, 2 * INSERT, INSERT, 0)
"""Costs behind the last turn."""
_NAMES = {"u": "user", "a": "assistant"}


class _Costs:
    """Cost vectors without their constants, and what the turns do to them, each worked out once."""

    def __init__(self) -> None:
        self.steps: dict[tuple, tuple] = {}
        self.moves: dict[tuple, tuple] = {}

    @staticmethod
    def _row(code: str) -> tuple[str, bool, int]:
        fault, initial = divmod(ord(code) - ord("a"), 4)
        return (_INITIALS + "-")[initial], fault == 1, TRUNCATED if fault == 2 else 0

    def _before(self, after: tuple, code: str) -> list[int]:
        initial, must, more = self._row(code)
        costs = []
        for q in range(4):
            least = DELETE + after[q]
            if not must:
                least = min(least, REROLE + more + after[_SAY[q][1]])
                if initial in _KEPT[q]:
                    least = min(least, KEEP + more + after[_KEPT[q][initial]])
            costs.append(least)
        two, three = min(costs[2], INSERT + costs[3]), min(costs[3], INSERT + costs[2])
        return [min(costs[0], INSERT + two), min(costs[1], INSERT + two), two, three]

    def step(self, after: tuple, code: str) -> tuple:
        """Costs in front of a turn, less their least."""
        key = after, code
        found = self.steps.get(key)
        if found is None:
            costs = self._before(after, code)
            least = min(costs)
            found = self.steps[key] = tuple(c - least for c in costs)
        return found

    def move(self, after: tuple, code: str, q: int) -> tuple[str, int, int, str]:
        """Edits up to and with a turn from state ``q``: their letters, the state behind, cost, and roles said."""
        key = after, code, q
        found = self.moves.get(key)
        if found is None:
            found = self.moves[key] = self._move(after, code, q)
        return found

    def _move(self, after: tuple, code: str, q: int) -> tuple[str, int, int, str]:
        initial, must, more = self._row(code)
        costs = self._before(after, code)
        letters, spent, said = "", 0, ""
        while True:
            if DELETE + after[q] == costs[q]:
                return letters + "D", q, spent + DELETE, said + "-"
            role, then = _SAY[q]
            if INSERT + costs[then] == costs[q]:
                letters, q, spent, said = letters + "I", then, spent + INSERT, said + role
                continue
            kept = _KEPT[q].get(initial)
            if not must and kept is not None and KEEP + more + after[kept] == costs[q]:
                return letters + "K", kept, spent + KEEP + more, said + "k"
            return letters + "R", then, spent + REROLE + more, said + role

    def vectors(self, codes: str, after: tuple) -> list[tuple]:
        """Costs behind each turn, first turn first, with those in front of the first at index 0."""
        found = [after]
        for code in reversed(codes):
            found.append(self.step(found[-1], code))
        found.reverse()
        return found

    def front(self, codes: str, after: tuple, old: tuple | None = None, known: tuple | None = None) -> tuple:
        """Costs in front of a chunk; ``known`` if the costs meet those that come from ``old``."""
        for code in reversed(codes):
            if after == old:
                return known
            after = self.step(after, code)
            old = self.step(old, code) if old is not None else None
        return after

    def trace(self, codes: str, after: tuple, q: int, last: bool) -> tuple[list[str], int, int, list[str]]:
        """Letters, last state, cost and roles said, a piece for each turn."""
        vectors = self.vectors(codes, after)
        letters, said, spent = [], [], 0
        for i, code in enumerate(codes):
            piece, q, cost, roles = self.move(vectors[i + 1], code, q)
            letters.append(piece)
            said.append(roles)
            spent += cost
        while last and _LAST[q]:
            role, q = _SAY[q]
            letters.append("I")
            said.append(role)
            spent += INSERT
        return letters, q, spent, said


def _bare(text: Column) -> Column:
    """A text without the blanks at its end."""
    return F.rtrim(text, F.lit(BLANKS))


def _sorted_turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows in order, numbered by ``at``: neighbours of a task follow each other, tasks are ranges."""
    spark = conversations.sparkSession
    held = F.col(conv).cast("string")
    rows = conversations.select(
        F.when(held.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), held)).alias("k"),
        F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"))
    # rows that are equal otherwise are told apart by where they stand, so a range can end among them
    keyed = rows.withColumns({"h": F.xxhash64("text"), "s": F.monotonically_increasing_id()})
    order = ["k", "turn", "role", "h", "s"]
    spread = keyed.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
    return stored(spread.sortWithinPartitions(*order).drop("h", "s").withColumn("at", F.monotonically_increasing_id()), "turns")


def _faults(turns: DataFrame) -> DataFrame:
    """``(k, at, turn, initial, fault)``: 1 blank, 2 duplicate, 3 truncated, else 0."""
    bare = _bare(F.col("text"))
    rows = turns.select("k", "at", "turn", "role", F.sha2(F.col("text").cast("binary"), 256).alias("digest"),
                        F.substring("role", 1, 1).alias("initial"), (bare == "").alias("blank"),
                        (~F.substring(bare, -1, 1).isin(*ENDS)).alias("cut"))
    said = rows.groupBy("k", "role", "digest").agg(F.min("at").alias("first"), F.count("*").alias("times"))
    again = said.where("times > 1").drop("times")
    fault = F.when(F.col("blank"), 1).when(F.col("at") > F.col("first"), 2).when(F.col("cut"), 3).otherwise(0)
    return rows.join(again, ["k", "role", "digest"], "left").select("k", "at", "turn", "initial", fault.alias("fault"))


_CHUNK = "k string, c long, first long, codes string, last boolean, back array<int>, front array<int>"


def _chunks(faults: DataFrame) -> DataFrame:
    """Chunks of consecutive turns, one letter a turn, with guessed costs behind all but the last."""
    kind = F.when(F.col("fault").isin(1, 2), 4).when(F.col("fault") == 3, 8).otherwise(0)
    initial = F.coalesce(*[F.when(F.col("initial") == x, i) for i, x in enumerate(_INITIALS)], F.lit(3))
    rows = faults.select("k", F.shiftright("at", CHUNK_BITS).alias("c"), "at", F.char(kind + initial + ord("a")).alias("code"))
    listed = rows.groupBy("k", "c").agg(F.array_sort(F.collect_list(F.struct("at", "code"))).alias("turns"))
    ends = rows.groupBy("k").agg(F.max("c").alias("end"))
    codes = listed.join(ends, "k").select(
        "k", "c", F.col("turns")[0]["at"].alias("first"), F.array_join("turns.code", "").alias("codes"),
        (F.col("c") == F.col("end")).alias("last"))

    def guess(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = _Costs()
        for batch in batches:
            front = [list(costs.front(c, _LAST)) for c in batch.column("codes").to_pylist()]
            back = pa.array([list(_LAST)] * batch.num_rows, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, back, pa.array(front, pa.list_(pa.int32()))],
                                             [*batch.schema.names, "back", "front"])

    return stored(codes.mapInArrow(guess, _CHUNK), "chunks")


def _settled(chunks: DataFrame) -> tuple[DataFrame, int]:
    """Chunks whose costs behind are those in front of their right neighbour, and the passes this took."""
    order = Window.partitionBy("k").orderBy("c")
    passes = 0

    def fix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = _Costs()
        for batch in batches:
            out = batch.to_pylist()
            for row in out:
                new = row.pop("new")
                if new is not None:
                    row["front"] = list(costs.front(row["codes"], tuple(new), tuple(row["back"]), tuple(row["front"])))
                    row["back"] = new
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([f for f in batch.schema if f.name != "new"]))

    while True:
        near = chunks.select("k", "c", "back", F.lead("front").over(order).alias("new"))
        stale = near.where("new IS NOT NULL AND new <> back").select("k", "c", "new")
        if stale.isEmpty():
            return chunks, passes
        passes += 1
        chunks = stored(chunks.join(stale, ["k", "c"], "left").mapInArrow(fix, _CHUNK), "chunks")


def _entered(chunks: DataFrame) -> DataFrame:
    """Chunks with the state that the trace enters each in, from the states each state leads to."""
    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = _Costs()
        for batch in batches:
            exits = [[costs.trace(codes, tuple(back), q, last)[1] for q in range(4)]
                     for codes, last, back in rows_of([batch], "codes", "last", "back")]
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("c"), pa.array(exits, pa.list_(pa.int32()))],
                                             ["k", "c", "exits"])

    exits = chunks.mapInArrow(lead, "k string, c long, exits array<int>")
    chain = exits.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("c", "exits"))).alias("chain"))
    begin = F.struct(F.lit(0).alias("q"), F.array().cast("array<struct<c:bigint,q:int>>").alias("seen"))
    walked = F.aggregate("chain", begin, lambda s, x: F.struct(
        F.get(x["exits"], s["q"]).alias("q"),
        F.concat(s["seen"], F.array(F.struct(x["c"].alias("c"), s["q"].alias("q")))).alias("seen")))["seen"]
    # most conversations are one chunk: these need no chain
    entries = chain.where(F.size("chain") > 1).select("k", F.inline(walked))
    return chunks.join(entries, ["k", "c"], "left").withColumn("q", F.coalesce("q", F.lit(0)))


_TRACE = "k string, c long, first long, letters string, cost long, illegal long, head string, tail string, " \
    "ats array<bigint>, hows array<string>"


def _traced(chunks: DataFrame) -> DataFrame:
    """Edits of each chunk: letters, cost, and the turns it leaves (``at``, null where inserted, and the role)."""
    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = _Costs()
        for k, c, first, codes, last, back, q in rows_of(batches, "k", "c", "first", "codes", "last", "back", "q"):
            letters, _, spent, said = costs.trace(codes, tuple(back), q, last)
            ats, hows = [], []
            for i, roles in enumerate(said):
                for role in roles[:-1] if i < len(codes) else roles:
                    ats.append(None)
                    hows.append(role)
                if i < len(codes) and roles[-1] != "-":
                    ats.append(first + i)
                    hows.append(roles[-1])
            kinds = [(_INITIALS + "-")[(ord(x) - ord("a")) % 4] for x in codes]
            bad = sum(x + y not in ("su", "ua", "au") for x, y in zip(kinds, kinds[1:]))
            yield pa.RecordBatch.from_pydict({
                "k": [k], "c": [c], "first": [first], "letters": ["".join(letters)], "cost": [spent], "illegal": [bad],
                "head": [kinds[0]], "tail": [kinds[-1]], "ats": pa.array([ats], pa.list_(pa.int64())),
                "hows": pa.array([hows], pa.list_(pa.string()))})

    return stored(chunks.mapInArrow(trace, _TRACE), "edits")


def _gaps(faults: DataFrame) -> DataFrame:
    turns = faults.where("turn IS NOT NULL").groupBy("k", "turn").agg(F.lit(1)).groupBy("k").agg(
        F.min("turn").alias("lo"), F.max("turn").alias("hi"), F.count("*").alias("n"))
    wide = F.expr("try_cast(cast(hi AS decimal(38,0)) - lo + 1 - n AS bigint)")
    return turns.select("k", wide.alias("gaps"))


def repair_conversations(conversations: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> tuple[DataFrame, DataFrame]:
    """A report row for each conversation of ``conversations``, and the repaired turns.

    The report has ``k`` (see ``conversation_key``), ``gaps, blank, duplicate, truncated, illegal,
    cost`` and ``audit``, the initials of the edits in order.  The turns are ``k, c, i, role, text``;
    ``c, i`` is their order.
    """
    turns = _sorted_turns(conversations, conv, turn, role, text)
    faults = stored(_faults(turns), "faults")
    chunks, _ = _settled(_chunks(faults))
    edits = _traced(_entered(chunks))

    counts = faults.groupBy("k").agg(*[
        F.count_if(F.col("fault") == i + 1).alias(name) for i, name in enumerate(("blank", "duplicate", "truncated"))])
    order = Window.partitionBy("k").orderBy("c")
    met = F.concat(F.lag("tail").over(order), F.col("head"))
    seams = edits.select("k", "cost", "illegal", F.coalesce((~met.isin("su", "ua", "au")).cast("long"), F.lit(0)).alias("seam"))
    sums = seams.groupBy("k").agg(F.sum("cost").alias("cost"), F.sum(F.col("illegal") + F.col("seam")).alias("illegal"))
    audits = edits.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("c", "letters"))).alias("p")).select(
        "k", F.array_join("p.letters", "").alias("audit"))
    report = counts.join(sums, "k").join(audits, "k").join(_gaps(faults), "k", "left").select(
        "k", F.coalesce("gaps", F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    plan = edits.select("k", "c", F.posexplode(F.arrays_zip(F.col("ats").alias("at"), F.col("hows").alias("how"))).alias("i", "x"))
    plan = plan.select("k", "c", "i", "x.at", "x.how")
    kept = plan.where("at IS NOT NULL").join(turns.select("at", "role", "text"), "at")
    named = F.coalesce(*[F.when(F.col("how") == x, n) for x, n in _NAMES.items()])
    left = kept.select("k", "c", "i", F.coalesce(named, F.col("role")).alias("role"), "text")
    return report, left.unionAll(plan.where("at IS NULL").select("k", "c", "i", named.alias("role"), F.lit("").alias("text")))


def conversation_key(conv: Column) -> Column:
    """What ``repair_conversations`` calls a conversation."""
    return F.coalesce(F.concat(F.lit("v"), conv.cast("string")), F.lit("n"))


def _digests(lines: DataFrame) -> DataFrame:
    """SHA-256 of the repaired turns of each conversation, a turn at a time.

    Such a digest is a sequence by nature: the turns of a conversation pass one task, which holds none of them.
    """
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, keys, sums = None, None, [], []

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(sums, pa.string())], ["k", "repaired_sha256"])
            keys.clear()
            sums.clear()
            return made

        for k, role, text in rows_of(batches, "k", "role", "text"):
            if k != now:
                if state is not None:
                    keys.append(now)
                    sums.append(state.hexdigest())
                    if len(keys) >= 1000:
                        yield out()
                now, state = k, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(f"{role}:".encode())
            state.update(text.encode())
        if state is not None:
            keys.append(now)
            sums.append(state.hexdigest())
        yield out()

    return lines.repartition("k").sortWithinPartitions("k", "c", "i").select("k", "role", "text").mapInArrow(
        digest, "k string, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with the faults of the contract: by the CRC-32 of conversation and turn."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", name("role").alias("role"), name("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")).drop("_copy")


@query("op12_repair")
def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    report, lines = repair_conversations(damaged(rows))
    every = rows.select("conv_id").distinct().withColumn("k", conversation_key(F.col("conv_id")))
    sums = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(report, "k", "left").join(_digests(lines), "k", "left").select(
        "conv_id", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in sums],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
