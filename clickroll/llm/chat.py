"""Chat formatting: conversations as windows of a token budget, with a loss mask.

A turn is written as ``### role: text</turn>`` and a line feed; a backslash before
``\\``, ``#``, ``:`` in roles and ``</turn>`` keeps control strings inside texts apart
from the template, and is taken off on reading.

Prefix sums of turn tokens choose the windows: as many whole turns as the budget holds.
A later window begins with the system turn and with as many whole turns of history as
the history budget holds; these are repeats, and their targets are masked.  The loss
mask holds the text of each assistant turn once.

A conversation is a sequence, so its turns are sorted and go through one task; the task
holds a window of them at a time, however long the conversation is.

Defined cases: a null text or role is empty; turns of equal number are ordered by role,
then text; a null turn number comes first and a null conversation id is a conversation
of its own; a turn longer than the budget is a window of its own (behind the system
turn), whole; no rows give no windows.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickroll.llm.common import query, rows_of, table
from clickroll.llm.token_files import worker_encoder
from clickroll.session import stored

BUDGET = 1024
"""Tokens of a window."""
HISTORY = 256
"""Tokens of repeated turns at the start of a window, the system turn aside."""

END = "</turn>\n"
_CONTROL = re.compile(r"[\\#]|</turn>")
_ROLE_CONTROL = re.compile(r"[\\#:]|</turn>")
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.|<(?!/turn>))*)</turn>\n", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str, control: re.Pattern = _CONTROL) -> str:
    return control.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def turn_head(role: str) -> str:
    return f"### {escape(role, _ROLE_CONTROL)}: "


def parsed(text: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start, end) of the turns of a window; the offsets hold the escaped text."""
    at = 0
    while at < len(text):
        m = _TURN.match(text, at)
        if not m:
            raise ValueError(f"no turn at character {at}")
        yield unescape(m[1]), unescape(m[2]), m.start(2), m.end(2)
        at = m.end()


@dataclass
class Turn:
    role: str
    head: str
    body: str
    tokens: int

    @property
    def text(self) -> str:
        return self.head + self.body + END


@dataclass
class ChatWindow:
    """Formatted text; turns repeated at its start; spans of the text under the loss."""

    text: str
    repeated: int
    turns: int
    tokens: int
    loss: list[tuple[int, int]] = field(default_factory=list)


def _window(repeats: list[Turn], new: list[Turn], target: str) -> ChatWindow:
    out = ChatWindow("", len(repeats), len(repeats) + len(new), sum(t.tokens for t in repeats + new))
    at, parts = 0, []
    for i, t in enumerate(repeats + new):
        if i >= len(repeats) and t.role == target:
            out.loss.append((at + len(t.head), at + len(t.head) + len(t.body)))
        parts.append(t.text)
        at += len(t.text)
    out.text = "".join(parts)
    return out


def windows(turns: Iterator[Turn], budget: int = BUDGET, history: int = HISTORY,
            target: str = "assistant") -> Iterator[ChatWindow]:
    """Windows of one conversation; holds the turns of the current one."""
    system: list[Turn] = []       # at the start of every window; new in the first
    repeats: list[Turn] = []
    new: list[Turn] = []
    used, first = 0, True

    def window() -> ChatWindow:
        if first:
            return _window([], system + new, target)
        return _window(system + repeats, new, target)

    for k, turn in enumerate(turns):
        if k == 0 and turn.role == "system":
            system, used = [turn], turn.tokens
            continue
        if new and used + turn.tokens > budget:
            yield window()
            first = False
            past = repeats + new
            sums = [0, *itertools.accumulate(t.tokens for t in past)]
            # as much history as fits its own budget and leaves room for the turn
            fixed = sum(t.tokens for t in system)
            room = min(history, budget - fixed - turn.tokens)
            repeats = past[bisect_left(sums, sums[-1] - room):] if room > 0 else []
            new, used = [], fixed + sum(t.tokens for t in repeats)
        new.append(turn)
        used += turn.tokens
    if new or (system and first):
        yield window()


_SCHEMA = "conv {kind}, window int, repeated int, turns int, tokens int, text string, loss array<struct<a:int,b:int>>"


def format_conversations(rows: DataFrame, tokenizer: bytes, *, key: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text", budget: int = BUDGET, history: int = HISTORY,
                         target: str = "assistant") -> DataFrame:
    """Windows of all conversations.

    Columns: ``conv``, ``window`` (from 0), ``repeated`` and ``turns`` (turns at its start that
    stand in an earlier window; all turns), ``tokens``, ``text``, and ``loss`` (spans of
    characters of ``text``).
    """
    ordered = rows.select(
        F.col(key).alias("conv"), F.col(turn).alias("_n"), F.coalesce(role, F.lit("")).alias("_r"),
        F.coalesce(text, F.lit("")).alias("_t"))
    kind = ordered.schema["conv"].dataType
    ordered = ordered.repartition("conv").sortWithinPartitions("conv", "_n", "_r", "_t")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        encoder = worker_encoder(tokenizer)
        for conv, r, t in rows_of(batches, "conv", "_r", "_t"):
            head, body = turn_head(r), escape(t)
            yield conv, Turn(r, head, body, len(encoder.encode(head + body + END)) // encoder.width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        for conv, turns in itertools.groupby(counted(batches), key=lambda x: x[0]):
            for n, w in enumerate(windows((t for _, t in turns), budget, history, target)):
                out.append((conv, n, w.repeated, w.turns, w.tokens, w.text, [{"a": a, "b": b} for a, b in w.loss]))
                size += len(w.text)
                if size > 4 << 20:
                    yield _batch(out)
                    out, size = [], 0
        if out:
            yield _batch(out)

    spans = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
    from pyspark.sql.pandas.types import to_arrow_type
    kinds = [to_arrow_type(kind), *[pa.int32()] * 4, pa.string(), spans]
    names = ["conv", "window", "repeated", "turns", "tokens", "text", "loss"]

    def _batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return ordered.select("conv", "_r", "_t").mapInArrow(run, _SCHEMA.format(kind=kind.simpleString()))


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from its windows: turns, what lies under the loss, and their digests."""
    kind = formatted.schema["conv"].dataType
    ordered = formatted.repartition("conv").sortWithinPartitions("conv", "window").select("conv", "repeated", "text", "loss")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv, found in itertools.groupby(rows_of(batches, "conv", "repeated", "text", "loss"), key=lambda x: x[0]):
            n, chars, formatted_chars, turns, loss = 0, 0, 0, hashlib.sha256(), hashlib.sha256()
            for _, repeated, text, spans in found:
                formatted_chars += len(text)
                for k, (role, body, _, _) in enumerate(parsed(text)):
                    if k >= repeated:
                        turns.update(f"{role}\n{body}\n".encode())
                        n += 1
                for span in spans:
                    part = unescape(text[span["a"]:span["b"]])
                    chars += len(part)
                    loss.update(part.encode())
            out.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), formatted_chars))
            if len(out) >= 4_096:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    from pyspark.sql.pandas.types import to_arrow_type
    kinds = [to_arrow_type(kind), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def _batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return ordered.mapInArrow(run, (
        f"conv {kind.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long"))


@query("op8_chat")
def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as file:
        tokenizer = file.read()
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    # a conversation that repeats the template's own marks
    marks = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return read_back(stored(format_conversations(rows.union(marks), tokenizer), "chat")).withColumnRenamed("conv", "conv_id")
