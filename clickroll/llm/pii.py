"""Personal data: patterns, and a skip-chain conditional random field over what they leave.

Patterns find e-mail addresses, IP addresses, card and phone numbers.  The nodes of the
field are all number groups and words with an at sign of a document, each labelled with a
kind or none.  Neighbouring nodes share chain potentials; distant nodes that are
repeated or similar (equal words, equal last digits) share skip potentials.  Nodes a
pattern has found are observed; loopy message passing carries their labels over to
repeats the patterns miss, such as a phone number written again without its plus.

The potentials are learnt from the patterns' own labels by pseudo-likelihood, over at
most ``Settings.train_rows`` documents (those with the smallest hash of their id).  A
span is added only where the passing of messages ends with ``Settings.accept`` or more for
its kind and skip edges lead to an observed node, so documents without personal data
get no spans.

Defined cases: a null text is an empty one and has no spans; positions are code points;
a node that touches a span of a pattern is never added; a sample without nodes leaves
the potentials at their priors.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickroll.llm.common import query, rows_of, table

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_NODE = re.compile(r"[^\s@]*+@[^\s@]*+|\+?[0-9](?:[\x20().-]{0,2}[0-9])*")
_DIGITS = re.compile(r"[0-9]")

Span = tuple[int, int, int]
"""(start, end, kind)"""


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # From the at signs outward: the longest local part that an earlier match leaves, so
    # a long run of letters costs its length once.
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def pattern_spans(text: str) -> list[Span]:
    """Spans of the patterns, by start, then kind."""
    if not _ANY.search(text):
        return []
    out = [(a, b, 0) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 and not p[:-3].strip("0") for p in m[0].split(".")):
            out.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        digits = "".join(_DIGITS.findall(m[0]))
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), m.end(), 3))
    return sorted(out, key=lambda s: (s[0], s[2]))


@dataclass(frozen=True)
class Settings:
    train_rows: int = 2_000
    epochs: int = 200
    rate: float = 0.5
    decay: float = 1e-3
    rounds: int = 30
    damping: float = 0.3
    accept: float = 0.9
    key_digits: int = 7
    """Digits at the end that make two numbers similar."""


@dataclass
class Graph:
    """Nodes of a text: spans, features, observed kind (-1: none), and the edges between them."""

    spans: list[tuple[int, int]]
    features: np.ndarray
    observed: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


N_FEATURES = 12


def _features(node: str) -> list[float]:
    digits = sum(c.isdigit() for c in node)
    row = [0.0] * N_FEATURES
    row[0] = 1.0
    row[1 + bisect_left((3, 6, 9, 12, 15, 19), digits)] = 1.0
    row[8] = float("@" in node)
    row[9] = float(node.count(".") == 3)
    row[10] = float("-" in node or " " in node)
    row[11] = float(any(c.isalpha() for c in node))
    return row


def graph_of(text: str, found: list[Span], settings: Settings) -> Graph:
    """The field of a text.  Edges grow with the nodes: each to the one before and to its last like."""
    nodes = [(m.start(), m.end()) for m in _NODE.finditer(text)]
    observed = np.full(len(nodes), -1)
    starts = [a for a, _ in nodes]
    for a, b, kind in reversed(found):
        i = bisect_left(starts, a)
        i -= i > 0 and nodes[i - 1][1] > a
        while i < len(nodes) and nodes[i][0] < b:
            observed[i] = kind
            i += 1
    last: dict[str, int] = {}
    skip = []
    for i, (a, b) in enumerate(nodes):
        word = text[a:b]
        if "@" in word:
            key = "".join(filter(str.isalnum, word.lower()))
        else:
            digits = "".join(_DIGITS.findall(word))
            key = digits[-settings.key_digits:] if len(digits) >= settings.key_digits else ""
        if key:
            if key in last:
                skip.append((last[key], i))
            last[key] = i
    n = len(nodes)
    return Graph(nodes, np.array([_features(text[a:b]) for a, b in nodes]).reshape(n, N_FEATURES), observed,
                 np.stack([np.arange(n - 1), np.arange(1, n)], axis=1) if n > 1 else np.zeros((0, 2), np.int64),
                 np.array(skip, np.int64).reshape(-1, 2))


@dataclass
class Field:
    """Potentials: of features, of neighbouring kinds, and of like nodes with equal kind."""

    settings: Settings
    unary: np.ndarray
    chain: np.ndarray
    skip: float

    def marginals(self, g: Graph) -> np.ndarray:
        """Chances of each kind per node, by damped loopy message passing."""
        own = g.features @ self.unary
        seen = np.flatnonzero(g.observed >= 0)
        own[seen] = -1e4
        own[seen, g.observed[seen]] = 0
        same = np.eye(NONE + 1) * self.skip
        tables = np.concatenate([np.repeat(self.chain[None], len(g.chain), 0), np.repeat(same[None], len(g.skip), 0)])
        edges = np.concatenate([g.chain, g.skip])
        source = np.concatenate([edges[:, 0], edges[:, 1]])
        target = np.concatenate([edges[:, 1], edges[:, 0]])
        both = np.concatenate([tables, tables.transpose(0, 2, 1)])
        back = np.roll(np.arange(len(source)), len(edges))
        messages = np.zeros((len(source), NONE + 1))
        for _ in range(self.settings.rounds if len(source) else 0):
            belief = own.copy()
            np.add.at(belief, target, messages)
            out = _log_sum((belief[source] - messages[back])[:, :, None] + both, 1)
            out -= _log_sum(out, 1)[:, None]
            new = self.settings.damping * messages + (1 - self.settings.damping) * out
            done = np.abs(new - messages).max() < 1e-4
            messages = new
            if done:
                break
        belief = own
        np.add.at(belief, target, messages)
        return np.exp(belief - _log_sum(belief, 1)[:, None])

    def added(self, g: Graph) -> list[Span]:
        """Spans of nodes that no pattern found, led to by skip edges from one that a pattern did."""
        if not len(g.skip) or not (g.observed >= 0).any() or (g.observed >= 0).all():
            return []
        leader = list(range(len(g.spans)))
        for a, b in g.skip.tolist():        # in order, so one pass joins each run of likes
            leader[b] = leader[a]
        led = {leader[i] for i in np.flatnonzero(g.observed >= 0).tolist()}
        open_ = [i for i in range(len(leader)) if g.observed[i] < 0 and leader[i] in led]
        if not open_:
            return []
        chances = self.marginals(g)
        out = []
        for i in open_:
            kind = int(chances[i].argmax())
            if kind != NONE and chances[i, kind] >= self.settings.accept:
                out.append((*g.spans[i], kind))
        return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit(graphs: list[Graph], settings: Settings = Settings()) -> Field:
    """Pseudo-likelihood of each node's kind given features and the kinds around it."""
    k = NONE + 1
    field = Field(settings, np.zeros((N_FEATURES, k)), np.zeros((k, k)), 4.0)
    if not graphs:
        return field
    base = np.cumsum([0] + [len(g.spans) for g in graphs])
    x = np.concatenate([g.features for g in graphs])
    y = np.concatenate([np.where(g.observed < 0, NONE, g.observed) for g in graphs])
    chain = np.concatenate([g.chain + b for g, b in zip(graphs, base, strict=False)])
    skip = np.concatenate([g.skip + b for g, b in zip(graphs, base, strict=False)])
    n, truth = len(y), np.eye(k)[y]
    left, right, like = (np.zeros((n, k)) for _ in range(3))
    np.add.at(left, chain[:, 1], truth[chain[:, 0]])
    np.add.at(right, chain[:, 0], truth[chain[:, 1]])
    np.add.at(like, skip[:, 0], truth[skip[:, 1]])
    np.add.at(like, skip[:, 1], truth[skip[:, 0]])
    prior = field.skip
    for _ in range(settings.epochs):
        z = x @ field.unary + left @ field.chain + right @ field.chain.T + field.skip * like
        slope = (truth - np.exp(z - _log_sum(z, 1)[:, None])) / n
        field.unary += settings.rate * (x.T @ slope - settings.decay * field.unary)
        field.chain += settings.rate * (left.T @ slope + slope.T @ right - settings.decay * field.chain)
        field.skip += settings.rate * (float((like * slope).sum()) - settings.decay * (field.skip - prior))
    return field


def train(documents: DataFrame, settings: Settings = Settings(), *, key: str = "doc_id", text: str = "text") -> Field:
    """Learn the potentials from at most ``settings.train_rows`` documents."""
    ids = documents.select(F.col(key).alias("_k")).where(F.col("_k").isNotNull()).distinct()
    # at most train_rows ids: small enough to send to every task
    chosen = F.broadcast(ids.orderBy(F.xxhash64("_k"), "_k").limit(settings.train_rows))
    rows = documents.select(F.col(key).alias("_k"), F.col(text).alias("_t")).join(chosen, "_k")

    def graphs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, t in rows_of(batches, "_k", "_t"):
            g = graph_of(t or "", pattern_spans(t or ""), settings)
            if g.spans:
                yield pa.RecordBatch.from_pydict({
                    "k": pa.array([str(k)]), "x": pa.array([g.features.astype("<f8").tobytes()], pa.binary()),
                    "y": pa.array([g.observed.astype("<i8").tobytes()], pa.binary()),
                    "s": pa.array([g.skip.astype("<i8").tobytes()], pa.binary())})

    found = sorted(rows.mapInArrow(graphs, "k string, x binary, y binary, s binary").collect(),
                   key=lambda r: (r.k, bytes(r.x)))
    out = []
    for r in found:
        y = np.frombuffer(r.y, "<i8")
        n = len(y)
        out.append(Graph([(0, 0)] * n, np.frombuffer(r.x, "<f8").reshape(n, N_FEATURES), y,
                         np.stack([np.arange(n - 1), np.arange(1, n)], axis=1), np.frombuffer(r.s, "<i8").reshape(-1, 2)))
    return fit(out, settings)


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], s[2])))


def personal_data(text: Column, field: Field) -> Column:
    """A struct per text: number of spans by kind, the patterns' spans, and all spans, as text."""
    names = [f"n_{k}" for k in KINDS]

    @F.pandas_udf(", ".join(f"{n} long" for n in names) + ", base string, spans string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts.array:
                base = pattern_spans(t)
                more = field.added(graph_of(t, base, field.settings)) if base else []
                counts = [sum(s[2] == k for s in base) for k in range(NONE)]
                rows.append([*counts, spans_text(base), spans_text(base + more)])
            yield pd.DataFrame(rows, columns=[*names, "base", "spans"])

    return run(F.coalesce(text, F.lit("")))


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans are one."""
    out, at = [], 0
    for a, b, k in sorted(spans, key=lambda s: (s[0], s[2])):
        if a >= at:
            out += [text[at:a], f"[{KINDS[k]}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


@query("op7_pii")
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    found = documents.select("doc_id", personal_data(F.col("text"), train(documents)).alias("f"))
    return found.select(
        "doc_id", *[f"f.n_{k}" for k in KINDS],
        F.sha2(F.col("f.base").cast("binary"), 256).alias("base_sha256"), F.col("f.spans").alias("spans"))
