"""Benchmark decontamination with a positional inverted index of the training texts.

The index holds, per term and document, the positions of the term.  A pass over all
texts counts the terms of the benchmark; each window of a benchmark item is then looked
up from its rarest terms: their position lists, shifted by the offset in the item, are
intersected, and what is left is compared word by word with the text.  A window with a
term no text holds cannot occur and is not looked up.  Lists are kept for the terms that
some window is looked up by; positions that lie close together in any order are
proximity matches.

The benchmark is taken in blocks of bounded size, each with its own pass, so what tasks
and driver hold does not grow with it.

Defined cases: null and empty texts have no words; an item without words occurs
nowhere; a null item id hits words but is not listed; equal item ids are one item in
the list; rows of equal id and text are one document, and each gets its result.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickroll.llm.common import alnum_words, carried, encoded, query, rows_of, table
from clickroll.session import stored

WINDOW = 13
RAREST = 2
"""Terms a window is looked up by."""
SLACK = 13
"""Words by which a proximity match may be longer than its window."""
BLOCK_BYTES = 4 << 20
"""Benchmark text looked up in one pass; a longer item is a block of its own."""

_KEYED = "_id string, _h long, "


def words_of(text: str | None) -> list[bytes]:
    return alnum_words(encoded(text).lower())


def _blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """Items as (id, words), in blocks; the driver holds one block at a time."""
    block, size = [], 0
    for row in benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).alias("t")).toLocalIterator():
        words = words_of(row.t)
        if not words:
            continue
        if block and size + len(row.t) > block_bytes:
            yield block
            block, size = [], 0
        block.append((row.i, words))
        size += len(row.t)
    if block:
        yield block


def _windows(words: list[bytes], window: int) -> list[tuple[int, int]]:
    """(start, length) of the windows of an item."""
    return [(i, min(window, len(words))) for i in range(max(1, len(words) - window + 1))]


def _counts(rows: DataFrame, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """How often the texts hold each term of a block."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for (t,) in rows_of(batches, "_t"):
            found.update(filter(vocabulary.__contains__, words_of(t)))
        yield pa.RecordBatch.from_pydict({"term": pa.array(list(found), pa.binary()),
                                          "n": pa.array(list(found.values()), pa.int64())})

    sums = rows.select("_t").mapInArrow(count, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {bytes(r.term): r.n for r in sums.collect()}      # at most the terms of a block


def _postings(rows: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """The index: positions by term and document; term -1 carries the number of words."""
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        for d, h, t in rows_of(batches, "_id", "_h", "_t"):
            words = words_of(t)
            lists: dict[int, list[int]] = defaultdict(list)
            lists[-1].append(len(words))
            for at, w in enumerate(words):
                if w in terms:
                    lists[terms[w]].append(at)
            out += [(d, h, k, v) for k, v in lists.items()]
            size += sum(map(len, lists.values()))
            if size > 200_000:
                yield _batch(out)
                out, size = [], 0
        yield _batch(out)

    def _batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "_id": pa.array([r[0] for r in out], pa.string()), "_h": pa.array([r[1] for r in out], pa.int64()),
            "term": pa.array([r[2] for r in out], pa.int32()),
            "positions": pa.array([r[3] for r in out], pa.list_(pa.int32()))})

    return rows.mapInArrow(index, _KEYED + "term int, positions array<int>")


def intersect(lists: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Positions s such that each list (offset, positions) holds s + offset, shortest list first."""
    lists = sorted(lists, key=lambda x: len(x[1]))
    starts = lists[0][1] - lists[0][0]
    for offset, positions in lists[1:]:
        if not len(starts):
            break
        starts = starts[np.isin(starts + offset, positions)]
    return starts[starts >= 0]


def near(lists: list[np.ndarray], width: int) -> bool:
    """Whether some stretch of ``width`` words holds a position of each list."""
    tagged = np.concatenate([np.stack([p, np.full(len(p), i)], axis=1) for i, p in enumerate(lists)])
    tagged = tagged[np.argsort(tagged[:, 0], kind="stable")]
    last = [-1] * len(lists)
    for at, which in tagged.tolist():
        last[which] = at
        if min(last) >= 0 and at - min(last) < width:
            return True
    return False


class _Block:
    """A block of items: their words, the terms each window is looked up by."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], counts: dict[bytes, int], window: int,
                 rarest: int) -> None:
        self.items, self.window = items, window
        self.terms: dict[bytes, int] = {}
        self.lookups: list[list[list[tuple[int, int]]]] = []     # item -> lookup -> (term, offset in the item)
        for _, words in items:
            seen: set[tuple] = set()
            for start, length in _windows(words, window):
                inside = range(start, start + length)
                if any(words[i] not in counts for i in inside):
                    continue
                chosen = sorted(inside, key=lambda i: (counts[words[i]], words[i], i))[:rarest]
                seen.add(tuple(sorted(chosen)))
            self.lookups.append([[(self.terms.setdefault(words[i], len(self.terms)), i) for i in c] for c in sorted(seen)])

    def anchors(self) -> list[tuple[int, int]]:
        return sorted({(t, i) for i, lookups in enumerate(self.lookups) for c in lookups for t, _ in c})


def _pairs(index: DataFrame, block: _Block, slack: int) -> DataFrame:
    """Documents and items with phrase candidates or proximity matches."""
    spark = index.sparkSession
    anchors = spark.createDataFrame(block.anchors(), "term int, item int")     # bounded by the block
    lists = index.join(anchors, "term").groupBy("_id", "_h", "item").agg(
        F.collect_list(F.struct("term", "positions")).alias("lists"))
    lookups, window = block.lookups, block.window

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for d, h, item, found in rows_of(batches, "_id", "_h", "item", "lists"):
            by_term = {x["term"]: np.array(x["positions"], np.int64) for x in found}
            shifts: set[int] = set()
            close = 0
            for lookup in lookups[item]:
                if all(t in by_term for t, _ in lookup):
                    shifts.update(_shifts(lookup, by_term))
                    close += near([by_term[t] for t, _ in lookup], window + slack)
            if shifts or close:
                out.append((d, h, item, sorted(shifts), close))
            if len(out) >= 2_000:
                yield _batch(out)
                out = []
        yield _batch(out)

    def _shifts(lookup: list[tuple[int, int]], by_term: dict[int, np.ndarray]) -> list[int]:
        first = min(at for _, at in lookup)
        return [int(s) - first for s in intersect([(at - first, by_term[t]) for t, at in lookup])]

    def _batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "_id": pa.array([r[0] for r in out], pa.string()), "_h": pa.array([r[1] for r in out], pa.int64()),
            "item": pa.array([r[2] for r in out], pa.int32()),
            "shifts": pa.array([r[3] for r in out], pa.list_(pa.int32())),
            "near": pa.array([r[4] for r in out], pa.int32())})

    return lists.mapInArrow(match, _KEYED + "item int, shifts array<int>, near int")


def spans_of(words: list[bytes], item: list[bytes], shifts: list[int], window: int) -> list[tuple[int, int]]:
    """Stretches of at least a window in which the text equals the item at one of the shifts."""
    need = min(window, len(item))
    spans = []
    for shift in shifts:
        run = 0
        for i in range(max(0, -shift), min(len(item), len(words) - shift) + 1):
            if i < min(len(item), len(words) - shift) and words[shift + i] == item[i]:
                run += 1
                continue
            if run >= need:
                spans.append((shift + i - run, shift + i))
            run = 0
    return spans


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same words as disjoint stretches in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _verified(rows: DataFrame, pairs: DataFrame, block: _Block) -> DataFrame:
    """Exact matches per document: the items, and the stretches of words they hit."""
    items, window = block.items, block.window
    wanted = pairs.groupBy(F.col("_id").alias("_i"), F.col("_h").alias("_g")).agg(
        F.collect_list(F.struct("item", "shifts")).alias("pairs"), F.sum(F.signum("near").cast("long")).alias("near"))
    texts = rows.join(wanted, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_h") == F.col("_g")))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for d, h, t, found, close in rows_of(batches, "_id", "_h", "_t", "pairs", "near"):
            words, spans, ids = words_of(t), [], set()
            for pair in found:
                name, item = items[pair["item"]]
                hit = spans_of(words, item, pair["shifts"], window)
                spans += hit
                if hit and name is not None:
                    ids.add(name)
            yield pa.RecordBatch.from_pydict({
                "_id": pa.array([d], pa.string()), "_h": pa.array([h], pa.int64()),
                "items": pa.array([sorted(ids)], pa.list_(pa.string())), "near": pa.array([close], pa.int64()),
                "spans": pa.array([[{"a": a, "b": b} for a, b in merged(spans)]],
                                  pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))})

    return texts.select("_id", "_h", "_t", "pairs", "near").mapInArrow(
        verify, _KEYED + "items array<string>, near long, spans array<struct<a:int,b:int>>")


def decontaminate(documents: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text", window: int = WINDOW, rarest: int = RAREST,
                  slack: int = SLACK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``documents``: what of the benchmark its text holds.

    Columns: the key as text (``_id``), ``_h`` (hash of the text), ``n_words``,
    ``n_hit`` (words inside an exact match), ``items`` (ids of the items, sorted),
    ``spans`` (disjoint stretches of words hit) and ``n_near`` (proximity matches: items with
    a window whose rarest terms lie within ``window + slack`` words in any order).
    """
    rows = documents.select(F.col(key).cast("string").alias("_id"), F.xxhash64(text).alias("_h"), F.col(text).alias("_t"))
    sizes, hits = None, None
    for items in _blocks(benchmark, item, item_text, block_bytes):
        counts = _counts(rows, frozenset(w for _, words in items for w in words))
        block = _Block(items, counts, window, rarest)
        index = stored(_postings(rows, block.terms), "postings")
        sizes = sizes if sizes is not None else index.where("term = -1")
        found = _verified(rows, _pairs(index.where("term >= 0"), block, slack), block)
        hits = found if hits is None else hits.union(found)
    if sizes is None:
        sizes, none = _postings(rows, {}), "array<struct<a:int,b:int>>"
        return sizes.select("_id", "_h", F.col("positions")[0].cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
                            F.array().cast("array<string>").alias("items"), F.array().cast(none).alias("spans"),
                            F.lit(0).cast("long").alias("n_near"))
    per_document = hits.groupBy(F.col("_id").alias("_i"), F.col("_h").alias("_g")).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("spans")))).alias("spans"),
        F.max("near").alias("near"))
    # stretches in order: each adds what lies beyond all before it
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda s, x: F.struct(
            F.greatest(s["end"], x["b"]).alias("end"),
            (s["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(s["end"], x["a"]))).alias("n")))["n"]
    own = F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_h") == F.col("_g"))
    return sizes.join(per_document, own, "left").select(
        "_id", "_h", F.col("positions")[0].cast("long").alias("n_words"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<a:int,b:int>>")).alias("spans"),
        F.coalesce("near", F.lit(0)).cast("long").alias("n_near"))


def contaminated() -> Column:
    """A match, and a twentieth of the words or more inside matches."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def clean_documents(documents: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text",
                    **options) -> DataFrame:
    """The rows of ``documents`` that are not contaminated."""
    bad = decontaminate(documents, benchmark, key=key, text=text, **options).where(contaminated()).select(
        "_id", "_h").distinct()
    rows = carried(documents, _key=F.col(key).cast("string"), _hash=F.xxhash64(text))
    clean = rows.join(bad, F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h")), "left_anti")
    return clean.select("_row.*")


_SQL = f"""
WITH words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS ws FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
parts AS (
  SELECT DISTINCT item_id, k, array_to_string(ws[i:i + k - 1], ' ') AS part FROM (
    SELECT item_id, ws, least({WINDOW}, len(ws)) AS k, unnest(range(1, len(ws) - least({WINDOW}, len(ws)) + 2)) AS i
    FROM items WHERE len(ws) > 0)),
places AS (
  SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS part FROM (
    SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
    FROM words, (SELECT DISTINCT k FROM parts) WHERE len(ws) >= k)),
found AS (SELECT doc_id, i, k, item_id FROM places JOIN parts USING (k, part)),
hits AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS pos FROM found) GROUP BY 1),
listed AS (
  SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT doc_id, len(ws) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(l.n, 0) AS n_items,
  sha256(coalesce(l.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(ws) AS contaminated
FROM words LEFT JOIN hits h USING (doc_id) LEFT JOIN listed l USING (doc_id)
"""


@query("op3_decontaminate", _SQL)
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("_id").cast("long").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"))
