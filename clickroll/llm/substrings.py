"""Substring dedup by an index of windows under sampled anchors (winnowing).

This is no relative Lempel-Ziv parse: nothing is factored greedily, and no longest match
is looked for.  The reference of a text is all documents with a smaller id.  A text is cut
at anchors: of each window of ``WINDOW`` words, the ``GRAM`` words with the smallest hash.
The windows that share an anchor form a block.  Blocks are compared as a whole; where the
context of an anchor differs between documents, their windows are looked up one by one.
The words of every window found are the duplicate spans, merged where they touch.

An anchor depends on its window alone, so equal windows have equal anchors, and no window is
missed: anchors that only one document holds need no further look, which leaves a
fraction of the windows to compare.  Keys are pairs of 64-bit hashes.

Within a stretch of some megabytes of texts, blocks that repeat an earlier document of the
stretch are settled on the spot.  So a passage of very many documents sends one
row per stretch into the shuffle, not one per document.

Defined cases: null and empty texts have no words; ids are whole numbers; from a row with a
null id nothing is removed, and it is no reference; rows of equal id are no reference for
each other; windows are judged on the input, not on what is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickroll.llm.common import encoded, hashes_of, per_worker, query, rows_of, space_words, table, word_hashes
from clickroll.session import stored

WINDOW = 13
GRAM = 4
STRETCH = 4 << 20
"""Bytes of text within which repeats are settled before the shuffle."""

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Word hashes of a text; hashes of any of its stretches in constant time."""

    def __init__(self, words: list[bytes]) -> None:
        self.hashes = hashes_of(words, per_worker("words", word_hashes))
        self.sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __len__(self) -> int:
        return len(self.hashes)

    def stretches(self, starts: np.ndarray, ends: np.ndarray, base: np.uint64) -> np.ndarray:
        """Polynomial hash of words[start:end] for each pair."""
        if int(base) not in self.sums:
            n = len(self.hashes)
            powers = np.cumprod(np.full(n, base))
            inverse = np.uint64(pow(int(base), -1, 1 << 64))
            self.sums[int(base)] = (np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.hashes * powers)]),
                                    np.cumprod(np.full(n, inverse)))
        sums, back = self.sums[int(base)]
        return (sums[ends] - sums[starts]) * back[starts]

    def blocks(self, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Anchor hash, block hash, first window and number of windows of each block."""
        n = len(self.hashes)
        if n < window:
            none = np.zeros(0, np.uint64)
            return none, none, np.zeros(0, np.int64), np.zeros(0, np.int64)
        grams = np.arange(n - gram + 1)
        values = _mixed(self.stretches(grams, grams + gram, _A))
        inside = window - gram + 1
        at = np.lib.stride_tricks.sliding_window_view(values, inside).argmin(axis=1) + np.arange(n - window + 1)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        counts = np.diff(np.append(first, len(at)))
        place = (at[first] - first).astype(np.uint64)
        whole = self.stretches(first, first + counts - 1 + window, _B)
        return values[at[first]], _mixed(whole + _mixed(place + np.uint64(1))), first, counts


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def _settle(keys: list[np.ndarray], ids: np.ndarray) -> np.ndarray:
    """Rows whose keys an earlier document of the same stretch has."""
    order = np.lexsort((ids, *keys))
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    least = ids[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    settled = np.zeros(len(order), bool)
    settled[order] = ids[order] > least
    return settled


_PLACED = "settled boolean, p long, q long, _id long, _c long, at long"
"""``at`` is the first window times 16 plus the number of windows."""


def _placed(p: np.ndarray, q: np.ndarray, ids: np.ndarray, checks: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    """Rows for the shuffle; those settled already go anywhere."""
    settled = _settle([q, p], ids)
    p = np.where(settled, _mixed(at.astype(np.uint64) * _A + ids.astype(np.uint64)), p)
    return pa.RecordBatch.from_pydict({
        "settled": pa.array(settled), "p": _signed(p), "q": _signed(q), "_id": pa.array(ids, pa.int64()),
        "_c": pa.array(checks, pa.int64()), "at": pa.array(at, pa.int64())})


def _stretches(rows: Iterator[tuple], per_row: Callable) -> Iterator[pa.RecordBatch]:
    """Placed rows of some megabytes of text at a time."""
    some: list[tuple] = []
    size = 0
    for row in rows:
        found, weight = per_row(row)
        if len(found[0]):
            some.append(found)
        size += weight
        if some and size >= STRETCH:
            yield _placed(*(np.concatenate(c) for c in zip(*some, strict=True)))
            some, size = [], 0
    if some:
        yield _placed(*(np.concatenate(c) for c in zip(*some, strict=True)))


def packed(text: Column) -> Column:
    """Texts compressed for the shuffles."""
    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            pack = zstandard.ZstdCompressor(level=3)
            yield pd.Series([pack.compress(encoded(t)) for t in texts.array], dtype="object")

    return run(F.coalesce(text, F.lit("")))


def _block_rows(rows: DataFrame, window: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks(row: tuple) -> tuple:
            d, c, t = row
            raw = encoded(t)
            anchor, block, first, counts = Words(space_words(raw)).blocks(window, gram)
            n = len(first)
            return (anchor, block, np.full(n, d, np.int64), np.full(n, c, np.int64), first * 16 + counts), len(raw)

        yield from _stretches(rows_of(batches, "_id", "_c", "_t"), blocks)

    return rows.mapInArrow(run, _PLACED)


def _window_rows(texts: DataFrame, window: int) -> DataFrame:
    """The windows of the blocks asked for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()

        def windows(row: tuple) -> tuple:
            d, c, z, asked = row
            words = Words(space_words(unpack.decompress(z)))
            spans = np.array(sorted(asked), np.int64)
            counts = spans & 15
            begin = np.repeat(spans >> 4, counts)
            starts = begin + np.arange(len(begin)) - np.repeat(np.cumsum(counts) - counts, counts)
            n = len(starts)
            return (_mixed(words.stretches(starts, starts + window, _A)), _mixed(words.stretches(starts, starts + window, _B)),
                    np.full(n, d, np.int64), np.full(n, c, np.int64), starts * 16 + 1), 64 * n

        yield from _stretches(rows_of(batches, "_id", "_c", "_z", "asked"), windows)

    return texts.mapInArrow(run, _PLACED)


def _lists(rows: DataFrame, name: str) -> DataFrame:
    """Places by document: no more than it has windows."""
    return rows.groupBy(F.col("_id").alias("_i"), F.col("_c").alias("_g")).agg(F.collect_list("at").alias(name))


def duplicate_windows(documents: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = WINDOW,
                      gram: int = GRAM) -> DataFrame:
    """``(_id, _c, at)``: runs of windows that start in a document with a smaller id.

    ``_c`` is the crc32 of the text, which tells rows of one id apart.
    """
    if not gram <= window < gram + 15:
        raise ValueError("a block must hold fewer than 16 windows")
    rows = documents.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("_id"), F.coalesce(text, F.lit("")).alias("_t")).withColumn(
        "_c", F.crc32(F.col("_t").cast("binary")))
    blocks = _block_rows(rows.select("_id", "_c", "_t"), window, gram).repartition("settled", "p")
    anchor, block = Window.partitionBy("settled", "p"), Window.partitionBy("settled", "p", "q")
    judged = blocks.withColumns({
        "least": F.min("_id").over(anchor), "most": F.max("_id").over(anchor),
        "one": F.min("q").over(anchor), "other": F.max("q").over(anchor)}).where("settled OR least < most")
    judged = judged.withColumn("first", F.min("_id").over(block))
    found = F.col("settled") | (F.col("_id") > F.col("first"))
    # a block that is the first of its kind stands for all of them when its anchor has others
    asks = ~found & (F.col("one") != F.col("other"))
    judged = stored(judged.select("_id", "_c", "at", found.alias("found"), asks.alias("asks")).where(
        "found OR asks"), "blocks")
    asked = rows.select("_id", "_c", packed(F.col("_t")).alias("_z")).join(
        _lists(judged.where("asks"), "asked"), (F.col("_id") == F.col("_i")) & (F.col("_c") == F.col("_g")))
    edges = _window_rows(asked.select("_id", "_c", "_z", "asked"), window).repartition("settled", "p")
    first = F.min("_id").over(Window.partitionBy("settled", "p", "q"))
    edges = edges.withColumn("first", first).where("settled OR _id > first")
    return judged.where("found").select("_id", "_c", "at").union(edges.select("_id", "_c", "at"))


def cover(places: list[int], window: int) -> list[tuple[int, int]]:
    """Stretches of words that runs of windows cover, joined where they touch."""
    out: list[tuple[int, int]] = []
    for at in sorted(places):
        a, b = at >> 4, (at >> 4) + (at & 15) - 1 + window
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def dedup_substrings(documents: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = WINDOW,
                     gram: int = GRAM, with_text: bool = True) -> DataFrame:
    """One row per row of ``documents``: the key, and its text without duplicate spans.

    Columns: the key, ``n_words``, ``n_removed``, ``spans`` (stretches of words removed),
    ``kept_sha256`` (of the words kept, joined by blanks), and ``kept`` (those words) if asked for.
    """
    places = _lists(duplicate_windows(documents, key=key, text=text, window=window, gram=gram), "places")
    rows = documents.select(F.col(key).cast("long").alias("_id"), F.coalesce(text, F.lit("")).alias("_t")).select(
        "_id", F.crc32(F.col("_t").cast("binary")).alias("_c"), packed(F.col("_t")).alias("_z"))
    both = rows.join(places, (F.col("_id") == F.col("_i")) & (F.col("_c") == F.col("_g")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        out: list[tuple] = []
        size = 0
        for d, z, at in rows_of(batches, "_id", "_z", "places"):
            words = space_words(unpack.decompress(z))
            spans, kept, end = cover(at or [], window), [], 0
            for a, b in spans:
                kept += words[end:a]
                end = b
            kept += words[end:]
            joined = b" ".join(kept)
            out.append((d, len(words), len(words) - len(kept), [{"a": a, "b": b} for a, b in spans],
                        hashlib.sha256(joined).hexdigest(), joined.decode("utf-8") if with_text else None))
            size += len(joined) if with_text else 64
            if size > STRETCH:
                yield _batch(out)
                out, size = [], 0
        if out:
            yield _batch(out)

    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])), pa.string(),
             pa.string()]
    names = ["_id", "n_words", "n_removed", "spans", "kept_sha256", "kept"]

    def _batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    done = both.select("_id", "_z", "places").mapInArrow(run, (
        "_id long, n_words long, n_removed long, spans array<struct<a:int,b:int>>, kept_sha256 string, kept string"))
    return done.select(F.col("_id").alias(key), *names[1:5], *(["kept"] if with_text else []))


_SQL = f"""
WITH words AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS ws FROM documents),
places AS (
  SELECT doc_id, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS part FROM (
    SELECT doc_id, ws, unnest(range(1, len(ws) - {WINDOW} + 2)) AS i FROM words WHERE len(ws) >= {WINDOW})),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS pos
  FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY part) AS first FROM places) WHERE first < doc_id),
kept AS (
  SELECT doc_id, count(g.pos) AS n, string_agg(word, ' ' ORDER BY w.pos) FILTER (WHERE g.pos IS NULL) AS text
  FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM words) w
  LEFT JOIN gone g USING (doc_id, pos) GROUP BY 1)
SELECT doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""


@query("op4_substrings", _SQL)
def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_substrings(table(spark, sf_dir, "documents", "doc_id", "text"), with_text=False)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")
