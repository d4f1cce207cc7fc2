"""Phrase collocations by stripes: each prefix keys a counter of the words that follow it.

A stripe of depth 0 has no prefix and counts words, one of depth 1 or 2 has as many words
before the next one.  Tasks build whole stripes in memory and send them merged; entries of
equal prefix and next word are then added up, entry by entry, so a stripe of a frequent
prefix is spread over all tasks and none holds it whole.  One slot of a stripe, with no
next word, counts all that is not followed further: the ends of pieces, and next words that
cannot be in a candidate.  So the sum of a stripe is the count of its prefix.  An entry is
the count of the longer phrase, hence the same number as the sum of the stripe that it grows into, and
the largest entries say what subsumes what.  Phrases are ranked by totals from the entries, so the slots are not sent there.

A phrase occurs no more often than its parts.  Stripes grow depth by depth, and a depth
follows only words (pairs) that the depth before found often enough; entries of fewer
occurrences than a candidate has are in no candidate and not kept.  Tasks know these from
a bitmap of hashes of fixed size: a hash that collides costs an entry too many and
changes no count.

Defined cases: a null text is empty; a null language is ``und``; words are bytes, only A-Z
are lower-cased; a piece of one word has no phrase; rows that repeat count again; an empty
table has no phrases.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickroll.llm.common import Memo, query, rows_of, table
from clickroll.session import stored

LEAST = 10
"""Occurrences a candidate has at least."""
TOP = 2000
"""Phrases reported of a language."""
SUBSUMED = 50
"""Percent of a phrase's occurrences inside a longer one that subsume it."""
SCALE = 1_000_000
NO_LANG = "und"
BITMAP_BITS = (1 << 25, 1 << 27)
"""Sizes of the bitmaps of frequent words and of frequent pairs."""

_TOKEN = re.compile(rb"[^ \t\n]+|\n")
_PIECE_ENDS = bytes.maketrans(b".,;:!?\r\x0b\x0c", b"\n" * 9)
_SLICE = 1 << 20
_BUFFER = 1 << 18
_STRIPES = "prefix string, nexts array<string>, counts array<bigint>"
"""The prefix is its language, a line break, which no word holds, and its words; one column, so that entries are short."""


def tokens_of(raw: bytes) -> Iterator[list[bytes]]:
    """Words of a text and ``\\n`` between its pieces, in runs, so that a long text is never split at once."""
    at = 0
    while at < len(raw):
        end = min(at + _SLICE, len(raw))
        if end < len(raw):
            gap = re.compile(rb"[ \t\n]").search(raw, end)
            end = gap.start() if gap else len(raw)
        yield _TOKEN.findall(raw[at:end])
        at = end


class _Stripes:
    """Stripes of one language in one task, of one depth."""

    def __init__(self, lang: str, depth: int, words: np.ndarray | None, pairs: np.ndarray | None, held: int,
                 slots: bool) -> None:
        self.lang, self.depth, self.words, self.pairs, self.held, self.slots = lang, depth, words, pairs, held, slots
        self.seed = xxhash.xxh64_intdigest(lang.encode(), 42)
        self._reset()

    def _reset(self) -> None:
        # number 0 is the end of a piece
        self.texts: list[bytes] = [b""]
        self.numbers = {b"\n": 0}
        self.hashed = np.zeros(0, np.uint64)
        self.waiting: list[np.ndarray] = [np.zeros(1, np.int64)]
        self.size = 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.nexts = np.zeros(0, np.int64)

    def _number(self, word: bytes) -> int:
        n = self.numbers.get(word)
        if n is None:
            n = self.numbers[word] = len(self.texts)
            self.texts.append(word)
        return n

    def add(self, raw: bytes) -> Iterator[pa.RecordBatch]:
        for run in tokens_of(raw):
            self.waiting.append(np.fromiter(map(self._number, run), np.int64, len(run)))
            self.size += len(run)
            if self.size >= _BUFFER:
                self._count()
                if len(self.keys) + len(self.texts) > self.held:
                    yield from self.flush()
        self.waiting.append(np.zeros(1, np.int64))

    def _hashes(self) -> np.ndarray:
        new = self.texts[len(self.hashed):]
        found = np.fromiter((xxhash.xxh64_intdigest(t, self.seed) for t in new), np.uint64, len(new))
        self.hashed = np.concatenate([self.hashed, found])
        return self.hashed

    def _count(self) -> None:
        """Count what is waiting; the last words wait on, for what may follow them."""
        ids = np.concatenate(self.waiting)
        keep = min(self.depth, len(ids))
        self.waiting, self.size = [ids[len(ids) - keep:]], 0
        n = len(ids) - self.depth
        if n <= 0:
            return
        if self.depth == 0:
            prefix, follow = np.zeros(n, np.uint64), ids
            use = ids > 0
        else:
            hashes = self._hashes()
            often = _bit(self.words, hashes)
            often[0] = False
            if self.depth == 1:
                use = often[ids[:-1]]
                prefix = ids[:-1].astype(np.uint64)
                follow = np.where(often[ids[1:]], ids[1:], 0)
            else:
                a, b = ids[:-1], ids[1:]
                both = np.flatnonzero(often[a] & often[b])
                pair = np.zeros(len(a), bool)
                pair[both] = _bit(self.pairs, pair_hash(hashes[a[both]], hashes[b[both]]))
                use = pair[:-1]
                prefix = a[:-1].astype(np.uint64) << np.uint64(32) | b[:-1].astype(np.uint64)
                follow = np.where(pair[1:], ids[2:], 0)
            if not self.slots:
                use = use & (follow > 0)
        self._merge(prefix[use], follow[use], np.ones(int(use.sum()), np.int64))

    def _merge(self, keys: np.ndarray, nexts: np.ndarray, counts: np.ndarray) -> None:
        keys, nexts = np.concatenate([self.keys, keys]), np.concatenate([self.nexts, nexts])
        counts = np.concatenate([self.counts, counts])
        if len(keys) == 0:
            return
        order = np.lexsort((nexts, keys))
        keys, nexts, counts = keys[order], nexts[order], counts[order]
        first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (nexts[1:] != nexts[:-1])])
        self.keys, self.nexts, self.counts = keys[first], nexts[first], np.add.reduceat(counts, first)

    def flush(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        """The stripes so far; nothing of them is held behind it.

        Words that wait for what follows them are numbered anew.
        """
        if last:
            self.waiting.append(np.zeros(2, np.int64))
        self._count()
        rest = [self.texts[i] for ids in self.waiting for i in ids]
        texts = pa.array([t.decode("utf-8", "replace") for t in self.texts], pa.string())
        starts = np.flatnonzero(np.r_[True, self.keys[1:] != self.keys[:-1]]) if len(self.keys) else np.zeros(0, np.int64)
        step = 20_000
        for at in range(0, len(starts), step):
            part = starts[at:at + step]
            end = starts[at + step] if at + step < len(starts) else len(self.keys)
            offsets = pa.array(np.r_[part, end] - part[0], pa.int32())
            keys = self.keys[part]
            high, low = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
            follow = self.nexts[part[0]:end]
            names = pa.array(follow, pa.int64(), mask=follow == 0)
            words = [texts.take(pa.array(p)) for p in ((), (low,), (high, low))[self.depth]]
            named = pc.binary_join_element_wise(*words, " ") if words else pa.array([""] * len(part), pa.string())
            yield pa.RecordBatch.from_arrays([
                pc.binary_join_element_wise(pa.scalar(self.lang), named, "\n"),
                pa.ListArray.from_arrays(offsets, texts.take(names)),
                pa.ListArray.from_arrays(offsets, pa.array(self.counts[part[0]:end], pa.int64())),
            ], ["prefix", "nexts", "counts"])
        self._reset()
        self.waiting = [np.fromiter((self._number(t or b"\n") for t in rest), np.int64, len(rest))]


def _bit(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes & np.uint64(len(bitmap) * 8 - 1)
    return (bitmap[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two words from theirs; the column form of it is ``_pair_hash``."""
    return a ^ b >> np.uint64(21)


def _word_hash(lang: str, word: str) -> Column:
    return F.xxhash64(lang, word)


def _pair_hash(lang: str, a: str, b: str) -> Column:
    return F.xxhash64(lang, a).bitwiseXOR(F.shiftrightunsigned(F.xxhash64(lang, b), 21))


def _bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """The slots of column ``h``, one bit each, as bytes: at most ``bits / 8`` of them come to the driver."""
    slot = F.col("h").bitwiseAND(F.lit(bits - 1))
    parts = hashes.select(slot.alias("slot")).selectExpr("slot div 32768 AS part", "slot % 32768 AS at")
    out = np.zeros(bits // 8, np.uint8)
    for row in parts.groupBy("part").agg(F.bitmap_construct_agg("at").alias("bits")).toLocalIterator():
        out[row.part * 4096:(row.part + 1) * 4096] = np.frombuffer(row.bits, np.uint8)
    return out


def stripes(documents: DataFrame, depth: int, words: np.ndarray | None = None, pairs: np.ndarray | None = None, *,
            least: int = 1, slots: bool = True, text: str = "text", lang: str = "lang", held: int = 300_000) -> DataFrame:
    """``(lang, p1, p2, next, count)``: the merged stripes of ``depth`` words, entries of ``least`` occurrences on.

    ``words`` and ``pairs`` are bitmaps of what is followed; ``slots`` says whether what is not has its slot.
    ``held`` entries of a task's stripes are kept at most, then they are sent.
    """
    spark = documents.sparkSession
    rows = documents.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"),
                            F.col(text).cast("binary").alias("raw"))
    maps = spark.sparkContext.broadcast((words, pairs))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_lang = Memo(lambda name: _Stripes(name, depth, *maps.value, held, slots), 1 << 30)
        for name, raw in rows_of(batches, "lang", "raw"):
            if raw:
                one = by_lang[name]
                yield from one.add(raw.lower().translate(_PIECE_ENDS))
                total = len(by_lang) > 8 and sum(len(s.keys) + len(s.texts) + s.size for s in by_lang.values())
                if total > held:
                    for s in by_lang.values():
                        yield from s.flush(True)
                    by_lang.clear()
        for s in by_lang.values():
            yield from s.flush(True)

    entries = rows.mapInArrow(build, _STRIPES).select(
        "prefix", F.inline(F.arrays_zip(F.col("nexts").alias("next"), F.col("counts").alias("count"))))
    merged = entries.groupBy("prefix", "next").agg(F.sum("count").alias("count")).where(F.col("count") >= least)
    named = merged.withColumn("words", F.expr("substring_index(prefix, '\\n', -1)"))
    none = F.lit(None).cast("string")
    return named.select(F.expr("left(prefix, length(prefix) - length(words) - 1)").alias("lang"),
                        (F.substring_index("words", " ", 1) if depth else none).alias("p1"),
                        (F.substring_index("words", " ", -1) if depth == 2 else none).alias("p2"), "next", "count")


def collocations(documents: DataFrame, *, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP,
                 subsumed: int = SUBSUMED, bits: tuple[int, int] = BITMAP_BITS, held: int = 300_000) -> DataFrame:
    """The ``top`` phrases of two and three words of each language, best first.

    Columns: ``lang, rank, phrase, a, l, r, n, score`` as the contract of ``op13`` has them.
    """
    options = {"slots": False, "text": text, "lang": lang, "held": held}
    counted = stored(stripes(documents, 0, **options).select("lang", F.col("next").alias("w"), F.col("count").alias("f")), "words")
    sizes = counted.groupBy("lang").agg(F.sum("f").alias("n"))
    often = counted.where(F.col("f") >= least)
    words = _bitmap(often.select(_word_hash("lang", "w").alias("h")), bits[0])
    pair = stored(stripes(documents, 1, words, least=least, **options).select(
        "lang", F.col("p1").alias("w1"), F.col("next").alias("w2"), F.col("count").alias("a")), "pairs")
    pairs = _bitmap(pair.select(_pair_hash("lang", "w1", "w2").alias("h")), bits[1])
    triple = stored(stripes(documents, 2, words, pairs, least=least, **options).select(
        "lang", F.col("p1").alias("w1"), F.col("p2").alias("w2"), F.col("next").alias("w3"), F.col("count").alias("a")), "triples")

    # totals of prefixes are the entries that grew into them
    single = often.select("lang", "w", "f")
    double = pair.select("lang", F.col("w1").alias("u"), F.col("w2").alias("v"), F.col("a").alias("f"))

    def with_word(rows: DataFrame, word: str, name: str) -> DataFrame:
        return rows.join(single.select(F.col("lang"), F.col("w").alias(word), F.col("f").alias(name)), ["lang", word])

    def with_pair(rows: DataFrame, a: str, b: str, name: str) -> DataFrame:
        return rows.join(double.select("lang", F.col("u").alias(a), F.col("v").alias(b), F.col("f").alias(name)), ["lang", a, b])

    # the largest entries that hold a pair, as their prefix or behind their first word
    longer = triple.select("lang", "w1", "w2", "a").unionAll(triple.select("lang", "w2", "w3", "a")).groupBy(
        "lang", "w1", "w2").agg(F.max("a").alias("inside"))
    twos = with_word(with_word(pair, "w1", "f1"), "w2", "f2").join(longer, ["lang", "w1", "w2"], "left").where(
        F.coalesce(100 * F.col("inside") < subsumed * F.col("a"), F.lit(True)))
    threes = with_pair(with_pair(with_word(with_word(triple, "w1", "f1"), "w3", "f3"), "w1", "w2", "f12"), "w2", "w3", "f23")
    cut = lambda left, right: F.struct(
        F.expr(f"cast({SCALE} as decimal(38,0)) * a * a div (cast({left} as decimal(38,0)) * {right})").alias("score"),
        F.col(left).alias("l"), F.col(right).alias("r"))
    found = twos.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", cut("f1", "f2").alias("c")).unionAll(
        threes.withColumns({"c1": cut("f1", "f23"), "c2": cut("f12", "f3")}).select(
            "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
            F.when(F.col("c1.score") <= F.col("c2.score"), F.col("c1")).otherwise(F.col("c2")).alias("c")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = found.select("lang", "phrase", "a", "c.l", "c.r", "c.score").withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top).join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


_SQL = f"""
WITH texts AS (
  SELECT coalesce(lang, '{NO_LANG}') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts),
lists AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda w: w <> '') AS ws FROM pieces),
places AS MATERIALIZED (
  SELECT lang, unnest(ws) AS w1, unnest(list_concat(ws[2:], [NULL])) AS w2, unnest(list_concat(ws[3:], [NULL, NULL])) AS w3
  FROM lists WHERE len(ws) > 0),
one AS MATERIALIZED (SELECT lang, w1 AS w, count(*) AS f FROM places WHERE w1 IS NOT NULL GROUP BY ALL),
two AS MATERIALIZED (SELECT lang, w1, w2, count(*) AS f FROM places WHERE w2 IS NOT NULL GROUP BY ALL),
three AS MATERIALIZED (SELECT lang, w1, w2, w3, count(*) AS f FROM places WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= {LEAST}),
sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM one GROUP BY 1),
held AS (SELECT lang, w1, w2, max(f) AS inside FROM (
  SELECT lang, w1, w2, f FROM three UNION ALL SELECT lang, w2, w3, f FROM three) GROUP BY 1, 2, 3),
cuts AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.f AS a, 1 AS j, x.f AS l, y.f AS r
  FROM two t JOIN one x ON x.lang = t.lang AND x.w = t.w1 JOIN one y ON y.lang = t.lang AND y.w = t.w2
  LEFT JOIN held h ON h.lang = t.lang AND h.w1 = t.w1 AND h.w2 = t.w2
  WHERE t.f >= {LEAST} AND (h.inside IS NULL OR 100 * h.inside < {SUBSUMED} * t.f)
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 1, x.f, y.f
  FROM three t JOIN one x ON x.lang = t.lang AND x.w = t.w1
  JOIN two y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 2, x.f, y.f
  FROM three t JOIN two x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2
  JOIN one y ON y.lang = t.lang AND y.w = t.w3),
scored AS (SELECT *, CAST({SCALE}::HUGEINT * a * a // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= {TOP}
"""


@query("op13_collocations", _SQL)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents", "text", "lang"))
