"""Suffix-array dedup: every byte inside a string of ``window`` bytes that starts elsewhere too.

The array holds suffixes at positions that the bytes choose themselves: of the middle
part of each window, the place of the smallest hash of eight bytes is its anchor.  Equal windows
have equal anchors, and the windows of one anchor are neighbours that all hold the same
``core`` of bytes, with which the suffix of the anchor begins.  So two windows are equal only if
their suffixes begin with equal cores; suffixes whose core stands nowhere else are not sorted.

Splitters sampled from the leading bytes range-partition the rest, and a bucket sorts its suffixes
by multikey quicksort, eight bytes a key: only runs that are still equal are sorted by the next
key.  What precedes the anchors is sorted likewise, backwards.  The common prefixes of
neighbours in both orders then tell which windows are equal, byte for byte.  Splitters
never part equal cores, so neighbours across a boundary share less than a core and no
window; a core with very many surroundings is compared window by window instead, dealt
by the window.

Blocks (an anchor with its windows) that are equal as a whole go through once.  Whole texts that
occur twice need no suffixes: all of them is covered.

Defined cases: a null text is empty; texts shorter than a window lose nothing; a text can repeat
itself; equal rows are copies of each other; a span may end inside a character; an empty table has no
rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickroll.llm.common import carried, query, rows_of, table
from clickroll.session import stored

WINDOW = 400
HOT = 20_000
"""Distinct surroundings of a core up to which one bucket sorts them."""
BUCKET = 20_000
"""Suffixes a bucket is meant to hold."""
HEAD = 16
"""Leading bytes that splitters are taken from."""

_GRAM = 8
_STRETCH = 1 << 20
_ROWS = 50_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SPANS = "array<struct<a:bigint,b:bigint>>"
_SPAN_TYPE = T.ArrayType(T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))


class Shape:
    """How windows, anchors and cores lie to each other."""

    def __init__(self, window: int) -> None:
        if window < 32:
            raise ValueError("windows have 32 bytes at least")
        self.window = window
        self.reach = window // 2 + 1
        self.core = window - self.reach + 1
        self.margin = (window - self.reach - _GRAM) // 2


def _keys(part: np.ndarray) -> np.ndarray:
    """For each eight bytes a hash, in the high half, and their place."""
    n = len(part) - _GRAM + 1
    grams = np.empty(n, np.uint64)
    for i in range(_GRAM):
        some = part[i:i + (n - i + _GRAM - 1) // _GRAM * _GRAM]
        grams[i::_GRAM] = some[:len(some) // _GRAM * _GRAM].view("<u8")
    grams *= _MIX
    grams ^= grams >> np.uint64(29)
    grams *= _MIX
    grams &= np.uint64(0xFFFFFFFF00000000)
    grams |= np.arange(n, dtype=np.uint64)
    return grams


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    n = len(values) - width + 1
    rows = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    rows[:len(values)] = values
    rows = rows.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def blocks_of(raw: bytes, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks of a text: begin of the core, and the least and most bytes from a window's begin to it."""
    data, count = np.frombuffer(raw, np.uint8), len(raw) - shape.window + 1
    if count <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    anchors = np.empty(count, np.int64)
    for at in range(0, count, _STRETCH):
        n = min(_STRETCH, count - at)
        low = shape.margin
        keys = _keys(data[at + low:at + low + n + shape.reach - 1 + _GRAM - 1])
        anchors[at:at + n] = (_sliding_min(keys, shape.reach) & np.uint64(0xFFFFFFFF)).astype(np.int64) + at + low
    first = np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]])
    last = np.r_[first[1:], count] - 1
    begin = anchors[first] - shape.margin
    return begin, begin - last, begin - first


def _core_hashes(raw: bytes, begins: np.ndarray, shape: Shape) -> np.ndarray:
    view, size = memoryview(raw), shape.core
    return np.fromiter((xxhash.xxh3_64_intdigest(view[b:b + size]) for b in begins.tolist()), np.uint64, len(begins)).view(np.int64)


def _cores(texts: DataFrame, shape: Shape) -> DataFrame:
    """``(core, fp, again)``: each core of each text once, and whether the text holds it again."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cores, prints, again, size = [], [], [], 0

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else [], t) for x, t in (
                (cores, pa.int64()), (prints, pa.int64()), (again, pa.bool_()))], ["core", "fp", "again"])
            for x in (cores, prints, again):
                x.clear()
            return made

        for fp, raw in rows_of(batches, "fp", "raw"):
            begins, _, _ = blocks_of(raw, shape)
            if len(begins):
                found, times = np.unique(_core_hashes(raw, begins, shape), return_counts=True)
                cores.append(found)
                prints.append(np.full(len(found), fp))
                again.append(times > 1)
                size += len(found)
                if size >= _ROWS:
                    yield out()
                    size = 0
        yield out()

    rows = texts.select("fp", "raw").mapInArrow(find, "core long, fp long, again boolean")
    return stored(rows.groupBy("core", "fp").agg(F.max("again").alias("again")), "cores")


_BLOCK = "id string, fp long, begin long, core long, lo int, hi int, g binary, s binary"


def _blocks(texts: DataFrame, wanted: DataFrame, shape: Shape) -> DataFrame:
    """Blocks of the wanted cores, with their bytes and a digest of them."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [[]] * 8
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                              ["id", "fp", "begin", "core", "lo", "hi", "g", "s"])
            rows.clear()
            return made

        for key, fp, raw, cores in rows_of(batches, "id", "fp", "raw", "cores"):
            begins, lo, hi = blocks_of(raw, shape)
            hashes = _core_hashes(raw, begins, shape)
            for i in np.flatnonzero(np.isin(hashes, np.array(cores, np.int64))).tolist():
                b, x, y = int(begins[i]), int(lo[i]), int(hi[i])
                s = raw[b - y:b - x + shape.window]
                rows.append((key, fp, b, int(hashes[i]), x, y, hashlib.blake2b(s, digest_size=16).digest(), s))
                if len(rows) >= 5000:
                    yield out()
        yield out()

    joined = texts.join(wanted, ["id", "fp"]).select("id", "fp", "raw", "cores")
    return stored(joined.mapInArrow(cut, _BLOCK), "blocks")


def multikey_order(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of equally long byte strings, and the common prefix of each with the one before it.

    Multikey quicksort by levels: what is equal so far is sorted by the next eight bytes alone.
    """
    n, width = rows.shape
    words = np.ascontiguousarray(np.pad(rows, ((0, 0), (0, -width % 8)))).view(">u8")
    order, run, live = np.arange(n), np.zeros(n, np.int64), np.arange(n)
    for depth in range(words.shape[1]):
        key, of = words[order[live], depth].astype(np.uint64), run[live]
        o = np.lexsort((key, of))
        order[live] = order[live][o]
        key, of = key[o], of[o]
        new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (of[1:] != of[:-1])])
        sizes = np.diff(np.r_[new, len(live)])
        run[live] = np.repeat(live[new], sizes)
        live = live[np.repeat(sizes > 1, sizes)]
        if len(live) == 0:
            break
    placed = rows[order]
    prefix = np.zeros(n, np.int64)
    for at in range(1, n, 4096):
        other = placed[at:at + 4096] != placed[at - 1:at + 4095][:len(placed[at:at + 4096])]
        prefix[at:at + 4096] = np.where(other.any(axis=1), other.argmax(axis=1), width)
    return order, prefix


def repeated_windows(blocks: list[tuple[bytes, int, int, bool]], shape: Shape) -> np.ndarray:
    """For blocks ``(bytes, lo, hi, shared)``, a row of flags by distance from window to core: does it start elsewhere?"""
    n = len(blocks)
    lo, hi = np.array([b[1] for b in blocks]), np.array([b[2] for b in blocks])
    shared = np.array([b[3] for b in blocks], bool)
    ahead = b"".join(s[y:].ljust(shape.window, b"\0") for s, _, y, _ in blocks)
    back = b"".join(s[:y][::-1].ljust(shape.reach - 1, b"\0") for s, _, y, _ in blocks)
    found = np.zeros((n, shape.reach), bool)
    order_a, prefix_a = multikey_order(np.frombuffer(ahead, np.uint8).reshape(n, -1))
    order_b, prefix_b = multikey_order(np.frombuffer(back, np.uint8).reshape(n, -1))
    class_a, class_b = np.empty(n, np.int64), np.empty(n, np.int64)
    for x in range(int(lo.min()), int(hi.max()) + 1):
        class_a[order_a] = np.cumsum(prefix_a < shape.window - x)
        class_b[order_b] = np.cumsum(prefix_b < x)
        use = np.flatnonzero((lo <= x) & (x <= hi))
        _, which, times = np.unique(class_a[use] * (n + 1) + class_b[use], return_inverse=True, return_counts=True)
        found[use, x] = (times[which] > 1) | shared[use]
    return found


_COVER = f"core long, g binary, lo int, hi int, spans {_SPANS}"


def _runs(flags: np.ndarray, window: int) -> list[dict]:
    """Bytes that windows at the flagged distances cover, from the begin of the core."""
    edges = np.flatnonzero(np.diff(np.r_[0, flags.astype(np.int8), 0]))
    return [{"a": -int(end - 1), "b": window - int(start)} for start, end in zip(edges[::2], edges[1::2])]


def _sorted_cover(blocks: DataFrame, shape: Shape) -> DataFrame:
    """What the windows of distinct blocks cover, by suffix arrays of buckets."""
    spark = blocks.sparkSession
    head = F.expr(f"substring(s, hi + 1, {HEAD})")
    number = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-blocks.count() // BUCKET))
    spread = blocks.withColumn("head", head).repartitionByRange(number, "head", "core")

    def bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = list(rows_of(batches, "core", "g", "lo", "hi", "s", "shared"))
        if not rows:
            return
        found = repeated_windows([(r[4], r[2], r[3], r[5]) for r in rows], shape)
        hit = np.flatnonzero(found.any(axis=1)).tolist()
        for at in range(0, len(hit), 5000):
            part = hit[at:at + 5000]
            yield pa.RecordBatch.from_arrays([
                pa.array([rows[i][0] for i in part], pa.int64()), pa.array([rows[i][1] for i in part], pa.binary()),
                pa.array([rows[i][2] for i in part], pa.int32()), pa.array([rows[i][3] for i in part], pa.int32()),
                pa.array([_runs(found[i], shape.window) for i in part], pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))],
                ["core", "g", "lo", "hi", "spans"])

    return spread.select("core", "g", "lo", "hi", "s", "shared").mapInArrow(bucket, _COVER)


def _dealt_cover(blocks: DataFrame, shape: Shape) -> DataFrame:
    """The same for cores with very many surroundings: each window is a row, dealt by its bytes."""
    each = blocks.select("core", "g", "lo", "hi", "shared", "s", F.explode(F.sequence("lo", "hi")).alias("x"))
    digest = F.substring(F.unhex(F.sha2(F.expr(f"substring(s, hi - x + 1, {shape.window})"), 256)), 1, 16)
    rows = stored(each.select("core", "g", "lo", "hi", "x", "shared", digest.alias("w")), "windows")
    again = rows.groupBy("w").agg(F.count("*").alias("n"), F.max("shared").alias("any")).where("n > 1 OR any").select("w")
    found = rows.join(stored(again, "windows-again"), "w")
    span = F.struct((-F.col("x")).cast("long").alias("a"), (shape.window - F.col("x")).cast("long").alias("b"))
    return found.groupBy("core", "g", "lo", "hi").agg(F.collect_list(span).alias("spans"))


@F.pandas_udf(_SPAN_TYPE)
def _joined(spans: pd.Series) -> pd.Series:
    """Overlapping and touching spans as one."""
    def one(found):
        out = []
        for a, b in sorted((int(s["a"]), int(s["b"])) for s in found):
            if out and a <= out[-1]["b"]:
                out[-1]["b"] = max(out[-1]["b"], b)
            else:
                out.append({"a": a, "b": b})
        return out

    return spans.map(one)


@F.pandas_udf(T.BinaryType())
def _without(raw: pd.Series, spans: pd.Series) -> pd.Series:
    def one(data, found):
        if data is None:
            return None
        kept, at = [], 0
        for s in found:
            kept.append(data[at:int(s["a"])])
            at = int(s["b"])
        return b"".join([*kept, data[at:]])

    return pd.Series([one(d, f) for d, f in zip(raw, spans)], dtype=object)


def repeated_spans(documents: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = WINDOW,
                   hot: int = HOT) -> DataFrame:
    """``(id, fp, spans)`` of the texts that hold repeated windows; ``id`` and ``fp`` as ``_named`` has them.

    Keys counted over a table are stored before the table is joined with them: AQE splits the rows of
    a frequent key only where both sides of a join come from shuffles, with no aggregate between.
    """
    shape = Shape(window)
    texts = _named(documents, key, text).where(F.octet_length("raw") >= window)
    meta = stored(texts.select("id", "fp", F.octet_length("raw").cast("long").alias("n"), F.sha2("raw", 256).alias("sha")), "texts")
    each = meta.groupBy("sha").agg(F.count("*").alias("times"), F.min(F.struct("id", "fp")).alias("rep"))
    copied = meta.join(stored(each.where("times > 1").select("sha"), "texts-again"), "sha").select(
        "id", "fp", F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("n").alias("b"))).alias("spans")).distinct()

    cores = _cores(texts, shape)
    again = cores.groupBy("core").agg(F.count("*").alias("n"), F.max("again").alias("any")).where("n > 1 OR any")
    held = cores.join(stored(again.select("core"), "cores-again"), "core").groupBy("fp").agg(F.collect_list("core").alias("cores"))
    wanted = held.join(each.select("rep.*"), "fp").select("id", "fp", "cores")
    blocks = _blocks(texts, wanted, shape)

    place = F.struct("id", "fp", "begin")
    distinct = stored(blocks.groupBy("core", "g", "lo", "hi").agg(
        (F.min(place) != F.max(place)).alias("shared"), F.any_value("s").alias("s")), "distinct-blocks")
    many = distinct.groupBy("core").agg(F.count("*").alias("around")).where(F.col("around") > hot)
    many = F.broadcast(stored(many.select("core"), "hot-cores"))  # one at most for each ``hot`` blocks
    cover = _sorted_cover(distinct.join(many, "core", "left_anti"), shape).unionAll(
        _dealt_cover(distinct.join(many, "core", "left_semi"), shape))
    place = F.explode("spans").alias("s")
    spans = blocks.drop("s").join(cover, ["core", "g", "lo", "hi"]).select("id", "fp", "begin", place).groupBy("id", "fp").agg(
        F.collect_list(F.struct((F.col("begin") + F.col("s.a")).alias("a"), (F.col("begin") + F.col("s.b")).alias("b"))).alias("spans"))
    whole = copied.select("id", "fp")
    return copied.unionAll(spans.join(whole, ["id", "fp"], "left_anti").select("id", "fp", _joined("spans").alias("spans")))


def _named(documents: DataFrame, key: str, text: str) -> DataFrame:
    """All rows as ``_row``, with ``id`` (the key as text, null told apart), ``raw`` (bytes) and ``fp`` (a hash of them)."""
    raw = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    return carried(documents, id=F.coalesce(F.concat(F.lit("v"), F.col(key).cast("string")), F.lit("n")), raw=raw, fp=F.xxhash64(raw))


def remove_repeats(documents: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = WINDOW,
                   hot: int = HOT) -> DataFrame:
    """All rows of ``documents`` (as the struct ``_row``) with ``n_bytes``, ``spans`` and ``kept``, the bytes left."""
    found = stored(repeated_spans(documents, key=key, text=text, window=window, hot=hot), "spans")
    rows = _named(documents, key, text).join(found, ["id", "fp"], "left")
    some = F.col("spans").isNotNull()
    kept = F.when(some, _without(F.when(some, F.col("raw")), F.col("spans"))).otherwise(F.col("raw"))
    return rows.select("_row", F.octet_length("raw").cast("long").alias("n_bytes"),
                       F.coalesce("spans", F.array().cast(_SPANS)).alias("spans"), kept.alias("kept"))


@query("op11_suffixes")
def op11_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])
    return found.select("_row.doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))
