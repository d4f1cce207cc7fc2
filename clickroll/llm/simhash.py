"""Near duplicates by SimHash, found with deletion variants of fingerprint segments.

With at most ``d`` differing bits and ``d // 2 + 1`` segments, one segment differs by
at most one bit.  Each segment is indexed once per bit with that bit left out; two
fingerprints with a close segment then share a key, and an equality join followed by
a count of the differing bits finds every link.

Equal fingerprints are one row from the start.  Before the join, cheap links (to the
most frequent fingerprint and to the neighbours in order, within equal segments) merge
most of a large group of near copies into one label.  The join then looks only at
pairs of different labels, each with a member outside the label that leads its
bucket, so neither links nor comparisons grow with the square of such a group.
Links inside a label add nothing to the components, so none is lost.

Defined cases: null and empty texts have no words and get fingerprint zero, which is
linked like any other; texts of fewer words than a shingle are one shingle; ids may
repeat or be null (a null id is never the smallest, unless the component has no other).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickroll.llm.common import carried, encoded, query, space_words, table
from clickroll.llm.components import components
from clickroll.session import stored

BITS = 64
_CHUNK = 1 << 16
"""Shingles hashed at a time: bounds the memory one text takes."""


def fingerprint_of(raw: bytes, shingle: int = 4, seed: int = 42) -> int:
    """SimHash of a text: a bit is set if it is in over half of the shingle hashes."""
    words = space_words(raw.lower())
    if not words:
        return 0
    shingle = min(shingle, len(words))
    n = len(words) - shingle + 1
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(BITS, np.int64)
    for i in range(0, n, _CHUNK):
        j = min(n, i + _CHUNK)
        spans = zip(starts[i:j].tolist(), ends[i + shingle - 1:j + shingle - 1].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * set_bits > n, bitorder="little").tobytes(), "little", signed=True)


def fingerprint(text: Column, shingle: int = 4, seed: int = 42) -> Column:
    """Fingerprint of a text column, as a signed 64-bit number."""
    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint_of(encoded(t), shingle, seed) for t in texts.array], dtype="int64")

    return of(F.coalesce(text, F.lit("")))


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, length) of as few segments as leave one with at most one differing bit."""
    n = distance // 2 + 1
    cuts = [round(BITS * i / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _part(start: Column | int, length: int) -> Column:
    value = F.expr(f"shiftrightunsigned(fp, {start})")
    return value if length >= BITS else value.bitwiseAND(F.lit((1 << length) - 1))


def _variants(prints: DataFrame, distance: int) -> DataFrame:
    """One row per bit: its segment with that bit left out, keyed by bit and rest."""
    key = None
    for start, length in segments(distance):
        hole = F.expr(f"~shiftleft(1L, bit - {start})")
        rest = F.struct(F.col("bit"), _part(start, length).bitwiseAND(hole).alias("rest"))
        inside = F.col("bit") < start + length
        key = F.when(inside, rest) if key is None else key.when(inside, rest)
    bits = F.explode(F.array(*[F.lit(i) for i in range(BITS)])).alias("bit")
    return prints.select("fp", "label", bits).select(key.alias("_k"), "fp", "label").select("_k.*", "fp", "label")


def _close(a: str, b: str, distance: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance


def _cheap_links(prints: DataFrame, distance: int) -> DataFrame:
    """Links within equal segments: to the most frequent fingerprint and to neighbours."""
    parts = F.explode(F.array(*[
        F.struct(F.lit(i).alias("segment"), _part(start, length).alias("value"))
        for i, (start, length) in enumerate(segments(distance))]))
    rows = prints.select("fp", "copies", parts.alias("_p")).select("fp", "copies", "_p.*")
    bucket = Window.partitionBy("segment", "value")
    turned = F.expr("shiftleft(fp, 32) | shiftrightunsigned(fp, 32)")
    seen = rows.select(
        "fp",
        F.max(F.struct("copies", "fp")).over(bucket)["fp"].alias("a"),
        F.lag("fp").over(bucket.orderBy("fp")).alias("b"),
        F.lag("fp").over(bucket.orderBy(turned)).alias("c"),
    )
    ends = F.explode(F.array("a", "b", "c")).alias("v")
    return seen.select(F.col("fp").alias("u"), ends).where("u <> v").where(_close("u", "v", distance)).distinct()


def _label_links(prints: DataFrame, distance: int) -> DataFrame:
    """Pairs of labels between which a link exists, from the variant index."""
    bucket = Window.partitionBy("bit", "rest")
    shared = _variants(prints, distance).withColumns(
        {"lo": F.min("label").over(bucket), "hi": F.max("label").over(bucket)}).where("lo <> hi")
    # all on the one shuffle by key: size of each label in its bucket, then the largest label
    sized = shared.withColumn("size", F.count("*").over(Window.partitionBy("bit", "rest", "label")))
    led = sized.withColumn("lead", F.max(F.struct("size", "label")).over(bucket)["label"]).select(
        "bit", "rest", "fp", "label", "lead")
    rest = led.where("label <> lead").select("bit", "rest", F.col("fp").alias("x"), F.col("label").alias("u"))
    # every pair of labels has a side that does not lead; two such sides meet once
    pairs = rest.join(led.withColumnsRenamed({"fp": "y", "label": "v"}), ["bit", "rest"]).where(
        (F.col("v") == F.col("lead")) | (F.col("u") < F.col("v"))).where("u <> v")
    return pairs.where(_close("x", "y", distance)).select("u", "v").distinct()


def near_duplicates(documents: DataFrame, *, key: str = "doc_id", text: str = "text", distance: int = 4,
                    shingle: int = 4, seed: int = 42) -> DataFrame:
    """One row per row of ``documents``: the key, ``fp`` and ``component_id``.

    ``component_id`` is the smallest key among the rows reachable over links of at
    most ``distance`` differing bits.
    """
    rows = stored(documents.select(
        F.col(key).alias("_key"), fingerprint(F.col(text), shingle, seed).alias("fp")), "fingerprints")
    prints = rows.groupBy("fp").agg(F.min("_key").alias("first"), F.count("*").alias("copies"))
    merged = components(_cheap_links(prints, distance)).select(
        F.col("node").alias("fp"), F.col("root").alias("label"))
    labelled = stored(prints.join(merged, "fp", "left").select(
        "fp", "first", F.coalesce("label", "fp").alias("label")), "labels")
    roots = components(_label_links(labelled, distance)).select(
        F.col("node").alias("label"), F.col("root"))
    joined = labelled.join(roots, "label", "left").withColumn("root", F.coalesce("root", "label"))
    firsts = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    members = joined.join(firsts, "root").select("fp", "component_id")
    return rows.join(members, "fp").select(F.col("_key").alias(key), "fp", "component_id")


def unique_documents(documents: DataFrame, *, key: str = "doc_id", text: str = "text", distance: int = 4,
                     shingle: int = 4) -> DataFrame:
    """The rows of ``documents`` of which no near duplicate has a smaller key.

    Of repeated rows with the smallest key one stays; rows without a key stay.
    """
    found = near_duplicates(documents, key=key, text=text, distance=distance, shingle=shingle)
    first = found.where(F.col(key) == F.col("component_id")).select(F.col(key).alias("_first")).distinct()
    rows = carried(documents, _key=F.col(key))
    kept = rows.where(F.col("_key").isNotNull()).join(first, F.col("_key") == F.col("_first"), "left_semi")
    return kept.dropDuplicates(["_key"]).union(rows.where(F.col("_key").isNull())).select("_row.*")


@query("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
