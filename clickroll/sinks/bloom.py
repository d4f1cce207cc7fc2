"""Bloom filters of text columns, built and asked with Spark's own expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASHES = 4
LEAST_BITS, MOST_BITS = 1 << 15, 1 << 23
"""A filter has ten bits a row, within these: 4 KB to 1 MB.  A fuller one says "maybe" more often."""
_PAGE = 1 << 15


def _slots(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(HASHES)]


def built(rows: DataFrame, column: str, number: int) -> bytes:
    """Filter of a column of ``number`` rows; nulls are left out.  Pages of it come to the driver, at most 1 MB."""
    bits = min(max(LEAST_BITS, 1 << (10 * number).bit_length()), MOST_BITS)
    slots = rows.where(F.col(column).isNotNull()).select(F.explode(F.array(*_slots(F.col(column), bits))).alias("s"))
    pages = slots.selectExpr(f"s div {_PAGE} AS page", f"s % {_PAGE} AS at").groupBy("page").agg(
        F.bitmap_construct_agg("at").alias("bits"))
    out = bytearray(bits // 8)
    for p in pages.collect():
        out[p["page"] * _PAGE // 8:(p["page"] + 1) * _PAGE // 8] = p["bits"]
    return bytes(out)


def holds(key: Column, bits: bytes) -> Column:
    """Whether a filter may hold a key: never false for one it was built with, null for null."""
    held = F.lit(bits)

    def bit(slot: Column) -> Column:
        byte = F.conv(F.hex(F.substring(held, (F.floor(slot / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, (slot % 8).cast("int")) == 1

    return reduce(lambda a, b: a & b, [bit(s) for s in _slots(key, 8 * len(bits))])
