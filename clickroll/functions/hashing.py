"""String hash and key partitioning as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def java_string_hash(text: Column | str) -> Column:
    """32-bit ``s[0]*31^(n-1) + .. + s[n-1]`` over UTF-16 units; null for "".

    The unit list is taken from one hex dump, and the sum is reduced to 32 bits
    at every step so it never leaves a bigint.
    """
    text = F.col(text) if isinstance(text, str) else text
    units = F.regexp_extract_all(
        F.hex(F.encode(text, "UTF-16BE")), F.lit("([0-9A-F]{4})"), F.lit(1)
    )
    wrap = F.lit(1 << 32)
    half = F.lit(1 << 31)
    total = F.aggregate(
        units,
        F.lit(0).cast("bigint"),
        lambda acc, unit: (acc * 31 + F.conv(unit, 16, 10).cast("bigint")) % wrap,
        lambda acc: F.when(acc >= half, acc - wrap).otherwise(acc).cast("int"),
    )
    return F.when(text != "", total)


def octet_partition(key: Column | str, partitions: int) -> Column:
    """Number after the last dot of the key, modulo ``partitions``; else 0."""
    key = F.col(key) if isinstance(key, str) else key
    last = F.substring_index(key, ".", -1).try_cast("int")
    dotted = key.rlike(r"^.+\.[0-9]+$")
    return F.coalesce(F.when(dotted, F.pmod(last, F.lit(partitions))), F.lit(0)).cast("int")
