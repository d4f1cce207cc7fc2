"""Joins of keyed click streams; the same code joins two tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickroll.functions.slices import seconds


SALT = 4
"""Parts a hot key is dealt into; the right rows of such keys are copied as often."""
TRACKED = 10_000
"""Keys that the sketch of heavy keys follows."""


def heavy_keys(rows: DataFrame, key: str, share: float = 0.02) -> list:
    """Keys that hold at least ``share`` of the rows: at most ``1 / share`` of them.

    A space-saving sketch of fixed size finds them in one pass, merged from partial ones; counts are
    at most ``1 / TRACKED`` of the rows too large, so no heavy key is missed.
    """
    most = min(int(1 / share) + 1, TRACKED)
    found = rows.where(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k(`{key}`, {most}, {TRACKED})").alias("top"), F.count("*").alias("n")).first()
    return sorted(x["item"] for x in found["top"] or [] if x["count"] >= share * found["n"])


def _salted(a: DataFrame, b: DataFrame, hot: list | None, salt: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with a part: 0 but for hot keys, whose left rows are dealt and right rows copied."""
    if not hot:
        return a.withColumn("salt", F.lit(0)), b.withColumn("salt", F.lit(0))
    part = F.pmod(F.xxhash64("left_value"), F.lit(salt)).cast("int")
    every = F.array(*[F.lit(i) for i in range(salt)])
    is_hot = F.col("key").isin(hot)
    return (a.withColumn("salt", F.when(is_hot, part).otherwise(F.lit(0))),
            b.withColumn("salt", F.explode(F.when(is_hot, every).otherwise(F.array(F.lit(0))))))


def _keyed(df: DataFrame, prefix: str, key: str, ts: str, value: str) -> DataFrame:
    return df.select(
        F.col(key).alias("key"), F.col(ts).alias(f"{prefix}_ts"), F.col(value).alias(f"{prefix}_value")
    )


def _bucket(ts: str, width: int):
    # a plain number, so the stream keeps one event-time column per side
    return F.floor(F.unix_seconds(F.col(ts)) / F.lit(width)).cast("bigint")


def join_same_batch(left: DataFrame, right: DataFrame, key: str, ts: str, value: str,
                    width: int = 20, delay: str = "0 seconds", hot: list | None = None,
                    salt: int = SALT) -> DataFrame:
    """Pairs with equal key in the same tumbling interval of ``width`` seconds.

    The left rows of ``hot`` keys (see ``heavy_keys``) are dealt over ``salt`` parts by the hash of their
    value, and only the right rows of these keys are copied into each.  A stream keeps
    the list it starts with; tables need none, as AQE splits their keys.
    """
    a = _watermarked(_keyed(left, "left", key, ts, value), "left_ts", delay)
    b = _watermarked(_keyed(right, "right", key, ts, value), "right_ts", delay)
    a, b = _salted(a, b, hot, salt)
    a = a.withColumn("slot", _bucket("left_ts", width))
    b = b.withColumn("slot", _bucket("right_ts", width))
    near = (F.col("right_ts") > F.col("left_ts") - seconds(width)) & (
        F.col("right_ts") < F.col("left_ts") + seconds(width)
    )
    # the range adds nothing to the slot but lets a stream drop old state
    return (
        a.alias("a").join(b.alias("b"),
                          (F.col("a.key") == F.col("b.key")) & (F.col("a.salt") == F.col("b.salt"))
                          & (F.col("a.slot") == F.col("b.slot")) & near)
        .select(F.col("a.key").alias("key"), "left_value", "right_value", "left_ts", "right_ts")
    )


def _watermarked(df: DataFrame, ts: str, delay: str) -> DataFrame:
    return df.withWatermark(ts, delay) if df.isStreaming else df


def join_windowed(left: DataFrame, right: DataFrame, key: str, ts: str, value: str,
                  left_secs: int = 20, right_secs: int = 60,
                  delay: str = "0 seconds", hot: list | None = None, salt: int = SALT) -> DataFrame:
    """Pairs with equal key where the right event is less than ``right_secs``
    before and less than ``left_secs`` after the left one; each pair once.

    The join also keys on time buckets as wide as both windows together, with
    the left side copied into the one or two buckets its range touches.  A hot
    key is thereby spread over its buckets, and only events of near buckets are
    compared.  Within a bucket ``hot`` keys are dealt, as above.
    """
    width = left_secs + right_secs
    a = _watermarked(_keyed(left, "left", key, ts, value), "left_ts", delay)
    b = _watermarked(_keyed(right, "right", key, ts, value), "right_ts", delay)
    from_ = F.floor((F.unix_seconds("left_ts") - right_secs) / F.lit(width)).cast("bigint")
    to = F.floor((F.unix_seconds("left_ts") + left_secs + 1) / F.lit(width)).cast("bigint")
    a, b = _salted(a, b, hot, salt)
    a = a.withColumn("slot", F.explode(F.sequence(from_, to)))
    b = b.withColumn("slot", _bucket("right_ts", width))
    near = (F.col("right_ts") > F.col("left_ts") - seconds(right_secs)) & (
        F.col("right_ts") < F.col("left_ts") + seconds(left_secs)
    )
    return (
        a.alias("a").join(b.alias("b"),
                          (F.col("a.key") == F.col("b.key")) & (F.col("a.salt") == F.col("b.salt"))
                          & (F.col("a.slot") == F.col("b.slot")) & near)
        .select(F.col("a.key").alias("key"), "left_value", "right_value", "left_ts", "right_ts")
    )


def join_static(stream: DataFrame, static: DataFrame, key: str) -> DataFrame:
    """Rows of a stream (or table) with the matching row of a fixed data set."""
    return stream.join(static, key)
