"""Time slices as column expressions.

Slices follow the session time zone.  With ``tz`` the slice is taken on that
zone's wall clock instead; the session must then be on UTC, as
``clickroll.tune`` sets it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Interval codes of the jobs.
INTERVALS = {
    1: "MINUTE",
    2: "HOUR",
    3: "DAY",
    4: "WEEK",
    5: "MONTH",
    6: "CUSTOM",
    7: "MONTH_WEEK",
    8: "FOREVER",
    9: "YEAR",
}

# The slice an interval is kept in.
INTERVAL_SLICES = {
    "MINUTE": "min5",
    "HOUR": "hour",
    "DAY": "day",
    "WEEK": "week",
    "MONTH": "month",
    "YEAR": "year",
}

# Seconds an interval scan looks back from the slice start. A
# full step for MINUTE (which means five minutes), half of it for the others.
SCAN_LOOKBACK = {"MINUTE": 300, "HOUR": 1800, "WEEK": 302400, "MONTH": 1296000}

# Seconds from the slice start back to the day shard it reads.
SHARD_LOOKBACK = {"MINUTE": 300, "HOUR": 1800, "WEEK": 43200, "MONTH": 43200}

SLICES = (
    "second", "minute", "min5", "hour", "half_hour", "hour_n", "day", "week",
    "month", "year",
)


def slice_of_interval(interval: int | str) -> str:
    """Slice name for an interval code or name."""
    name = INTERVALS[interval] if isinstance(interval, int) else interval
    if name not in INTERVAL_SLICES:
        raise ValueError(f"interval {name} has no slice")
    return INTERVAL_SLICES[name]


def seconds(n: int) -> Column:
    """Interval of n seconds."""
    return F.expr(f"INTERVAL '{n}' SECOND")


def _shift(start: Column, by: Column) -> Column:
    # whole seconds in plain long arithmetic; interval columns go by decimals
    return F.timestamp_seconds(F.unix_seconds(start) + by)


def _local_start(name: str, ts: Column, n: int, back: int) -> Column:
    if name in ("second", "minute", "hour"):
        start = F.date_trunc(name, ts)
        unit = {"second": 1, "minute": 60, "hour": 3600}[name]
        return start - seconds(back * unit) if back else start
    if name == "min5":
        # within the hour, so 7 gives 0, 7, .. 56 and starts again
        hour = F.date_trunc("hour", ts)
        start = _shift(hour, (F.minute(ts) - F.minute(ts) % n) * 60)
        return start - seconds(back * n * 60) if back else start
    if name == "half_hour":
        half = F.date_trunc("hour", ts) + seconds(1800)
        return F.when(ts > half, half + seconds(1800)).otherwise(half)
    if name == "hour_n":
        # hours of the 12-hour clock; morning and afternoon stay apart
        over = (F.hour(ts) % 12) % n
        return _shift(F.date_trunc("hour", ts), over * -3600)
    if name == "day":
        start = F.date_trunc("day", ts)
        return F.date_sub(start, back).cast("timestamp") if back else start
    if name == "week":
        day = F.to_date(ts)
        return F.date_sub(day, F.dayofweek(day) - 1 + 7 * back).cast("timestamp")
    if name == "month":
        month = F.trunc(F.to_date(ts), "month")
        return (F.add_months(month, -back) if back else month).cast("timestamp")
    if name == "year":
        year = F.trunc(F.to_date(ts), "year")
        return (F.add_months(year, -12 * back) if back else year).cast("timestamp")
    raise ValueError(f"unknown slice {name}")


def slice_start(name: str, ts: Column | str, n: int = 5, back: int = 0,
                tz: str | None = None) -> Column:
    """Start of the slice that holds ``ts``, or of the one ``back`` slices earlier.

    ``half_hour`` is the next half-hour mark, not the one before.  Weeks start
    on Sunday.  An interval name (``WEEK``) stands for its slice.  ``n`` is the step
    of ``min5`` (minutes) and ``hour_n`` (hours).
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    name = INTERVAL_SLICES.get(name, name)
    if tz is None:
        return _local_start(name, ts, n, back)
    wall = F.from_utc_timestamp(ts, tz)
    return F.to_utc_timestamp(_local_start(name, wall, n, back), tz)


def day_key(ts: Column | str, tz: str | None = None, fmt: str = "yyyyMMdd") -> Column:
    """Day (or month) of a timestamp as digits."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(ts if tz is None else F.from_utc_timestamp(ts, tz), fmt)


def day_shard(start: Column | str, interval: str, tz: str | None = None) -> Column:
    """Day shard a slice reads: the day half an interval before the slice starts."""
    start = F.col(start) if isinstance(start, str) else start
    return day_key(start - seconds(SHARD_LOOKBACK[interval]), tz)
