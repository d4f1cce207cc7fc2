"""Sets of whole numbers as sorted ranges ``[first, last]``: what is mostly consecutive stays short."""

from __future__ import annotations

from bisect import bisect_right

Ranges = list[list[int]]


def added(ranges: Ranges, first: int, last: int) -> Ranges:
    """The ranges with ``first`` to ``last`` in them; ranges that touch become one."""
    out: Ranges = []
    for a, b in sorted([*ranges, [first, last]]):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def meets(ranges: Ranges, first: int, last: int) -> bool:
    """Whether a number from ``first`` to ``last`` is in the set."""
    i = bisect_right(ranges, [last, float("inf")])
    return i > 0 and ranges[i - 1][1] >= first
