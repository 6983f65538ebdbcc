"""Edit distance of texts, in UTF-16 units as script engines count them.

One Arrow function: what two texts begin and end with in common is left out, and the rest takes a bit for each cell of
the table, a whole row of steps in a few operations on integers. With a greatest distance it ends as soon as
the rest can't bring it back within that.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col


def units(text: str) -> list[int]:
    """UTF-16 units of a text."""
    return list(text.encode("ascii")) if text.isascii() else np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16).tolist()


def distance(a: list[int], b: list[int], most: int | None = None) -> int:
    """Fewest insertions, deletions and substitutions; most + 1 if it is more than most."""
    n, m = len(a), len(b)
    while n and m and a[n - 1] == b[m - 1]:
        n, m = n - 1, m - 1
    k, short = 0, min(n, m)
    while k < short and a[k] == b[k]:
        k += 1
    a, b = a[k:n], b[k:m]
    if len(a) > len(b):
        a, b = b, a
    beyond = len(b) + 1 if most is None else most + 1
    if not a or len(b) - len(a) >= beyond:
        return min(len(b), beyond)
    places: dict[int, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, value, left = full, 0, len(a), len(b)  # where a column rises and falls going down, and what it ends with
    for c in b:
        same = places.get(c, 0)
        free = same | down
        same |= ((same & up) + up ^ up) & full  # the additions carry along runs of steps
        rise, fall = down | full & ~(same | up), up & same  # along the row
        if rise & top:
            value += 1
        elif fall & top:
            value -= 1
        left -= 1
        if value - left >= beyond:
            return beyond
        rise = rise << 1 & full | 1
        fall = fall << 1 & full
        up, down = fall | full & ~(free | rise), rise & free
    return min(value, beyond)


def _measured(a: pa.Array, b: pa.Array) -> pa.Array:
    found, shares = [], []
    for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True):
        if x is None or y is None:
            found.append(None)
            shares.append(None)
            continue
        p, q = units(x), units(y)
        found.append(distance(p, q))
        shares.append(found[-1] / max(len(p), len(q), 1))
    return pa.StructArray.from_arrays([pa.array(found, pa.int32()), pa.array(shares, pa.float64())], ["distance", "share"])


def _gate(most: float):
    def beyond(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True):
            if x is None or y is None:
                out.append(None)
                continue
            p, q = units(x), units(y)
            longest = max(len(p), len(q))
            # the greatest distance that the share still allows
            allowed = int(most * longest)
            while (allowed + 1) / max(longest, 1) <= most:
                allowed += 1
            out.append(distance(p, q, allowed) > allowed)
        return pa.array(out, pa.bool_())

    return beyond


def _both(a: Column | str, b: Column | str) -> Column:
    return F.arrow_udf(_measured, "distance int, share double")(col(a), col(b))


def edit_distance(a: Column | str, b: Column | str) -> Column:
    return _both(a, b)["distance"]


def norm_edit_distance(a: Column | str, b: Column | str) -> Column:
    """Edit distance over the longer length: 0 for equal texts, 1 where one is empty."""
    return _both(a, b)["share"]


def distance_beyond(a: Column | str, b: Column | str, most: float) -> Column:
    """Whether the normalized edit distance is more than most; only as much of it is found out as that takes."""
    return F.arrow_udf(_gate(most), "boolean")(col(a), col(b))
