"""Sums of doubles that do not depend on the order of the rows.

A double sum rounds after every addition, so its last bits change with the partitioning.  Here each value is cut into
three whole numbers, its multiples of 2**-8 and of 2**-38 and 2**-68 of what is left, which are exact; the numbers are
added as 64-bit integers, where order is of no matter, and put together once per group.  Bits of a value under 2**-68
(5e-21) are dropped.  All parts are plain sums, so they are combined on the map side before the shuffle like any sum.

A group falls back to the double sum if a value is not finite or reaches 2**54 (1.8e16), or an integer sum overflows
(2**33 rows at least, for values under 2**21).  NaN and infinities give what the double sum gives, in any order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bits of the first part after the point, bits of each of the others, and where the fallback begins.
POINT_BITS, LIMB_BITS = 8, 30
LIMIT = 2.0**54


def limbs(x: Column) -> tuple[Column, Column, Column]:
    """Three longs; NULL for a NULL and for what the parts cannot hold."""
    scaled = F.when(F.abs(x) < LIMIT, x * 2.0**POINT_BITS)
    high = F.floor(scaled)
    rest = (scaled - high) * 2.0**LIMB_BITS
    middle = F.floor(rest)
    return high, middle, F.floor((rest - middle) * 2.0**LIMB_BITS)


def exact_sum(col: Column | str) -> Column:
    """``sum(x)`` as a double, the same bits for every order and partitioning of the rows."""
    x = (F.col(col) if isinstance(col, str) else col).cast("double")
    high, middle, low = (F.try_sum(c) for c in limbs(x))
    whole = (high + (middle + low / 2.0**LIMB_BITS) / 2.0**LIMB_BITS) / 2.0**POINT_BITS
    fits = (F.max(F.abs(x)) < LIMIT) & high.isNotNull() & middle.isNotNull() & low.isNotNull()
    return F.when(fits, whole).otherwise(F.sum(x))


def exact_avg(col: Column | str) -> Column:
    """``avg(x)`` as a double from ``exact_sum``; NULL for a group without values."""
    x = F.col(col) if isinstance(col, str) else col
    n = F.count(x)
    return F.when(n > 0, exact_sum(x) / n)
