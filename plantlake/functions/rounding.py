"""Rounding that gives the same answer on every engine and every run.

``round(double, n)`` is decided by the binary value on some engines and by the
shortest decimal text on others, and a sum's last bit depends on the order of
its additions.  Going through a fixed decimal first settles both: values within
1e-6 of a tie round half-up (away from zero), everything else rounds as usual.
What the decimal cannot hold (NaN, infinities, very large values) rounds plainly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Scale of the intermediate decimal, its precision, and where plain rounding takes over.
TIE_SCALE = 6
DECIMAL_PRECISION = 38
DECIMAL_LIMIT = 1e31

ROUNDINGS = ("stable", "plain")


def plain_round(col: Column | str, digits: int = 1) -> Column:
    """``round(x, digits)`` as Spark does it on doubles."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c.cast("double"), digits)


def stable_round(col: Column | str, digits: int = 1) -> Column:
    """``round(x, digits)`` half-up through ``decimal(38, 6)``, returned as double.

    NULL stays NULL; NaN, infinities and values from 1e31 on round as ``plain_round`` does.
    """
    c = F.col(col) if isinstance(col, str) else col
    fits = F.abs(c.cast("double")) < DECIMAL_LIMIT  # false for NaN, which sorts above all numbers
    decimal = F.round(c.try_cast(DecimalType(DECIMAL_PRECISION, TIE_SCALE)), digits).cast("double")
    return F.when(fits, decimal).otherwise(plain_round(c, digits))


def stable_round_sql(expr: str, digits: int = 1) -> str:
    """The same rounding as Spark SQL text."""
    decimal = f"CAST(ROUND(TRY_CAST({expr} AS DECIMAL({DECIMAL_PRECISION},{TIE_SCALE})), {digits}) AS DOUBLE)"
    return f"CASE WHEN abs(CAST({expr} AS DOUBLE)) < {DECIMAL_LIMIT:g} THEN {decimal} ELSE round(CAST({expr} AS DOUBLE), {digits}) END"
