"""Exact ratios for DECIMAL serving columns.

A DECIMAL(p, s) rate must be rounded half-up at ``s`` digits. Rounding a double
is not exact near ties (2.675 is stored just below the tie), so rates over integer
counts are rounded in integer arithmetic and only the final ``n / 10^s`` is a double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str | int) -> Column:
    if isinstance(x, Column):
        return x
    return F.col(x) if isinstance(x, str) else F.lit(x)


def floor_div(a: Column, b: Column) -> Column:
    """Exact ``floor(a / b)`` for BIGINT 0 <= a <= 2^62 and b > 0.

    The double quotient is off by at most ``a * 2^-52 + 1``. One step on the exact
    BIGINT remainder brings it within one, and a last integer comparison in each
    direction makes it exact, so large cent totals round correctly too.
    """
    a, b = a.cast("bigint"), b.cast("bigint")
    q0 = F.floor(a.cast("double") / b.cast("double")).cast("bigint")
    q1 = q0 + F.floor((a - q0 * b).cast("double") / b.cast("double")).cast("bigint")
    return (F.when(q1 * b > a, q1 - 1)
             .when((q1 + 1) * b <= a, q1 + 1)
             .otherwise(q1))


def half_up_units(num: Column | str, den: Column | str, scale: int) -> Column:
    """round_half_up(num / den * 10^scale) as BIGINT, for integer num and den > 0.

    Halves round away from zero, as a decimal cast does. NULL unless den > 0.
    """
    n, d = _c(num).cast("bigint"), _c(den).cast("bigint")
    units = floor_div(F.abs(n) * F.lit(2 * 10 ** scale) + d, d * F.lit(2))
    return F.when(d > 0, F.when(n < 0, -units).otherwise(units))


def half_up_ratio(num: Column | str, den: Column | str, scale: int) -> Column:
    """num / den rounded half-up at ``scale`` digits, as a DOUBLE."""
    return half_up_units(num, den, scale).cast("double") / F.lit(float(10 ** scale))
