"""Exact money sums and HALF_UP rounding (FN13, FN14, FN16).

Double sums depend on the order rows arrive in, which differs between runs,
partitionings and engines.  Money is therefore summed exactly and only the
final value is turned into a double:

* ``amount_units(c, s)`` turns an amount into an integer count of ``10^-s``
  units with ``rint`` (one multiply and one rounding per row — no per-row
  double->decimal conversion, which costs a string round trip);
* ``units_sum`` adds the units as DECIMAL(38,0), which cannot overflow where
  a long sum would;
* ``units_to_double`` scales the exact total back once per group.

Means of integer scores are rounded from the exact ratio of two integer sums,
so ``round(mean, 2)`` never depends on how the double mean happens to print.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS_SUM = "decimal(38,0)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def amount_units(c: str | Column, scale: int = 2) -> Column:
    """``c`` as a whole number of ``10^-scale`` units (long).  Exact for
    amounts with at most ``scale`` decimals and ``|c| < 2^52 / 10^scale``;
    an amount with more decimals fails the query instead of losing value."""
    scaled = _col(c) * F.lit(float(10 ** scale))
    whole = F.rint(scaled)
    # what double arithmetic may be off by, against what a further decimal is worth
    close = F.abs(scaled - whole) <= F.greatest(F.lit(1e-3), F.abs(scaled) * F.lit(1e-12))
    fail = F.raise_error(F.concat(F.lit(f"amount finer than {scale} decimals: "), _col(c).cast("string")))
    return F.when(scaled.isNull() | close, whole).otherwise(fail).cast("long")


def units_sum(units: str | Column) -> Column:
    """Exact, overflow-safe sum of integer units."""
    return F.sum(_col(units).cast(UNITS_SUM))


def units_to_double(total: str | Column, scale: int = 2) -> Column:
    """An exact unit total as a double amount (one correctly rounded step)."""
    return (_col(total).cast(UNITS_SUM) * F.lit(Decimal(1).scaleb(-scale))).cast("double")


def ratio_half_up(numerator: str | Column, denominator: str | Column,
                  digits: int = 2) -> Column:
    """``round(numerator / denominator, digits)`` with HALF_UP on the exact
    ratio of two integers (denominator > 0).  Uses integral division of
    decimals only, so nothing overflows or is rounded on the way and the result
    is the same double in any engine."""
    num = _col(numerator).cast("decimal(32,0)")
    den = _col(denominator).cast("decimal(32,0)")
    scale = 10 ** digits
    # HALF_UP: floor((|num| * 2 * scale + den) / (2 * den)), all in integers
    top = F.abs(num) * F.lit(2 * scale) + den
    bottom = F.when(den > 0, den * F.lit(2))
    whole = F.call_function("div", top, bottom)  # exact floor division
    signed = F.when(num < 0, -whole).otherwise(whole)
    return F.when(den > 0, signed / F.lit(float(scale)))
