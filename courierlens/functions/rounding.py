"""The two rounding laws in use, exact on whole numbers.

SQL reports round halves away from zero, DataFrame datasets round halves to even. A
measure is a quotient of two sums of whole numbers, so it is rounded from these in
decimal arithmetic and never passes through a double: the digits depend neither on the
size of the group nor on the order in which a distributed sum was added up.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# sums are kept to this many digits, which leaves room for the scaling below
_SUM = "decimal(24,0)"


def _whole(value: Column) -> Column:
    return value.cast(_SUM)


def _quotient(top: Column, base: Column) -> Column:
    """The whole part of top / base, without a rounded division in between."""
    return ((top - top % base) / base).cast(_SUM)


def _scaled(value: Column, sign: Column, digits: int) -> Column:
    return value.cast("double") * sign.cast("double") / F.lit(float(10**digits))


def half_up(numerator: Column, denominator: Column, digits: int) -> Column:
    """``numerator / denominator`` to ``digits`` places, halves away from zero; NULL over zero."""
    top, base = F.abs(_whole(numerator)), F.nullif(_whole(denominator), F.lit(0))
    rounded = _quotient(top * F.lit(2 * 10**digits) + base, base * F.lit(2))
    return _scaled(rounded, F.signum(numerator), digits)


def half_even(numerator: Column, denominator: Column, digits: int) -> Column:
    """``numerator / denominator`` to ``digits`` places, halves to the even digit; NULL over zero."""
    base = F.nullif(_whole(denominator), F.lit(0))
    top = F.abs(_whole(numerator)) * F.lit(10**digits)
    below = _quotient(top, base)
    twice = (top % base) * F.lit(2)
    up = (twice > base) | ((twice == base) & (below % F.lit(2) == 1))
    return _scaled(below + F.when(up, F.lit(1)).otherwise(F.lit(0)), F.signum(numerator), digits)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; NULL, not an error, when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def settled(value: Column, digits: int) -> Column:
    """A real-valued result for display.

    It is cut to nine places first: its last bits depend on the order of a distributed sum.
    """
    return F.round(F.round(value, 9), digits)
