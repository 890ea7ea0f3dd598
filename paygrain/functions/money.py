"""Null-safe ratios and exact money arithmetic.

Inside an aggregation an amount is two whole numbers: its whole units, and the rest in millionths
(``MONEY_DIGITS`` digits after the point, finer than any currency in use and four more than a
cent). Both are summed as 64-bit integers, in generated code and without objects: sums are exact,
do not depend on the order in which partitions arrive, and an overflow raises (ANSI mode) rather
than wrap. That is at 9 * 10^18 units, or at as many millionths, for which it takes 9 * 10^12 rows. The
two become one figure at the end. An amount with more digits is rounded, row by row;
``finer_than_money`` finds such rows, and a critical check of the quality gate counts them.
Amounts are exact to all six digits below 2^33, where a double has them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_DIGITS = 6
SCALE = 10**MONEY_DIGITS
SAFE_UNITS = 9_000_000_000  # so many units in millionths are whole numbers that a double has
NOISE = 1e-9  # of an amount: what binary fractions leave where decimal digits end


def _column(amount: str | Column) -> Column:
    return F.col(amount) if isinstance(amount, str) else amount


def units(amount: str | Column) -> Column:
    """The whole units of an amount; what is no number, or too large for one, raises."""
    return _column(amount).cast("bigint")


def fraction(amount: str | Column, digits: int = MONEY_DIGITS) -> Column:
    """What is left of an amount beside its whole units, in its last digit."""
    return F.rint((_column(amount) - units(amount)) * float(10**digits)).cast("bigint")


def limbs(name: str) -> tuple[str, str]:
    """The names of the two columns of the money total ``name``."""
    return f"{name}_units", f"{name}_millionths"


def money_sums(amount: str | Column, name: str) -> dict[str, Column]:
    """The two sums of an amount, by column name."""
    return dict(zip(limbs(name), (F.sum(units(amount)), F.sum(fraction(amount))), strict=True))


def dollars(name: str) -> Column:
    """The money total ``name``, kept in its two columns, as a double."""
    return as_double(*map(F.col, limbs(name)))


def as_double(whole: Column, millionths: Column) -> Column:
    """The double nearest to an exact total; null where it is null."""
    exact = whole.cast("decimal(38,0)") * SCALE + millionths
    few = F.abs(whole) + F.abs(F.floor(millionths / SCALE)) < SAFE_UNITS
    return F.when(few, (whole * SCALE + millionths) / F.lit(float(SCALE))).when(
        whole.isNotNull(), (exact.cast("decimal(38,0)") / F.lit(SCALE).cast("decimal(7,0)")).cast("double")
    )


def finer_than_money(amount: str | Column, digits: int = MONEY_DIGITS) -> Column:
    """Whether an amount has digits that an exact sum would lose."""
    column = _column(amount)
    kept = units(column) + fraction(column, digits) / F.lit(float(10**digits))
    return F.abs(column - kept) > NOISE * F.greatest(F.lit(1.0), F.abs(column))


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """``numerator / denominator`` as a double, null where the denominator is zero or null."""
    return F.try_divide(numerator, denominator)


def clip(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def lookup(key: str | Column, values: dict) -> Column:
    """Value of ``key`` in a small fixed mapping, null when it is not listed."""
    pairs = [F.lit(item) for pair in values.items() for item in pair]
    return F.try_element_at(F.create_map(*pairs), F.col(key) if isinstance(key, str) else key)


def round_half_even(value: Column, digits: int = 0) -> Column:
    """Round the scaled double to the nearest whole number, halves to even, and scale back."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale
