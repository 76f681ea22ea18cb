"""Numeric column helpers: rounding, ratios, conditional counts, money sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round2(value: Column, digits: int = 2) -> Column:
    """Round half-up to ``digits`` decimals through an exact decimal.

    Spark rounds a double half-up on its shortest decimal text; going through
    ``decimal(18,8)`` first makes the tie rule explicit and keeps aggregates
    whose last bits depend on the summation order on the same side of a tie.
    Precision 18 keeps the decimal in a 64-bit long (no BigDecimal per row);
    values from 1e9 on, which it might not hold, and non-finite ones are
    rounded as doubles.
    """
    number = value.cast("double")
    exact = F.round(value.try_cast("decimal(18,8)"), digits).cast("double")
    return F.when(F.abs(number) < F.lit(1e9), exact).otherwise(F.round(number, digits))


def ratio_pct(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """``numerator * 100 / denominator`` as a rounded percentage (double math).

    An empty group (denominator 0) gives null, as without ANSI mode.
    """
    return round2(F.try_divide(numerator.cast("double") * F.lit(100.0), denominator), digits)


def count_where(condition: Column) -> Column:
    """Rows of the group where ``condition`` is true (null counts as false)."""
    return F.count_if(F.coalesce(condition, F.lit(False)))


#: Unit of the high limb of a sum of money, and the size from which an amount has one.
LIMB = 10**18
#: Amounts from here on, in either direction, are no money (and no decimal could hold them).
MONEY_LIMIT = 1e36


def summable(amount: Column) -> Column:
    """True for a finite amount that an exact sum can hold."""
    return F.coalesce(~F.isnan(amount) & (F.abs(amount) < F.lit(MONEY_LIMIT)), F.lit(False))


def money_limbs(amount: Column) -> tuple[Column, Column]:
    """An amount as ``high * LIMB + low``: whole high units, and a low part with six decimals.

    Either limb can be added up over 10^18 rows without leaving a decimal; null for an amount
    that is not :func:`summable`."""
    number = amount.cast("double")
    kept, small = summable(number), F.abs(number) < F.lit(float(LIMB))
    whole = number.try_cast("decimal(37,0)")  # from 2^53 on a double is a whole number
    unit = F.lit(LIMB).cast("decimal(19,0)")
    high = F.when(kept, F.when(small, F.lit(0)).otherwise(F.try_divide(whole - whole % unit, unit)))
    low = F.when(kept, F.when(small, amount.try_cast("decimal(24,6)")).otherwise((whole % unit).cast("decimal(24,6)")))
    return high.cast("decimal(20,0)"), low


def money_of(high: Column, low: Column, digits: int = 2) -> Column:
    """The rounded double of summed limbs."""
    near = F.round(low, digits).cast("double")
    return F.when(high == 0, near).otherwise(high.cast("double") * F.lit(float(LIMB)) + near)


def money_sum(amount: Column, digits: int = 2) -> Column:
    """Exact decimal sum of an amount, rounded half-up, returned as double.

    Two limbs are summed, so that large amounts count as well. Amounts that are
    not :func:`summable` stay out of the sum; the quality table counts them
    (``amount_not_summable``)."""
    high, low = money_limbs(amount)
    return money_of(F.try_sum(high), F.try_sum(low), digits)


def mean_rounded(value: Column, digits: int = 2) -> Column:
    """Null-skipping average, rounded half-up."""
    return round2(F.avg(value), digits)
