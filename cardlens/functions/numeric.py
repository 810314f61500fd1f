"""Rates, rounding and exact money sums.

Sums of doubles depend on the order in which partitions are merged, so a rounded
average could change from run to run.  Amounts are therefore summed as whole cents
in a long: exact, order-free, and about as fast as a plain double sum, where a
decimal sum costs some ten times more.  A long holds 9.2e16 currency units; a larger
amount is an error, and so is a larger sum.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, digits: int) -> Column:
    """Round to ``digits`` decimals, ties upward, the same in every SQL engine.

    NaN is missing.  From 2^53 units on a double has no digits left to round and stays as it is.
    """
    unit = float(10**digits)
    number = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    scaled = number * F.lit(unit)
    return F.when(F.abs(scaled) < F.lit(2.0**53), F.floor(scaled + F.lit(0.5)) / F.lit(unit)).otherwise(number)


def cents(amount: Column | str) -> Column:
    """Amount as whole cents; NaN counts as missing, an amount beyond the range is an error."""
    value = (F.col(amount) if isinstance(amount, str) else amount).cast("double")
    scaled = F.nanvl(value, F.lit(None).cast("double")) * F.lit(100.0) + F.lit(0.5)
    too_large = F.raise_error(F.lit("an amount is too large for whole cents")).cast("bigint")
    return F.when(F.abs(scaled) >= F.lit(9.2e18), too_large).otherwise(F.floor(scaled))


def money_sum(amount: Column | str) -> Column:
    return F.sum(cents(amount)) / F.lit(100.0)


def money_mean(amount: Column | str, digits: int | None = 2) -> Column:
    whole = cents(amount)
    mean = F.try_divide(F.sum(whole) / F.lit(100.0), F.count(whole))
    return mean if digits is None else round_half_up(mean, digits)


def percent(part: Column, whole: Column, digits: int) -> Column:
    """``100 * part / whole`` rounded; NULL, not an error, when ``whole`` is zero."""
    return round_half_up(F.try_divide(part.cast("double") * F.lit(100.0), whole), digits)
