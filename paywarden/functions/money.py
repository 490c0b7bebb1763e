"""Rounding and summing rules for amounts and scores kept as doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 2^27 + 1 splits a double into two halves of 26 bits, so that each half times
# 200 is exact.
_SPLITTER = 134217729.0
# From here on a double has at most 12 binary places, so its fraction times 100 is exact.
_FEW_PLACES = 2.0**40
# From here on doubles lie further apart than hundredths, and each is its own rounding.
_COARSE = 2.0**46

# Amounts under this bound fit decimal(18,2), which Spark keeps in one long.
_NARROW_BOUND = 1e15
# Amounts under this bound fit decimal(28,2); ten billion of them fit their sum.
_WIDE_BOUND = 1e25


def round_half_even(value: Column) -> Column:
    """Round a double to 2 places by its exact binary value, true ties to even.

    ``bround`` looks at the shortest decimal text of the double: it takes 2.675
    for a tie although the stored value lies below it. Here the integer nearest
    to ``value * 200`` tells the result if it is even; if it is odd, the value
    is close to a tie, and the sign of its distance from the tie is computed
    without rounding error. Large values have so few binary places that their
    whole part and fraction are rounded exactly on their own.
    """
    doubled = F.rint(value * 200.0)
    shifted = value * _SPLITTER
    high = shifted - (shifted - value)
    low = value - high
    excess = (high * 200.0 - doubled) + low * 200.0
    hundredths = (
        F.when(doubled % 2.0 == 0, doubled / 2.0)
        .when(excess > 0, (doubled + 1.0) / 2.0)
        .when(excess < 0, (doubled - 1.0) / 2.0)
        .otherwise(F.rint(doubled / 2.0))
    )
    fraction = value % 1.0
    # The whole part gives an even number of hundredths, so ties go the same way.
    large = (value - fraction) * 100.0 + F.rint(fraction * 100.0)
    return (
        F.when(F.abs(value) >= _COARSE, value)
        .when(F.abs(value) >= _FEW_PLACES, large / 100.0)
        .otherwise(hundredths / 100.0)
    )


def exact_sum(amount: Column) -> Column:
    """Sum of amounts in hundredths, independent of row order up to 1e25 an amount.

    The sums run over decimals, those of usual size apart from larger ones. An
    amount too large for both is added as a double instead of failing the job
    or being dropped.
    """
    size = F.abs(amount)
    usual = F.sum(F.when(size < _NARROW_BOUND, amount.cast("decimal(18,2)")))
    large = F.sum(F.when((size >= _NARROW_BOUND) & (size < _WIDE_BOUND), amount.cast("decimal(28,2)")))
    huge = F.sum(F.when(size >= _WIDE_BOUND, amount))
    exact = F.coalesce(usual + large, usual, large).cast("double")
    return F.coalesce(exact + huge, exact, huge)


def round_half_up(value: Column) -> Column:
    """Round a double to 2 places, ties away from zero, as the warehouse does."""
    return F.round(value, 2)


def percentage(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``, rounded to 2 places; NULL for an empty whole."""
    return round_half_up(F.try_divide(part, whole) * 100)
