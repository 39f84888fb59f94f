"""Exact two-digit rounding in whole cents.

``avg(decimal)`` rounds to its own scale first, so rounding it again can land one
cent off. Sums of cents and one integer division have a single rounding step.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_cents(amount: Column) -> Column:
    """A decimal with two digits as whole cents."""
    return (amount * F.lit(100)).cast("bigint")


def from_cents(cents: Column, precision: int) -> Column:
    """Whole cents as ``decimal(precision, 2)``."""
    return (cents.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast(f"decimal({precision},2)")


def rounded_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` to the nearest whole, halves up; both non-negative.

    NULL when the denominator is 0 or NULL.
    """
    whole = F.nullif(denominator, F.lit(0).cast("bigint"))
    doubled = F.lit(2).cast("bigint")
    return F.call_function("div", doubled * numerator + whole, doubled * whole)


def mean_of_cents(sum_cents: Column, count: Column, precision: int = 10) -> Column:
    """Mean amount rounded to cents."""
    return from_cents(rounded_ratio(sum_cents, count), precision)


def percentage(part: Column, total: Column) -> Column:
    """``part`` of ``total`` in percent, rounded to two digits."""
    return from_cents(rounded_ratio(part * F.lit(10000).cast("bigint"), total), 5)
