"""Weighted averages, shares and rounding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def divide(a: Column, b: Column) -> Column:
    """Double division, NULL on a zero or missing divisor."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def wavg_total(value: Column, weight: Column) -> Column:
    """Weighted average whose divisor keeps the weight of rows without a value."""
    return divide(F.sum(value.cast("double") * weight.cast("double")), F.sum(weight))


def wavg_strict(value: Column, weight: Column) -> Column:
    """Weighted average over rows that have a value and a positive weight."""
    ok = value.isNotNull() & (weight > 0)
    return divide(
        F.sum(F.when(ok, value.cast("double") * weight.cast("double"))), F.sum(F.when(ok, weight))
    )


def share(pred: Column, weight: Column) -> Column:
    """Part of the total weight for which ``pred`` holds; NULL when no row qualifies."""
    return divide(F.sum(F.when(pred, weight)), F.sum(weight))


def total(c: Column) -> Column:
    """Sum of money as an exact decimal."""
    return F.sum(c)


def half_even(c: Column, digits: int) -> Column:
    return F.bround(c, digits)
