"""Tolerant conversions of tape text: a bad value becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed values: spellings of "no value" on a tape
NULL_SPELLINGS = ("", "nan", "NaT", "ND")


def null_spellings(c: Column) -> Column:
    return F.when(F.trim(c).isin(*NULL_SPELLINGS), None).otherwise(c)


def money(c: Column) -> Column:
    return c.try_cast("decimal(18,2)")


def ratio(c: Column) -> Column:
    return c.try_cast("decimal(18,9)")


def whole(c: Column) -> Column:
    """Whole numbers only: ``12.0`` is not one."""
    return c.try_cast("bigint")


def iso_date(c: Column) -> Column:
    """``yyyy-MM-dd`` with leading zeros and nothing else."""
    shaped = (F.length(c) == 10) & (F.substring(c, 5, 1) == "-") & (F.substring(c, 8, 1) == "-")
    return F.when(shaped, c.try_cast("date"))


#: what counts as a figure: Spark's own cast also takes a type suffix (``12d``), words for infinity, and hexadecimals
_FIGURE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _figure(c: Column) -> Column:
    """What ends in a digit and has no ``x`` needs no pattern: the cast takes nothing else of that kind."""
    plain = F.right(c, F.lit(1)).between("0", "9") & ~c.contains("x") & ~c.contains("X")
    return F.when(plain | c.rlike(_FIGURE), c.try_cast("double"))


def number(c: Column) -> Column:
    """Any numeric text as double, else NULL."""
    return _figure(c.cast("string"))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def decode(c: Column, labels: dict[str, str]) -> Column:
    """Label of a code from a short fixed list, NULL for an unknown code."""
    pairs = ", ".join(f"{_quoted(code)}, {_quoted(label)}" for code, label in labels.items())
    return F.try_element_at(F.expr(f"map({pairs})"), c)


def decode_number(c: Column, labels: dict[str, str]) -> Column:
    """As :func:`decode`, for codes delivered as any spelling of a whole number (``3``, ``3.0``).

    The plain spelling is looked up as text; only others are read as numbers.
    """
    pairs = ", ".join(f"{code}D, {_quoted(label)}" for code, label in labels.items())
    return F.coalesce(decode(c, labels), F.try_element_at(F.expr(f"map({pairs})"), number(c)))


def without_noise(c: Column) -> Column:
    """Report text of a figure without thousands commas, ``%``, the pound sign and ``GBP``."""
    return F.translate(F.replace(F.trim(c), F.lit("GBP"), F.lit("")), ",%£", "")


def figure(c: Column) -> Column:
    """Plain text as a number.  It looks at its argument several times: give it a column, not what computes one."""
    return _figure(c)


def may_be_figure(c: Column) -> Column:
    """False for most words that are no figure, at the price of a comparison: those that begin with a letter other than G."""
    return (c < "A") | (c >= "{") | c.startswith("G")


def parse_number(c: Column) -> Column:
    """A figure in report text, noise taken off.

    Words for "none" (``N/A``, ``null``, ``-``, blank) are no numbers and give NULL.
    """
    return _figure(without_noise(c))
