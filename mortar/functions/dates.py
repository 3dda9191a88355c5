"""Month arithmetic and the two readings of a quarter."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from mortar.functions.casts import iso_date

# fixed values: month names
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
FULL_MONTHS = [
    "january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december",
]

#: two-digit years from this one on are of the last century
PIVOT = 69
#: time of day behind a date
_CLOCK = r"[T ](([01]\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d+)?)?)( ?Z|[+-]\d{2}:?\d{2})?"


def month_steps(later: Column, earlier: Column) -> Column:
    """Calendar-month boundaries between two dates; the day of month plays no part."""
    index = lambda d: F.year(d) * 12 + F.month(d)
    return index(later) - index(earlier)


def quarter_end(c: Column) -> Column:
    """``Q4-2006`` -> last day of the quarter."""
    quarter, year = F.substring(c, 2, 1).try_cast("int"), F.right(c, F.lit(4)).try_cast("int")
    return F.when(c.rlike(r"^Q[1-4].*\d{4}$"), F.last_day(F.make_date(year, quarter * 3, F.lit(1))))


def quarter_middle(c: Column) -> Column:
    """``Q2-1997`` (any case, ``-``, ``/`` or blank) -> first day of the middle month."""
    quarter, year = F.substring(c, 2, 1).try_cast("int"), F.substring(c, 4, 4).try_cast("int")
    return F.when(c.rlike(r"^[Qq][1-4][-/ ]\d{4}"), F.make_date(year, quarter * 3 - 1, F.lit(1)))


def _date(year: Column, month: Column, day: Column) -> Column:
    """Date of three numbers given as text; NULL where there is no such day."""
    number = year.try_cast("int")
    full = F.when(F.length(year) == 4, year).otherwise((number + F.when(number < PIVOT, 2000).otherwise(1900)).cast("string"))
    return F.concat_ws("-", full, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")).try_cast("date")


def _named_month(name: Column) -> Column:
    """``dec``, ``sept`` or ``december`` -> 12 as text."""
    short = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.when(name == "sept", "sep").otherwise(name))
    full = F.array_position(F.array(*[F.lit(m) for m in FULL_MONTHS]), name)
    return F.nullif(F.greatest(short, full), F.lit(0)).cast("string")


def _by_shape(c: Column) -> Column:
    """A date in any spelling but ``yyyy-MM-dd``: its shape (digits as 0, a run of letters as a) names the parser."""
    text = F.lower(F.trim(c))
    shape = F.regexp_replace(F.translate(text, "123456789", "000000000"), "[a-z]+", "a")
    marks = F.translate(text, "/.,", "---")
    part = lambda n: F.get(F.split(marks, "-"), F.lit(n))
    month_first = F.coalesce(_date(part(2), part(0), part(1)), _date(part(2), part(1), part(0)))
    words = F.regexp_extract_all(text, F.lit("[0-9]+|[a-z]+"), F.lit(0))
    word = lambda n: F.get(words, F.lit(n))
    return (
        F.when(F.upper(text).rlike(rf"^\d{{4}}-\d{{2}}-\d{{2}}{_CLOCK}$"), F.left(text, F.lit(10)).try_cast("date"))
        .when(shape.rlike(r"^00?([-/.])00?\1(0000|00)$"), month_first)  # day first where there is no such month
        .when(shape.rlike(r"^0000([-/.])00?\1 ?00?$"), _date(part(0), part(1), part(2)))
        .when(shape == "00000000", _date(F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)))
        .when(shape.rlike("^00?[- ]?a[-, ]*(0000|00)$"), _date(word(2), _named_month(word(1)), word(0)))
        .when(shape.rlike("^a[- .]?00?,? 0000$"), _date(word(2), _named_month(word(0)), word(1)))
        .when(shape.rlike("^a[- ]0000$"), _date(word(1), _named_month(word(0)), F.lit("1")))
        .when(shape.rlike("^0000[-/]00?$"), _date(part(0), part(1), F.lit("1")))
        .when(shape.rlike("^00?[-/]0000$"), _date(part(1), part(0), F.lit("1")))
        .when(shape == "0000", _date(text, F.lit("1"), F.lit("1")))
    )


def parse_date(c: Column) -> Column:
    """``yyyy-MM-dd`` or another usual spelling; month before day unless only the other way round is a date."""
    plain = iso_date(c)
    return F.when(c.isNull() | plain.isNotNull(), plain).otherwise(_by_shape(c))


def parse_origination(c: Column) -> Column:
    text = F.trim(c)
    return F.coalesce(quarter_middle(text), parse_date(text))


def period(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def month_number(name: Column) -> Column:
    """``Nov`` -> 11, any case; NULL for anything else."""
    at = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(name))
    return F.when(at > 0, at.cast("int"))
