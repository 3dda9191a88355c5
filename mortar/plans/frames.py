"""The frames every registered query starts from, and the presentation of results."""

from __future__ import annotations

from collections.abc import Sequence
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from mortar.operators import prep, star
from mortar.sources import sample_tape

#: per session: analysed (still lazy) source frames, so that a query does not rebuild the tape's plan
_KNOWN: WeakKeyDictionary = WeakKeyDictionary()


class Frames:
    """Lazy frames over one test-data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        if spark not in _KNOWN:
            _KNOWN[spark] = {}

    def _once(self, name: str, build) -> DataFrame:
        known = _KNOWN[self.spark]
        if (name, self.sf_dir) not in known:
            known[name, self.sf_dir] = build()
        return known[name, self.sf_dir]

    def tape(self) -> DataFrame:
        return self._once("tape", lambda: sample_tape.loan_tape(self.spark, self.sf_dir))

    def raw(self) -> DataFrame:
        return sample_tape.raw_tape(self.spark, self.sf_dir)

    def fact(self) -> DataFrame:
        return self._once("fact", lambda: star.fact_loan_period(self.tape()))

    def dim(self) -> DataFrame:
        return self._once("dim", lambda: star.dim_loan(self.tape()))

    def star(self, *columns: str) -> DataFrame:
        return star.star_join(self.fact(), self.dim(), list(columns), self.parts())

    def parts(self) -> int:
        return self._once("parts", lambda: sample_tape.parts(self.spark, self.sf_dir))

    def loans(self, tape_keys: Sequence[str] | None = None) -> DataFrame:
        return self._once(f"loans {tape_keys}", lambda: prep.prep_loans(self.tape(), tape_keys))

    def exits(self) -> DataFrame:
        return prep.prep_exits(prep.exits_sheet(self.tape()))

    def notes(self) -> DataFrame:
        return self._once("notes", lambda: sample_tape.note_tape(self.spark, self.sf_dir))

    def reported(self) -> DataFrame:
        return self._once("reported", lambda: sample_tape.reported_history(self.spark, self.sf_dir))

    def pages(self) -> DataFrame:
        return self._once("pages", lambda: sample_tape.report_pages(self.spark, self.sf_dir))


def present(df: DataFrame, **digits: int) -> DataFrame:
    """Results in plain types: decimals as doubles, doubles rounded half-even, counts as bigint.

    Doubles get six digits and decimals keep theirs unless ``digits`` says otherwise.
    """
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            c = (F.bround(c, digits[field.name]) if field.name in digits else c).cast("double")
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = F.bround(c, digits.get(field.name, 6))
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        out.append(c.alias(field.name))
    return df.select(*out)
