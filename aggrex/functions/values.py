"""Value coercion expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aggrex.schemas import REPORTING_RATE

# Fixed value: what counts as a number (decimal or scientific notation, optional
# sign, surrounding blanks). Spark's own cast also accepts '1d' / '1f'; the
# pattern keeps those out.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_number(col) -> Column:
    c = _c(col)
    return c.isNotNull() & c.rlike(NUMBER_PATTERN)


def to_number_or_null(col) -> Column:
    """H9: text -> DOUBLE, NULL when not a number (never raises under ANSI)."""
    c = _c(col)
    return F.when(is_number(c), F.trim(c).try_cast("double"))


def rate_100_to_1(value_num, rate_type) -> Column:
    """A REPORTING_RATE of exactly 100 becomes 1."""
    v, r = _c(value_num), _c(rate_type)
    return F.when((r == F.lit(REPORTING_RATE)) & (v == F.lit(100.0)), F.lit(1.0)).otherwise(v)
