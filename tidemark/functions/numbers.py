"""Numbers carried as text, and the small arithmetic of the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: plain and scientific decimals, spaces around, nothing else.
# It keeps out what a bare cast would take ('1.0d', 'NaN', 'Infinity').
NUMBER_PATTERN = r"^ *[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)? *$"
# Fixed value: the largest finite double.
MAX_DOUBLE = 1.7976931348623157e308


def strict_double(text: Column) -> Column:
    """The double a text stands for, or NULL. Never fails the job, never infinite."""
    value = F.when(text.rlike(NUMBER_PATTERN), text).try_cast("double")
    return F.when(F.abs(value) <= MAX_DOUBLE, value)


def is_strict_number(text: Column) -> Column:
    return strict_double(text).isNotNull()


def clamp(value: Column, low: Column, high: Column) -> Column:
    return F.least(F.greatest(value, low), high)


def to_fixed(value: Column, digits: int) -> Column:
    return F.round(value, digits)


def page_count(total: Column, page_rows: int) -> Column:
    """Pages needed to show ``total`` rows; an empty result still has one page."""
    return F.greatest(F.lit(1).cast("long"), F.ceil(total / F.lit(page_rows)).cast("long"))
