"""Expressions that turn dirty strings into typed values.

Every expression is total: bad input gives null, never an error, so one broken
cell cannot fail a job over billions of rows.
"""

from pyspark.sql import Column, functions as F


def to_int(column: str | Column) -> Column:
    """Integer value of a string, null where it does not parse."""
    return _col(column).try_cast("int")


def dotted_year(column: str | Column) -> Column:
    """Year written with a thousands dot, such as ``2.019``."""
    return F.regexp_replace(_col(column), "[.]", "").try_cast("int")


def blank_to_null(column: str | Column) -> Column:
    """Trimmed text, null where nothing is left."""
    return F.nullif(F.trim(_col(column)), F.lit(""))


def blank_to_default(column: str | Column, default: str) -> Column:
    """Trimmed text, ``default`` where the cell is blank or null."""
    return F.coalesce(blank_to_null(column), F.lit(default))


def percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; null for an empty whole."""
    return F.try_divide(part * F.lit(100.0), whole)


def short_label(column: str | Column, length: int) -> Column:
    """Leading characters of a label, for narrow report columns."""
    return F.substring(_col(column), 1, length)


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
