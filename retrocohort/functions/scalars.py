"""Scalar expressions, all evaluated in the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Days from ``start`` to ``end``; negative when they are reversed."""
    return F.datediff(_column(end), _column(start))


def age_years(born: ColumnOrName, at: ColumnOrName) -> Column:
    """Age in years: whole anniversaries plus the elapsed share of the current one."""
    born, at = _column(born), _column(at)
    whole = F.floor(F.months_between(at, born) / 12).cast("int")
    last, following = F.add_months(born, whole * 12), F.add_months(born, (whole + 1) * 12)
    return whole + F.datediff(at, last) / F.datediff(following, last)


def binary_flag(value: ColumnOrName, members: Iterable) -> Column:
    """1 for members of the list, 0 for everything else, NULL included."""
    return F.when(_column(value).isin(list(members)), 1).otherwise(0)


def binary_flag_null(value: ColumnOrName, member: object) -> Column:
    """1 or 0 by equality; NULL stays NULL."""
    value = _column(value)
    return F.when(value.isNull(), F.lit(None).cast("int")).when(value == F.lit(member), 1).otherwise(0)


def safe_date(value: ColumnOrName) -> Column:
    """Date of a string, timestamp or date; NULL when it cannot be read."""
    return _column(value).try_cast("date")


def scientific(value: ColumnOrName) -> Column:
    """Two-decimal scientific notation such as ``1.23E-05``; NULL and text that is no number give NULL.

    ``format_string`` rounds the shortest decimal text of the number half up;
    ``format_number`` rounds the number itself, as C's ``%.2E`` does.
    """
    text = F.call_function("format_number", _column(value).try_cast("double"), F.lit("0.00E00"))
    return F.regexp_replace(text, r"E(\d)", "E+$1")
