"""Conversions that give NULL for bad input while ANSI mode stays on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def try_convert(column: Column, data_type: str) -> Column:
    return column.try_cast(data_type)


def try_date(column: Column | str, pattern: str = "yyyy-MM-dd") -> Column:
    return F.try_to_date(column, pattern)


def normal_code(column: Column | str) -> Column:
    """Code in upper case without outer spaces."""
    return F.upper(F.trim(column))


def normal_email(column: Column | str) -> Column:
    """Address in lower case without outer spaces."""
    return F.lower(F.trim(column))


def money(column: Column | str) -> Column:
    """Exact two-digit amount, so that sums do not depend on the order of the rows."""
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(18,2)")
