"""Month and year expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_of_period(code: Column) -> Column:
    """``M01`` -> 1. Text from the second character on, at most three long."""
    return F.substring(code, 2, 3).try_cast("int")


def is_calendar_month(month: Column) -> Column:
    """False for the annual average, which is coded as month 13."""
    return month.between(1, 12)


def year_month(day: Column) -> Column:
    """Zero-padded ``yyyyMM``, the address of a month of raw data."""
    return F.date_format(day, "yyyyMM")


def parsed_date(text: Column) -> Column:
    return text.try_cast("date")
