"""Calendar expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# The open bounds of a version's validity.
FIRST_DAY = date(1900, 1, 1)
LAST_DAY = date(9999, 12, 31)


def date_key(day: Column) -> Column:
    """Day as an integer yyyyMMdd; NULL stays NULL."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def days_between(start: Column, end: Column) -> Column:
    return F.date_diff(end.cast("date"), start.cast("date"))


def date_attributes(day: Column) -> list[Column]:
    """The columns of a date dimension; weekday counts from Monday = 0."""
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day"),
        F.weekday(day).alias("weekday"),
        F.date_format(day, "EEEE").alias("day_name"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    ]
