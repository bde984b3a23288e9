"""Measures, bands and guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def net_amount(gross: Column, discount: Column) -> Column:
    return (gross * (F.lit(1) - discount)).cast("decimal(18,4)")


def mean(col: Column) -> Column:
    """Exact sum divided once as double; independent of row order for decimals."""
    return F.try_divide(F.sum(col).cast("double"), F.count(col))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, NULL when `whole` is 0."""
    return F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double"))


def discount_band(discount: Column) -> Column:
    return (
        F.when(discount == 0, "None")
        .when(discount <= 0.05, "Low")
        .when(discount <= 0.15, "Medium")
        .otherwise("High")
    )


def ship_mode(code: Column) -> Column:
    return F.when(code == 1, "Express").when(code == 2, "Standard").otherwise("Economy")


def late_flag(shipped: Column, required: Column) -> Column:
    """NULL while the shipment is pending."""
    return F.when(shipped.isNotNull(), shipped.cast("date") > required.cast("date"))
