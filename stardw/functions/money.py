"""Fixed-point money from binary doubles.

Casting a double to a decimal goes through its text, and decimals made that
way keep slow big numbers in every later step. Whole units in a long are
exact, stay in generated code, and become compact decimals at the end.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def units(amount: Column, scale: int) -> Column:
    """A double as a whole number of 10^-scale."""
    return F.rint(amount * 10**scale).cast("bigint")


def divide_half_up(number: Column, by: Column) -> Column:
    """Whole quotient rounded half away from zero, for a positive divisor."""
    return F.call_function("div", number * 2 + F.signum(number).cast("bigint") * by, by * 2)


def to_decimal(whole: Column, scale: int) -> Column:
    """Whole units as decimal(18, scale)."""
    unit = F.lit(Decimal(1).scaleb(-scale))
    return (whole.cast("decimal(18,0)") * unit).cast(f"decimal(18,{scale})")
