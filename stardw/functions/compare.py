"""NULL-safe comparison of attribute values."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def changed(left: Column, right: Column) -> Column:
    """True when the values differ; NULL against a value counts as a change."""
    return ~left.eqNullSafe(right)


def any_changed(pairs: Iterable[tuple[Column, Column]]) -> Column:
    return reduce(lambda a, b: a | b, (changed(x, y) for x, y in pairs), F.lit(False))
