"""Registration of queries and the SQL that must give the same rows.

Results are shown in plain types: decimals as doubles, days and instants as
text. The SQL writes the same casts.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from stardw.plans.model import Model

MODULES = [
    "scans", "relational", "joins", "aggregates", "scalars", "dimensions", "histories",
    "warehouse", "reports", "checks", "storage",
]

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    def shown(field):
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DecimalType):
            return col.cast("double").alias(field.name)
        if isinstance(field.dataType, DateType):
            return col.cast("string").alias(field.name)
        if isinstance(field.dataType, (TimestampType, TimestampNTZType)):
            return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(field.name)
        return col

    return df.select(*[shown(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None):
    """Register a function of a `Model` under `name`, with its SQL twin."""
    def register(build: Callable[[Model], DataFrame]):
        if name in _queries:
            raise ValueError(f"{name} is registered twice")

        @wraps(build)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(build(Model(spark, folder)))

        _queries[name] = run
        if sql is not None:
            _oracles[name] = sql.strip()
        return build

    return register


def _load() -> None:
    for module in MODULES:
        import_module(f"stardw.suite.{module}")


def registered() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracles() -> dict[str, str]:
    _load()
    return dict(_oracles)
