"""Equi-join with hot keys split over several tasks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than one row in HOT_SHARE; at most HOT_SHARE
# keys can, which bounds the list of hot keys whatever the size of the table.
HOT_SHARE = 1000
# Rows of one key that one task takes.
ROWS_PER_TASK = 500_000


def hot_keys(
    facts: DataFrame, keys: Sequence[str], share: int = HOT_SHARE, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Keys holding more than 1/`share` of the rows, at most `share` of them.

    `_ways` says over how many tasks the rows of each are to be dealt.
    """
    counts = facts.groupBy(*keys).agg(F.count("*").alias("_n"))
    total = facts.agg(F.count("*").alias("_total")).scalar()
    ways = F.greatest(F.lit(2), F.ceil(F.col("_n") / F.lit(rows_per_task))).cast("int")
    return counts.filter(F.col("_n") * share > total).select(*keys, ways.alias("_ways"))


def join_split(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    hot: DataFrame,
    spread_by: Sequence[str],
    how: str = "inner",
    residual: Column | None = None,
) -> DataFrame:
    """Join `facts` to `lookup`, dealing the rows of hot keys to `_ways` tasks.

    Only lookup rows of hot keys are repeated. `hot` must come from `hot_keys`,
    whose bound makes the broadcast safe; its key columns are some or all of
    `keys`. Rows are dealt by `spread_by`, the grain of the facts, and not at
    random: a task that runs again after a lost executor must send each row to
    the same place. `residual` is a further condition on both sides; with
    `how="left"` facts without a match are kept.
    """
    keys, marks = list(keys), [c for c in hot.columns if c != "_ways"]
    marked = F.broadcast(hot)
    ways = F.coalesce(F.col("_ways"), F.lit(1))
    salt = F.pmod(F.xxhash64(*spread_by), ways.cast("bigint")).cast("int")
    left = facts.join(marked, marks, "left").withColumn("_salt", salt).drop("_ways")
    right = lookup.join(marked, marks, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), ways - 1))
    ).drop("_ways").withColumnsRenamed({c: f"_r_{c}" for c in [*keys, "_salt"]})
    condition = reduce(lambda a, b: a & b, (F.col(c) == F.col(f"_r_{c}") for c in [*keys, "_salt"]))
    if residual is not None:
        condition = condition & residual
    return left.join(right, condition, how).drop(*[f"_r_{c}" for c in [*keys, "_salt"]], "_salt")
