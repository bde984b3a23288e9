"""Merge of a source into a target by key, for tables without row-level commands.

Every function returns the new state of the target with a column `_action`
(inserted, updated, deleted, kept), so one pass gives rows and counts.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stardw.functions import any_changed

ACTION = "_action"
Side = Callable[[str], Column]
Condition = Callable[[Side, Side], Column]


def once_per_key(source: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Add `flag` = true to each row; the job fails on a second row of a key.

    Partitioned like the join that follows, so it adds no shuffle, and a row
    number streams through a group without holding it.
    """
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    message = F.concat(
        F.lit("merge source has a key twice: "), F.to_json(F.struct(*keys))
    )
    return source.withColumn("_nth", nth).withColumn(
        flag, F.when(F.col("_nth") > 1, F.raise_error(message)).otherwise(F.lit(True))
    ).drop("_nth")


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_when: Condition | None = None,
    update_cols: Sequence[str] | None = None,
    only_changes: bool = False,
    insert: bool = True,
    delete_when: Condition | None = None,
    source_unique: bool = False,
) -> DataFrame:
    """Update matched rows, insert the others, never lose a target row.

    `update_when(t, s)` and `delete_when(t, s)` are conditions on the two sides
    (`t("col")`, `s("col")`). `only_changes` updates a row only if one of the
    updated columns differs. `update_cols` limits what an update writes;
    an inserted row takes all columns of the source. Pass `source_unique` when
    the source comes straight from a grouping by the keys.
    """
    keys = list(keys)
    own = [c for c in target.columns if c not in keys]
    arriving = [c for c in source.columns if c not in keys]
    written = [c for c in (update_cols or own) if c in arriving]

    def t(name: str) -> Column:
        return F.col(name) if name in keys else F.col(f"_t_{name}")

    def s(name: str) -> Column:
        return F.col(name) if name in keys else F.col(f"_s_{name}")

    left = target.select(
        *keys, *[F.col(c).alias(f"_t_{c}") for c in own], F.lit(True).alias("_t_here")
    )
    checked = (
        source.withColumn("_s_here", F.lit(True)) if source_unique
        else once_per_key(source, keys, "_s_here")
    )
    right = checked.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in arriving], "_s_here")
    joined = left.join(right, keys, "full" if insert else "left")

    update = F.lit(True) if update_when is None else update_when(t, s)
    if only_changes:
        update = update & any_changed((t(c), s(c)) for c in written)
    both = F.col("_t_here").isNotNull() & F.col("_s_here")
    action = F.when(F.col("_t_here").isNull(), "inserted")
    if delete_when is not None:
        action = action.when(both & delete_when(t, s), "deleted")
    action = action.when(both & update, "updated").otherwise("kept")

    def value(name: str) -> Column:
        old = t(name)
        new = s(name) if name in arriving else F.lit(None).cast(target.schema[name].dataType)
        inserted = F.when(F.col(ACTION) == "inserted", new)
        if name in written:
            inserted = inserted.when(F.col(ACTION) == "updated", s(name))
        return inserted.otherwise(old).alias(name)

    return joined.withColumn(ACTION, action).select(
        *[F.col(c) if c in keys else value(c) for c in target.columns], ACTION
    )


def scd1_merge(target: DataFrame, source: DataFrame, key: str, only_changes: bool = False):
    """Type 1: matched members are overwritten, new ones added, none removed."""
    return merge_rows(target, source, [key], only_changes=only_changes)


def update_from(
    target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Set `columns` of the matching rows from `source`; other rows stay."""
    return merge_rows(target, source, keys, update_cols=columns, insert=False)


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add source rows whose key is new; present rows are not looked at further."""
    new = source.join(target.select(*keys), list(keys), "left_anti")
    return target.withColumn(ACTION, F.lit("kept")).unionByName(
        new.select(*target.columns).withColumn(ACTION, F.lit("inserted"))
    )


def update_where(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """Set columns of the rows that meet a condition."""
    return df.withColumns(
        {c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()}
    )


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Drop the rows for which the condition is true; NULL keeps the row."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def current_state(merged: DataFrame) -> DataFrame:
    """The rows to store after a merge."""
    return merged.filter(F.col(ACTION) != "deleted").drop(ACTION)


def action_counts(merged: DataFrame) -> DataFrame:
    return merged.groupBy(F.col(ACTION).alias("action")).agg(F.count("*").alias("rows"))
