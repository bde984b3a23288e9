"""Incremental loads: high-water mark and change feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .merge import merge_rows


def new_rows(
    source: DataFrame, target: DataFrame, mark: str, late_by: str | None = None
) -> DataFrame:
    """Source rows from the highest mark in the target on; all rows if it is empty.

    Rows that carry the mark itself come again, since others with the same stamp
    may have arrived after the last load: load them with `upsert_latest` or
    `insert_only`, which a repeated row does not change. A row older than the
    mark counts as late and is not loaded, unless `late_by` (an interval, such
    as "2 days") reaches back to it.
    """
    seen = target.agg(F.max(mark)).scalar()
    since = seen if late_by is None else seen - F.expr(f"interval {late_by}")
    return source.filter(seen.isNull() | (F.col(mark) >= since))


def latest_per_key(
    events: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Last event of each key in the total order `order_by`.

    An aggregate rather than a row number: each task keeps one event per key
    before the shuffle, so a busy key sends one row per task.
    """
    rest = [c for c in events.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order_by))
    return events.groupBy(*keys).agg(last.alias("_e")).select(*keys, "_e.*")


def upsert_latest(
    target: DataFrame, events: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Bring a table of latest events forward.

    An event older than the stored row changes nothing, so replaying events is
    harmless.
    """
    return merge_rows(
        target, latest_per_key(events, keys, order_by), keys, source_unique=True,
        update_when=lambda t, s: F.struct(*[s(c) for c in order_by])
        > F.struct(*[t(c) for c in order_by]),
    )


def apply_changes(
    target: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    is_delete: Column,
) -> DataFrame:
    """Apply ordered insert, update and delete events to a table.

    Deleted keys stay as marked rows (`is_deleted`), so that an older event
    arriving late cannot bring them back; `live` filters them.
    """
    marked = events.withColumn("is_deleted", is_delete)
    return upsert_latest(target, marked, keys, order_by)


def live(table: DataFrame) -> DataFrame:
    return table.filter(~F.col("is_deleted")).drop("is_deleted")
