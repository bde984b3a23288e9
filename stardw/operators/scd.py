"""Slowly changing dimensions of type 2 and 3.

Versions are valid from `valid_from` to `valid_to`, both days included, and a
member has at most one version per day. The number of versions of a member is
therefore bounded by the number of days, however many source rows it has.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stardw.functions import FIRST_DAY, LAST_DAY, any_changed, changed, surrogate_key

from .merge import ACTION, once_per_key

VALIDITY = ["valid_from", "valid_to", "is_current"]


def scd2_initial(
    snapshot: DataFrame, key: str, sk: str, valid_from: date = FIRST_DAY
) -> DataFrame:
    """First load: every member gets one open version."""
    start = F.lit(valid_from)
    return snapshot.select(
        surrogate_key(key, start).alias(sk),
        *snapshot.columns,
        start.alias("valid_from"),
        F.lit(LAST_DAY).alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def scd2_changes(dim: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str]):
    """Members whose current version differs from the snapshot in a tracked column."""
    current = dim.filter("is_current").select(
        key, *[F.col(c).alias(f"_old_{c}") for c in tracked]
    )
    both = current.join(snapshot.select(key, *tracked), key)
    return both.filter(any_changed((F.col(f"_old_{c}"), F.col(c)) for c in tracked))


def scd2_apply(
    dim: DataFrame,
    snapshot: DataFrame,
    key: str,
    tracked: Sequence[str],
    load_date: date,
    sk: str,
    new_member_from: date | None = None,
    close_missing: bool = False,
) -> DataFrame:
    """Apply one snapshot: expire, add versions, add members, in one output.

    One full outer join replaces the change detection, the update and the two
    inserts, so no state exists in which a member lacks its current version.
    The `_action` of a row is kept, expired, updated (second change on one
    load date: the version is overwritten in place) or inserted.

    A member is new if it has no version at all. New members start on the load
    date unless `new_member_from` says otherwise. Members absent from the
    snapshot stay open unless `close_missing`; a closed member that returns is
    then opened again, and a version that began on the load date itself is
    removed and not closed, as it was never valid.

    Loads must come in order: a version that begins after the load date, or a
    closed one that ends on it or later and would be opened again, stops the
    job whether the member differs or not.
    """
    attrs = [c for c in snapshot.columns if c != key]
    old = dim.select(
        key,
        *[F.col(c).alias(f"_d_{c}") for c in dim.columns if c != key],
        F.lit(True).alias("_d_here"),
    )
    if close_missing:
        members = Window.partitionBy(key)
        newest_first = members.orderBy(F.col("_d_valid_from").desc())
        old = old.withColumn("_open", F.max("_d_is_current").over(members)).withColumn(
            "_newest", F.row_number().over(newest_first) == 1
        )
    new = once_per_key(snapshot, [key], "_s_here").select(
        key, *[F.col(c).alias(f"_s_{c}") for c in attrs], "_s_here"
    )
    joined = old.join(new, key, "full")

    today = F.lit(load_date)
    current = F.col("_d_is_current")
    differs = current & F.col("_s_here") & any_changed(
        (F.col(f"_d_{c}"), F.col(f"_s_{c}")) for c in tracked
    )
    too_late = F.raise_error(F.lit(f"a version later than load date {load_date} exists"))

    def row(
        from_snapshot: bool, start: Column, end: Column, is_current: Column, action: str,
        keep_sk: bool = False,
    ) -> Column:
        side = "_s_" if from_snapshot else "_d_"
        fields = {
            sk: F.col(f"_d_{sk}") if keep_sk else surrogate_key(F.col(key), start),
            key: F.col(key),
            **{c: F.col(f"{side}{c}") for c in attrs},
            "valid_from": start,
            "valid_to": end,
            "is_current": is_current,
            ACTION: F.lit(action),
        }
        return F.struct(*[fields[c].alias(c) for c in [*dim.columns, ACTION]])

    forever, yes, no = F.lit(LAST_DAY), F.lit(True), F.lit(False)
    begin = F.col("_d_valid_from")
    kept = row(False, begin, F.col("_d_valid_to"), current, "kept", keep_sk=True)
    closed = row(
        False, begin, F.lit(load_date - timedelta(days=1)), no, "expired", keep_sk=True
    )
    opened = row(True, today, forever, yes, "inserted")
    replaced = row(True, today, forever, yes, "updated", keep_sk=True)
    first_seen = F.lit(new_member_from) if new_member_from else today
    arrived = row(True, first_seen, forever, yes, "inserted")

    result = F.when(F.col("_d_here").isNull(), F.array(arrived))
    result = result.when(begin > today, F.array(F.when(too_late.isNotNull(), kept)))
    result = result.when(differs & (begin == today), F.array(replaced))
    result = result.when(differs, F.array(closed, opened))
    if close_missing:
        missing = current & F.col("_s_here").isNull()
        result = result.when(missing & (begin == today), F.filter(F.array(kept), lambda _: F.lit(False)))
        result = result.when(missing, F.array(closed))
        returns = F.col("_newest") & ~F.col("_open") & F.col("_s_here")
        still_valid = returns & (F.col("_d_valid_to") >= today)
        result = result.when(still_valid, F.array(F.when(too_late.isNotNull(), kept)))
        result = result.when(returns, F.array(kept, opened))
    return joined.select(F.inline(result.otherwise(F.array(kept))))


def scd2_history(
    events: DataFrame,
    key: str,
    tracked: Sequence[str],
    day: str,
    order_by: Sequence[str] | None,
    sk: str,
    first_from: date | None = FIRST_DAY,
    first_until: date | None = None,
) -> DataFrame:
    """Whole version history in one pass, equal to applying the days in turn.

    Events are first reduced to the last one per member and day (a partial
    aggregate runs before the shuffle), so the windows below see at most one
    row per member and day even if a member holds most of the events. Unless
    `first_from` is None, the first version of a member starts there, but only if
    it was seen by `first_until`, where that is given. Without
    `order_by` the events must be one per member and day already.
    """
    if order_by is None:
        daily = events.select(key, F.col(day).alias("_day"), F.struct(*tracked).alias("_v"))
    else:
        last = F.max_by(F.struct(*tracked), F.struct(*order_by))
        daily = events.groupBy(key, F.col(day).alias("_day")).agg(last.alias("_v"))
    by_day = Window.partitionBy(key).orderBy("_day")
    before = F.lag("_v").over(by_day)
    first = F.row_number().over(by_day) == 1
    points = (
        daily.withColumn("_first", first)
        .withColumn("_new", first | changed(before, F.col("_v")))
        .filter("_new")
    )
    until = F.lead("_day").over(by_day)
    start = F.col("_day")
    if first_from is not None:
        early = F.col("_first") if first_until is None else F.col("_first") & (start <= F.lit(first_until))
        start = F.when(early, F.lit(first_from)).otherwise(start)
    return points.withColumn("_until", until).select(
        surrogate_key(F.col(key), start).alias(sk),
        key,
        *[F.col(f"_v.{c}").alias(c) for c in tracked],
        start.alias("valid_from"),
        F.coalesce(F.date_sub("_until", 1), F.lit(LAST_DAY)).alias("valid_to"),
        F.col("_until").isNull().alias("is_current"),
    )


def scd2_absorb(
    dim: DataFrame | None,
    events: DataFrame,
    key: str,
    tracked: Sequence[str],
    day: str,
    order_by: Sequence[str],
    sk: str,
    untracked: Sequence[str] = (),
    first_from: date | None = FIRST_DAY,
    spread: Callable[..., DataFrame] | None = None,
) -> DataFrame:
    """Versions with further events worked in, in whatever order these arrive.

    Each version keeps in `seen` the days on which an event confirmed it, with
    that event's place in `order_by`: an event older than the last version can
    split a version in two (the days seen behind it keep the old value), move its
    ends, or make it equal to its neighbour, which removes one. So the state after
    any sequence of batches equals `scd2_history` of all their events; with no
    `dim` it is built from `events` alone. `untracked` columns follow the newest
    event and stand on all versions of a member.

    Only members of the batch are taken apart and put together, by windows over
    at most one row per day; all other versions pass through. Of two events of a
    day the later one in `order_by` counts, and of equal ones the stored one. The
    surrogate key of a version follows its first day: facts of the days that a
    late event moves to another version have to be keyed anew.

    `spread` may deal rows by the columns named to it over more tasks, as days and
    versions of many members are sorted in each.
    """
    spread = spread or (lambda rows, *_: rows)
    when = F.struct(F.col(day).alias("day"), *order_by)
    daily = events.groupBy(key, F.col(day).alias("_day")).agg(
        F.max_by(F.struct(*tracked), when).alias("_v"), F.max(when).alias("_when"),
        F.max_by(F.struct(*untracked) if untracked else F.lit(None).cast("struct<none:int>"), when).alias("_t"),
    ).withColumn("_stored", F.lit(False))
    rest = None
    if dim is not None:
        members = daily.select(key).distinct()
        dim, members = spread(dim, key), spread(members, key)
        rest = dim.join(members, key, "left_anti")
        known = dim.join(members, key, "left_semi").select(
            key, F.struct(*tracked).alias("_v"),
            (F.struct(*untracked) if untracked else F.lit(None).cast("struct<none:int>")).alias("_t"),
            F.explode("seen").alias("_when"),
        ).select(key, F.col("_when.day").alias("_day"), "_v", "_when", "_t", F.lit(True).alias("_stored"))
        both = spread(daily.unionByName(known), key)
        rank = F.struct("_when", "_stored")
        daily = both.groupBy(key, "_day").agg(
            F.max_by("_v", rank).alias("_v"), F.max("_when").alias("_when"), F.max_by("_t", rank).alias("_t"))
    else:
        daily = spread(daily, key)
    by_day = Window.partitionBy(key).orderBy("_day")
    newest = Window.partitionBy(key)
    before = F.lag("_v").over(by_day)
    turns = (F.row_number().over(by_day) == 1) | changed(before, F.col("_v"))
    runs = (
        daily.withColumn("_t", F.max_by("_t", "_when").over(newest))
        .withColumn("_turn", turns.cast("int")).withColumn("_run", F.sum("_turn").over(by_day))
        .groupBy(key, "_run")
        .agg(F.first("_v").alias("_v"), F.first("_t").alias("_t"), F.sort_array(F.collect_list("_when")).alias("seen"))
    )
    by_run = Window.partitionBy(key).orderBy("_run")
    until = F.lead(F.col("seen")[0]["day"]).over(by_run)
    start = F.col("seen")[0]["day"]
    if first_from is not None:
        start = F.when(F.col("_run") == 1, F.lit(first_from)).otherwise(start)
    built = runs.withColumns({"_until": until, "valid_from": start}).select(
        surrogate_key(F.col(key), F.col("valid_from")).alias(sk),
        key,
        *[F.col(f"_v.{c}").alias(c) for c in tracked],
        *[F.col(f"_t.{c}").alias(c) for c in untracked],
        "valid_from",
        F.coalesce(F.date_sub("_until", 1), F.lit(LAST_DAY)).alias("valid_to"),
        F.col("_until").isNull().alias("is_current"),
        "seen",
    )
    return built if rest is None else rest.select(*built.columns).unionByName(built)


def with_profile(dim: DataFrame, members: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Untracked columns of the members on all their versions, before the validity columns."""
    own = [c for c in dim.columns if c not in VALIDITY]
    return dim.join(members.select(key, *columns), key, "left").select(*own, *columns, *VALIDITY)


def scd3_initial(snapshot: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """Current values from the source, nothing known before."""
    types = dict(snapshot.dtypes)
    cols = [F.col(key)]
    for a in attrs:
        cols += [
            F.col(a).alias(f"current_{a}"),
            F.lit(None).cast(types[a]).alias(f"previous_{a}"),
            F.lit(None).cast("date").alias(f"{a}_changed_on"),
        ]
    return snapshot.select(*cols)


def scd3_apply(
    dim: DataFrame, snapshot: DataFrame, key: str, attrs: Sequence[str], load_date: date
) -> DataFrame:
    """Rotate each changed attribute on its own: previous <- current <- new."""
    old = dim.withColumn("_d_here", F.lit(True))
    new = once_per_key(snapshot, [key], "_s_here").select(
        key, *[F.col(a).alias(f"_s_{a}") for a in attrs], "_s_here"
    )
    joined = old.join(new, key, "full")
    arrived = F.col("_d_here").isNull()
    present = F.col("_d_here") & F.col("_s_here")
    cols, turned = [F.col(key)], F.lit(False)
    for a in attrs:
        now, then, on = F.col(f"current_{a}"), F.col(f"previous_{a}"), F.col(f"{a}_changed_on")
        new_value = F.col(f"_s_{a}")
        turn = present & changed(now, new_value)
        turned = turned | turn
        cols += [
            F.when(arrived | turn, new_value).otherwise(now).alias(f"current_{a}"),
            F.when(turn, now).otherwise(then).alias(f"previous_{a}"),
            F.when(turn, F.lit(load_date)).otherwise(on).alias(f"{a}_changed_on"),
        ]
    action = F.when(arrived, "inserted").when(turned, "updated").otherwise("kept")
    return joined.select(*cols, action.alias(ACTION))
