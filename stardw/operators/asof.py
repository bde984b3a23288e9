"""Point-in-time joins: the version of a member that was valid on a day.

All forms include both ends of a version, so the last day of a closed version
still matches. They differ in what is shuffled:

* `range`: equality on the member, validity tested on each candidate. Least
  work when members have few versions.
* `bucket`: versions are filed under every year they touch, and the join is on
  member and year. One shuffle of the facts; a member with a long history is
  compared only to the versions of that year, and its facts are spread over
  the years.
* `lookup`: the version is found once per distinct member and day by a window,
  then joined back on member and day. Best when facts repeat members and days
  many times; the window sees at most two rows per member and day.
* `carried`: facts and versions are dealt together by ranges of member and day,
  and the last version of each range is carried over its edge. A member with
  any share of the facts, or of one day, spans as many tasks as its rows fill,
  without a list of hot members. It writes the ranges once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stardw.session import work_folder

from .skew import join_split


def as_of_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    day: str,
    take: Sequence[str],
    how: str = "inner",
    form: str = "bucket",
    hot: DataFrame | None = None,
    spread_by: Sequence[str] | None = None,
    span: Column | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Add the columns `take` of the version valid on `day` to each fact.

    With `how="left"` facts without a version are kept. Very large sides are
    split by adaptive execution; `hot` (from `skew.hot_keys`, on the member, or
    on member and day for `lookup`) splits hot keys explicitly, by the grain
    columns `spread_by`. `span` (from `years_of`) lists the years the facts
    touch; without it the bucket form reads the facts' days once more. Versions
    are filed only under those years, so a stray day far away adds one year.
    `parts` is the number of ranges of the carried form, otherwise that of
    shuffle partitions; `hot` means nothing to it.
    """
    if form not in ("range", "bucket", "lookup", "carried"):
        raise ValueError(f"unknown form {form!r}")
    slim = versions.select(
        key, F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"), *take
    )
    if form == "lookup":
        found = _lookup(facts, slim, key, day, take)
        on = [key, day]
        if hot is None:
            return facts.join(found, on, how)
        return join_split(facts, found, on, hot, spread_by or facts.columns, how)

    if form == "carried":
        return _carried(facts, slim, key, day, take, how, parts)

    on = [key]
    if form == "bucket":
        span = years_of(facts, day) if span is None else span
        # The years become a column first: a lambda may not hold a scalar subquery.
        touched = F.filter(
            "_span", lambda y: (y >= F.year(F.col("_from"))) & (y <= F.year(F.col("_to")))
        )
        slim = slim.withColumn("_span", span).withColumn("_year", F.explode(touched)).drop("_span")
        facts = facts.withColumn("_year", F.year(day))
        on = [key, "_year"]

    valid = (F.col(day) >= F.col("_from")) & (F.col(day) <= F.col("_to"))
    extra = ["_from", "_to"] + (["_year"] if form == "bucket" else [])
    if hot is None:
        right = slim.withColumnsRenamed({c: f"_r_{c}" for c in on})
        equal = [F.col(c) == F.col(f"_r_{c}") for c in on]
        return facts.join(right, [*equal, valid], how).drop(*[f"_r_{c}" for c in on], *extra)
    spread = spread_by or [c for c in facts.columns if c != "_year"]
    return join_split(facts, slim, on, hot, spread, how, valid).drop(*extra)


def years_of(facts: DataFrame, day: str) -> Column:
    """The distinct years of a column of days, as one array: 10,000 at most."""
    return facts.agg(F.array_sort(F.collect_set(F.year(day)))).scalar()


def _lookup(
    facts: DataFrame, slim: DataFrame, key: str, day: str, take: Sequence[str]
) -> DataFrame:
    asked = facts.select(key, day).distinct().withColumn("_v", F.lit(None))
    known = slim.select(
        key, F.col("_from").alias(day), F.struct("_from", "_to", *take).alias("_v")
    )
    # A version starting on the day itself comes before the question.
    line = (
        asked.select(key, day, F.lit(1).alias("_asked"), F.col("_v").cast(known.schema["_v"].dataType))
        .unionByName(known.withColumn("_asked", F.lit(0)))
    )
    so_far = (
        Window.partitionBy(key).orderBy(day, "_asked")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    latest = line.withColumn("_v", F.last("_v", ignorenulls=True).over(so_far))
    valid = (F.col("_asked") == 1) & (F.col(day) <= F.col("_v._to"))
    return latest.filter(valid).select(key, day, *[F.col(f"_v.{c}").alias(c) for c in take])


def _carried(
    facts: DataFrame, slim: DataFrame, key: str, day: str, take: Sequence[str], how: str,
    parts: int | None,
) -> DataFrame:
    """The version of each fact from the facts and versions laid out by member and day.

    A range holds rows that are neighbours in the order (member, day, versions
    before facts). Inside a range a window over the rows of one member finds the
    latest version; for the first member of a range it may lie in an earlier
    one, which one row per range tells.
    """
    spark = facts.sparkSession
    version, fact = F.struct("_from", "_to", *take), F.struct(*[F.col(f"`{c}`") for c in facts.columns])
    kinds = slim.select(version.alias("_v")).schema["_v"].dataType, facts.select(fact.alias("_f")).schema["_f"].dataType
    known = slim.filter(F.col(key).isNotNull() & F.col("_from").isNotNull()).select(
        F.col(key).alias("_key"), F.col("_from").alias("_at"), F.lit(0).alias("_asked"),
        version.alias("_v"), F.lit(None).cast(kinds[1]).alias("_f"),
    )
    asked = facts.select(
        F.col(key).alias("_key"), F.col(day).alias("_at"), F.lit(1).alias("_asked"),
        F.lit(None).cast(kinds[0]).alias("_v"), fact.alias("_f"),
    )
    # Facts of one member and day may fill several ranges: their content cuts them.
    line = known.unionByName(asked).withColumn("_tie", F.xxhash64("_f"))
    count = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = work_folder(spark, "as-of-ranges")
    line.repartitionByRange(count, "_key", "_at", "_asked", "_tie").withColumn(
        "_part", F.spark_partition_id()).drop("_tie").write.parquet(ranges)
    # Read back: the number of a range must not be found a second time.
    line = spark.read.parquet(ranges)

    last = F.max_by(F.struct("_key", "_v"), F.when(F.col("_v").isNotNull(), F.struct("_key", "_at")))
    ends = line.groupBy("_part").agg(last.alias("_last"))  # `count` rows
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_part", F.last("_last", ignorenulls=True).over(earlier).alias("_carry"))
    so_far = (
        Window.partitionBy("_part", "_key").orderBy("_at", "_asked")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = (
        line.withColumn("_here", F.last("_v", ignorenulls=True).over(so_far))
        .filter("_asked = 1")
        .join(F.broadcast(carried), "_part", "left")
        .withColumn("_v", F.coalesce(
            "_here", F.when(F.col("_carry._key") == F.col("_key"), F.col("_carry._v"))))
        .withColumn("_valid", F.coalesce(F.col("_at") <= F.col("_v._to"), F.lit(False)))
    )
    if how == "inner":
        found = found.filter("_valid")
    elif how != "left":
        raise ValueError(f"a carried join is inner or left, not {how!r}")
    return found.select(
        *[F.col(f"_f.`{c}`") for c in facts.columns],
        *[F.when(F.col("_valid"), F.col(f"_v.`{c}`")).alias(c) for c in take],
    )


def current_join(
    facts: DataFrame, versions: DataFrame, key: str, take: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Add columns of the version that is current now."""
    return facts.join(versions.filter("is_current").select(key, *take), key, how)


def unmatched(
    facts: DataFrame, versions: DataFrame, key: str, day: str, span: Column | None = None,
    hot: DataFrame | None = None, spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Facts no version covers: what an inner point-in-time join leaves out."""
    marked = versions.withColumn("_found", F.lit(True))
    tested = as_of_join(
        facts, marked, key, day, ["_found"], how="left", span=span, hot=hot, spread_by=spread_by
    )
    return tested.filter(F.col("_found").isNull()).drop("_found")
