"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Stands for a NULL part; other parts begin with their length.
NULL_PART = "~"


def key_text(*parts: Column | str) -> Column:
    """One text for the key parts. Different parts give different texts."""
    def one(part: Column | str) -> Column:
        text = (F.col(part) if isinstance(part, str) else part).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit(NULL_PART))

    return F.concat(*[one(p) for p in parts])


def surrogate_key(*parts: Column | str) -> Column:
    """60-bit key of a dimension member from the MD5 of its key parts.

    Stable across runs and engines. 32 bits collide from some ten thousand keys
    on; 60 bits stay collision-free in practice up to hundreds of millions of
    members, and `expect_unique` reports a collision should one occur.
    """
    prefix = F.substring(F.md5(key_text(*parts)), 1, 15)
    return F.conv(prefix, 16, 10).cast("bigint")


def fact_key(*parts: Column | str) -> Column:
    """128-bit key of a fact row as 32 hexadecimal digits.

    Among 10^12 rows the chance of any collision is about 10^-15.
    """
    return F.md5(key_text(*parts))


def dense_key(df: DataFrame, key: str, name: str) -> DataFrame:
    """Numbers 1..n without a gap, one per row of a frame with unique `key`.

    A row number over the whole frame would run in one task. Rows are numbered
    inside 4096 hash buckets instead, and each bucket starts where the running
    total of the earlier buckets ends; only the 4096 totals are summed in order.
    """
    hashed = df.withColumn("_bucket", F.substring(F.md5(F.col(key).cast("string")), 1, 3))
    totals = hashed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        hashed.withColumn("_row", inside)
        .join(F.broadcast(starts), "_bucket")  # at most 4096 rows
        .withColumn(name, F.col("_start") + F.col("_row"))
        .select(name, *df.columns)
    )


def grown_keys(known: DataFrame | None, members: DataFrame, key: str, name: str) -> DataFrame:
    """A key map with the members that are new numbered from the highest key on.

    `known` has (`name`, `key`), as an earlier call returned it, or is None. Keys that
    were given stay; the same members again add none; a NULL or repeated member gets
    no second key. Only new members are numbered, in hash buckets.
    """
    found = members.select(key).filter(F.col(key).isNotNull()).distinct()
    if known is None:
        return dense_key(found, key, name)
    new = dense_key(found.join(known.select(key), key, "left_anti"), key, name)
    highest = known.agg(F.coalesce(F.max(name), F.lit(0))).scalar()
    return known.select(name, key).unionByName(new.withColumn(name, F.col(name) + highest))
