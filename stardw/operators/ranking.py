"""Positions, ranks and quantile groups over a whole frame, without gathering it in one task.

Rows are dealt by ranges of the ordering value and the ranges are written once.
The rows of each range are counted, a running total over one row per range says
where it starts, and a window numbers the rows inside. No window spans the frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stardw.session import work_folder


def _key(by: str) -> Column:
    """A sort key: a name, with a minus in front for falling order. NULL is least."""
    return F.col(by[1:]).desc() if by.startswith("-") else F.col(by).asc()


def numbered(df: DataFrame, by: Sequence[str], name: str, parts: int | None = None) -> DataFrame:
    """Add the position 1..n in the total order `by` ("-x" falls); rows equal in all of `by` are in any order."""
    spark, order = df.sparkSession, [_key(b) for b in by]
    count = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = work_folder(spark, "ranges")
    df.repartitionByRange(count, *order).withColumn("_part", F.spark_partition_id()).write.parquet(path)
    ranges = spark.read.parquet(path)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.groupBy("_part").agg(F.count("*").alias("_n")).select(  # `count` rows
        F.col("_part").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (
        ranges.withColumn("_row", inside)
        .join(F.broadcast(starts), F.col("_part") == F.col("_of"))
        .withColumn(name, F.col("_start") + F.col("_row"))
        .select(*df.columns, name)
    )


def tiled(df: DataFrame, tiles: int, by: Sequence[str], name: str, parts: int | None = None) -> DataFrame:
    """Add the group 1..`tiles` of the order `by`, as `ntile` does: sizes differ by one at most, larger ones first."""
    position = numbered(df, by, "_position", parts)
    total = df.agg(F.count("*")).scalar()
    size, more = F.expr(f"_total div {tiles}"), F.expr(f"_total % {tiles}")
    at = F.col("_position") - 1
    # The first groups have one row more each.
    edge = F.col("_more") * (F.col("_size") + 1)
    group = F.when(at < edge, F.expr("(_position - 1) div (_size + 1)")).otherwise(
        F.col("_more") + F.expr("(_position - 1 - _more * (_size + 1)) div greatest(_size, 1)"))
    return (
        position.withColumn("_total", total).withColumns({"_size": size, "_more": more})
        .withColumn(name, (group + 1).cast("int")).select(*df.columns, name)
    )


def ranked_all(df: DataFrame, by: str, name: str, parts: int | None = None) -> DataFrame:
    """Add the rank by one column ("-x" falls), ties sharing a place, over all rows.

    Values are counted first, so that the rows of one value, however many, are one
    row in the ranges; the place of a value is the number of rows before it plus one.
    """
    column, spark = by.lstrip("-"), df.sparkSession
    values = df.groupBy(column).agg(F.count("*").alias("_n"))
    count = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = work_folder(spark, "ranges")
    values.repartitionByRange(count, _key(by)).withColumn("_part", F.spark_partition_id()).write.parquet(path)
    ranges = spark.read.parquet(path)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.groupBy("_part").agg(F.sum("_n").alias("_rows")).select(
        F.col("_part").alias("_of"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_part").orderBy(_key(by)).rowsBetween(Window.unboundedPreceding, -1)
    places = (
        ranges.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .join(F.broadcast(starts), F.col("_part") == F.col("_of"))
        .select(F.col(column).alias("_value"), (F.col("_start") + F.col("_before") + 1).alias(name))
    )
    return df.join(places, F.col(column).eqNullSafe(F.col("_value"))).select(*df.columns, name)
