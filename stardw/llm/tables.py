"""Reading the given tables and cutting lineage through the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stardw.session import work_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the folder all executors share and read it back.

    A later step then restarts from these files when an executor is lost, and
    no step computes the rows a second time.
    """
    spark = df.sparkSession
    path = work_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


ROWS_A_TASK = 1 << 17


def in_tasks(df: DataFrame, rows: int) -> DataFrame:
    """`df`, which has about `rows` short rows, in no more tasks than keep all cores busy or these rows ask for.

    Each task leaves files and log entries, however little it holds, so that many
    nearly empty ones would outweigh a small table.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_A_TASK)))


def fresh(df: DataFrame, name: str) -> str:
    """`name`, or a longer name if `df` has a column of that name already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def unused(df: DataFrame) -> str:
    """A prefix that no column of `df` begins with."""
    prefix = "_"
    while any(c.startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


HOT_SHARE = 1000


def spread_join(rows: DataFrame, lookup: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """`rows` joined to `lookup`, which has each key once and in `size` how many rows have it.

    Keys of more than one row in 1000 of `total` number at most 1000; their
    rows are joined to a broadcast list and not shuffled, so that the rows of
    no key meet in one task.
    """
    hot = F.broadcast(lookup.filter(F.col(size) * HOT_SHARE > total))
    usual = lookup.filter(F.col(size) * HOT_SHARE <= total)
    return rows.join(hot, key).unionByName(
        rows.join(hot.select(key), key, "left_anti").join(usual, key)
    )


def running_sum(rows: DataFrame, group: str, bucket: str, order: list, value: str, into: str) -> DataFrame:
    """`rows` with the sum of `value` over all rows before it in its group.

    In two steps, over the buckets of a group and inside each bucket, so that
    a large group is not summed in one task.
    """
    sums = rows.groupBy(group, bucket).agg(F.sum(value).alias("_sum"))
    over = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col(group).alias("_group"), F.col(bucket).alias("_at_bucket"),
        F.coalesce(F.sum("_sum").over(over), F.lit(0)).alias("_offset"),
    )
    inside = Window.partitionBy(group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(offsets, F.col(group).eqNullSafe(F.col("_group")) & (F.col(bucket) == F.col("_at_bucket")))
        .withColumn(into, F.col("_inside") + F.col("_offset"))
        .drop("_inside", "_offset", "_group", "_at_bucket")
    )
