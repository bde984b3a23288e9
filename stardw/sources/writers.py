"""Sinks. Only this module and `operators.versions` write tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stardw.session import work_folder

from .contracts import conform

# So many partitions at most are named in a filter.
LISTED = 1000


def full_load(df: DataFrame, path: str, schema: StructType | None = None) -> None:
    """Replace all rows of the table at `path`; columns are matched by name."""
    (conform(df, schema) if schema else df).write.mode("overwrite").parquet(path)


def create_or_replace(df: DataFrame, path: str) -> None:
    """Replace rows and schema of the table at `path` by a query result."""
    df.write.mode("overwrite").parquet(path)


def by_period(df: DataFrame, period: str) -> DataFrame:
    """Rows of a period together, in as many tasks as their size asks for.

    The rebalance is split and merged by adaptive execution: small periods take
    one file, and a large one is not written by one task.
    """
    return df.hint("rebalance", F.col(period))


def append_periods(df: DataFrame, path: str, period: str) -> None:
    """Add rows, filed by period; rows already there are not touched."""
    by_period(df, period).write.mode("append").partitionBy(period).parquet(path)


def drop_periods(spark: SparkSession, path: str, period: str, values: Sequence) -> None:
    """Remove whole periods; None stands for the rows without one.

    Writing an empty frame with dynamic overwrite would leave them in place, so
    their folders are removed. A period without a folder is an error, and so is
    a folder that cannot be removed.
    """
    known = [v for v in values if v is not None]
    wanted = F.col(period).isin(known)
    if len(known) < len(values):
        wanted = wanted | F.col(period).isNull()
    folders = list(period_folders(spark.read.parquet(path).filter(wanted), period))
    if len(folders) < len(set(values)):
        raise LookupError(f"{path} lacks some of the periods {list(values)}")
    for folder in folders:
        remove_folder(spark, folder)


def period_folders(df: DataFrame, period: str) -> Iterator[str]:
    """The folders that hold the rows of `df`, read from a table filed by `period`.

    They come one partition of the result at a time, so that the driver holds
    no list of all of them. A folder is a URI, as Spark writes it: what a
    partition value quotes in the folder's name is quoted once more.
    """
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
    found = df.select(folder.alias("folder"), period).distinct().select("folder")
    return (r[0] for r in found.toLocalIterator())


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder, given as a URI, through the file system settings of the session."""
    path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True):
        raise FileNotFoundError(f"{folder} could not be removed")


def merge_into_partitions(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    partition: str,
    keys: Sequence[str],
    merge: Callable[[DataFrame, DataFrame], DataFrame],
) -> None:
    """Merge `source` by `keys` into a partitioned table, rewriting only the partitions it touches.

    Touched are the partitions of the source rows and those in which the table
    holds a key of the source, so that a key may move to another partition. Up
    to `LISTED` of them become a literal filter that prunes the scan; more than
    that are joined. The source and the result are written to the shared work
    folder first: the table is not replaced by a plan that still reads it.
    Partitions that the merge left without a row are removed before the others
    are replaced, so that no failure leaves a key in two partitions. Until the
    end the whole result is in the work folder: an error in between names the
    folder in a note, and `replace_partitions` finishes from it.
    """
    given = work_folder(spark, "merge-source")
    source.write.parquet(given)
    source = spark.read.schema(source.schema).parquet(given)
    target = spark.read.parquet(path)
    held = target.select(*dict.fromkeys([*keys, partition]))
    moved = held.join(source.select(*[F.col(k).alias(f"_s_{k}") for k in keys]).distinct(), [
        F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys], "left_semi")
    touched = source.select(partition).unionByName(moved.select(partition)).distinct()
    listed = [row[0] for row in touched.limit(LISTED + 1).collect()]
    if len(listed) <= LISTED:
        in_touched = F.col(partition).isin([v for v in listed if v is not None])
        if None in listed:
            in_touched = in_touched | F.col(partition).isNull()
        affected = target.filter(in_touched)
    else:
        names = touched.withColumnRenamed(partition, "_touched")
        affected = target.join(names, F.col(partition).eqNullSafe(F.col("_touched")), "left_semi")
    staged = work_folder(spark, "merge")
    merge(affected, source).select(*target.columns).write.parquet(staged)
    result = spark.read.schema(target.schema).parquet(staged)
    full = result.select(F.col(partition).alias("_full")).distinct()
    emptied = affected.join(full, F.col(partition).eqNullSafe(F.col("_full")), "left_anti")
    try:
        for folder in period_folders(emptied, partition):
            remove_folder(spark, folder)
        replace_partitions(result, path, partition)
    except Exception as error:
        error.add_note(f"the merged partitions are complete in {staged}")
        raise


def replace_partitions(rows: DataFrame, path: str, partition: str) -> None:
    """Replace the partitions that `rows` has rows of; the others stay."""
    (
        by_period(rows, partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
