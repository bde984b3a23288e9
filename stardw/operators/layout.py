"""File layout jobs: compaction and clustering by several columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Files of a table with their size; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length")
    )


def compact(
    spark: SparkSession, path: str, out: str, target_bytes: int = 512 << 20,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Write a table again in files of about `target_bytes`, filed as before by `partition_by`.

    No row is shuffled: a task reads files up to that size together and writes
    them as one file, in each partition that they come from. Returns one row with
    the number of files and their bytes before and after.
    """
    reader = spark.newSession()
    reader.conf.set("spark.sql.files.maxPartitionBytes", target_bytes)
    reader.conf.set("spark.sql.files.openCostInBytes", 0)
    reader.conf.set("spark.sql.files.minPartitionNum", 1)
    table = reader.read.parquet(path)
    if sorted(partition_by) != sorted(partition_columns(spark, path)):
        raise ValueError(f"{path} is filed by {partition_columns(spark, path)}")
    table.write.partitionBy(*partition_by).parquet(out)
    return layout_of(spark, path, "before").join(layout_of(spark, out, "after"))


def layout_of(spark: SparkSession, path: str, moment: str) -> DataFrame:
    """One row: files of a table and their bytes."""
    return file_sizes(spark, path).agg(
        F.count("*").alias(f"files_{moment}"), F.coalesce(F.sum("length"), F.lit(0)).alias(f"bytes_{moment}"))


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The columns by whose values the files of a table are filed."""
    names = F.transform(
        F.filter(F.split("path", "/"), lambda p: p.contains("=")), lambda p: F.split(p, "=")[0]
    )
    below = F.substring_index("path", path.rstrip("/").split("/")[-1] + "/", -1)
    files = file_sizes(spark, path).select(below.alias("path")).select(names.alias("names")).distinct()
    found = [r[0] for r in files.limit(2).collect()]
    if len(found) > 1:
        raise ValueError(f"{path} is filed in more than one way")
    return found[0] if found else []


def interleaved(ranges: Mapping[str, tuple[Column, Column]], bits: int = 10) -> Column:
    """Z-value: the bits of the scaled columns taken in turn.

    `ranges` gives the lowest and highest value of each column. Each column is
    scaled to `bits` bits by its range, NULL going to the low end.
    """
    top = (1 << bits) - 1

    def scaled(name: str, low: Column, high: Column) -> Column:
        part = (F.col(name).cast("double") - low.cast("double")) * top
        share = F.try_divide(part, high.cast("double") - low.cast("double"))
        return F.least(F.greatest(F.coalesce(F.floor(share), F.lit(0)), F.lit(0)), F.lit(top))

    cells = [scaled(n, lo, hi) for n, (lo, hi) in ranges.items()]
    taken = [
        F.shiftleft(F.shiftright(cell, bit).bitwiseAND(F.lit(1)), bit * len(cells) + place)
        for place, cell in enumerate(cells)
        for bit in range(bits)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), taken)


def with_z(df: DataFrame, columns: list[str], bits: int = 10) -> DataFrame:
    """Add the z-value of `columns`, scaled by their range in the frame."""
    ends = df.agg(
        F.struct(
            *[F.min(c).cast("double").alias(f"lo_{c}") for c in columns],
            *[F.max(c).cast("double").alias(f"hi_{c}") for c in columns],
        )
    ).scalar()
    ranges = {c: (ends[f"lo_{c}"], ends[f"hi_{c}"]) for c in columns}
    return df.withColumn("z", interleaved(ranges, bits))


def cluster(df: DataFrame, columns: list[str], out: str, files: int, bits: int = 10) -> None:
    """Write rows that are near in all `columns` into the same files.

    Ranges are cut on the z-value and then on row content, so one frequent
    value can be cut into several files.
    """
    mixed = F.xxhash64(*df.columns)
    (
        with_z(df, columns, bits)
        .repartitionByRange(files, "z", mixed)
        .sortWithinPartitions("z")
        .drop("z")
        .write.parquet(out)
    )


def files_for(spark: SparkSession, path: str, target_bytes: int = 512 << 20) -> int:
    """How many files of about `target_bytes` the table at `path` fills, by its bytes on disk."""
    total = file_sizes(spark, path).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    return max(1, -(-total // target_bytes))


def rank_cells(df: DataFrame, columns: Sequence[str], bits: int = 6, accuracy: int = 10_000) -> dict[str, Column]:
    """For each column the cell 0..2^bits-1 that holds an equal share of the rows.

    Cells end at approximate quantiles (one mergeable sketch per column, one pass), so
    that an outlier or a long tail is one row more in the last cell and does not
    widen the others. NULL is in the first cell. The driver holds the 2^bits - 1
    cuts of each column, and a row finds its cell in `bits` comparisons.
    """
    shares = F.array(*[F.lit(i / (1 << bits)) for i in range(1, 1 << bits)])
    cuts = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, accuracy).alias(c) for c in columns]).first()

    def cell(value: Column, ends: list, low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value <= F.lit(ends[middle]), cell(value, ends, low, middle)).otherwise(
            cell(value, ends, middle + 1, high))

    def of(name: str) -> Column:
        ends = cuts[name]
        value = F.col(name).cast("double")
        return F.when(value.isNull(), F.lit(0)).otherwise(cell(value, ends, 0, len(ends))) if ends else F.lit(0)

    return {c: of(c) for c in columns}


def cluster_by_rank(df: DataFrame, columns: Sequence[str], out: str, files: int, bits: int = 6) -> None:
    """Write rows that are near in all `columns` into the same files, near by rank and not by distance."""
    cells = rank_cells(df, columns, bits)
    taken = [
        F.shiftleft(F.shiftright(cell.cast("bigint"), bit).bitwiseAND(F.lit(1)), bit * len(cells) + place)
        for place, cell in enumerate(cells.values())
        for bit in range(bits)
    ]
    z = reduce(lambda a, b: a.bitwiseOR(b), taken)
    (
        df.withColumn("_z", z).repartitionByRange(files, "_z", F.xxhash64(*df.columns))
        .sortWithinPartitions("_z").drop("_z").write.parquet(out)
    )
