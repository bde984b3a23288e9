"""Tables in pieces, with a manifest written last that names the live folder of each piece.

A manifest is one small Parquet file in a numbered folder: a row per piece with
the folder that holds it, and one row for the table itself. Data is written to
new folders first; until the manifest is there, readers see the table as it was,
and what a failed writer left is never read. Folders of the manifests before the
last `KEPT` are removed, so that a reader has that many loads' time to finish.
One writer per table at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

KEPT = 2
ENTRY = "piece string, folder string, rows bigint, label string"


@dataclass
class Manifest:
    """`pieces`: folder below the table and rows by piece; `label`: what load wrote it; -1: no table yet."""

    number: int = -1
    label: str = ""
    pieces: dict[str, tuple[str, int]] = field(default_factory=dict)


def manifests(spark: SparkSession, path: str) -> list[Manifest]:
    """All manifests that are kept, oldest first: a row per piece each, so a bounded list."""
    try:
        found = spark.read.schema(f"{ENTRY}, number bigint").parquet(f"{path}/manifest").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    out: dict[int, Manifest] = {}
    for row in found:
        one = out.setdefault(row.number, Manifest(row.number))
        if row.piece is None:
            one.label = row.label
        else:
            one.pieces[row.piece] = (row.folder, row.rows)
    return [out[n] for n in sorted(out)]


def newest(spark: SparkSession, path: str) -> Manifest:
    return (manifests(spark, path) or [Manifest()])[-1]


def read_live(
    spark: SparkSession, path: str, schema: StructType, pieces: Sequence[str] | None = None,
    manifest: Manifest | None = None,
) -> DataFrame:
    """The table, or some of its pieces, as its last manifest has it."""
    manifest = manifest or newest(spark, path)
    wanted = manifest.pieces if pieces is None else [p for p in pieces if p in manifest.pieces]
    folders = [f"{path}/{manifest.pieces[p][0]}" for p in wanted]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def switch(spark: SparkSession, path: str, manifest: Manifest, keep: int = KEPT) -> None:
    """Make `manifest` the last one, and remove the folders that only expired ones name."""
    rows = [(None, None, None, manifest.label)]
    rows += [(piece, folder, n, None) for piece, (folder, n) in manifest.pieces.items()]
    spark.createDataFrame(rows, ENTRY).coalesce(1).write.mode("overwrite").parquet(
        f"{path}/manifest/number={manifest.number}")
    known = manifests(spark, path)
    live = {folder for m in known[-keep:] for folder, _ in m.pieces.values()}
    for old in known[:-keep]:
        for folder, _ in old.pieces.values():
            if folder not in live:
                remove_path(spark, f"{path}/{folder}")
        remove_path(spark, f"{path}/manifest/number={old.number}")


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder, if it is there, through the file system settings of the session."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def rows_by(df: DataFrame, piece: str) -> dict[str, int]:
    """Rows of each piece of a table just written, for a manifest."""
    counts = df.groupBy(F.col(piece).cast("string").alias("piece")).agg(F.count("*").alias("n"))
    return {r.piece: r.n for r in counts.collect()}
