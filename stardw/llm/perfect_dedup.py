"""Exact duplicates against a minimal perfect hash of the digests seen before.

`build` turns the distinct digests of a history into shards. A shard holds a
minimal perfect hash (levels of bit arrays: a key settles on the first level
where its place is its own; its slot is the number of settled places before
it) and per slot the whole digest, the winner's id and the number of rows.
`lookup` sends each distinct new digest to its shard, computes the slot and
compares all 32 bytes, so that a digest which is not in the history is never
taken for one that is. Digests without a match are grouped by themselves.

A null text counts as empty. Of equal texts the row with the smallest id stays;
a null id comes after all others, and of rows with one id all get the same
answer. Empty tables give empty tables. Shards hold about `SHARD` digests
whatever the size of the history; digests are hashes, so shards are even, and
every group is reduced to one row per task before it is shuffled.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stardw.llm.tables import spread_join, stored, unused
from stardw.llm.words import mix

SHARD = 20_000
GAMMA = 2

_U = np.uint64


def normalised(text: Column) -> Column:
    """Each run of white space replaced by one space; null becomes empty."""
    # Matches only runs that are not one space already, which leaves most spaces untouched.
    return F.regexp_replace(
        F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " "
    )


def digests(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns `key` and `digest`, the 32 bytes of SHA-256 of the normalised text."""
    digest = F.unhex(F.sha2(F.encode(normalised(F.col(text)), "utf-8"), 256))
    return documents.select(F.col(key).alias("key"), digest.alias("digest"))


def grouped(rows: DataFrame) -> DataFrame:
    """One row per digest: smallest key and number of rows."""
    return rows.groupBy("digest").agg(F.min("key").alias("winner"), F.count("*").alias("n"))


def _numbers(digest: pd.Series) -> np.ndarray:
    raw = np.frombuffer(b"".join(digest), np.uint8).reshape(-1, 32)
    return raw.view(_U)[:, 1].copy()


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys + _U((level * 0x9E3779B97F4A7C15) % 2**64)) % _U(size)).astype(np.int64)


def perfect_levels(keys: np.ndarray) -> list[np.ndarray]:
    """Bit arrays of a minimal perfect hash of distinct 64-bit keys."""
    levels = []
    while len(keys):
        size = GAMMA * len(keys) + 1
        at = _place(keys, len(levels), size)
        hits = np.bincount(at, minlength=size)
        levels.append(hits == 1)
        keys = keys[hits[at] != 1]
        if len(levels) > 200:
            raise ValueError("keys of a perfect hash must be distinct")
    return levels


def slots(keys: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Slot of each key, -1 where no level has a place for it."""
    found = np.full(len(keys), -1, np.int64)
    left, before = np.arange(len(keys)), 0
    for level, bits in enumerate(levels):
        if not len(left):
            break
        at = _place(keys[left], level, len(bits))
        settled = bits[at]
        found[left[settled]] = before + np.cumsum(bits)[at[settled]] - 1
        before += int(bits.sum())
        left = left[~settled]
    return found


def _shard(n: int) -> Column:
    return F.pmod(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long"), F.lit(n)).cast("int")


def build(history: DataFrame, shards: int) -> DataFrame:
    """Shards of the perfect hash of distinct rows (`digest`, `winner`, `n`)."""
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        levels = perfect_levels(_numbers(pdf["digest"]))
        order = np.argsort(slots(_numbers(pdf["digest"]), levels))
        ranked = pdf.iloc[order]
        return pd.DataFrame({
            "shard": [int(pdf["shard"].iloc[0])],
            "levels": [[np.packbits(b).tobytes() for b in levels]],
            "sizes": [[len(b) for b in levels]],
            "digests": [b"".join(ranked["digest"])],
            "winners": [[None if pd.isna(w) else int(w) for w in ranked["winner"]]],
            "counts": [ranked["n"].tolist()],
        })

    kind = ("shard int, levels array<binary>, sizes array<int>, digests binary, "
            "winners array<bigint>, counts array<bigint>")
    rows = history.withColumn("winner", F.col("winner").cast("long")).withColumn("shard", _shard(shards))
    return rows.groupBy("shard").applyInPandas(pack, kind)


def lookup(new: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """Rows (`digest`, `winner`, `n`) of `new` with what the history holds of the same digest.

    Adds `old_winner` and `old_n`, null and 0 for a digest the history lacks.
    """
    def probe(_, new: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        out = new[["digest", "winner", "n"]].copy()
        winner, count = [None] * len(out), np.zeros(len(out), np.int64)
        if len(index) and len(out):
            row = index.iloc[0]
            levels = [
                np.unpackbits(np.frombuffer(b, np.uint8), count=size).astype(bool)
                for b, size in zip(row["levels"], row["sizes"], strict=True)
            ]
            slot = slots(_numbers(out["digest"]), levels)
            whole = np.frombuffer(row["digests"], np.uint8).reshape(-1, 32)
            mine = np.frombuffer(b"".join(out["digest"]), np.uint8).reshape(-1, 32)
            member = (slot >= 0) & (whole[slot] == mine).all(axis=1)
            for i in np.flatnonzero(member):
                w = row["winners"][slot[i]]
                winner[i] = None if pd.isna(w) else int(w)
                count[i] = row["counts"][slot[i]]
        out["old_winner"], out["old_n"] = pd.array(winner, "Int64"), count
        out["winner"] = out["winner"].astype("Int64")
        return out

    left = new.withColumn("winner", F.col("winner").cast("long")).withColumn("shard", _shard(shards))
    return left.groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(
        probe, "digest binary, winner bigint, n bigint, old_winner bigint, old_n bigint"
    )


def groups(new: DataFrame, history: DataFrame) -> DataFrame:
    """One row per distinct digest of both: `digest`, `keep`, `size`.

    `new` and `history` have columns `key` and `digest`; both are best stored,
    as each is read more than once.
    """
    old = stored(grouped(history), "op6-history")
    shards = max(1, -(-old.count() // SHARD))
    index = stored(build(old, shards), "op6-index")
    found = stored(lookup(grouped(new), index, shards), "op6-found")
    met = found.select(
        "digest", F.least("winner", "old_winner").alias("keep"), (F.col("n") + F.col("old_n")).alias("size")
    )
    unmet = old.join(found.filter("old_n > 0").select("digest"), "digest", "left_anti")
    return met.unionByName(unmet.select("digest", F.col("winner").alias("keep"), F.col("n").alias("size")))


def decide(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Every row of `rows` (with a column `digest`) with `keep` and `size` of its group."""
    return spread_join(rows, classes, "digest", "size", rows.count())


def split_by_age(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with an id up to the middle of the range of ids as history, all others as new."""
    low, high = rows.agg(F.min("key"), F.max("key")).first()
    if low is None:
        return rows.limit(0), rows
    older = F.col("key") <= F.lit((low + high) // 2)
    return rows.filter(older), rows.filter(~F.coalesce(older, F.lit(False)))


def deduplicate(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: `key`, `digest`, `keep` (id of the row that stays), `size`."""
    rows = stored(digests(documents, key, text), "op6-digests")
    history, new = split_by_age(rows)
    classes = stored(groups(new, history), "op6-groups")
    return decide(rows, classes)


def keep_first(documents: DataFrame) -> DataFrame:
    """The rows of `documents` that are the first of their text.

    Of rows that share both the smallest id and the text, one stays.
    """
    p = unused(documents)
    digest, names = f"{p}own", [F.col("key").alias(f"{p}key"), F.col("digest").alias(f"{p}digest")]
    judged = stored(deduplicate(documents), "op6-judged")
    dropped = judged.filter(~F.col("key").eqNullSafe(F.col("keep"))).select(*names).distinct()
    again = judged.groupBy("key", "digest").count().filter("count > 1").select(*names)
    marked = documents.withColumn(
        digest, F.unhex(F.sha2(F.encode(normalised(F.col("text")), "utf-8"), 256))
    )
    same = F.col("doc_id").eqNullSafe(F.col(f"{p}key")) & (F.col(digest) == F.col(f"{p}digest"))
    kept = marked.join(dropped, same, "left_anti")
    once = kept.join(again, same, "left_anti")
    if not again.isEmpty():
        once = once.unionByName(kept.join(again, same, "left_semi").dropDuplicates(["doc_id", digest]))
    return once.drop(digest)
