"""Mixing sources to target weights with a low-discrepancy schedule.

1. `targets` shares the total size out to the sources by weight. A target stops
   at `repeats` times its source's size and what it leaves is reshared by
   weight among the others, which is the level `x` at which the targets
   `min(repeats * size, weight * x)` add up to the total.
2. `schedule` numbers slots of `block` words. Slot i has the point
   frac((i + 1) * golden ratio); the source whose interval of cumulative targets
   holds the point owns the slot, and the slot's rank among its source's slots
   is the block it takes. Slots beyond a source's target are left out, and
   blocks that no slot has taken yet follow at the end.
3. `pieces` lays the documents of a source end to end in a keyed shuffled order,
   repeats that stream up to `repeats` times and cuts it into blocks.
4. `mix` joins slots and pieces: which words of which document each slot reads.

Running sums over a hot source are made in two steps, over blocks of keys and
inside them, so that no source is summed in one task. The two windows without
a wide key run over one row per source. Everything is DataFrame functions.

A null text has size 0; documents of size 0 take part in nothing and have taken
0. The null source is a source and comes last. Sources without words have
target 0. Rows with one id are documents of their own in the stream; ties in
the shuffled order are between equal rows, whose order changes nothing but
which of them is read first. An empty table gives an empty mix.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stardw.llm.tables import running_sum, stored, unused

BLOCK = 512
REPEATS = 3
SPLIT = 1 << 20
# Fractions of the golden ratio and of SPLIT times it, each exact to a double.
GOLDEN = 0.6180339887498949
GOLDEN_SPLIT = ((math.isqrt(5 << 240) - (1 << 120)) * (SPLIT // 2) % (1 << 120)) / (1 << 120)
BUCKETS = 4096
STRIDE = 4096


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """Rows (`source`, `source_size`) with `target`, a whole number `quota` and an interval of shares.

    Weights 1, 2, 3 repeat over the sources in code point order, null last.
    """
    everything = Window.partitionBy()
    ranked = sources.withColumn(
        "_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    ).withColumn("weight", (F.pmod(F.col("_rank") - 1, F.lit(3)) + 1).cast("double"))
    cap = (F.col("source_size") * repeats).cast("double")
    # Sources reach their caps in the order of cap / weight: with the first ones at their caps,
    # the rest share what is left; the level is the greatest that the next cap does not cut.
    by_cap = Window.orderBy(cap / F.col("weight"), "_rank")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(0, Window.unboundedFollowing)
    levelled = ranked.withColumn(
        "_level",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0.0)))
        / F.sum("weight").over(after),
    ).withColumn("_x", F.max(F.when(F.col("_level") <= cap / F.col("weight"), F.col("_level"))).over(everything))
    target = F.least(cap, F.col("weight") * F.coalesce(F.col("_x"), F.lit(0.0)))
    shares = Window.orderBy("_rank")
    return (
        levelled.withColumn("target", target)
        .withColumn("quota", F.least(F.round("target").cast("long"), F.col("source_size") * repeats))
        .withColumn("_hi", F.sum("target").over(shares))
        .withColumn("_all", F.sum("target").over(everything))
        .select("source", "source_size", "weight", "target", "quota",
                F.when(F.col("_all") > 0, (F.col("_hi") - F.col("target")) / F.col("_all"))
                .otherwise(0.0).alias("low"),
                F.when(F.col("_all") > 0, F.col("_hi") / F.col("_all")).otherwise(0.0).alias("high"))
    )


def schedule(shares: DataFrame, block: int = BLOCK) -> DataFrame:
    """Slots in order: `slot`, `rank` of its source (the block it takes), `sid` the source's number."""
    spark = shares.sparkSession
    total, n_sources = shares.agg(F.sum("quota"), F.count("*")).first()
    slots = -(-(total or 0) // block)
    owners = shares.filter("quota > 0").select("sid", "low", "high", "quota")
    # Intervals are found by equal pieces of [0, 1): a point meets the few intervals of its piece.
    parts = max(1, 4 * n_sources)
    spans = owners.withColumn(
        "_part", F.explode(F.sequence(
            F.floor(F.col("low") * parts), F.least(F.floor(F.col("high") * parts), F.lit(parts - 1).cast("long"))
        ))
    )
    # In two parts, so that the fraction stays exact to 1e-9 for 2^40 slots.
    n = F.col("id") + 1
    point = F.floor(n / SPLIT) * F.lit(GOLDEN_SPLIT) + F.pmod(n, F.lit(SPLIT)) * F.lit(GOLDEN)
    points = spark.range(slots).select(
        F.col("id").alias("slot"), (point - F.floor(point)).alias("_point")
    ).withColumn("_part", F.floor(F.col("_point") * parts))
    dealt = points.join(spans, "_part").filter(
        (F.col("_point") >= F.col("low")) & (F.col("_point") < F.col("high"))
    ).select("slot", "sid", "quota", F.lit(1).alias("_one"), (F.col("slot") / STRIDE).cast("long").alias("_chunk"))
    ranked = running_sum(dealt, "sid", "_chunk", ["slot"], "_one", "rank").filter(
        F.col("rank") * block < F.col("quota")
    ).select("slot", "sid", "rank")
    taken = ranked.groupBy("sid").agg(F.count("*").alias("_n"))
    needed = F.ceil(F.col("quota") / F.lit(block))
    late = (
        owners.join(taken, "sid", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
        .filter(F.col("_n") < needed)
        .select("sid", F.explode(F.sequence(F.col("_n"), needed - 1)).alias("rank"))
        .select((F.lit(slots) + F.col("rank") * n_sources + F.col("sid")).alias("slot"), "sid", "rank")
    )
    return ranked.unionByName(late)


def pieces(sized: DataFrame, shares: DataFrame, block: int = BLOCK, seed: int = 0) -> DataFrame:
    """Which words of each document lie in which block of its source's repeated stream.

    `sized` has `key`, `source`, `size` and `copy`, which tells equal rows apart. Returns `key`, `copy`, `sid`, `rank`, `start` (word in the
    document), `words`, `pass` (how often the stream was read before).
    """
    keyed = sized.filter("size > 0").withColumn("_hash", F.xxhash64(F.lit(seed), "source", "key", "size", "copy"))
    keyed = keyed.join(
        shares.select(F.col("source").alias("_source"), "sid", "source_size", "quota"),
        F.col("source").eqNullSafe(F.col("_source")),
    ).drop("source", "_source").withColumn("_bucket", F.pmod(F.shiftrightunsigned("_hash", 20), F.lit(BUCKETS)))
    placed = running_sum(keyed, "sid", "_bucket", ["_hash", "key", "size", "copy"], "size", "_at")
    again = placed.filter("quota > 0").withColumn(
        "pass", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("quota") - 1) / F.col("source_size"))))
    ).withColumn("_from", F.col("pass") * F.col("source_size") + F.col("_at"))
    again = again.filter(F.col("_from") < F.col("quota"))
    upto = F.least(F.col("_from") + F.col("size"), F.col("quota"))
    cut = again.withColumn("_upto", upto).withColumn(
        "rank", F.explode(F.sequence(
            F.floor(F.col("_from") / F.lit(block)), F.floor((F.col("_upto") - 1) / F.lit(block))
        ))
    )
    low = F.greatest(F.col("_from"), F.col("rank") * block)
    high = F.least(F.col("_upto"), (F.col("rank") + 1) * block)
    return cut.select("key", "copy", "sid", "rank", (low - F.col("_from")).alias("start"), (high - low).alias("words"), "pass")


def plan(sized: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """Stored targets of the sources of `sized`, with a number `sid` for each source."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    shares = targets(sources, repeats).withColumn(
        "sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long") - 1
    )
    return stored(shares, "op2-targets")


def mix(sized: DataFrame, shares: DataFrame, block: int = BLOCK, seed: int = 0) -> DataFrame:
    """The mix in reading order: `slot`, `key`, `copy`, `start`, `words`, `pass`; sort by slot, pass and start."""
    return pieces(sized, shares, block, seed).join(schedule(shares, block), ["sid", "rank"]).select(
        "slot", "sid", "rank", "key", "copy", "start", "words", "pass"
    )


def sizes(documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Stored `key`, `source`, `size` of every row, and `copy`, which numbers equal rows."""
    rows = documents.select(
        F.col(key).alias("key"), F.col(source).alias("source"), n_words(F.col(text)).alias("size")
    )
    numbered = Window.partitionBy("key", "source", "size").orderBy(F.lit(0))
    return stored(rows.withColumn("copy", F.row_number().over(numbered)), "op2-sizes")


def taken(documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Per row `key`, `source`, `size`, `source_size`, `target` and `taken`, the words the mix reads of it."""
    sized = sizes(documents, key, text, source)
    shares = plan(sized)
    read = mix(sized, shares).groupBy("sid", "key", "copy").agg(F.sum("words").alias("taken"))
    homes = shares.select(F.col("source").alias("_source"), F.col("sid").alias("_sid"), "source_size", "target")
    read = read.select("sid", F.col("key").alias("_key"), F.col("copy").alias("_copy"), "taken")
    return (
        sized.join(homes, F.col("source").eqNullSafe(F.col("_source")))
        .join(read, F.col("key").eqNullSafe(F.col("_key")) & (F.col("_sid") == F.col("sid"))
              & (F.col("copy") == F.col("_copy")), "left")
        .select("key", "source", "size", "source_size", "target",
                F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))
    )


def materialised(documents: DataFrame) -> DataFrame:
    """The rows of `documents` as often as the mix reads them, a partly read one counted as read.

    Rows that the mix does not reach go; equal rows share their number of reads.
    """
    p = unused(documents)
    key, source, size, reads = (f"{p}{c}" for c in ("key", "source", "size", "reads"))
    often = stored(
        taken(documents).filter("taken > 0").groupBy("key", "source", "size")
        .agg(F.ceil(F.avg("taken") / F.col("size")).cast("int").alias(reads))
        .select(F.col("key").alias(key), F.col("source").alias(source), F.col("size").alias(size), reads),
        "op2-reads",
    )
    return (
        documents.join(
            often,
            F.col("doc_id").eqNullSafe(F.col(key)) & F.col("source").eqNullSafe(F.col(source))
            & (n_words(F.col("text")) == F.col(size)),
        )
        .withColumn(f"{p}read", F.explode(F.sequence(F.lit(1), F.col(reads))))
        .drop(key, source, size, reads, f"{p}read")
    )
