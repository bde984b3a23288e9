"""Quality rules whose cutoffs follow the documents of each language and source.

`measured` adds counts of every whole text. `fences` summarises six ratios of
them in KLL quantile sketches per language and source; a group with too few
documents takes the sketch merged over its language, and then over all
documents. A cutoff is an upper quantile (`TAIL`) plus `reach` times its distance
from the median, so that it follows the group, and `FLOOR`, about twice the
sketch's rank error. The mean length of words has such a cutoff on either side. So that
one stray symbol, line or passage does not reject a short text, `ALLOWED` of
each count are free. Cutoffs taken over all languages are wider where languages
differ (`STRANGE`). `verdicts` joins the cutoffs to the documents.

Null and empty texts have no words and fail the base rule. Null languages and
sources are groups of their own. Repeated rows are measured one by one. An
empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stardw.llm.tables import fresh, unused
from stardw.llm.words import Words, first_of_each, mix, slices, tidy

SYMBOLS = b"#*$%&|<>"
COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_echoes",
]
# The ratios with a greatest value, and how much of the count is free.
ALLOWED = {
    "symbols_per_word": 1, "dup_line_share": 1, "repeat_share": 10, "upper_share": 1, "echo_share": 1,
}
LENGTH = "word_length"
# The quantile that a cutoff starts from. Symbols are junk in whole sources, so that theirs is lower.
TAILS = {"symbols_per_word": 0.75}
TAIL = 0.9
FLOOR = 0.02
LENGTH_FLOOR = 0.5
REACH = 3.0
# What is added to the share of capitals, and the factor of the word lengths, of a language that is not known.
STRANGE_UPPER, STRANGE_LENGTH = 0.2, 2.0
LEAST_GROUP = 50
SKETCH_K = 400
SLICE = 1 << 19

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_UPPER = np.zeros(256, bool)
_UPPER[ord("A"):ord("Z") + 1] = True


def _within(places: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.searchsorted(places, bounds))


def counts_of(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts of each text of an Arrow column."""
    words = Words(column)
    data, bounds = words.data, words.bounds
    solid = np.zeros(len(data) + 1, np.int64)
    np.add.at(solid, words.start, 1)
    np.add.at(solid, words.end, -1)
    in_word = np.cumsum(solid)[:-1] > 0
    lead = np.flatnonzero(in_word & ((data & 0xC0) != 0x80))

    breaks = np.flatnonzero(data == 10)
    begin = np.sort(np.concatenate([bounds[:-1], breaks + 1]))
    end = np.sort(np.concatenate([breaks, bounds[1:]]))
    worded = np.searchsorted(words.start, end) > np.searchsorted(words.start, begin)
    begin, end = begin[worded], end[worded]
    row = np.searchsorted(bounds, begin, "right") - 1
    line = words.spans(begin, end) ^ mix(row.astype(np.uint64))
    again = row[~first_of_each(line)]

    at, value = words.windows()
    value = value ^ mix(words.doc[at].astype(np.uint64))
    order = np.argsort(value)
    same = value[order][1:] == value[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(words.hash) + 6, np.int64)
    cover[at[twice]] += 1
    cover[at[twice] + 5] -= 1
    repeated = np.flatnonzero(np.cumsum(cover) > 0)
    echo = (words.hash[1:] == words.hash[:-1]) & (words.doc[1:] == words.doc[:-1])
    return {
        "n_words": words.counts(),
        "word_chars": _within(lead, bounds),
        "n_symbols": _within(np.flatnonzero(_SYMBOL[data]), bounds),
        "n_dup_lines": np.bincount(again, minlength=words.rows),
        "n_repeat_words": _within(repeated, words.first),
        "n_lines": np.bincount(row, minlength=words.rows),
        "n_upper": _within(np.flatnonzero(_UPPER[data]), bounds),
        "n_echoes": _within(np.flatnonzero(echo) + 1, words.first),
    }


def measured(documents: DataFrame, text: str = "text", into: str = "quality") -> DataFrame:
    """`documents` with a struct `into` of the counts of each whole text."""
    kind = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])

    def run(batches):
        for batch in batches:
            for part in slices(batch, text, SLICE):
                found = counts_of(part.column(text))
                column = pa.StructArray.from_arrays(
                    [pa.array(found[c].astype(np.int64)) for c in COUNTS], COUNTS
                )
                yield pa.RecordBatch.from_arrays([*part.columns, column], [*part.schema.names, into])

    return documents.mapInArrow(tidy(run), T.StructType([*documents.schema.fields, T.StructField(into, kind)]))


def _ratios(m: str, free: bool = False) -> dict[str, Column]:
    """The ratios of the counts, or of what they have beyond `ALLOWED`."""
    def per(name: str, a: str, b: str) -> Column:
        count = F.col(f"{m}.{a}")
        if free:
            count = F.greatest(count - ALLOWED.get(name, 0), F.lit(0))
        return F.when(F.col(f"{m}.{b}") > 0, count / F.col(f"{m}.{b}")).otherwise(0.0)

    parts = {
        "symbols_per_word": ("n_symbols", "n_words"), "dup_line_share": ("n_dup_lines", "n_lines"),
        "repeat_share": ("n_repeat_words", "n_words"), "upper_share": ("n_upper", "word_chars"),
        "echo_share": ("n_echoes", "n_words"), LENGTH: ("word_chars", "n_words"),
    }
    return {name: per(name, *of) for name, of in parts.items()}


def fences(
    measures: DataFrame, by: tuple[str, str] = ("lang", "source"), into: str = "quality",
    reach: float = REACH, least_group: int = LEAST_GROUP,
) -> DataFrame:
    """One row per language and source: `lang`, `source`, the greatest value of each ratio, and
    the least and greatest mean length of words (`least_word_length`, `word_length`)."""
    ratios = _ratios(into)
    names = list(ratios)
    groups = (
        measures.filter(F.col(f"{into}.n_words") > 0)
        .select(F.col(by[0]).alias("_lang"), F.col(by[1]).alias("_source"),
                *[ratios[n].alias(n) for n in names])
        .groupBy("_lang", "_source")
        .agg(F.count("*").alias("_n"),
             *[F.kll_sketch_agg_double(n, F.lit(SKETCH_K)).alias(n) for n in names])
    )
    merged = [F.kll_merge_agg_double(n, F.lit(SKETCH_K)).alias(n) for n in names]
    languages = groups.groupBy("_lang").agg(F.sum("_n").alias("_n"), *merged)
    overall = groups.agg(*merged)

    def prefixed(df: DataFrame, p: str) -> DataFrame:
        return df.select(*[F.col(c).alias(p + c) for c in df.columns])

    wide = groups.join(
        prefixed(languages, "l"), F.col("_lang").eqNullSafe(F.col("l_lang"))
    ).withColumn("a", overall.select(F.struct(*names)).scalar())

    own, language = F.col("_n") >= least_group, F.col("l_n") >= least_group

    def quantile(n: str, q: float) -> Column:
        sketch = F.when(own, F.col(n)).when(language, F.col("l" + n)).otherwise(F.col(f"a.{n}"))
        return F.kll_sketch_get_quantile_double(sketch, F.lit(q))

    def cutoff(n: str, tail: float = TAIL, floor: float = FLOOR) -> Column:
        end = quantile(n, tail)
        return end + reach * (end - quantile(n, 0.5)) + floor

    known = own | language
    factor = F.when(known, 1.0).otherwise(STRANGE_LENGTH)
    greatest = {n: cutoff(n, TAILS.get(n, TAIL)) for n in ALLOWED}
    greatest["upper_share"] += F.when(known, 0.0).otherwise(STRANGE_UPPER)
    greatest[LENGTH] = cutoff(LENGTH, floor=LENGTH_FLOOR) * factor
    greatest[f"least_{LENGTH}"] = cutoff(LENGTH, 1 - TAIL, -LENGTH_FLOOR) / factor
    return wide.select(
        F.col("_lang").alias("lang"), F.col("_source").alias("source"), *[c.alias(n) for n, c in greatest.items()]
    )


def verdicts(
    measures: DataFrame, cutoffs: DataFrame, by: tuple[str, str] = ("lang", "source"),
    into: str = "quality", base_failed: str = "base_failed", kept: str = "kept",
) -> DataFrame:
    """`measures` with two booleans: failed the base rule, and is to be kept."""
    words, repeats = F.col(f"{into}.n_words"), F.col(f"{into}.n_repeat_words")
    failed = (words < 10) | (100 * repeats > 20 * words)
    p = unused(measures)
    limits = cutoffs.select(*[F.col(c).alias(p + c) for c in cutoffs.columns])
    joined = measures.join(
        limits,
        F.col(by[0]).eqNullSafe(F.col(f"{p}lang")) & F.col(by[1]).eqNullSafe(F.col(f"{p}source")),
        "left",
    )
    inside = F.lit(True)
    for name, ratio in _ratios(into, free=True).items():
        inside = inside & (ratio <= F.coalesce(F.col(p + name), F.lit(float("inf"))))
    inside = inside & (_ratios(into)[LENGTH] >= F.coalesce(F.col(f"{p}least_{LENGTH}"), F.lit(0.0)))
    return joined.withColumn(base_failed, failed).withColumn(kept, ~failed & inside).drop(*limits.columns)


def keep_good(documents: DataFrame) -> DataFrame:
    """The rows of `documents` that pass the base rule and their group's cutoffs.

    The texts are measured once for the sketches and once for the filter, so
    that no measure of all documents has to be joined back to their texts.
    """
    into = fresh(documents, "quality")
    small = measured(documents.select("text", "lang", "source"), into=into).drop("text")
    failed, kept = fresh(documents, "base_failed"), fresh(documents, "kept")
    judged = verdicts(
        measured(documents, into=into), fences(small, into=into), into=into,
        base_failed=failed, kept=kept,
    )
    return judged.filter(F.col(kept)).select(*[F.col(f"`{c}`") for c in documents.columns])
