"""Term use of sources compared in pairs, by hash-consed segment trees over term ids.

Terms are runs of ASCII letters and characters beyond ASCII, only A-Z being
lower-cased. A language keeps the terms that at least `LEAST_DOCS` of its
documents use; N is the number of kept terms in a group's texts, V the number of
terms kept. A group's price of a term is p = 1 + floor(10^9 (count + 5) / (N + 5 V)),
and two groups of a language differ by the sum of |p - q| over all kept terms.

The ids of a language's terms are cut into segments of about `SEGMENT`, frequent
terms in front. Over each segment every group has a binary tree whose leaves are
its counts. Trees are hash-consed from the leaves up: two nodes with equal
children are one node, whichever group or place they come from, so that the
zeros of a rare term or equal counts of a run of terms are stored once. Two trees
are compared by walking both at once from the roots. What is still to be priced
is a set of node pairs with the number of times they were reached; equal pairs
of one comparison are merged on every level (the memo), so that each is expanded,
and at the leaves priced, once.

A task holds one segment of at most two blocks of `BLOCK` groups, whatever the
number of documents, groups or terms; the sums of segments meet in an aggregate.
Counts of a task's documents are added up before the shuffle.

Null text, language or source is ''. Repeated rows count as often as they stand.
A group without terms has counts of 0, and a language without kept terms has
differences of 0. An empty table gives no rows. Other columns are not looked at.
Counts are exact as long as they stay under 10^18.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stardw.llm.tables import stored
from stardw.llm.words import Spans, as_bytes, mix, slices

LEAST_DOCS = 30
SEGMENT = 1 << 11
BLOCK = 32
TOP_TERMS = 50
# Bytes of texts whose counts a task adds up before it passes them on.
FLUSH = 1 << 25
# Node pairs that one comparison step may hold.
FRONTIER = 1 << 21
SCALE = 10**9
SMOOTH = 5

_U = np.uint64
_TERM = np.zeros(256, bool)
_TERM[ord("A"):ord("Z") + 1] = True
_TERM[ord("a"):ord("z") + 1] = True
_TERM[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def term_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first byte and end of every term of texts that lie one after the other."""
    inside = _TERM[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = bounds[1:-1]
    at = edges[edges < len(data)]
    begins[at] |= inside[at]
    last = edges[edges > 0] - 1
    ends[last] |= inside[last]
    start = np.flatnonzero(begins)
    return np.searchsorted(bounds, start, "right") - 1, start, np.flatnonzero(ends) + 1


class _Counts:
    """Occurrences and documents of (group, term) over the slices of a task."""

    def __init__(self):
        self.groups: dict[tuple[str, str], int] = {}
        self.clear()

    def clear(self) -> None:
        self.parts: list[tuple] = []
        self.size = 0

    def add(self, part: pa.RecordBatch) -> None:
        data, bounds = as_bytes(part.column("text"))
        if not len(data):
            return
        data = _LOWER[data]
        pairs = zip(part.column("lang").to_pylist(), part.column("source").to_pylist(), strict=True)
        group = np.array([self.groups.setdefault(p, len(self.groups)) for p in pairs], np.int64)
        row, start, end = term_spans(data, bounds)
        if not len(row):
            return
        hashes = mix(Spans(data)(start, end) + (end - start).astype(_U))
        # Once per row and term, with its occurrences there.
        order = np.argsort(hashes ^ mix(row.astype(_U)), kind="stable")
        ranked = (hashes ^ mix(row.astype(_U)))[order]
        cut = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        times = np.diff(np.append(cut, len(order)))
        some = order[cut]
        self._merge(data, group[row[some]], hashes[some], start[some], end[some], times, np.ones(len(some), np.int64))
        self.size += len(data)

    def _merge(self, data, group, hashes, start, end, times, docs) -> None:
        code = hashes ^ mix(group.astype(_U) + _U(1 << 40))
        order = np.argsort(code, kind="stable")
        ranked = code[order]
        cut = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        some = order[cut]
        size = (end - start)[some]
        first = np.concatenate([[0], np.cumsum(size)])
        kept = data[np.repeat(start[some] - first[:-1], size) + np.arange(first[-1])]
        self.parts.append((
            kept, group[some], hashes[some], first[:-1], first[1:],
            np.add.reduceat(times[order], cut), np.add.reduceat(docs[order], cut),
        ))

    def flushed(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        data = np.concatenate([p[0] for p in self.parts])
        shift = np.cumsum([0, *[len(p[0]) for p in self.parts[:-1]]])
        moved = [np.concatenate([p[i] + s for p, s in zip(self.parts, shift, strict=True)]) for i in (3, 4)]
        rest = [np.concatenate([p[i] for p in self.parts]) for i in (1, 2, 5, 6)]
        self.clear()
        self._merge(data, rest[0], rest[1], *moved, rest[2], rest[3])
        data, group, _, first, end, times, docs = self.parts.pop()
        names = list(self.groups)
        lang, source = (pa.array([n[i] for n in names], pa.string()) for i in (0, 1))
        for low in range(0, len(group), 1 << 17):
            part = slice(low, low + (1 << 17))
            offsets = np.append(first[part], end[part][-1])
            terms = pa.StringArray.from_buffers(
                len(offsets) - 1, pa.py_buffer((offsets - offsets[0]).astype(np.int32).tobytes()),
                pa.py_buffer(data[offsets[0]:offsets[-1]].tobytes()))
            index = pa.array(group[part])
            yield pa.RecordBatch.from_pydict({
                "lang": lang.take(index), "source": source.take(index), "term": terms,
                "n": pa.array(times[part]), "docs": pa.array(docs[part]),
            })
        self.clear()


def term_counts(documents: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(`lang`, `source`, `term`, `n`, `docs`), several rows of a term if several tasks met it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts()
        for batch in batches:
            for part in slices(batch, "text"):
                counts.add(part)
                if counts.size > FLUSH:
                    yield from counts.flushed()
        yield from counts.flushed()

    return _named(documents, text, lang, source).mapInArrow(
        run, "lang string, source string, term string, n bigint, docs bigint")


def _named(documents: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    def filled(name: str, into: str):
        return F.coalesce(F.col(name), F.lit("")).alias(into)

    return documents.select(filled(lang, "lang"), filled(source, "source"), filled(text, "text"))


def price(count: int, total: int, kept: int) -> int:
    return 1 + SCALE * (count + SMOOTH) // (total + SMOOTH * kept)


class Forest:
    """The trees of several groups over one segment, equal subtrees being one node.

    `counts` has a row per group and a column per term of the segment. Nodes are
    numbered level by level; `children[d]` has the two nodes below each node of
    level d, `roots` the top node of each group, and `leaves` the count of each
    node of the lowest level, -1 standing for a place beyond the segment.
    """

    def __init__(self, counts: np.ndarray):
        groups, terms = counts.shape
        width = 1 << max(0, terms - 1).bit_length()
        padded = np.full((groups, width), -1, np.int64)
        padded[:, :terms] = counts
        self.leaves, nodes = np.unique(padded, return_inverse=True)
        nodes = nodes.reshape(groups, width)
        self.children: list[np.ndarray] = []
        known = len(self.leaves)
        while nodes.shape[1] > 1:
            pairs = nodes[:, ::2] * known + nodes[:, 1::2]
            distinct, nodes = np.unique(pairs, return_inverse=True)
            nodes = nodes.reshape(pairs.shape)
            self.children.append(np.stack([distinct // known, distinct % known], axis=1))
            known = len(distinct)
        self.children.reverse()
        self.roots = nodes[:, 0]

    def nodes(self) -> int:
        return len(self.leaves) + sum(len(c) for c in self.children)

    def distances(self, left: np.ndarray, right: np.ndarray, prices: np.ndarray) -> np.ndarray:
        """For each pair of groups the sum of |p - q|; `prices` has a row per group and a column per leaf."""
        pair = np.arange(len(left))
        a, b, times = self.roots[left], self.roots[right], np.ones(len(left), np.int64)
        for children in self.children:
            low = len(children)
            pair, a, b, times = _once(pair, a, b, times, low)
            pair, times = np.concatenate([pair, pair]), np.concatenate([times, times])
            a, b = children[a].T.ravel(), children[b].T.ravel()
        pair, a, b, times = _once(pair, a, b, times, len(self.leaves))
        apart = np.abs(prices[left[pair], a] - prices[right[pair], b]) * times
        apart[(self.leaves[a] < 0) | (self.leaves[b] < 0)] = 0
        out = np.zeros(len(left), np.int64)
        np.add.at(out, pair, apart)
        return out


def _once(pair, a, b, times, nodes):
    """Equal node pairs of one comparison merged, with the number of times they were reached."""
    code = (pair * nodes + a) * nodes + b
    order = np.argsort(code)
    ranked = code[order]
    cut = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    some = order[cut]
    return pair[some], a[some], b[some], np.add.reduceat(times[order], cut)


def compared(rows: pd.DataFrame) -> pd.DataFrame:
    """Distances over one segment between the groups of two blocks.

    `rows` has (`member`, `block`, `total`, `kept`, `place`, `n`): a count per
    group and term, and for every group one row with place -1, whose `n` is the
    number of terms of the segment. Terms that no group here uses count as well.
    """
    members = rows.drop_duplicates("member").sort_values("member")
    number = members["member"].to_numpy()
    at = np.searchsorted(number, rows["member"].to_numpy())
    place = rows["place"].to_numpy()
    real = place >= 0
    n = rows["n"].to_numpy()
    counts = np.zeros((len(number), int(n[~real].max())), np.int64)
    counts[at[real], place[real]] = n[real]
    forest = Forest(counts)
    totals, kept = members["total"].tolist(), int(members["kept"].iloc[0])
    prices = np.array([[price(c, t, kept) if c >= 0 else 0 for c in forest.leaves.tolist()] for t in totals], np.int64)
    block = members["block"].to_numpy()
    left, right = np.triu_indices(len(number), 1)
    if block.min() != block.max():
        crossing = block[left] != block[right]
        left, right = left[crossing], right[crossing]
    step = max(1, FRONTIER // counts.shape[1])
    found = [forest.distances(left[i:i + step], right[i:i + step], prices) for i in range(0, len(left), step)]
    value = np.concatenate(found) if found else np.zeros(0, np.int64)
    return pd.DataFrame({"a": number[left], "b": number[right], "value": value})


def audited(
    documents: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
    least_docs: int = LEAST_DOCS, top: int = TOP_TERMS, segment: int = SEGMENT, block: int = BLOCK,
) -> DataFrame:
    """`lang`, `source`, `part`, `item`, `value`, `rank`: what sets each group apart.

    Part `pair` has every other source of the language with their distance,
    part `term` the `top` terms whose price is most above that of the language.
    """
    raw = term_counts(documents, text, lang, source)
    # One exchange by term serves the sums per group and those per language.
    per_group = raw.repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    counts = stored(
        per_group.withColumn("lang_docs", F.sum("docs").over(of_term))
        .filter(F.col("lang_docs") >= least_docs)
        .withColumn("lang_n", F.sum("n").over(of_term))
        .select("lang", "source", "term", "n", "lang_n"), "term-counts")
    by_lang = Window.partitionBy("lang")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    terms = counts.select("lang", "term", "lang_n").distinct()
    sizes = terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    named = _named(documents, text, lang, source).select("lang", "source").distinct()
    groups = stored(
        named.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
        .select(
            "lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "kept", "lang_total")],
            (F.row_number().over(by_lang.orderBy("source")) - 1).alias("member"),
        ), "term-groups")
    parts = _pairs(counts, terms, groups, segment, block).unionByName(_terms(counts, groups, top))
    return parts.select("lang", "source", "part", "item", "value", "rank")


def _pairs(counts: DataFrame, terms: DataFrame, groups: DataFrame, segment: int, block: int) -> DataFrame:
    cut = F.greatest(F.ceil(F.col("kept") / F.lit(segment)), F.lit(1)).cast("int")
    sized = groups.groupBy("lang").agg(F.max("kept").alias("kept"), F.max("member").alias("last"))
    spread = terms.join(sized, "lang").withColumn("segment", F.pmod(F.xxhash64("term"), cut).cast("int"))
    frequent = Window.partitionBy("lang", "segment").orderBy(F.desc("lang_n"), "term")
    placed = spread.select("lang", "term", "segment", (F.row_number().over(frequent) - 1).alias("place"))
    info = groups.select("lang", "source", "member", "total", "kept")
    leaves = counts.join(placed, ["lang", "term"]).join(info, ["lang", "source"]).select(
        "lang", "segment", "member", "total", "kept", "place", "n")
    # Every group has a tree over every segment, also where it has no term of it.
    widths = placed.groupBy("lang", "segment").agg(F.count("*").alias("n"))
    everywhere = info.filter("kept > 0").select(
        "lang", F.explode(F.sequence(F.lit(0), cut - 1)).alias("segment"), "member", "total", "kept",
        F.lit(-1).alias("place")).join(widths, ["lang", "segment"])
    rows = leaves.unionByName(everywhere).join(sized.select("lang", "last"), "lang")
    mine = F.floor(F.col("member") / block).cast("int")
    blocks = F.sequence(F.lit(0), F.floor(F.col("last") / block).cast("int"))
    dealt = rows.withColumn("block", mine).withColumn("other", F.explode(blocks)).select(
        "lang", "segment", "member", "block", "total", "kept", "place", "n",
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = compared(rows)
        out.insert(0, "lang", rows["lang"].iloc[0])
        return out

    apart = dealt.groupBy("lang", "segment", "low", "high").applyInPandas(
        run, "lang string, a int, b int, value bigint")
    sums = apart.groupBy("lang", "a", "b").agg(F.sum("value").cast("bigint").alias("value"))
    both = sums.select("lang", F.explode(F.array(
        F.struct(F.col("a").alias("member"), F.col("b").alias("other")),
        F.struct(F.col("b").alias("member"), F.col("a").alias("other")))).alias("p"), "value"
    ).select("lang", "p.*", "value")
    # Where no term is kept, there is no segment, and all differences are 0.
    bare = groups.filter("kept = 0").select("lang", "member")
    bare = bare.join(bare.select("lang", F.col("member").alias("other")), "lang").filter("member <> other")
    every = both.unionByName(bare.withColumn("value", F.lit(0).cast("bigint")))
    names = groups.select("lang", "source", "member")
    shown = every.join(names, ["lang", "member"]).join(
        names.select("lang", F.col("source").alias("item"), F.col("member").alias("other")), ["lang", "other"])
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return shown.select("lang", "source", F.lit("pair").alias("part"), "item", "value", place.alias("rank"))


def _terms(counts: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    def p(count: str, total: str):
        # Integer division of decimals gives a long; all of it is exact.
        above = f"{SCALE}BD * cast({count} + {SMOOTH} as decimal(19,0))"
        return F.expr(f"{above} div cast({total} + {SMOOTH} * kept as decimal(19,0))") + 1

    apart = counts.join(groups, ["lang", "source"]).withColumn("value", p("n", "total") - p("lang_n", "lang_total"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term"))
    return apart.filter("value > 0").withColumn("rank", place).filter(F.col("rank") <= top).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
