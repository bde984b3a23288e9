"""A hashed maximum-entropy language model with classes of words.

The probability of a token is that of its class given the words before it,
times that of the word given its class and the word before it.

P(class | history) = softmax of the sum of the
weight rows of the history's features, each hashed to one of `ROWS` rows: the
previous word; the word before it, as a skip feature; the last two different
frequent words (anchors) at any distance, as skip features; the previous word
with the last anchor; and one for all. Of words beyond the `NAMED` most
frequent ones only the class is a feature.

P(word | class, word before) is the word's share of the class, (count + 1) /
(sum of counts + 1 over the class), times exp of the weight of the pair of both
words, divided by the sum of that over the class. Each pair of the training
documents has a weight of its own, so the table of weights grows with the
corpus. It is the largest of the mean ln chance less `DISCOUNT` times each
weight, none below 0: pairs that occur oftener than the share gives are expected
`DISCOUNT` times less often than they occur, the others have weight 0. One pair
is a feature of a token at most, so that each word before and class is solved by
itself, exactly. Words beyond `TOP` go by `BUCKETS` hashes: the pair chooses the
bucket, inside it a word has its share; each bucket has an equal part of the
one event of unknown words.

Blocks of about `PAIRED` tokens send each different pair once to the group that
solves its class and word before, with the number of times it occurs in training
documents. The group adds these up and answers with the sums and what it has
solved; the answers meet the places of their block again. So neither the
rows of a frequent pair nor the table of pairs is ever in one place.

Each of the `ANCHORS` most frequent tokens is a class. The next ones up to
`GROUPED` join the class of the anchor after which they stand most often,
compared with how often anything does; the others up to `TOP` are cut into
`BINS` classes by frequency; all others, unseen words included, are the last
class. So the classes sum up to one event for each known word and one for
unknown words, as in the base score.

Texts are cut into tokens twice: to count the words, and to store each token's
place among the top words. Every later pass reads the stored places, or the
histories gathered from them.

Weights start from counts: `START` times the log of how much oftener a class
follows a feature than it occurs. What the weights give a token depends on its
history alone, so equal histories of the whole corpus are gathered once, dealt
by the weight row of their previous word and anchor, and stored with their
numbers. In each round every task adds up the probabilities that the shared
weights give its histories, and few rows are in the sums of more than one task;
the sums over all tasks
are the expected counts, and observed less expected counts, over the larger of
the two, are the step. Weights other than those for all are drawn to 0 as by a
normal prior of precision `PENALTY`, so that rare histories are not learned by
heart. Rounds go on until one raises what is sought, the mean ln of a training
token's chance less the penalty, by less than `LEAST`. Weights stay fixed within a
round, so order, split and number of tasks do not change a score beyond rounding.

What the driver holds is the table of top tokens and the weight matrix, both
of fixed size. Counts cover all training documents; rarer words are joined to
their counts by shuffle.

Documents whose crc32 of the id as text has the remainder 2 by 7 are held out;
a null id is not. A null or empty text is one token, the end. Rows with one id
are documents of their own. With nothing to train on, N and V are 0 and the
model is the base score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stardw.llm.tables import stored
from stardw.llm.words import HashIndex, Words, give_back, mix, slices, tidy

TOP = 1 << 18
ANCHORS = 24
GROUPED = 1 << 16
BINS = 3
NAMED = 1 << 11
ROWS = 1 << 15
BLOCK = 1 << 18
WIDE = 1 << 12
BATCH = 1 << 11
START = 0.25
PRIOR = 4.0
RATE = 0.35
PENALTY = 1.0
LEAST = 0.01
FLUSH = 1 << 21
GROUP_BYTES = 1 << 25
BUCKETS = 1 << 18
PAIRED = 1 << 20
DISCOUNT = 0.75
HEAD_BITS = 28
EVENT_BITS = 20
KIND_BITS = 8

_U = np.uint64
END = mix(np.array([0x656E64], _U))[0]
FEATURES = 6


def held_out(key: str) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 7 == 2, F.lit(False))


def tokens(part: pa.RecordBatch, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all rows, each row's end included, and where each row begins."""
    words = Words(part.column(text), lower=True)
    first = words.first + np.arange(words.rows + 1)
    out = np.empty(first[-1], _U)
    out[np.arange(len(words.hash)) + words.doc] = words.hash
    out[first[1:] - 1] = END
    return out, first


def bucket(words: np.ndarray) -> np.ndarray:
    return (words >> _U(20)).astype(np.int64) & (BUCKETS - 1)


def counts(documents: DataFrame, text: str = "text") -> DataFrame:
    """(`word`, `n`) of all tokens of the documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            words, which = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
            n = np.bincount(which, weights=np.concatenate([c for _, c in held]))
            return pa.RecordBatch.from_pydict(
                {"word": pa.array(words.view(np.int64)), "n": pa.array(n.astype(np.int64))})

        for batch in batches:
            for part in slices(batch, text):
                words, n = np.unique(tokens(part, text)[0], return_counts=True)
                held.append((words, n))
                size += len(words)
                if size > FLUSH:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return documents.select(text).mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """The most frequent tokens by rank, with their counts; N and V; the sum of counts + 1 over the others of each bucket."""

    index: HashIndex
    count: np.ndarray
    n: int
    v: int
    rare: np.ndarray

    @classmethod
    def of(cls, table: DataFrame) -> Vocabulary:
        v, n = table.agg(F.count("*"), F.sum("n")).first()
        top = table.orderBy(F.desc("n"), "word").limit(TOP).toArrow()
        words, count = top.column("word").to_numpy().view(_U), top.column("n").to_numpy()
        sums = table.groupBy(F.shiftrightunsigned("word", 20).bitwiseAND(BUCKETS - 1).alias("bucket")).agg(
            F.sum(F.col("n") + 1).alias("n")
        ).toArrow()  # BUCKETS rows at most
        rare = -np.bincount(bucket(words), weights=count + 1.0, minlength=BUCKETS)
        rare[sums.column("bucket").to_numpy()] += sums.column("n").to_numpy()
        return cls(HashIndex(words), count, n or 0, v, rare)


@dataclass
class Classes:
    """The class of each top token, that of all others last; the mass of each class."""

    kind: np.ndarray
    mass: np.ndarray

    @classmethod
    def of(cls, vocabulary: Vocabulary, encoded: DataFrame) -> Classes:
        count = vocabulary.count
        rank = np.arange(len(count))
        bins = ANCHORS + np.minimum((rank - GROUPED) * BINS // max(1, len(rank) - GROUPED), BINS - 1)
        kind = np.where(rank < ANCHORS, rank, np.where(rank < GROUPED, 0, bins + ANCHORS))
        grouped = slice(ANCHORS, min(GROUPED, len(rank)))
        kind[grouped] = ANCHORS + anchored(encoded)[grouped][: max(0, len(rank) - ANCHORS)]
        kind = np.unique(kind, return_inverse=True)[1]
        rare = int(kind.max()) + 1 if len(kind) else 0
        sums = np.bincount(kind, weights=count + 1.0, minlength=rare + 1)
        sums[rare] = vocabulary.n + vocabulary.v + 1 - sums.sum()
        return cls(np.append(kind, rare), np.maximum(sums, 1.0))


@dataclass
class Events:
    """The class and mass of each top token and then of each bucket; the mass of each class."""

    kind: np.ndarray
    mass: np.ndarray
    whole: np.ndarray

    @classmethod
    def of(cls, vocabulary: Vocabulary, classes: Classes) -> Events:
        rare = np.full(BUCKETS, classes.kind[-1])
        return cls(np.concatenate([classes.kind[:-1], rare]).astype(np.int64),
                   np.concatenate([vocabulary.count + 1.0, vocabulary.rare + 1.0 / BUCKETS]), classes.mass)


def encoded(documents: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Per row its tokens as places among the top tokens, and the other tokens with their numbers.

    Others have the place -1 less their bucket. Places are 32-bit numbers in one
    binary value, which Spark copies as a whole. Rows are numbered, and the blocks
    of consecutive rows whose pairs are sent together.
    """
    index = vocabulary.index

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = block = TaskContext.get().partitionId() << 32
        held = 0
        for batch in batches:
            for part in slices(batch, "text"):
                token, first = tokens(part, "text")
                place = index(token)
                doc = np.repeat(np.arange(part.num_rows), np.diff(first))
                away = np.flatnonzero(place < 0)
                order = np.lexsort((token[away], doc[away]))
                word, owner = token[away][order], doc[away][order]
                new = np.ones(len(word), bool)
                new[1:] = (word[1:] != word[:-1]) | (owner[1:] != owner[:-1])
                cut = np.flatnonzero(new)
                times = np.diff(np.append(cut, len(word))).astype(np.int32)
                offsets = pa.array(np.searchsorted(owner[cut], np.arange(part.num_rows + 1)).astype(np.int32))
                place[away] = -1 - bucket(token[away])
                if held + len(token) > PAIRED and held:
                    block, held = block + 1, 0
                held += len(token)
                row += part.num_rows
                yield pa.RecordBatch.from_pydict({
                    "row": pa.array(np.arange(row - part.num_rows, row)),
                    "block": pa.array(np.full(part.num_rows, block)),
                    "key": part.column("key"), "held_out": part.column("held_out"),
                    "place": pa.BinaryArray.from_buffers(pa.binary(), part.num_rows, [
                        None, pa.py_buffer((first * 4).astype(np.int32)), pa.py_buffer(place.astype("<i4"))]),
                    "rare": pa.ListArray.from_arrays(offsets, pa.array(word[cut].view(np.int64))),
                    "times": pa.ListArray.from_arrays(offsets, pa.array(times)),
                })

    return documents.mapInArrow(
        run, "row bigint, block bigint, key bigint, held_out boolean, place binary, rare array<bigint>, times array<int>")


def _places(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The places of all rows, and where each row begins."""
    column = batch.column("place").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + batch.num_rows + 1] // 4
    return np.frombuffer(data, "<i4")[bounds[0]:bounds[-1]], bounds - bounds[0]


def blocks(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Consecutive rows of at most `BLOCK` tokens or one row: the rows, their places, where each row begins.

    All tokens beyond the top ones have the place -1 here.
    """
    if not batch.num_rows:
        return
    values, bounds = _places(batch)
    values = np.maximum(values, -1)
    lo = 0
    while lo < batch.num_rows:
        hi = int(np.searchsorted(bounds, bounds[lo] + BLOCK, "right")) - 1
        hi = min(max(hi, lo + 1), batch.num_rows)
        yield batch.slice(lo, hi - lo), values[bounds[lo]:bounds[hi]], bounds[lo:hi + 1] - bounds[lo]
        lo = hi


def last_anchor(place: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The number in the slice of the anchor before each token in its row, -1 if there is none."""
    here = np.where((place >= 0) & (place < ANCHORS), np.arange(len(place)), -1)
    last = np.maximum.accumulate(here)
    before = np.concatenate([[-1], last[:-1]])
    return np.where(before >= np.repeat(first[:-1], np.diff(first)), before, -1)


def anchored(encoded: DataFrame) -> np.ndarray:
    """For each of the `GROUPED` most frequent tokens the anchor it goes with."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(GROUPED * (ANCHORS + 1), np.int64)
        for batch in batches:
            for _, place, first in blocks(batch):
                before = last_anchor(place, first)
                anchor = np.where(before >= 0, place[before], ANCHORS)
                some = (place >= 0) & (place < GROUPED)
                seen += np.bincount(place[some] * (ANCHORS + 1) + anchor[some], minlength=len(seen))
        cell = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(cell), "n": pa.array(seen[cell])})

    cells = encoded.select("place").mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    found = cells.toArrow()  # GROUPED * (ANCHORS + 1) rows at most
    seen = np.zeros(GROUPED * (ANCHORS + 1))
    seen[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    seen = seen.reshape(GROUPED, ANCHORS + 1)[:, :ANCHORS]
    return np.argmax(seen / (seen.sum(axis=0) + 1.0), axis=1)


def _row(a: np.ndarray, b: np.ndarray | int, feature: int) -> np.ndarray:
    """The weight row of a feature of the words named `a` and `b`."""
    code = mix((a.astype(np.int64) * 1_000_003 + b).view(_U) + _U(feature << 48))
    return (code >> _U(40)) % _U(ROWS - 1) + _U(1)


def rows_of(place: np.ndarray, kind: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each feature the weight row of each token's history."""
    size = np.diff(first)
    begin = np.repeat(first[:-1], size)
    # A frequent word stands for itself, another one for its class, a text's beginning for -1.
    name = np.where((place >= 0) & (place < NAMED), place, NAMED + kind).astype(np.int64)
    here = np.arange(len(place))

    def named(at: np.ndarray) -> np.ndarray:
        return np.where(at >= begin, name[np.maximum(at, 0)], -1)

    anchor = last_anchor(place, first)
    # The last anchor that differs from the one before the token.
    other = np.where(anchor >= 0, anchor, 0)
    different = np.where(anchor >= 0, anchor[other], -1)
    same = (different >= 0) & (place[np.maximum(different, 0)] == place[other])
    different = np.where(same, anchor[np.maximum(different, 0)], different)
    one, two = named(here - 1), named(here - 2)
    near, far = named(anchor), named(different)
    out = np.zeros((FEATURES, len(place)), np.uint16)  # numpy sorts 16 bits by radix
    for j, (a, b) in enumerate([(one, -2), (two, -3), (near, -4), (far, -5), (one, near)]):
        out[j] = _row(a, b, j)
    return out


def _anchor_rows() -> np.ndarray:
    """The weight rows of either skip feature of an anchor or none."""
    anchor = np.arange(-1, ANCHORS)
    return np.unique(np.concatenate([_row(anchor, -4, 2), _row(anchor, -5, 3)]).astype(np.int64))


def histories(place: np.ndarray, first: np.ndarray, classes: Classes) -> tuple[np.ndarray, np.ndarray]:
    """In order, a number for each different set of weight rows that histories have, and how many have it.

    The rows of the previous word and anchor are the number's leading part.
    """
    one, two, near, far, both = rows_of(place, classes.kind[place], first)[:-1].astype(np.int64)
    names = _anchor_rows()  # they are few, so a number of all rows has less than 63 bits
    near, far = np.searchsorted(names, near), np.searchsorted(names, far)
    code = (((both * ROWS + one) * len(names) + near) * ROWS + two) * len(names) + far
    return np.unique(code, return_counts=True)


def _merged(code: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different codes in order, and the sum of the times of each."""
    order = np.argsort(code, kind="stable")
    code = code[order]
    cut = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    return code[cut], np.add.reduceat(times[order], cut)


def gathered(encoded: DataFrame, classes: Classes) -> DataFrame:
    """(`code`, `times`) of the different histories of all rows.

    Tasks send blocks of codes and times. Histories of one previous word and
    anchor meet in one group, which is bounded as their words before and second
    anchors are few; so groups are even and hold about `GROUP_BYTES` at most.
    """
    tokens = int(classes.mass.sum())  # a little more than there are
    groups = max(2 * encoded.sparkSession.sparkContext.defaultParallelism, tokens * 20 // GROUP_BYTES)
    tail = ROWS * len(_anchor_rows())
    kinds = {"head": np.int64, "tail": np.int32, "times": np.int64}

    def dealt(code: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
        head, rest = np.divmod(code, tail)  # heads repeat, and are packed small by themselves
        part = head // tail * groups // ROWS
        cut = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]])
        columns = {"head": head, "tail": rest, "times": times}
        return pa.RecordBatch.from_pydict({"part": pa.array(part[cut[:-1]].astype(np.int32))} | {
            name: pa.array([columns[name][low:high].astype(kind).tobytes()
                            for low, high in zip(cut[:-1], cut[1:], strict=True)], pa.binary())
            for name, kind in kinds.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, place, first in blocks(batch):
                held.append(histories(place, first, classes))
                size += len(held[-1][0])
                if size > FLUSH:
                    held = [_merged(*map(np.concatenate, zip(*held, strict=True)))]
                    size = len(held[0][0])
                    if size > FLUSH // 2:
                        yield dealt(*held[0])
                        held, size = [], 0
        if held:
            yield dealt(*_merged(*map(np.concatenate, zip(*held, strict=True))))

    def meet(table: pa.Table) -> pa.Table:
        head, rest, times = (
            np.frombuffer(b"".join(table.column(name).to_pylist()), kind) for name, kind in kinds.items())
        code, times = _merged(head * tail + rest, times)
        return pa.table({"code": pa.array(code), "times": pa.array(times)})

    sent = encoded.select("place").mapInArrow(run, "part int, head binary, tail binary, times binary")
    return sent.groupBy("part").applyInArrow(meet, "code bigint, times bigint")


def _logits(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of weight rows; they stay far below the range of exp, being logs of ratios of counts."""
    out = weights.take(rows[0], axis=0)
    more = np.empty_like(out)
    for row in rows[1:-1]:
        weights.take(row, axis=0, out=more, mode="clip")
        out += more
    out += weights[0]
    return out


def observed(sums: np.ndarray, place: np.ndarray, first: np.ndarray, classes: Classes) -> None:
    """Add how often each class follows each weight row."""
    kind = classes.kind[place]
    cell = rows_of(place, kind, first) + kind * np.int64(ROWS)
    sums += np.bincount(cell.ravel(), minlength=sums.size).reshape(sums.shape)


def _add(sums: np.ndarray, row: np.ndarray, values: np.ndarray) -> None:
    """Add the values of each weight row, in whatever order they are."""
    order = np.argsort(row, kind="stable")
    row = row[order]
    cut = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    sums[:, row[cut]] += np.add.reduceat(values.take(order, axis=0), cut, axis=0).T


def expected(sums: np.ndarray, place: np.ndarray, first: np.ndarray, classes: Classes, weights: np.ndarray) -> float:
    """Add how often each class should follow each weight row by these weights; the sum of ln of all tokens' norms."""
    return reckoned(sums, *histories(place, first, classes), weights)


def reckoned(sums: np.ndarray, code: np.ndarray, times: np.ndarray, weights: np.ndarray) -> float:
    """What `expected` adds and returns, of the histories of these codes, which are in order.

    What histories of the same previous word and anchor share is reckoned once for these.
    """
    names = _anchor_rows()
    few = len(names)
    norms = 0.0
    for low in range(0, len(code), WIDE):
        some, n = code[low:low + WIDE], times[low:low + WIDE]
        pair, rest = np.divmod(some, ROWS * few)
        two, far = np.divmod(rest, few)
        cut = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        ahead, near = np.divmod(pair[cut], few)
        both, one = np.divmod(ahead, ROWS)
        near, far = names[near], names[far]
        shared = weights[both] + weights[one] + weights[near] + weights[0]
        part = np.repeat(shared, np.diff(np.append(cut, len(some))), axis=0)
        part += weights.take(two, axis=0)
        part += weights.take(far, axis=0)
        np.exp(part, out=part)
        norm = part.sum(axis=1, dtype=np.float64)
        norms += float((n * np.log(norm)).sum())
        chance = part * (n / norm)[:, None]
        together = np.add.reduceat(chance, cut, axis=0)
        sums[:, 0] += together.sum(axis=0)
        for row, values in ((both, together), (one, together), (near, together), (two, chance), (far, chance)):
            _add(sums, row, values)
    return norms


def added(
    rows: DataFrame, width: int, add: Callable[[np.ndarray, pa.RecordBatch], float]
) -> tuple[np.ndarray, float]:
    """The table of classes by weight rows to which `add` adds every batch, and what it returns, summed over all tasks."""
    names = [f"w{i}" for i in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, total = np.zeros((width, ROWS + 1)), 0.0  # the last row holds the total
        for batch in batches:
            total += add(sums[:, :ROWS], batch)
        sums[0, ROWS] = total
        used = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_pydict(
            {"row": pa.array(used.astype(np.int32))} | {n: pa.array(sums[i, used]) for i, n in enumerate(names)})

    schema = "row int, " + ", ".join(f"{n} double" for n in names)
    # Every task sends a whole table, in each round: so there are no more tasks than keep all cores busy.
    tasks = 2 * rows.sparkSession.sparkContext.defaultParallelism
    found = rows.coalesce(tasks).mapInArrow(run, schema).groupBy("row").agg(
        *[F.sum(n).alias(n) for n in names]
    ).toArrow()  # ROWS + 1 rows at most
    out = np.zeros((width, ROWS + 1))
    for name, into in zip(names, out):
        into[found.column("row").to_numpy()] = found.column(name).to_numpy()
    return out[:, :ROWS].T, float(out[0, ROWS])


def start(seen: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """Weights from counts alone."""
    share = mass / mass.sum()
    weights = START * np.log((seen + PRIOR * share) / ((seen.sum(axis=1, keepdims=True) + PRIOR) * share))
    weights[0] = np.log(share)
    return weights.astype(np.float32, order="C")


def step(weights: np.ndarray, seen: np.ndarray, guess: np.ndarray, rate: float = RATE) -> np.ndarray:
    """Weights after one step along the gradient, observed less expected counts less the pull of the penalty."""
    slope = seen - guess
    slope[1:] -= PENALTY * weights[1:]
    return (weights + rate * slope / (np.maximum(seen, guess) + PRIOR)).astype(np.float32, order="C")


def fitness(weights: np.ndarray, seen: np.ndarray, norms: float) -> float:
    """The mean ln of a training token's chance, less the penalty.

    A token's is the sum of its class's weights less ln of its norm; the weights add up over `seen`.
    """
    squares = np.square(weights[1:], dtype=np.float64).sum()
    return float((seen * weights).sum() - norms - PENALTY / 2 * squares) / max(seen[0].sum(), 1.0)


def train(encoded: DataFrame, classes: Classes) -> np.ndarray:
    """The weight matrix, trained on the histories of every document in every round until a round gains less than `LEAST`.

    A round that loses is undone and its step halved, so that the rounds end.
    """
    width = len(classes.mass)

    def see(sums: np.ndarray, batch: pa.RecordBatch) -> float:
        for _, place, first in blocks(batch):
            observed(sums, place, first, classes)
        return 0.0

    def reckon(sums: np.ndarray, batch: pa.RecordBatch) -> float:
        return reckoned(sums, batch.column("code").to_numpy(), batch.column("times").to_numpy(), weights)

    seen, _ = added(encoded.select("place"), width, see)
    met = stored(gathered(encoded, classes), "op4-histories")
    weights, rate = start(seen, classes.mass), RATE
    fit = kept = away = None
    while True:
        guess, norms = added(met, width, reckon)
        now = fitness(weights, seen, norms)
        if fit is not None and not now >= fit:
            rate /= 2
        elif fit is not None and now - fit < LEAST:
            return weights
        else:
            fit, kept, away = now, weights, guess
        weights = step(kept, seen, away, rate)


def gains(place: np.ndarray, first: np.ndarray, classes: Classes, weights: np.ndarray) -> np.ndarray:
    """For each token ln of its class's probability over the share of the class; `word_gains` has the word's."""
    kind = classes.kind[place]
    share = np.log(classes.mass / classes.mass.sum())
    rows = rows_of(place, kind, first)
    out = np.empty(len(place))
    for low in range(0, len(place), BATCH):
        some = slice(low, low + BATCH)
        logits = _logits(weights, rows[:, some])
        own = logits[np.arange(len(logits)), kind[some]]
        np.exp(logits, out=logits)
        out[some] = own - np.log(logits.sum(axis=1)) - share[kind[some]]
    return out


def pairs(place: np.ndarray, first: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """A number for each token and the one before it.

    The class of the token and the word before it are the number's leading part,
    in a mixed order, and the token's event the other.
    """
    event = np.where(place >= 0, place, len(kind) - BUCKETS - 1 - place).astype(np.int64)
    before = np.empty_like(event)
    before[1:] = event[:-1]
    before[first[:-1]] = len(kind)  # a text's beginning
    head = (before << KIND_BITS | kind[event]) * 0x9E3779B1 & ((1 << HEAD_BITS) - 1)
    return head << EVENT_BITS | event


def contexts(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each class and word before begins among pairs in order, and the number of that of each pair."""
    head = code >> EVENT_BITS
    new = np.concatenate([[True], head[1:] != head[:-1]])
    return np.flatnonzero(new), np.cumsum(new) - 1


def solved(code: np.ndarray, n: np.ndarray, events: Events) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which pairs have a weight; of each class and word before its occurrences, and its rate.

    The rate is the chance of a mass of 1 without a weight, times the occurrences. All
    pairs of a class and word before are here, in order, and `n` is how often each
    occurs in training documents. A pair has a weight if it occurs oftener, less the
    discount, than the rate gives its mass; rates fall as pairs join, until none does.
    """
    event = code & ((1 << EVENT_BITS) - 1)
    cut, which = contexts(code)
    mass, whole = events.mass[event], events.whole[events.kind[event[cut]]]
    worth = np.maximum(n - DISCOUNT, 0.0)
    total = np.add.reduceat(n, cut)
    rate, raised = total / whole, np.zeros(len(code), bool)
    while True:
        more = (worth > rate[which] * mass) & ~raised
        if not more.any():
            return raised, total, rate
        raised |= more
        rate = (total - np.add.reduceat(worth * raised, cut)) / (whole - np.add.reduceat(mass * raised, cut))


def word_gains(
    code: np.ndarray, n: np.ndarray, raised: np.ndarray, total: np.ndarray, rate: np.ndarray, events: Events
) -> np.ndarray:
    """For each pair, in order, ln of the word's probability in its class over its share of the class."""
    event = code & ((1 << EVENT_BITS) - 1)
    cut, which = contexts(code)
    whole = events.whole[events.kind[event[cut]]]
    seen = total > 0  # else nothing is known but the share
    share = np.log(whole / np.where(seen, total, whole))
    usual = np.log(np.where(seen, rate, 1.0)) + share
    gain = usual[which]
    gain[raised] = np.log((n[raised] - DISCOUNT) / events.mass[event[raised]]) + share[which[raised]]
    return gain


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of numbers by their bytes, as of small numbers the upper ones are 0."""
    planes = b"".join(
        np.ascontiguousarray(c.view(np.uint8).reshape(-1, c.itemsize).T).tobytes() for c in columns)
    return np.array([c.nbytes for c in columns], "<u4").tobytes() + pa.compress(planes, "zstd", asbytes=True)


def _unpacked(data: bytes, *kinds: str) -> list[np.ndarray]:
    size = np.frombuffer(data, "<u4", len(kinds)).astype(int)
    planes = np.frombuffer(pa.decompress(data[4 * len(kinds):], int(size.sum()), "zstd"), np.uint8)
    cuts = np.concatenate([[0], np.cumsum(size)])
    return [np.ascontiguousarray(planes[low:high].reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()
            for kind, low, high in zip(kinds, cuts[:-1], cuts[1:], strict=True)]


def _pack_pairs(code: np.ndarray, n: np.ndarray) -> bytes:
    cut, _ = contexts(code)
    return _packed(*(c.astype("<u4") for c in (
        np.diff(code[cut] >> EVENT_BITS, prepend=0), np.diff(np.append(cut, len(code))),
        code & ((1 << EVENT_BITS) - 1), n)))


def _unpack_pairs(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    head, times, event, n = _unpacked(data, "<u4", "<u4", "<u4", "<u4")
    return np.repeat(np.cumsum(head.astype(np.int64)), times) << EVENT_BITS | event, n


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """The consecutive rows of a block: its number and that of the first row, held out or not, places, where each begins."""
    def whole(held):
        rows, out, place, size = zip(*held, strict=True)
        return block, int(rows[0]), np.concatenate(out), np.concatenate(place), np.concatenate(
            [[0], np.cumsum(np.concatenate(size))])

    held, block = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        place, first = _places(batch)
        of, row = batch.column("block").to_numpy(), batch.column("row").to_numpy()
        out = batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        cut = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (row[1:] != row[:-1] + 1), [True]]))
        for low, high in zip(cut[:-1], cut[1:], strict=True):
            if held and (of[low] != block or row[low] != after):
                yield whole(held)
                held = []
            block, after = int(of[low]), row[high - 1] + 1
            held.append((row[low], out[low:high], place[first[low]:first[high]], np.diff(first[low:high + 1])))
    if held:
        yield whole(held)


def _given(run: Callable[..., pa.Table], *groups: pa.Table) -> pa.Table:
    """What `run` makes of the groups; the memory it has freed is given back."""
    try:
        return run(*groups)
    finally:
        give_back()


def _worded(encoded: DataFrame, vocabulary: Vocabulary, classes: Classes) -> DataFrame:
    """(`row`, `word_gain`): the sum of `word_gains` over each row's tokens, in log10."""
    events = Events.of(vocabulary, classes)
    kind = events.kind
    groups = max(2 * encoded.sparkSession.sparkContext.defaultParallelism, vocabulary.n * 20 // GROUP_BYTES)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, row, out, place, first in runs(batches):
            code = np.sort(pairs(place, first, kind) << 1 | np.repeat(out, np.diff(first)))
            held, code = code & 1, code >> 1
            cut = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            n, code = np.add.reduceat(1 - held, cut), code[cut]
            part = (code >> EVENT_BITS) * groups >> HEAD_BITS
            cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
            size = len(cut) - 1
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(part[cut[:-1]].astype(np.int32)),
                "block": pa.array(np.full(size, block)), "row": pa.array(np.full(size, row)),
                "pairs": pa.array([_pack_pairs(code[low:high], n[low:high])
                                   for low, high in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
            })

    def answer(asked: pa.Table) -> pa.Table:
        codes, times = zip(*map(_unpack_pairs, asked.column("pairs").to_pylist()), strict=True)
        ends = np.cumsum([len(c) for c in codes])[:-1]
        code, n = np.concatenate(codes), np.concatenate(times)
        order = np.argsort(code, kind="stable")
        code = code[order]
        new = np.concatenate([[True], code[1:] != code[:-1]])
        cut = np.flatnonzero(new)
        code, n = code[cut], np.add.reduceat(n[order].astype(np.int64), cut)
        raised, total, rate = solved(code, n, events)
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        both, (_, context) = (n << 1 | raised).astype("<u8"), contexts(code)
        back = []
        for here, its in zip(codes, np.split(which, ends), strict=True):
            some = context[its[contexts(here)[0]]]
            back.append(_packed(both[its], total[some].astype("<u8"), rate[some].astype("<f4")))
        return asked.drop_columns(["pairs"]).append_column("solved", pa.array(back, pa.binary()))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, row, _, place, first in runs(batches):
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([block]), "row": pa.array([row]),
                "places": pa.array([_packed(np.diff(first).astype("<u4"), place.astype("<i4"))], pa.binary())})

    def meet(sent: pa.Table, answered: pa.Table) -> pa.Table:
        sent, answered = sent.sort_by("row"), answered.sort_by([("row", "ascending"), ("part", "ascending")])
        sizes, places = zip(*(_unpacked(p, "<u4", "<i4") for p in sent.column("places").to_pylist()), strict=True)
        row = sent.column("row")[0].as_py()  # a block's rows have numbers without a gap
        place, first = np.concatenate(places), np.concatenate([[0], np.cumsum(np.concatenate(sizes), dtype=np.int64)])
        begin = answered.column("row").to_numpy() - row
        found = [_unpacked(s, "<u8", "<u8", "<f4") for s in answered.column("solved").to_pylist()]
        cut = np.flatnonzero(np.concatenate([[True], begin[1:] != begin[:-1], [True]]))
        ends = np.append(begin[cut[1:-1]], len(first) - 1)
        sums = []
        for part, low, high in zip(zip(cut[:-1], cut[1:], strict=True), begin[cut[:-1]], ends, strict=True):
            here = first[low:high + 1] - first[low]
            code = pairs(place[first[low]:first[high]], here, kind)
            order = np.argsort(code)
            code = code[order]
            new = np.concatenate([[True], code[1:] != code[:-1]])
            code = code[new]
            both, total, rate = (np.concatenate(c) for c in zip(*found[slice(*part)], strict=True))
            n, raised = (both >> _U(1)).astype(np.int64), (both & _U(1)).astype(bool)
            gain = np.empty(len(order))
            gain[order] = word_gains(code, n, raised, total, rate, events)[np.cumsum(new) - 1]
            sums.append(np.add.reduceat(gain, here[:-1]))
        return pa.table({"row": pa.array(np.arange(row, row + len(first) - 1)),
                         "word_gain": pa.array(np.concatenate(sums) / np.log(10.0))})

    asked = encoded.select("row", "block", "held_out", "place").mapInArrow(
        tidy(ask), "part int, block bigint, row bigint, pairs binary")
    answered = asked.groupBy("part").applyInArrow(
        lambda asked: _given(answer, asked), "part int, block bigint, row bigint, solved binary")
    sent = encoded.select("row", "block", "held_out", "place").mapInArrow(
        tidy(send), "block bigint, row bigint, places binary")
    return sent.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(
        lambda sent, answered: _given(meet, sent, answered), "row bigint, word_gain double")


def _scored(encoded: DataFrame, vocabulary: Vocabulary, classes: Classes, weights: np.ndarray) -> DataFrame:
    """Per row: tokens, sums over the top tokens, the gain of classes in log10, and the rarer tokens."""
    logs = np.append(np.log10(vocabulary.count + 1.0), 0.0)
    kinds = ("row bigint, key bigint, held_out boolean, n_tokens bigint, top_known bigint, top_log double, gain double, "
             "rare array<bigint>, times array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, place, first in blocks(batch):
                gain = gains(place, first, classes, weights)
                at = first[:-1]  # no row is without its end
                yield pa.RecordBatch.from_pydict({
                    "row": part.column("row"), "key": part.column("key"), "held_out": part.column("held_out"),
                    "n_tokens": pa.array(np.diff(first).astype(np.int64)),
                    "top_known": pa.array(np.add.reduceat((place >= 0).astype(np.int64), at)),
                    "top_log": pa.array(np.add.reduceat(logs[place], at)),
                    "gain": pa.array(np.add.reduceat(gain, at) / np.log(10.0)),
                    "rare": part.column("rare"), "times": part.column("times"),
                })

    return encoded.mapInArrow(run, kinds)


def score(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row `key`, `held_out`, `n_tokens`, `n_known`, `train_tokens`, `base_score` and `score` (log10)."""
    rows = documents.select(
        F.col(key).cast("long").alias("key"), F.col(text).alias("text"), held_out(key).alias("held_out")
    )
    table = stored(counts(rows.filter("not held_out")), "op4-counts")
    vocabulary = Vocabulary.of(table)
    places = stored(encoded(rows, vocabulary), "op4-places")
    training = places.filter("not held_out")
    classes = Classes.of(vocabulary, training)
    weights = train(training, classes)
    words = _worded(places, vocabulary, classes)
    scored = stored(_scored(places, vocabulary, classes, weights), "op4-scored")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("p")).select(
        "row", F.col("p.rare").alias("word"), F.col("p.times").alias("times")
    )
    least = int(vocabulary.count.min()) if len(vocabulary.count) else 0
    known = rare.join(table.filter(F.col("n") <= least), "word")
    sums = known.groupBy("row").agg(
        F.sum("times").alias("rare_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rare_log")
    )
    n, v = F.lit(vocabulary.n).cast("long"), F.lit(vocabulary.v)
    base = (
        F.col("top_log") + F.coalesce("rare_log", F.lit(0.0))
        - F.col("n_tokens") * F.log10(n.cast("double") + v + 1)
    )
    return scored.join(sums, "row", "left").join(words, "row").select(
        "key", "held_out", "n_tokens",
        (F.col("top_known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        n.alias("train_tokens"), base.alias("base_score"), (base + F.col("gain") + F.col("word_gain")).alias("score"),
    )
