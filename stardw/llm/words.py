"""Words, shingles and lines of whole texts as numpy arrays.

A word is a run of bytes other than space and 0x09-0x0D; these bytes never
occur inside a longer UTF-8 sequence, so words of bytes are words of text.
Words, shingles and lines are told apart by 64-bit hashes of all their bytes.
Everything works on slices of a batch of at most `SLICE` bytes (a longer text
is a slice of its own), which bounds the memory of a task.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 21
STEP = 1 << 16
SHINGLE = 5

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_CODE = mix(np.arange(1, 257, dtype=_U)) | _U(1)
_PLACE = mix(np.arange(101, 101 + 64, dtype=_U)) | _U(1)


def _power(kind: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        have = np.full((n // STEP + 1) * STEP, base, _U)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n > 4 * SLICE:
            return have
        _powers[kind] = have
    return have[:n]


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after the other, and where each begins; null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0]:bounds[-1]], bounds - bounds[0]


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of the batch with at most `limit` bytes of text together."""
    if not batch.num_rows:
        return
    _, bounds = as_bytes(batch.column(text))
    lo = 0
    while lo < batch.num_rows:
        hi = int(np.searchsorted(bounds, bounds[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), batch.num_rows)
        yield batch.slice(lo, hi - lo)
        lo = hi


def give_back() -> None:
    """Return to the system what numpy and Arrow have freed; a system without such a call keeps its ways."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """`run`, which makes batches from batches, giving memory back at the end of a task.

    Spark keeps a worker of Python for later tasks; what it has freed but not given
    back counts for the executor also while the JVM works alone.
    """
    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def run_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of values[bounds[i]:bounds[i+1]] for each i, empty runs being 0."""
    total = np.zeros(len(values) + 1, values.dtype if values.dtype.kind in "uf" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def first_of_each(keys: np.ndarray) -> np.ndarray:
    """True at one place of each distinct key."""
    order = np.argsort(keys)
    ranked = keys[order]
    keep = np.ones(len(keys), bool)
    keep[order[1:][ranked[1:] == ranked[:-1]]] = False
    return keep


class Spans:
    """Hashes of any spans of `data`: the same bytes have the same hash wherever they stand."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, _U)
        np.cumsum(_CODE[data] * _power("up", _BASE, len(data)), out=self.sums[1:])
        self.down = _power("down", _INVERSE, len(data) + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


class Words:
    """The words of a column of texts.

    `start`, `end`: bytes of each word; `doc`: row of each word; `first`: for
    each row the number of its first word, and the number of words at the end;
    `hash`: 64 bits of each word; `spans`: hashes of other spans of `data`.
    """

    def __init__(self, column: pa.Array, lower: bool = False):
        self.data, self.bounds = as_bytes(column)
        self.rows = len(self.bounds) - 1
        if lower:
            self.data = _LOWER[self.data]
        solid = ~_SPACE[self.data]
        n = len(solid)
        starts, ends = solid.copy(), solid.copy()
        starts[1:] &= ~solid[:-1]
        ends[:-1] &= ~solid[1:]
        inner = self.bounds[1:-1]
        at = inner[inner < n]
        starts[at] |= solid[at]
        last = inner[inner > 0] - 1
        ends[last] |= solid[last]
        self.start, self.end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, self.bounds)
        self.doc = np.repeat(np.arange(self.rows), np.diff(self.first))
        self.spans = Spans(self.data)
        self.hash = self.spans(self.start, self.end)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers at which k words of one row begin, and the hashes of those k words."""
        w = len(self.hash)
        if w < k:
            return np.zeros(0, np.int64), np.zeros(0, _U)
        total = np.zeros(w - k + 1, _U)
        for j in range(k):
            total += self.hash[j:w - k + 1 + j] * _PLACE[j]
        inside = np.flatnonzero(self.doc[:w - k + 1] == self.doc[k - 1:])
        return inside, mix(total[inside])

    def shingles(self, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
        """Row and hash of every distinct shingle, sorted by row.

        A row with 1 to k-1 words has one shingle, all its words.
        """
        at, value = self.windows(k)
        row = self.doc[at]
        n = self.counts()
        short = np.flatnonzero((n > 0) & (n < k))
        if len(short):
            total = np.zeros(len(short), _U)
            for j in range(k - 1):
                some = n[short] > j
                total[some] += self.hash[self.first[short[some]] + j] * _PLACE[j]
            total += n[short].astype(_U) * _PLACE[k]
            row, value = np.concatenate([row, short]), np.concatenate([value, mix(total)])
        keep = first_of_each(value ^ mix(row.astype(_U)))
        if len(short):
            order = np.argsort(row[keep], kind="stable")
            return row[keep][order], value[keep][order]
        return row[keep], value[keep]


class HashIndex:
    """The place of a 64-bit hash in a list of distinct hashes, -1 for others.

    Each level is a table in which a hash stands at a place given by its own
    bits; hashes that lose their place to another go on to the next level.
    """

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, number = hashes, np.arange(len(hashes), dtype=np.int32)
        while len(left):
            size = 1 << max(8, len(left).bit_length() + 2)
            at = self._place(left, len(self.levels), size)
            keys, values = np.zeros(size, _U), np.full(size, -1, np.int32)
            keys[at], values[at] = left, number
            self.levels.append((keys, values))
            lost = values[at] != number
            left, number = left[lost], number[lost]
            if len(self.levels) > 60:
                raise ValueError("hashes of an index must be distinct")

    def __reduce__(self):
        return HashIndex, (self.hashes,)  # tables are made anew where the index is used

    @staticmethod
    def _place(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
        spread = hashes if not level else mix(hashes + _U(level))
        return (spread & _U(size - 1)).view(np.int64)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        found, left = np.full(len(hashes), -1, np.int32), None
        for level, (keys, values) in enumerate(self.levels):
            some = hashes if left is None else hashes[left]
            at = self._place(some, level, len(keys))
            value, hit = values[at], keys[at] == some
            hit &= value >= 0
            if left is None:
                found[hit] = value[hit]
                left = np.flatnonzero(~hit & (value >= 0))
            else:
                found[left[hit]] = value[hit]
                left = left[~hit & (value >= 0)]
        return found
