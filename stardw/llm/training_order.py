"""Token sequences in training order: fixed-stride shards in a keyed random order.

1. `blocks` encodes whole texts, an end id behind each, and stores the ids of
   each slice of texts as one compressed block.
2. The running sum of the blocks' lengths gives each id a place in one long
   stream, which is cut into sequences of `LENGTH` ids; only the last sequence
   is padded, with the end id.
3. A keyed Feistel network permutes the numbers of the sequences. Its domain is
   the next power of 4; numbers that leave the range walk on along their cycle
   until they are back inside. So each sequence has a slot of its own and no
   permutation is stored.
4. Slots are cut into ranges, one shard each. Tasks collect the pieces of a
   range, write it with one fixed stride, and move the file into place, so that
   a task that runs again writes the same file. Sequence `slot` begins at byte
   (slot % `SHARD`) * stride of shard slot // `SHARD`: reading can be resumed
   at any slot with a single seek.

A null or empty text is its end id only. Documents follow each other in the
order of the input files; the same files in the same splits give the same
shards. Rows with one id are documents of their own. An empty table writes no
shard. Memory is bounded by a slice of texts, or by one shard.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stardw.llm.tables import running_sum, stored
from stardw.llm.words import Spans, as_bytes, mix, slices

RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# How the vocabulary's texts are split before merging; a fixed value that belongs to it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LENGTH = 1024
SHARD = 1 << 14
SEED = 17
ROUNDS = 6
LEVEL = 3
CACHE = 1 << 20

_U = np.uint64
PIECE = np.dtype([("doc", "<i8"), ("null", "<i4"), ("at", "<i4"), ("slot", "<i8"), ("n", "<i4")])
# Last bytes of white space beyond ASCII, and first bytes of it.
_UNSAFE_BEFORE = np.zeros(256, bool)
_UNSAFE_BEFORE[[*range(0x21), 0x85, *range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True
_UNSAFE_AFTER = np.zeros(256, bool)
_UNSAFE_AFTER[[*range(0x21), 0xC2, 0xE1, 0xE2, 0xE3]] = True


def permuted(numbers: np.ndarray, size: int, seed: int = SEED) -> np.ndarray:
    """The slot of each number below `size`: a keyed bijection of range(size)."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask, shift = _U((1 << half) - 1), _U(half)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=_U) + _U(seed * 0x9E3779B97F4A7C15 % 2**64))
    out = numbers.astype(_U)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> shift, out[todo] & mask
        for key in keys:
            left, right = right, left ^ (mix(right + key) & mask)
        out[todo] = (left << shift) | right
        todo = todo[out[todo] >= _U(size)]
    return out.astype(np.int64)


def ranks_of(path: str = RANKS) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


class Encoder:
    """Ids of texts; a stretch of text that was met before is not merged again.

    Texts are cut before a single space between two characters that are no
    white space: there the pattern splits as well, so that the parts' ids are
    the text's ids.
    """

    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken

        self.plain = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.end = max(ranks.values()) + 1
        self.size = np.zeros(self.end + 1, np.int64)
        self.size[list(ranks.values())] = [len(k) for k in ranks]
        self.kind = np.uint16 if self.end < 1 << 16 else np.uint32
        self.reset()

    def reset(self) -> None:
        self.keys, self.first = np.zeros(0, _U), np.zeros(0, np.int64)
        self.count, self.ids = np.zeros(0, np.int64), np.zeros(0, self.kind)

    def _known(self, keys: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Where each of the sorted distinct `keys` stands in the table, after adding new ones."""
        if len(self.keys) > CACHE:
            self.reset()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        new = np.flatnonzero(~known)
        count, ids = self._encode(data, start[new], end[new])
        base = len(self.ids)
        self.ids = np.concatenate([self.ids, ids])
        self.first = np.insert(self.first, at[new], base + np.cumsum(count) - count)
        self.count = np.insert(self.count, at[new], count)
        self.keys = np.insert(self.keys, at[new], keys[new])
        return np.searchsorted(self.keys, keys)

    def _encode(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each part, and all their ids.

        Parts that begin with a space and end with another character are
        encoded as one text, which the pattern splits between them again.
        """
        if not len(start):
            return np.zeros(0, np.int64), np.zeros(0, self.kind)
        last = data[end - 1]
        chain = (data[start] == 0x20) & (end - start > 1) & ~_UNSAFE_BEFORE[last]
        chain[chain] = ~_UNSAFE_AFTER[data[start[chain] + 1]]
        raw = data.tobytes()

        def ids_of(text: bytes) -> np.ndarray:
            return np.array(self.plain.encode_ordinary(text.decode("utf-8", "replace")), self.kind)

        joined = [raw[s:e] for s, e in zip(start[chain].tolist(), end[chain].tolist(), strict=True)]
        ids = ids_of(b"".join(joined))
        upto = np.searchsorted(np.cumsum(self.size[ids]), np.cumsum([len(x) for x in joined]), "right")
        count = np.zeros(len(start), np.int64)
        count[chain] = np.diff(np.concatenate([[0], upto]))
        rest = [ids_of(raw[s:e]) for s, e in zip(start[~chain].tolist(), end[~chain].tolist(), strict=True)]
        count[~chain] = [len(x) for x in rest]
        both = np.concatenate([ids, *rest])
        # Back into the order of the parts.
        source = np.zeros(len(start), np.int64)
        source[chain] = np.cumsum(count[chain]) - count[chain]
        source[~chain] = len(ids) + np.cumsum(count[~chain]) - count[~chain]
        at = np.cumsum(count) - count
        return count, both[np.repeat(source - at, count) + np.arange(count.sum())]

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, an end id behind each, and the number of ids of each."""
        data, bounds = as_bytes(column)
        n = len(data)
        cut = np.zeros(n + 1, bool)
        if n > 2:
            cut[1:n - 1] = (data[1:-1] == 0x20) & ~_UNSAFE_BEFORE[data[:-2]] & ~_UNSAFE_AFTER[data[2:]]
        cut[bounds] = True
        start = np.flatnonzero(cut[:n])
        end = np.append(start[1:], n) if len(start) else start
        keys, first, kind = np.unique(Spans(data)(start, end), return_index=True, return_inverse=True)
        place = self._known(keys, data, start[first], end[first])[kind]
        # The end of a text is one more part, behind the parts of its row.
        row_end = np.searchsorted(start, bounds[1:])
        count = np.insert(self.count[place], row_end, 1)
        source = np.insert(self.first[place], row_end, -1)
        at = np.cumsum(count) - count
        pick = np.repeat(source - at, count) + np.arange(count.sum())
        ends = at[source < 0]
        out = np.empty(len(pick), self.kind)
        body = np.ones(len(pick), bool)
        body[ends] = False
        out[body] = self.ids[pick[body]]
        out[ends] = self.end
        return out, np.diff(np.concatenate([[-1], ends]))


def blocks(documents: DataFrame, ranks: dict[bytes, int], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored blocks of ids: `part`, `number`, `docs`, `counts`, `total`, `data`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number = Encoder(ranks), TaskContext.get().partitionId(), 0
        pack = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            for rows in slices(batch, "text"):
                ids, counts = encoder(rows.column("text"))
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part], pa.int64()), "number": pa.array([number], pa.int64()),
                    "docs": pa.array([rows.column("key").to_pylist()], pa.list_(pa.int64())),
                    "counts": pa.array([counts.tolist()], pa.list_(pa.int64())),
                    "total": pa.array([len(ids)], pa.int64()),
                    "data": pa.array([pack.compress(ids.tobytes())], pa.binary()),
                })
                number += 1

    rows = documents.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    kind = "part bigint, number bigint, docs array<bigint>, counts array<bigint>, total bigint, data binary"
    return stored(rows.mapInArrow(run, kind), "op3-blocks")


def _pieces(placed: DataFrame, size: int, seed: int, kind: type) -> DataFrame:
    """Blocks cut into the parts of each shard: `shard`, `data` (pieces and their ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, unpack = zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor()
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(unpack.decompress(row["data"]), kind)
                ends = row["begin"] + np.cumsum(row["counts"])
                starts = np.concatenate([[row["begin"]], ends[:-1]])
                breaks = np.arange((row["begin"] // LENGTH + 1) * LENGTH, row["begin"] + len(ids), LENGTH)
                cut = np.unique(np.concatenate([starts, breaks]))
                upto = np.append(cut[1:], row["begin"] + len(ids))
                doc = np.searchsorted(starts, cut, "right") - 1
                piece = np.empty(len(cut), PIECE)
                names = np.array([0 if d is None else d for d in row["docs"]], np.int64)
                piece["doc"] = names[doc]
                piece["null"] = np.array([d is None for d in row["docs"]])[doc]
                piece["at"], piece["n"] = cut % LENGTH, upto - cut
                piece["slot"] = permuted(cut // LENGTH, size, seed)
                order = np.argsort(piece["slot"], kind="stable")
                piece, begin = piece[order], (cut - row["begin"])[order]
                shard = piece["slot"] // SHARD
                edges = np.concatenate([[0], np.flatnonzero(shard[1:] != shard[:-1]) + 1, [len(shard)]])
                out, data = [], []
                for low, high in zip(edges[:-1], edges[1:], strict=True):
                    some = piece[low:high]
                    n = some["n"].astype(np.int64)
                    at = np.repeat(begin[low:high] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    head = len(some).to_bytes(8, "little")
                    out.append(int(shard[low]))
                    data.append(pack.compress(head + some.tobytes() + ids[at].tobytes()))
                yield pa.RecordBatch.from_pydict({"shard": pa.array(out, pa.int64()), "data": pa.array(data, pa.binary())})

    return placed.select("begin", "docs", "counts", "data").mapInArrow(run, "shard bigint, data binary")


def _digests(ids: np.ndarray, n: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ids of each piece and of their places in the sequence."""
    turn = (np.arange(len(ids)) % LENGTH).astype(_U) * _U(0x9E3779B97F4A7C15)
    sums = np.zeros(len(ids) + 1, _U)
    np.cumsum(mix(ids.astype(_U) + turn), out=sums[1:])
    return mix(sums[begin + n] - sums[begin])


def write(
    documents: DataFrame, folder: str, key: str = "doc_id", text: str = "text",
    ranks: str = RANKS, seed: int = SEED,
) -> DataFrame:
    """Write the shards of `documents` to `folder` and return where every piece of a document went.

    Columns: `key`, `slot`, `shard`, `offset` (bytes into the shard), `n_tokens`,
    `digest` (of the piece's ids, as read back from the written shard).
    """
    table = ranks_of(ranks)
    end = max(table.values()) + 1
    kind = np.uint16 if end < 1 << 16 else np.uint32
    held = blocks(documents, table, key, text)
    total = held.agg(F.sum("total")).first()[0] or 0
    size = -(-total // LENGTH)
    spread = held.select("part", "number", "total").withColumn("all", F.lit(0))
    begins = running_sum(spread, "all", "part", ["number"], "total", "begin").select("part", "number", "begin")
    placed = held.join(stored(begins, "op3-begins"), ["part", "number"])
    schema = "key bigint, slot bigint, shard bigint, offset bigint, n_tokens int, digest bigint"

    def shard(group: pa.Table) -> pa.Table:
        number = group.column("shard")[0].as_py()
        rows = min(SHARD, size - number * SHARD)
        body = np.full(rows * LENGTH, end, kind)
        pieces = []
        unpack = zstandard.ZstdDecompressor()
        for data in group.column("data"):
            raw = unpack.decompress(data.as_py())
            n = int.from_bytes(raw[:8], "little")
            piece = np.frombuffer(raw, PIECE, n, 8)
            ids = np.frombuffer(raw, kind, -1, 8 + n * PIECE.itemsize)
            begin = (piece["slot"] - number * SHARD) * LENGTH + piece["at"]
            count = piece["n"].astype(np.int64)
            body[np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())] = ids
            pieces.append(piece)
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        final = f"{base}/shard-{number:08d}.bin"
        aside = f"{base}/_{number}-{TaskContext.get().taskAttemptId()}"
        with fs.open_output_stream(aside, compression=None) as out:
            out.write(body)
        fs.move(aside, final)
        with fs.open_input_stream(final, compression=None) as back:
            body = np.frombuffer(back.read(), kind)
        piece = np.concatenate(pieces)
        piece = piece[np.lexsort((piece["at"], piece["slot"]))]
        begin = (piece["slot"] - number * SHARD) * LENGTH + piece["at"]
        digest = np.concatenate([
            _digests(body[low:low + (LENGTH << 9)], piece["n"][a:b], begin[a:b] - low)
            for low in range(0, len(body), LENGTH << 9)
            for a, b in [np.searchsorted(begin, (low, low + (LENGTH << 9)))]
        ])
        return pa.table({
            "key": pa.array(piece["doc"], mask=piece["null"].astype(bool)), "slot": pa.array(piece["slot"]),
            "shard": pa.array(np.full(len(piece), number)), "offset": pa.array(begin * np.dtype(kind).itemsize),
            "n_tokens": pa.array(piece["n"]), "digest": pa.array(digest.view(np.int64)),
        })

    return _pieces(placed, size, seed, kind).groupBy("shard").applyInArrow(shard, schema)


def read(folder: str, shard: int, first: int = 0, length: int = LENGTH, kind: type = np.uint16) -> Iterator[np.ndarray]:
    """The sequences of one shard in training order, from its sequence `first` on."""
    fs, base = pafs.FileSystem.from_uri(folder)
    with fs.open_input_file(f"{base}/shard-{shard:08d}.bin") as file:
        stride = length * np.dtype(kind).itemsize
        file.seek(first * stride)
        while data := file.read(stride):
            yield np.frombuffer(data, kind)
