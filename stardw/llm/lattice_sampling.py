"""Distinct sampled segmentations of texts into the pieces of a SentencePiece model, and back.

A text is a chain of chunks: a space with the word behind it, a word that
follows other white space, or one white space byte; a space is put before every
text. Pieces are looked up inside chunks. The lattice of a chunk has an edge
for each piece at each place, and an edge of byte pieces for a character
without a piece. A piece has probability proportional to (rank + 2)^-sharpness,
where the rank is its place in the model; backward sums turn this into the
exact probability of every edge given where it starts.

Segmentations are drawn without replacement by Gumbel top-k. The search keeps,
for each text, perturbed values of sets of segmentations that share a prefix,
takes the greatest and completes it: along the completed path the value stays,
and the other edges of each node get one truncated Gumbel draw together, which
joins the queue. Because the exact probability of what follows is part of each
value, the search is an A* search that expands only what it returns. The values
come out in falling order; the value after the last, kappa, gives the
inclusion score log(1 - exp(-exp(log_prob - kappa))) of each segmentation, 0 if
there are no others.

Draws depend on the seed, the row key and the place in the text only, so every
run returns the same rows. All texts of a slice are walked together in numpy,
and a distinct chunk gets its lattice once, as long as the cache of a task holds it.

A null or empty text has one segmentation, of no pieces. A text with fewer
segmentations than asked for gives all of them. Rows with the same key and text
get the same segmentations; a null key counts as 0. No text is shortened.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stardw.llm.words import _SPACE, HashIndex, Spans, as_bytes, mix, slices, tidy

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SHARPNESS = 1.0
SAMPLES = 2
SLICE = 1 << 17
# What a task remembers of lattices: 55 MB of edges and 7 MB of places.
EDGES, PLACES = 1 << 21, 7 << 17
# No uniform number of 53 bits gives a Gumbel draw above this.
GREATEST = 36.8

_U = np.uint64
SCHEMA = ("key bigint, sample int, ids array<int>, log_prob double, perturbed double, "
          "log_inclusion double, exact boolean")


@dataclass
class Pieces:
    """The pieces of a model: bytes (a space for the word mark) and log probability by id."""

    data: list[bytes]
    log_prob: np.ndarray
    byte_id: np.ndarray

    @classmethod
    def load(cls, path: str = MODEL, sharpness: float = SHARPNESS) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        data, byte_id = [], np.zeros(256, np.int32)
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_id[int(piece[3:5], 16)] = i
                data.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                data.append(b"")
            else:
                data.append(piece.replace("▁", " ").encode())
        usual = np.array([len(d) > 0 for d in data])
        usual[byte_id] = False
        rank = np.cumsum(usual) - 1
        score = np.where(usual, -sharpness * np.log(rank + 2.0), -np.inf)
        score -= np.log(np.exp(score).sum())
        score[byte_id] = score[usual].min()
        return cls(data, score, byte_id)

    def lookup(self) -> Lookup:
        return Lookup(self)


class Lookup:
    """Piece ids by the hash of a piece's bytes, and what pieces begin with."""

    def __init__(self, pieces: Pieces):
        byte_ids = set(pieces.byte_id.tolist())
        ids = np.array([i for i, d in enumerate(pieces.data) if d and i not in byte_ids], np.int32)
        data = np.frombuffer(b"".join(pieces.data[i] for i in ids), np.uint8)
        ends = np.cumsum([len(pieces.data[i]) for i in ids])
        starts = ends - [len(pieces.data[i]) for i in ids]
        self.longest = int((ends - starts).max())
        # Every beginning of a piece, with the piece's id where it is all of it.
        size = ends - starts
        owner = np.repeat(np.arange(len(ids)), size)
        upto = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + 1
        hashes = np.unique(Spans(data)(starts[owner], starts[owner] + upto))
        whole = np.full(len(hashes), -1, np.int32)
        whole[np.searchsorted(hashes, Spans(data)(starts, ends))] = ids
        self.index, self.ids = HashIndex(hashes), np.append(whole, np.int32(-1))
        self.log_prob, self.byte_id = pieces.log_prob, pieces.byte_id
        self.size = np.array([len(d) for d in pieces.data])
        self.bytes_first = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(pieces.data), np.uint8)

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether a piece begins so, and the id of the piece that ends here or -1."""
        found = self.index(hashes)
        return found >= 0, self.ids[found]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a sequence of ids."""
        size = self.size[ids]
        at = np.repeat(self.bytes_first[ids] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return self.bytes[at]


class Lattice:
    """Edges of all places of a chain of distinct chunks, `data` cut at `bounds`."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, lookup: Lookup):
        n = len(data)
        size = np.diff(bounds)
        remaining = np.repeat(bounds[1:], size) - np.arange(n)
        hashed = Spans(data)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        begins = lead
        # Edges of each length, places in order.
        places: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        has_char = np.zeros(n, bool)
        after = np.full(n + 1, n)
        after[:n][lead[:-1]] = lead[1:] if len(lead) else 0
        width = np.zeros(n, np.int32)
        for length in range(1, lookup.longest + 1):
            lead = lead[remaining[lead] >= length]
            if not len(lead):
                break
            begun, found = lookup(hashed(lead, lead + length))
            hit = np.flatnonzero(found >= 0)
            at = lead[hit]
            places.append(at)
            ids.append(found[hit])
            lead = lead[begun]
            has_char[at] |= after[at] - at == length
            width[at] += 1
        # Characters without a piece, and continuation bytes without a beginning, become byte pieces.
        lost = begins[~has_char[begins]]
        char = np.minimum(after[lost] - lost, remaining[lost])
        first = bounds[:-1][(data[bounds[:-1]] & 0xC0) == 0x80] if n else bounds[:0]
        if len(first):
            following = np.searchsorted(begins, first)
            next_lead = np.where(following < len(begins), begins[np.minimum(following, len(begins) - 1)], n) \
                if len(begins) else np.full(len(first), n)
            lost = np.concatenate([lost, first])
            char = np.concatenate([char, np.minimum(next_lead - first, remaining[first])])
        width[lost] += 1
        # Edges by the bytes left at their place, then by place and length: each length fills the next slot.
        short = remaining.astype(np.int16) if n and remaining.max() < 1 << 15 else remaining
        rank = np.argsort(short, kind="stable")
        slot = np.empty(n, np.int64)
        ends = np.cumsum(width[rank])
        slot[rank] = ends - width[rank]
        edges = int(ends[-1]) if n else 0
        place, length, piece = np.empty(edges, np.int64), np.empty(edges, np.int32), np.empty(edges, np.int32)
        order = np.argsort(char, kind="stable")
        lost, char = lost[order], char[order]
        reach = max(len(places), int(char[-1]) if len(char) else 0)
        cuts = np.searchsorted(char, np.arange(1, reach + 2))
        for i in range(reach):
            groups = [(places[i], ids[i])] if i < len(places) else []
            if cuts[i] < cuts[i + 1]:
                groups.append((lost[cuts[i]:cuts[i + 1]], np.int32(-1)))
            for at, found in groups:
                here = slot[at]
                place[here], length[here], piece[here] = at, i + 1, found
                slot[at] += 1
        score = np.where(piece >= 0, lookup.log_prob[piece], length * lookup.log_prob[lookup.byte_id[0]])

        # Backward sums, places with fewer bytes left first.
        beta = np.full(n + 1, -np.inf)
        through = score.copy()
        cuts = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1]) if len(place) else np.zeros(0, int)
        steps = remaining[place[cuts]] if len(place) else np.zeros(0, int)
        level = np.concatenate([[0], np.flatnonzero(steps[1:] != steps[:-1]) + 1, [len(cuts)]]) if len(cuts) else [0]
        edge_cuts = np.append(cuts, len(place))
        for a, b in zip(level[:-1], level[1:], strict=True):
            low, high = edge_cuts[a], edge_cuts[b]
            target = place[low:high] + length[low:high]
            inside = length[low:high] < remaining[place[low:high]]
            through[low:high] += np.where(inside, beta[np.minimum(target, n)], 0.0)
            beta[place[cuts[a:b]]] = np.logaddexp.reduceat(through[low:high], cuts[a:b] - low)
        share = np.exp(through - beta[place])
        total = np.cumsum(share)
        before = np.concatenate([[0.0], total])[cuts] if len(cuts) else np.zeros(0)
        width = np.diff(edge_cuts)
        self.place, self.length, self.piece, self.share = place, length, piece, share
        self.upto = total - np.repeat(before, width)
        last = edge_cuts[1:] - 1
        self.upto[last] = 2.0
        self.share[last[width == 1]] = 1.0
        self.first = np.zeros(n, np.int64)
        self.count = np.zeros(n, np.int64)
        self.first[place[cuts]], self.count[place[cuts]] = cuts, width


class Lattices:
    """The lattices of the chunks that a task has met.

    They lie one after the other in buffers of `EDGES` edges and `PLACES` places,
    26 bytes an edge and 8 a place. What does not fit beside the others begins the
    buffers anew; only a slice that needs more by itself gets larger ones.
    """

    def __init__(self, lookup: Lookup):
        self.lookup = lookup
        self._begin(EDGES, PLACES)

    def _begin(self, edges: int, places: int) -> None:
        self.keys, self.states = np.zeros(0, _U), np.zeros(0, np.int64)
        self.edges = self.places = 0
        if edges > EDGES or places > PLACES or len(getattr(self, "share", ())) != edges:
            self.first, self.count = np.empty(places, np.int32), np.empty(places, np.int32)
            self.length, self.piece = np.empty(edges, np.int16), np.empty(edges, np.int32)
            self.share, self.upto = np.empty(edges), np.empty(edges)

    def of(self, keys: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The first place of the lattice of each chunk; `keys` are sorted hashes of the chunks."""
        size = end - start
        if len(self.share) != EDGES:
            self._begin(EDGES, PLACES)
        while True:
            at = np.searchsorted(self.keys, keys)
            known = np.zeros(len(keys), bool)
            inside = at < len(self.keys)
            known[inside] = self.keys[at[inside]] == keys[inside]
            new = np.flatnonzero(~known)
            if known.any() and self.places + size[new].sum() > PLACES:
                self._begin(EDGES, PLACES)
                continue
            cut = np.concatenate([[0], np.cumsum(size[new])])
            chosen = np.repeat(start[new] - cut[:-1], size[new]) + np.arange(cut[-1])
            more = Lattice(data[chosen], cut, self.lookup)
            edges, places = self.edges + len(more.share), self.places + len(more.first)
            if edges <= len(self.share) and places <= len(self.first):
                break
            self._begin(max(EDGES, len(more.share)), max(PLACES, len(more.first)))
            if not known.any():
                edges, places, at = len(more.share), len(more.first), np.zeros(len(keys), np.int64)
                break
        states = np.empty(len(keys), np.int64)
        states[known] = self.states[at[known]]
        states[new] = self.places + cut[:-1]
        self.first[self.places:places] = more.first + self.edges
        self.count[self.places:places] = more.count
        for name in ("length", "piece", "share", "upto"):
            getattr(self, name)[self.edges:edges] = getattr(more, name)
        self.edges, self.places = edges, places
        self.keys = np.insert(self.keys, at[new], keys[new])
        self.states = np.insert(self.states, at[new], states[new])
        return states

    def log_share(self, edge: np.ndarray) -> np.ndarray:
        return np.log(self.share[edge])

    def draw(self, place: np.ndarray, uniform: np.ndarray) -> np.ndarray:
        """An edge from each place, by its probability."""
        edge = self.first[place]
        later = np.flatnonzero(uniform >= self.upto[edge])
        while len(later):
            edge[later] += 1
            later = later[uniform[later] >= self.upto[edge[later]]]
        return edge


def _uniform(keys: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from 64-bit keys."""
    return ((mix(keys) >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53


class Texts:
    """Texts of a slice, cut into chunks, with the lattice of the distinct chunks."""

    def __init__(self, column: pa.Array, seeds: np.ndarray, lattices: Lattices):
        data, bounds = as_bytes(column)
        full = np.diff(bounds) > 0
        self.rows, self.lookup = len(full), lattices.lookup
        self.data = np.insert(data, bounds[:-1][full], 0x20)
        self.bounds = bounds + np.concatenate([[0], np.cumsum(full)])
        space = _SPACE[self.data]
        begins = space.copy()
        begins[1:] |= space[:-1] & (self.data[:-1] != 0x20)
        begins[self.bounds[:-1][full]] = True
        self.start = np.flatnonzero(begins)
        self.end = np.append(self.start[1:], len(self.data)) if len(self.start) else self.start
        self.row = np.searchsorted(self.bounds, self.start, "right") - 1
        self.seeds = seeds
        keys, first, kind = np.unique(
            Spans(self.data)(self.start, self.end), return_index=True, return_inverse=True)
        self.lattice = lattices
        self.state = lattices.of(keys, self.data, self.start[first], self.end[first])[kind]

    def walk(self, edges: np.ndarray, at: np.ndarray, state: np.ndarray, end: np.ndarray, row: np.ndarray, turn: int):
        """Draw edges from each place to the end of its chunk, into `edges` by place in the slice."""
        salt = mix(self.seeds + _U(turn * 0x632BE59BD9B4E019 % 2**64))
        while len(at):
            places = (at - self.bounds[row]).astype(_U)
            edge = self.lattice.draw(state, _uniform(salt[row] ^ (places * _U(0xD1342543DE82EF95))))
            edges[at] = edge
            step = self.lattice.length[edge]
            at = at + step
            open_ = at < end
            at, state, end, row = at[open_], (state + step)[open_], end[open_], row[open_]

    def top(self, k: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Up to k segmentations of every row: (rows, edges by place, log_prob, value), then kappa per row."""
        edges = np.full(len(self.data), -1, np.int32)
        self.walk(edges, self.start, self.state, self.end, self.row, 0)
        value = -np.log(-np.log(_uniform(self.seeds ^ _U(0xA0761D6478BD642F))))
        queues: list[list] = [[] for _ in range(self.rows)]
        samples = [(np.ones(self.rows, bool), edges, value)]
        self._queue(queues, edges, value, np.full(self.rows, -1), 0, k)
        for turn in range(1, k):
            rows = np.array([bool(q) for q in queues])
            taken = [heapq.heappop(q) if q else None for q in queues]
            # The prefix of each row's new path comes from the path that its set was found on.
            new = np.full(len(self.data), -1, np.int32)
            value, start = np.full(self.rows, -np.inf), np.full(self.rows, -1)
            some = np.flatnonzero(rows)
            at = np.array([taken[r][1] for r in some], np.int64)
            value[some], start[some] = [-taken[r][0] for r in some], at
            for path in range(turn):
                mine = np.array([taken[r][2] == path for r in some], bool)
                size = at[mine] - self.bounds[some[mine]]
                copied = np.repeat(self.bounds[some[mine]] - np.cumsum(size) + size, size) + np.arange(size.sum())
                new[copied] = samples[path][1][copied]
            chunk = np.searchsorted(self.start, at, "right") - 1
            state = self.state[chunk] + at - self.start[chunk]
            edge, rest = self._other(some, at, state, [taken[r][3] for r in some], turn)
            new[at] = edge
            before = np.array([taken[r][4] for r in some])
            more = np.flatnonzero(rest > 0)
            draws = self._rest(some[more], at[more], turn, before[more] + np.log(rest[more]), value[some[more]])
            for i, draw in zip(more, draws, strict=True):
                r = some[i]
                heapq.heappush(queues[r], (
                    -float(draw), int(at[i]), taken[r][2], (*taken[r][3], int(edge[i])), taken[r][4]))
            step = self.lattice.length[edge]
            on = at + step < self.end[chunk]
            chunks = np.flatnonzero(rows[self.row] & (self.start > start[self.row]))
            self.walk(
                new, np.concatenate([(at + step)[on], self.start[chunks]]),
                np.concatenate([(state + step)[on], self.state[chunks]]),
                np.concatenate([self.end[chunk[on]], self.end[chunks]]),
                np.concatenate([some[on], self.row[chunks]]), turn,
            )
            samples.append((rows, new, value))
            self._queue(queues, new, value, start, turn, k)
        kappa = np.array([-q[0][0] if q else -np.inf for q in queues])
        return samples, kappa

    def _other(self, row: np.ndarray, at: np.ndarray, state: np.ndarray, used: list[tuple], turn: int):
        """For each row an edge from `state` that is not in `used`, by its probability among those.

        Then what probability the edges have that are left after it, 0 if there are none.
        """
        first, count = self.lattice.first[state].astype(np.int64), self.lattice.count[state].astype(np.int64)
        cut = np.cumsum(count) - count
        share = self.lattice.share[np.repeat(first - cut, count) + np.arange(count.sum())]
        taken = np.array([len(u) for u in used], np.int64)
        gone = np.array([e for u in used for e in u], np.int64) - np.repeat(first - cut, taken)
        spent = np.bincount(np.repeat(np.arange(len(row)), taken), weights=share[gone], minlength=len(row))
        share[gone] = 0.0
        upto = np.cumsum(share)
        low = upto[cut] - share[cut]
        whole = upto[cut + count - 1] - low
        key = self.seeds[row] + (at - self.bounds[row]).astype(_U) * _U(0x9FB21C651E98DF25)
        u = _uniform(mix(key) ^ _U(turn * 2 + 1)) * whole + low
        # The last edge that is left, should rounding lead beyond it.
        left = np.where(share > 0, np.arange(len(share)), -1)
        pick = np.minimum(np.searchsorted(upto, u, "right"), np.maximum.reduceat(left, cut) if len(cut) else left)
        pick = np.maximum(pick, cut)
        behind = 1.0 - spent - share[pick]
        return pick - cut + first, np.where(taken + 1 < count, behind, 0.0)

    def _rest(self, row, at, turn: int, location, limit):
        """A Gumbel draw at `location` that is at most `limit`."""
        place = (at - self.bounds[row]).astype(_U)
        key = mix(self.seeds[row] + _U(turn * 0x589965CC75374CC3 % 2**64)) ^ (place * _U(0x1D8E4E27C47D124F))
        return -np.logaddexp(-limit, np.log(-np.log(_uniform(key))) - location)

    def _queue(self, queues, edges, value, start, path: int, k: int) -> None:
        """Put the other edges along the new paths, from `start` on, into the rows' queues.

        The prefix of a path only loses probability, so that its nodes count
        only as long as the greatest draw possible there exceeds the least
        value that the queue can still need.
        """
        every = np.flatnonzero(edges >= 0)
        low, high = np.searchsorted(every, self.bounds[:-1]), np.searchsorted(every, self.bounds[1:])
        todo, ahead = np.flatnonzero(high > low), 160
        while len(todo):
            size = np.minimum((high - low)[todo], ahead)
            cut = np.cumsum(size) - size
            at = every[np.repeat(low[todo] - cut, size) + np.arange(size.sum())]
            which = np.repeat(np.arange(len(todo)), size)
            row, edge = todo[which], edges[at]
            total = np.concatenate([[0.0], np.cumsum(self.lattice.log_share(edge))])
            before = total[:-1] - total[cut[which]]
            with np.errstate(divide="ignore"):
                location = before + np.log1p(-np.minimum(self.lattice.share[edge], 1.0))
            near = np.flatnonzero((at > start[row]) & (location > -np.inf))
            draw = self._rest(row[near], at[near], path, location[near], value[row[near]])
            # Most rows have enough draws close below their value; only those are sorted then.
            close = draw > value[row[near]] - 12
            plenty = np.bincount(which[near][close], minlength=len(todo)) > k
            some = close | ~plenty[which[near]]
            near, draw = near[some], draw[some]
            order = np.lexsort((-draw, which[near]))
            near, draw = near[order], draw[order]
            nth = np.arange(len(near)) - np.searchsorted(which[near], which[near])
            least = np.full(len(todo), -np.inf)
            least[which[near[nth == k]]] = draw[nth == k]
            done = (size == (high - low)[todo]) | (least >= total[cut + size] - total[cut] + GREATEST)
            for i in np.flatnonzero((nth <= k) & done[which[near]]):
                j = near[i]
                heapq.heappush(queues[row[j]], (-float(draw[i]), int(at[j]), path, (int(edge[j]),), float(before[j])))
            todo, ahead = todo[~done], ahead * 4

    def ids(self, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the pieces of a segmentation, where each row's begin, and each row's log probability."""
        at = np.flatnonzero(edges >= 0)
        edge = edges[at]
        out = self.lattice.piece[edge]
        first = np.arange(len(at))
        if (out < 0).any():
            count = np.where(out >= 0, 1, self.lattice.length[edge])
            first = np.cumsum(count) - count
            out = np.repeat(out, count)
            raw = np.flatnonzero(out < 0)
            owner = np.repeat(np.arange(len(at)), count)[raw]
            out[raw] = self.lookup.byte_id[self.data[at[owner] + raw - first[owner]]]
        cut = np.searchsorted(at, self.bounds)
        log = np.concatenate([[0.0], np.cumsum(self.lattice.log_share(edge))])
        return out, np.append(first, len(out))[cut], log[cut[1:]] - log[cut[:-1]]


def encoded(
    documents: DataFrame, key: str = "doc_id", text: str = "text", k: int = SAMPLES,
    seed: int = 0, model: str = MODEL, sharpness: float = SHARPNESS,
) -> DataFrame:
    """Up to `k` distinct segmentations of every row; see SCHEMA. `exact`: the ids decode to the text."""
    lookup = Pieces.load(model, sharpness).lookup()
    salt = _U(seed * 0x2545F4914F6CDD1D % 2**64)

    def batch_of(part: pa.RecordBatch, lattices: Lattices) -> Iterator[pa.RecordBatch]:
        keys = part.column("key")
        seeds = mix(keys.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(_U) + salt)
        texts = Texts(part.column("text"), seeds, lattices)
        samples, kappa = texts.top(k)
        for turn, (rows, edges, value) in enumerate(samples):
            ids, cut, log_prob = texts.ids(edges)
            with np.errstate(over="ignore", divide="ignore"):
                gap = log_prob - kappa
                score = np.where(gap < -30, gap, np.log(-np.expm1(-np.exp(gap))))
            back = lookup.decode(ids)
            shift = np.concatenate([[0], np.cumsum(lookup.size[ids])])[cut]
            whole = np.array_equal(back, self_bytes(texts, rows))
            exact = np.ones(len(rows), bool) if whole else np.array([
                np.array_equal(back[shift[i]:shift[i + 1]], texts.data[texts.bounds[i]:texts.bounds[i + 1]])
                for i in range(len(rows))])
            lists = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_pydict({
                "key": keys, "sample": pa.array(np.full(len(rows), turn, np.int32)), "ids": lists,
                "log_prob": pa.array(log_prob), "perturbed": pa.array(value),
                "log_inclusion": pa.array(np.where(np.isneginf(kappa), 0.0, score)), "exact": pa.array(exact),
            }).filter(pa.array(rows))

    def self_bytes(texts: Texts, rows: np.ndarray) -> np.ndarray:
        return texts.data if rows.all() else texts.data[np.repeat(rows, np.diff(texts.bounds))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = Lattices(lookup)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                yield from batch_of(part, lattices)

    rows = documents.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(tidy(run), SCHEMA)


def decoded(pieces: DataFrame, ids: str = "ids", into: str = "text", model: str = MODEL) -> DataFrame:
    """`pieces` with the column `ids` replaced by the text `into` that the ids stand for.

    Ids of control pieces stand for nothing; bytes that are not UTF-8 become U+FFFD; null stays null.
    """
    from pyspark.sql import types as T

    lookup = Pieces.load(model).lookup()
    fields = [T.StructField(into, T.StringType()) if f.name == ids else f for f in pieces.schema.fields]

    def text(values) -> str | None:
        if values is None:
            return None
        data = lookup.decode(np.array(values, np.int64)).tobytes()
        return data.removeprefix(b" ").decode("utf-8", "replace")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([text(v) for v in batch.column(ids).to_pylist()], pa.string())
            columns = [texts if n == ids else c for n, c in zip(batch.schema.names, batch.columns, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return pieces.mapInArrow(run, T.StructType(fields))
