import itertools
import math
import os
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from stardw.llm import lattice_sampling as ls
from stardw.llm.words import mix

from llm_fixtures import documents  # noqa: F401

pytestmark = pytest.mark.skipif(not os.path.exists(ls.MODEL), reason="no model file")


@pytest.fixture(scope="module")
def pieces():
    return ls.Pieces.load()


def segmentations(pieces, chunk):
    """All segmentations of one chunk with their log probability, by trying every piece."""
    bytes_ = set(pieces.byte_id.tolist())
    by_data = {d: i for i, d in enumerate(pieces.data) if d and i not in bytes_}

    def walk(rest):
        if not rest:
            return [((), 0.0)]
        out = []
        for n in range(1, len(rest) + 1):
            if rest[:n] in by_data:
                i = by_data[rest[:n]]
                out += [((i, *r), pieces.log_prob[i] + p) for r, p in walk(rest[n:])]
        char = len(rest.decode()[0].encode())
        if rest[:char] not in by_data:
            ids = tuple(int(pieces.byte_id[b]) for b in rest[:char])
            out += [(ids + r, sum(pieces.log_prob[i] for i in ids) + p) for r, p in walk(rest[char:])]
        return out

    return walk(chunk)


def exact(pieces, chunks):
    every = {}
    for parts in itertools.product(*[segmentations(pieces, c) for c in chunks]):
        every[sum((p[0] for p in parts), ())] = sum(p[1] for p in parts)
    total = np.logaddexp.reduce(list(every.values()))
    return {k: math.exp(v - total) for k, v in every.items()}


def drawn(pieces, text, n, k):
    texts = ls.Texts(pa.array([text] * n), mix(np.arange(n, dtype=np.uint64)), ls.Lattices(pieces.lookup()))
    samples, kappa = texts.top(k)
    out = []
    for rows, edges, value in samples:
        ids, cut, log_prob = texts.ids(edges)
        out.append(([tuple(ids[cut[i]:cut[i + 1]].tolist()) for i in range(n)], log_prob, value, rows))
    return out, kappa


def test_draws_follow_the_lattice_without_replacement(pieces):
    flat = ls.Pieces.load(sharpness=0.3)
    want = exact(flat, [b" the", b" \xc3\xa9", b"\n", "ﷺ".encode()])
    n = 20_000
    samples, kappa = drawn(flat, "the é\nﷺ", n, 3)
    assert all(len({s[0][i] for s in samples}) == 3 for i in range(n))
    for ids, log_prob, _, _ in samples:
        assert all(abs(log_prob[i] - math.log(want[ids[i]])) < 1e-9 for i in range(200))
    first = Counter(samples[0][0])
    assert sum(abs(first[s] / n - p) for s, p in want.items()) / 2 < 0.02
    second = Counter()
    for a, p in want.items():
        for b, q in want.items():
            if a != b:
                second[b] += p * q / (1 - p)
    seen = Counter(samples[1][0])
    assert sum(abs(seen[s] / n - p) for s, p in second.items()) / 2 < 0.02
    values = np.stack([s[2] for s in samples])
    assert (np.diff(values, axis=0) <= 0).all() and (kappa <= values[-1]).all()
    # Inclusion scores make the weighted sum of probabilities unbiased.
    included = [-np.expm1(-np.exp(s[1] - kappa)) for s in samples]
    estimate = sum(np.exp(s[1]) / q for s, q in zip(samples, included, strict=True))
    assert abs(estimate.mean() - 1) < 0.02


def test_all_segmentations_of_a_short_text(pieces):
    want = exact(pieces, [b" the"])
    samples, kappa = drawn(pieces, "the", 5, len(want) + 3)
    for i in range(5):
        assert {s[0][i] for s in samples if s[3][i]} == set(want)
        assert sum(s[3][i] for s in samples) == len(want)
    assert np.isneginf(kappa).all()


def test_encode_decode_round_trip(spark, documents):
    rows = [
        (1, "the cat  sat\n\non\tthe mat"), (2, None), (3, ""), (4, " "), (5, "▁ \x85 　 日本語 ﷺ\n"), (6, "x" * 5000),
        (7, "word " * 40_000), (None, "null key"), (1, "the cat  sat\n\non\tthe mat"),
    ]
    docs = documents(rows)
    found = ls.encoded(docs, k=3)
    back = ls.decoded(found).collect()
    by_key = {}
    for r in found.collect():
        assert r.exact
        by_key.setdefault(r.key, set()).add(tuple(r.ids))
    for r in back:
        assert r.text in {t or "" for k, t in rows if k == r.key}
    assert len(by_key[7]) == len(by_key[1]) == 3 and by_key[2] == by_key[3] == {()}
    again = {(r.key, r.sample, tuple(r.ids)) for r in ls.encoded(docs.repartition(3), k=3).collect()}
    assert again == {(r.key, r.sample, tuple(r.ids)) for r in found.collect()}
    assert ls.encoded(documents([])).count() == 0
    assert ls.decoded(spark.createDataFrame([(None, 1)], "ids array<int>, text2 int")).first().text is None


def test_a_task_of_many_chunks_takes_little_memory(pieces):
    rng = random.Random(5)
    column = pa.array([" ".join(
        "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 12))) for _ in range(400)
    ) for _ in range(300)])
    batch, lookup = pa.record_batch({"text": column}), pieces.lookup()
    tracemalloc.start()
    try:
        lattices = ls.Lattices(lookup)
        for part in ls.slices(batch, "text", ls.SLICE):
            ls.Texts(part.column("text"), mix(np.arange(part.num_rows, dtype=np.uint64)), lattices).top(2)
        assert tracemalloc.get_traced_memory()[1] < 120 << 20
    finally:
        tracemalloc.stop()
