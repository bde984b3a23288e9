import os

import numpy as np
import pyarrow as pa
import pytest
from stardw.llm import training_order as to
from stardw.session import work_folder

from llm_fixtures import documents  # noqa: F401

pytestmark = pytest.mark.skipif(not os.path.exists(to.RANKS), reason="no vocabulary file")
TEXTS = [
    "it's  a test\n\n now", None, "", " ", "a\xa0 b", "voilà la", "x \n y  z", "word " * 3000, "end", "é" * 500,
]


@pytest.mark.parametrize("size", [1, 2, 3, 17, 1000, 4097])
def test_permutation_is_a_bijection(size):
    slots = to.permuted(np.arange(size), size)
    assert sorted(slots.tolist()) == list(range(size))
    if size > 100:
        assert (slots != to.permuted(np.arange(size), size, seed=1)).any()


def test_parts_encode_as_whole_texts():
    encoder = to.Encoder(to.ranks_of())
    for _ in range(2):
        ids, count = encoder(pa.array(TEXTS))
        cut = np.concatenate([[0], np.cumsum(count)])
        for i, text in enumerate(TEXTS):
            assert ids[cut[i]:cut[i + 1]].tolist() == encoder.plain.encode_ordinary(text or "") + [encoder.end]


def test_shards_hold_every_token_once(spark, documents, monkeypatch):
    monkeypatch.setattr(to, "LENGTH", 16)
    monkeypatch.setattr(to, "SHARD", 100)
    rows = [(i if i != 3 else None, t) for i, t in enumerate(TEXTS)]
    folder = work_folder(spark, "test-shards")
    placed = to.write(documents(rows).coalesce(1), folder).collect()
    shards = max(r.shard for r in placed) + 1
    slots = [list(to.read(folder, s, length=16)) for s in range(shards)]
    assert all(len(s) == 100 for s in slots[:-1]) and all(len(x) == 16 for s in slots for x in s)
    assert [x.tolist() for x in to.read(folder, 0, first=40, length=16)] == [x.tolist() for x in slots[0][40:]]
    encoder = to.Encoder(to.ranks_of())
    sequences = {s * 100 + i: x for s, held in enumerate(slots) for i, x in enumerate(held)}
    number = {int(slot): i for i, slot in enumerate(to.permuted(np.arange(len(sequences)), len(sequences)))}
    stream = np.concatenate([sequences[s] for s in sorted(sequences, key=number.get)]).tolist()
    want = [i for t in TEXTS for i in encoder.plain.encode_ordinary(t or "") + [encoder.end]]
    assert stream[:len(want)] == want and set(stream[len(want):]) <= {encoder.end}
    assert len(stream) - len(want) < 16
    tokens = {}
    for r in placed:
        assert r.offset == ((r.slot % 100) * 16 + r.offset // 2 % 16) * 2
        tokens[r.key] = tokens.get(r.key, 0) + r.n_tokens
    assert tokens == {k: len(encoder.plain.encode_ordinary(t or "")) + 1 for k, t in rows}


def test_empty_table(spark, documents):
    assert to.write(documents([]), work_folder(spark, "test-none")).count() == 0
