import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from stardw.llm import words
from stardw.llm.words import HashIndex, Words, mix, slices


def some_texts(n=60, seed=3):
    rng = random.Random(seed)
    chars = "ab \t\n\r\x0b\x0cé \x85Z"
    return [None, "", " ", "\n", "x", "Aé b"] + [
        "".join(rng.choice(chars) for _ in range(rng.randrange(60))) for _ in range(n)
    ]


def split(text, lower):
    data = (text or "").encode()
    return (data.lower() if lower else data).split()


def test_words_and_shingles_match_plain_python():
    texts = some_texts()
    for lower in (False, True):
        words = Words(pa.array(texts), lower=lower)
        want = [split(t, lower) for t in texts]
        assert words.counts().tolist() == [len(w) for w in want]
        flat = [w for ws in want for w in ws]
        by_hash = {}
        for w, h in zip(flat, words.hash.tolist()):
            assert by_hash.setdefault(h, w) == w
        assert len(by_hash) == len(set(flat))
        row, value = words.shingles()
        for i, ws in enumerate(want):
            sets = {tuple(ws[j:j + 5]) for j in range(len(ws) - 4)} or ({tuple(ws)} if ws else set())
            assert len(sets) == (row == i).sum() == len(set(value[row == i].tolist()))


def test_slices_cover_all_rows_and_respect_the_limit():
    texts = ["x" * n for n in (5, 0, 9, 100, 1, 1, 1)] + [None]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts)})
    parts = list(slices(batch, "text", 10))
    assert [t for p in parts for t in p.column(0).to_pylist()] == texts
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column(0).to_pylist()) <= 10 for p in parts)
    assert list(slices(batch.slice(0, 0), "text")) == []


def test_hash_index():
    keys = mix(np.arange(5000, dtype=np.uint64))
    index = HashIndex(keys)
    assert index(keys).tolist() == list(range(5000))
    assert (index(mix(np.arange(5000, 9000, dtype=np.uint64))) == -1).all()
    assert HashIndex(keys[:0])(keys).tolist() == [-1] * 5000


def test_powers_of_no_bytes_come_first(monkeypatch):
    monkeypatch.setattr(words, "_powers", {})
    assert words.Words(pa.array(["", None])).counts().tolist() == [0, 0]
    for size in (0, 1, words.STEP - 1, words.STEP, words.STEP + 1):
        assert len(words.Words(pa.array(["a" * size])).hash) == (size > 0)


HELD = """
import re
from pathlib import Path
from stardw.llm.words import tidy

def run(batches):
    held = [bytes(2000) for _ in range(50_000)]
    last.append(held[-1])  # so that what lies below it is not given back by itself
    yield len(held)

last = []
list(%s)
print(re.search(r"Pss_Anon:\\s+(\\d+)", Path("/proc/self/smaps_rollup").read_text())[1])
"""


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="memory can't be read here")
def test_a_worker_gives_freed_memory_back_at_the_end_of_a_task():
    def left(call):
        root = Path(words.__file__).parents[2]
        return int(subprocess.run([sys.executable, "-c", HELD % call], cwd=root, check=True, capture_output=True).stdout)

    assert left("tidy(run)([])") + 50_000 < left("run([])")


def test_a_task_that_stops_early_is_tidied(monkeypatch):
    done = []
    monkeypatch.setattr(words, "give_back", lambda: done.append(1))
    batches = words.tidy(lambda batches: (b for b in batches))(iter([1, 2]))
    assert next(batches) == 1 and not done
    batches.close()
    assert done == [1]
