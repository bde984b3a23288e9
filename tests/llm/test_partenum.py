import random

import numpy as np
import pytest
from stardw.llm import partenum

from llm_fixtures import documents  # noqa: F401


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4)) or (
        frozenset([tuple(words)]) if words else frozenset())


def plain(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    first = {}
    for i, (key, _) in enumerate(rows):
        first.setdefault(find(i), []).append(key)
    out = []
    for i, (key, _) in enumerate(rows):
        known = [k for k in first[find(i)] if k is not None]
        out.append((key, len(sets[i]), (min(known) if known else None) if sets[i] else key))
    return sorted(out, key=repr)


def corpus(seed, families=12, copies=8, length=120):
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(55)]
    rows = []
    for f in range(families):
        base = [f"w{rng.randrange(900)}" for _ in range(rng.choice([3, 9, 25, 60, length, 400]))]
        if f % 3 == 0:
            base = base[:20] + passage + base[20:]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(5)):
                text[rng.randrange(len(text))] = f"n{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(text)))
    return rows


EDGES = [
    (900, None), (901, ""), (902, " \n"), (903, "one"), (904, "One"), (905, "a b c d"), (906, "a b c d e"),
    (None, "a b c d"), (907, "a b c d"), (907, "a b c d"), (908, "long " * 30_000),
]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_all_pairs(documents, seed):
    rows = corpus(seed) + EDGES
    found = partenum.classes(documents(rows)).collect()
    assert sorted(((r.key, r.n_shingles, r.component) for r in found), key=repr) == plain(rows)


def test_large_family_of_near_copies(documents, monkeypatch):
    # Wide signatures only: copies of one text, some of them too far from it, beside another family with the same passage.
    monkeypatch.setattr(partenum, "WIDE", 3)
    monkeypatch.setattr(partenum, "BLOCK", 20)
    monkeypatch.setattr(partenum, "PIVOTS", 2)
    rng = random.Random(5)
    rows = []
    for family in range(2):
        base = [f"f{family}w{i}" for i in range(90)] + [f"p{i}" for i in range(30)]
        for n in range(60):
            text = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 4, 6, 9])):
                text[rng.randrange(len(text))] = f"n{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(text)))
    found = partenum.classes(documents(rows)).collect()
    assert sorted(((r.key, r.n_shingles, r.component) for r in found), key=repr) == plain(rows)


def test_similar_sets_share_enough_signatures():
    rng = np.random.default_rng(0)
    for size in (1, 2, 5, 16, 17, 23, 40, 64, 65, 130, 500, 3000):
        for _ in range(20):
            a = rng.integers(1, 2**63, size, dtype=np.uint64)
            differ = rng.integers(0, size // 7 + 1)
            b = np.concatenate([a[differ:], rng.integers(1, 2**63, rng.integers(0, differ + 1), dtype=np.uint64)])
            both = len(np.intersect1d(a, b))
            if 100 * both < 75 * (len(a) + len(b) - both) or not len(b):
                continue
            entries, node, band, need = partenum.signatures(
                np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), np.array([len(a), len(b)]),
                np.array([1, 2], np.uint64))
            one, two = (set(entries["sig"][entries["node"] == n].tolist()) for n in (1, 2))
            shared = {}
            for sig in one & two:
                shared[sig % partenum.BANDS] = shared.get(sig % partenum.BANDS, 0) + 1
            bands = set(band[node == 1]) & set(band[node == 2])
            assert any(
                shared.get(x, 0) >= max(need[(node == n) & (band == x)].max() for n in (1, 2)) for x in bands)


def test_one_row_of_each_group_stays(documents):
    rows = corpus(3, families=6) + EDGES
    docs = documents(rows)
    kept = partenum.keep_one(docs)
    assert kept.columns == docs.columns
    want = {}
    for key, n, component in plain(rows):
        want.setdefault((component, n > 0), set()).add(key)
    stays = sorted((r.doc_id for r in kept.collect()), key=repr)
    empties = [k for k, t in rows if not shingles(t)]
    assert stays == sorted([c for (c, full) in want if full] + empties, key=repr)
    assert partenum.classes(documents([])).count() == 0
    assert partenum.keep_one(documents([])).count() == 0


def test_keep_one_reads_texts_back_in_no_python_step(documents):
    same = "a b c d e f g h i j k l"
    rows = [(1, same), (1, same), (1, same.upper()), (2, same), (3, ""), (3, ""), (None, None), (4, "other words only"),
            (None, "p q r s t u"), (None, "P q r s t u")]
    docs = documents(rows).selectExpr("doc_id", "text", "1 AS _key")
    kept = partenum.keep_one(docs)
    assert "MapInArrow" not in kept._jdf.queryExecution().executedPlan().toString()
    found = sorted(((r.doc_id, (r.text or "").lower(), r._key) for r in kept.collect()), key=repr)
    assert found == sorted([(1, same, 1), (3, "", 1), (3, "", 1), (None, "", 1), (4, "other words only", 1),
                            (None, "p q r s t u", 1)], key=repr)
