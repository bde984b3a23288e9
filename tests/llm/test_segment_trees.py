"""Differences of sources beside a plain count in Python."""

import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from llm_fixtures import documents  # noqa: F401
from stardw.llm import segment_trees as st

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top):
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(ASCII))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        spread = Counter(t for _, _, terms in mine for t in set(terms))
        kept = [t for t, n in spread.items() if n >= least]
        whole = Counter(t for _, _, terms in mine for t in terms if t in set(kept))
        groups = {s: Counter() for _, s, _ in mine}
        for _, s, terms in mine:
            groups[s].update(t for t in terms if t in set(kept))

        def price(counts, t, kept=kept):
            return 1 + 10**9 * (counts[t] + 5) // (sum(counts.values()) + 5 * len(kept))

        for s, counts in groups.items():
            pairs = [(sum(abs(price(counts, t) - price(other, t)) for t in kept), o) for o, other in groups.items() if o != s]
            for r, (v, o) in enumerate(sorted(pairs, key=lambda x: (-x[0], x[1].encode())), 1):
                out.append((lang, s, "pair", o, v, r))
            above = [(price(counts, t) - price(whole, t), t) for t in kept if counts[t] and price(counts, t) > price(whole, t)]
            for r, (v, t) in enumerate(sorted(above, key=lambda x: (-x[0], x[1].encode()))[:top], 1):
                out.append((lang, s, "term", t, v, r))
    return sorted(out)


def rows_of(seed=1):
    rng = np.random.default_rng(seed)
    words = ["Alpha", "beta's", "ÉTÉ", "été", "x", "日本", "don't", "ÄA", "𝔘x", "zz9zz"]
    rows = []
    for i in range(60):
        n = int(rng.integers(0, 9))
        text = " ".join(words[int(k)] for k in rng.integers(0, len(words), n))
        rows.append((i, text, ["en", "de", None][i % 3], ["a", "b", "c", None, "é", "Z"][int(rng.integers(0, 6))]))
    rows += [(100, None, "en", "bare"), (101, "", "en", "bare"), (102, "123 ,.", "en", "none"), (103, "once", "xx", "p"),
             (104, "", "xx", "q"), (105, None, "xx", None), (106, "alpha " * 30000, "en", "a")]
    return rows + rows[:7]  # repeated rows count again


@pytest.mark.parametrize(("segment", "block"), [(st.SEGMENT, st.BLOCK), (2, 2), (1, 1)])
def test_equals_a_plain_count(spark, documents, segment, block):
    rows = rows_of()
    found = st.audited(documents(rows), least_docs=3, top=4, segment=segment, block=block)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, 3, 4)


def test_column_names_that_clash(spark):
    df = spark.createDataFrame(
        [("a b", "en", "s", 1, "x"), ("a c", "en", "t", 2, "y")],
        "body string, l string, lang string, term int, source string")
    found = st.audited(df, "body", "l", "lang", least_docs=1)
    assert sorted(tuple(r) for r in found.collect()) == plain(
        [(0, "a b", "en", "s"), (1, "a c", "en", "t")], 1, 50)


def test_an_empty_table(documents):
    assert st.audited(documents([]).limit(0)).count() == 0


def test_equal_subtrees_are_one_node():
    counts = np.zeros((40, 1024), np.int64)
    counts[:, 0] = np.arange(40)
    forest = st.Forest(counts)
    # One path of own nodes per group with a count, and one zero node per level.
    assert forest.nodes() <= 40 * 11 + 11
    same = st.Forest(np.tile(np.arange(8), (5, 128)))
    assert len(set(same.roots.tolist())) == 1
    assert same.nodes() == 8 + 4 + 2 + 1 + 7


def test_distances_equal_the_dense_sum():
    rng = np.random.default_rng(2)
    counts = rng.poisson(0.7, (9, 77)) * rng.integers(0, 2, (9, 77))
    forest = st.Forest(counts)
    prices = rng.integers(1, 10**9, (9, len(forest.leaves)))
    dense = prices[np.arange(9)[:, None], np.searchsorted(forest.leaves, counts)]
    left, right = np.array(list(combinations(range(9), 2))).T
    wanted = np.abs(dense[left] - dense[right]).sum(axis=1)
    assert np.array_equal(forest.distances(left, right, prices), wanted)


def test_prices_stay_exact_for_large_counts():
    assert st.price(10**17, 3 * 10**17, 10**6) == 1 + (10**9 * (10**17 + 5)) // (3 * 10**17 + 5 * 10**6)
