import re

import numpy as np
import pytest
from stardw.llm import perfect_dedup as pd_
from stardw.llm.words import mix

from llm_fixtures import documents  # noqa: F401

ROWS = [
    (1, "a b"), (2, "a  b"), (3, "a\t\n b"), (4, " a b"), (5, "a b "), (None, "a b"), (7, ""), (8, None), (9, " "),
    (10, "x" * 200_000), (11, "x" * 200_000), (12, "A b"), (12, "A b"), (20, "a b"), (30, "only"), (None, "null id"),
]


def plain(rows):
    groups = {}
    for key, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(key)
    out = []
    for key, text in rows:
        members = groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")]
        known = [m for m in members if m is not None]
        out.append((key, min(known) if known else None, len(members)))
    return sorted(out, key=repr)


def test_groups_match_plain_python(documents):
    found = pd_.deduplicate(documents(ROWS)).collect()
    assert sorted(((r.key, r.keep, r["size"]) for r in found), key=repr) == plain(ROWS)


def test_one_row_of_each_text_stays(documents):
    docs = documents(ROWS)
    kept = pd_.keep_first(docs)
    assert kept.columns == docs.columns
    texts = sorted(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in kept.collect())
    assert texts == sorted({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in ROWS})
    assert pd_.deduplicate(documents([])).count() == 0
    assert pd_.keep_first(documents([])).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 20_000])
def test_hash_is_minimal_and_perfect(n):
    keys = mix(np.arange(n, dtype=np.uint64))
    levels = pd_.perfect_levels(keys)
    assert sorted(pd_.slots(keys, levels).tolist()) == list(range(n))


def test_repeated_keys_are_refused():
    with pytest.raises(ValueError):
        pd_.perfect_levels(np.array([5, 5], np.uint64))


def test_no_group_meets_in_one_task(documents):
    rows = [(i, "same text" if i % 3 == 0 else f"text {i}") for i in range(3000)]
    found = pd_.deduplicate(documents(rows)).collect()
    assert sorted(((r.key, r.keep, r["size"]) for r in found), key=repr) == plain(rows)
