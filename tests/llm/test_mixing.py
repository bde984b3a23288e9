import re

from stardw.llm import mixing

from llm_fixtures import documents  # noqa: F401


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: 1.0 + i % 3 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s] + 1e-9}
        if not over:
            return {**{s: 3.0 * sizes[s] for s in capped}, **share}
        capped |= over


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_mix_meets_targets_and_limits(spark, documents):
    rows = [(i, "w " * (i % 7 * 40), None, ["a", "b", "é", None][i % 4 if i % 3 else 0]) for i in range(120)]
    rows += [(7, "w " * 50, None, "b"), (7, "w " * 50, None, "b"), (None, "x y z", None, "tiny"),
             (None, None, None, "none"), (200, "word " * 30_000, None, "a")]
    found = mixing.taken(documents(rows)).collect()
    again = mixing.taken(documents(rows)).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again))
    assert len(found) == len(rows)
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + size_of(text)
    want = brute_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in found:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)


def test_slots_are_a_low_discrepancy_schedule(spark, documents):
    rows = [(i, "w " * 200, None, "abc"[i % 3]) for i in range(600)]
    sized = mixing.sizes(documents(rows))
    shares = mixing.plan(sized)
    slots = sorted((r.slot, r.sid, r["rank"]) for r in mixing.schedule(shares, 64).collect())
    assert len({s for s, _, _ in slots}) == len(slots)
    share = {r.sid: r.high - r.low for r in shares.collect()}
    count = dict.fromkeys(share, 0)
    for i, (_, sid, rank) in enumerate(slots, 1):
        assert rank == count[sid]
        count[sid] += 1
        assert all(abs(count[s] - share[s] * i) <= 6 for s in share)


def test_empty_and_materialised(spark, documents):
    assert mixing.taken(documents([])).count() == 0
    docs = documents([(1, "a b c", None, "s"), (2, "d e f", None, "t"), (3, "", None, "t")])
    kept = mixing.materialised(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} <= {1, 2}
    assert mixing.materialised(documents([])).count() == 0
