import math
import random
import zlib
from collections import Counter

import numpy as np

from stardw.llm import maxent_lm

from llm_fixtures import documents  # noqa: F401


def corpus(n, seed=1):
    rng = random.Random(seed)
    tongues = [[f"{p}{i}" for i in range(300)] for p in ("a", "b")]
    rows = []
    for i in range(n):
        words = tongues[i % 2]
        text = " ".join(words[min(int(rng.expovariate(0.03)), 299)] for _ in range(rng.randrange(20, 60)))
        rows.append((i, text))
    return rows


def base(rows):
    def held(key):
        return key is not None and zlib.crc32(str(key).encode()) % 7 == 2

    count = Counter()
    for key, text in rows:
        if not held(key):
            count.update((text or "").encode().lower().split())
            count[None] += 1
    n, v = sum(count.values()), len(count)
    out = []
    for key, text in rows:
        words = (text or "").encode().lower().split() + [None]
        score = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in words)
        out.append((key, held(key), len(words), sum(count[w] > 0 for w in words), n, score))
    return out


def rounded(rows):
    return sorted(((*r[:5], round(r[5], 6)) for r in rows), key=repr)


def test_base_score_and_held_out_gain(documents, monkeypatch):
    monkeypatch.setattr(maxent_lm, "TOP", 200)  # the other words take the way by shuffle
    rows = corpus(600) + [(1000, None), (1001, ""), (None, "A a1 a1 Zz"), (7, "again"), (1002, "a1 " * 30_000)]
    found = maxent_lm.score(documents(rows)).collect()
    fields = [(r.key, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found]
    assert rounded(fields) == rounded(base(rows))
    away = [r for r in found if r.held_out and r.n_tokens < 100]
    assert sum(r.score for r in away) > sum(r.base_score for r in away)


def model(docs):
    rows = docs.selectExpr("doc_id key", "text", "false held_out")
    vocabulary = maxent_lm.Vocabulary.of(maxent_lm.counts(docs))
    encoded = maxent_lm.encoded(rows, vocabulary)
    classes = maxent_lm.Classes.of(vocabulary, encoded)
    return vocabulary, classes, maxent_lm.train(encoded, classes)


def test_classes_are_a_distribution(documents):
    vocabulary, classes, _ = model(documents(corpus(200)))
    assert abs(classes.mass.sum() - (vocabulary.n + vocabulary.v + 1)) < 1e-6


def test_chances_of_all_next_words_sum_to_one(documents, monkeypatch):
    monkeypatch.setattr(maxent_lm, "TOP", 200)
    docs = documents(corpus(200))
    vocabulary, classes, weights = model(docs)
    table = maxent_lm.counts(docs).toPandas()
    place = vocabulary.index(table.word.to_numpy().view(np.uint64))
    count = np.append(table.n.to_numpy(), 0)  # the last event is an unknown word
    place = np.append(place, -1)
    rng = np.random.default_rng(3)
    for length in (0, 1, 2, 5, 30):
        history = rng.integers(-1, 200, length)
        texts = np.concatenate([np.append(history, w) for w in place]).astype(np.int32)
        first = np.arange(len(place) + 1) * (length + 1)
        gain = maxent_lm.gains(texts, first, classes, weights)[length::length + 1]
        chance = np.exp(gain) * (count + 1) / (vocabulary.n + vocabulary.v + 1)
        assert abs(chance.sum() - 1) < 1e-5
        assert chance.min() > 0


def test_expected_counts_add_up_to_the_observed_number_of_tokens(documents):
    docs = documents(corpus(50))
    vocabulary, classes, weights = model(docs)
    rng = np.random.default_rng(4)
    place = rng.integers(-1, len(vocabulary.count), 5000).astype(np.int32)
    first = np.array([0, 10, 11, 3000, 5000])
    seen, guess = (np.zeros((len(classes.mass), maxent_lm.ROWS)) for _ in range(2))
    maxent_lm.observed(seen, place, first, classes)
    maxent_lm.expected(guess, place, first, classes, weights)
    assert np.allclose(seen.sum(axis=0), guess.sum(axis=0), atol=1e-3)


def test_scores_do_not_depend_on_order_and_split(documents):
    rows = corpus(300)
    one = {r.key: (r.score, r.n_tokens) for r in maxent_lm.score(documents(rows).coalesce(1)).collect()}
    random.Random(5).shuffle(rows)
    seven = maxent_lm.score(documents(rows).repartition(7)).collect()
    assert len(seven) == len(one)
    for r in seven:
        score, tokens = one[r.key]
        assert abs(score - r.score) <= 1e-6 * tokens


def test_a_word_after_its_usual_word_scores_higher(documents):
    rows = [(i, " ".join(["x y"] * 20 + ["p q"] * 20)) for i in range(60)]
    usual, odd = (next(i for i in range(k, k + 99) if zlib.crc32(str(i).encode()) % 7 == 2) for k in (100, 300))
    found = {r.key: r for r in maxent_lm.score(documents([*rows, (usual, "x y x y"), (odd, "y y x x")])).collect()}
    assert abs(found[usual].base_score - found[odd].base_score) < 1e-9
    assert found[usual].score > found[odd].score


def test_nothing_to_train_on(documents):
    assert maxent_lm.score(documents([])).count() == 0
    key = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = maxent_lm.score(documents([(key, "a b")])).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (True, 3, 0, 0)
    assert row.base_score == row.score == 0.0


def test_training_goes_on_until_a_round_gains_nothing(documents):
    docs = documents(corpus(200))
    rows = docs.selectExpr("doc_id key", "text", "false held_out")
    vocabulary = maxent_lm.Vocabulary.of(maxent_lm.counts(docs))
    places = maxent_lm.encoded(rows, vocabulary)
    classes = maxent_lm.Classes.of(vocabulary, places)
    kept = [b for batch in places.toArrow().to_batches() for b in maxent_lm.blocks(batch)]
    seen, guess = (np.zeros((len(classes.mass), maxent_lm.ROWS)) for _ in range(2))
    weights = maxent_lm.train(places, classes)
    for _, place, first in kept:
        maxent_lm.observed(seen, place, first, classes)
        maxent_lm.expected(guess, place, first, classes, weights)
    more = maxent_lm.step(weights, seen.T, guess.T)
    small = 0.01  # ln a token
    ahead = sum(maxent_lm.gains(place, first, classes, more).sum() for _, place, first in kept)
    here = sum(maxent_lm.gains(place, first, classes, weights).sum() for _, place, first in kept)
    assert ahead - here < small * seen.T[0].sum()


def test_equal_histories_count_as_often_as_they_occur(documents):
    docs = documents(corpus(50))
    vocabulary, classes, weights = model(docs)
    place = np.random.default_rng(6).integers(-1, 40, 4000).astype(np.int32)
    place = np.concatenate([place, place[:2000], place])
    first = np.array([0, 1, 700, 4000, 6000, 10_000])
    found, sums = (np.zeros((len(classes.mass), maxent_lm.ROWS)) for _ in range(2))
    norms = maxent_lm.expected(found, place, first, classes, weights)
    rows = maxent_lm.rows_of(place, classes.kind[place], first)
    chance = np.exp(weights[rows].sum(axis=0, dtype=np.float64))
    assert abs(norms - np.log(chance.sum(axis=1)).sum()) < 1e-3
    chance /= chance.sum(axis=1, keepdims=True)
    for row in rows:
        for total, part in zip(sums, chance.T):
            total += np.bincount(row, weights=part, minlength=maxent_lm.ROWS)
    assert np.allclose(found, sums, rtol=1e-4, atol=1e-4)


def test_histories_are_gathered_once_over_the_whole_corpus(documents):
    rows = corpus(120)
    whole = documents([(10 * i + j, text) for i, text in rows for j in range(3)]).repartition(5)
    vocabulary, classes, weights = model(documents(rows))
    places = maxent_lm.encoded(whole.selectExpr("doc_id key", "text", "false held_out"), vocabulary)
    found = maxent_lm.gathered(places, classes).toPandas()
    assert found.code.is_unique  # copies in other tasks add to the times only
    assert (found.times % 3 == 0).all()
    guess, sums = (np.zeros((len(classes.mass), maxent_lm.ROWS)) for _ in range(2))
    tokens, norms = 0, 0.0
    for batch in places.toArrow().to_batches():
        for _, place, first in maxent_lm.blocks(batch):
            tokens += len(place)
            norms += maxent_lm.expected(guess, place, first, classes, weights)
    assert found.times.sum() == tokens
    found = found.sort_values("code")
    together = maxent_lm.reckoned(sums, found.code.to_numpy(), found.times.to_numpy(), weights)
    assert abs(together - norms) < 1e-3
    assert np.allclose(sums, guess, rtol=1e-4, atol=1e-4)


def whole_model(rows, documents):
    docs = documents(rows)
    held = docs.select(maxent_lm.F.col("doc_id").alias("key"), "text", maxent_lm.held_out("doc_id").alias("held_out"))
    table = maxent_lm.counts(held.filter("not held_out"))
    vocabulary = maxent_lm.Vocabulary.of(table)
    places = maxent_lm.stored(maxent_lm.encoded(held, vocabulary), "test-places")
    classes = maxent_lm.Classes.of(vocabulary, places.filter("not held_out"))
    return vocabulary, places, classes, maxent_lm.Events.of(vocabulary, classes)


def test_events_share_the_mass_of_their_classes(documents, monkeypatch):
    monkeypatch.setattr(maxent_lm, "TOP", 200)  # the other words go by buckets
    vocabulary, _, classes, events = whole_model(corpus(200), documents)
    assert len(events.mass) == 200 + maxent_lm.BUCKETS and events.mass.min() > 0
    assert np.allclose(np.bincount(events.kind, weights=events.mass), classes.mass, rtol=1e-12)
    assert abs(events.mass.sum() - (vocabulary.n + vocabulary.v + 1)) < 1e-6


def test_words_in_a_class_are_a_distribution_with_the_pairs_of_the_largest_entropy(documents, monkeypatch):
    monkeypatch.setattr(maxent_lm, "TOP", 200)
    _, places, _, events = whole_model(corpus(200), documents)
    code = []
    for batch in places.filter("not held_out").select("place").toArrow().to_batches():
        code.append(maxent_lm.pairs(*maxent_lm._places(batch), events.kind))
    code, n = np.unique(np.concatenate(code), return_counts=True)
    raised, total, rate = maxent_lm.solved(code, n, events)
    gain = maxent_lm.word_gains(code, n, raised, total, rate, events)
    assert 0 < raised.sum() < len(raised)
    cut, which = maxent_lm.contexts(code)
    event = code & ((1 << maxent_lm.EVENT_BITS) - 1)
    share = events.mass / events.whole[events.kind]
    chance = np.exp(gain) * share[event]
    # The words of the class that never follow the word before have the rate's chance.
    rest = np.exp(np.log(rate) + np.log(events.whole[events.kind[event[cut]]] / total))
    away = 1 - np.add.reduceat(share[event], cut)
    assert np.allclose(np.add.reduceat(chance, cut) + rest * away, 1, atol=1e-9)
    # With a weight: expected as often as it occurs less the discount; without: no less than that.
    expected = chance * total[which]
    assert np.allclose(expected[raised], n[raised] - maxent_lm.DISCOUNT)
    assert (expected[~raised] >= n[~raised] - maxent_lm.DISCOUNT - 1e-9).all()


def test_word_gains_of_rows_are_those_of_the_whole_corpus_for_any_split(documents, monkeypatch):
    monkeypatch.setattr(maxent_lm, "TOP", 200)
    rows = corpus(150) + [(1000, None), (1001, ""), (1002, "a1 b1 " * 2000)]
    found = {}
    for tasks in (1, 5):
        docs = documents(rows).repartition(tasks)
        held = docs.select(maxent_lm.F.col("doc_id").alias("key"), "text", maxent_lm.held_out("doc_id").alias("held_out"))
        vocabulary = maxent_lm.Vocabulary.of(maxent_lm.counts(held.filter("not held_out")))
        places = maxent_lm.stored(maxent_lm.encoded(held, vocabulary), "test-places")
        classes = maxent_lm.Classes.of(vocabulary, places.filter("not held_out"))
        gains = maxent_lm._worded(places, vocabulary, classes).join(places.select("row", "key"), "row")
        found[tasks] = {r.key: r.word_gain for r in gains.collect()}
    # By hand: one table of all training pairs, looked up for each token.
    events = maxent_lm.Events.of(vocabulary, classes)
    code, trained, keys = [], [], []
    for batch in places.select("key", "held_out", "place").toArrow().to_batches():
        place, first = maxent_lm._places(batch)
        code.append(maxent_lm.pairs(place, first, events.kind))
        trained.append(np.repeat([not h for h in batch.column("held_out").to_pylist()], np.diff(first)))
        keys.append(np.repeat(batch.column("key").to_numpy(), np.diff(first)))
    code, which = np.unique(np.concatenate(code), return_inverse=True)
    n = np.bincount(which, weights=np.concatenate(trained)).astype(np.int64)
    gain = maxent_lm.word_gains(code, n, *maxent_lm.solved(code, n, events), events)[which] / np.log(10)
    keys = np.concatenate(keys)
    assert set(found[1]) == set(found[5]) == {key for key, _ in rows}
    for key, _ in rows:
        tokens = (keys == key).sum()
        assert abs(gain[keys == key].sum() - found[1][key]) < 1e-6 * tokens
        assert abs(found[5][key] - found[1][key]) < 1e-6 * tokens


def test_a_word_scores_higher_after_its_usual_word_than_others_of_its_class(documents):
    """All words but the anchors are of one class here, in which a word had its share of counts before."""
    rng = random.Random(9)
    anchors = [f"f{i}" for i in range(maxent_lm.ANCHORS - 2)]  # with "the" and the end of a text
    rows = [(2 * i, " ".join(rng.choices(anchors, k=60))) for i in range(300)]
    rows += [(2 * i + 1, " ".join(f"the u{k} v{k}" for k in rng.choices(range(40, 100), k=40))) for i in range(300)]
    usual, odd = (next(i for i in range(k, k + 99) if zlib.crc32(str(i).encode()) % 7 == 2) for k in (1000, 3000))
    texts = [(usual, "the u60 v60 the u70 v70 the u80 v80"), (odd, "the u60 v70 the u70 v80 the u80 v60")]
    found = {r.key: r for r in maxent_lm.score(documents([*rows, *texts])).collect()}
    assert abs(found[usual].base_score - found[odd].base_score) < 1e-9
    assert found[usual].score > found[odd].score + 3  # three pairs, each by more than a factor of ten
