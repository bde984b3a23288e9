"""Matches beside plain edit distances, and scores on texts with known terms."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from stardw.llm import toxic_terms as t

TERMS = ["vorgle", "brask", "mindolt", "quexelthorn", "zob"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def mangled(rng, word):
    for _ in range(rng.randrange(4)):
        i, c = rng.randrange(len(word) + 1), rng.choice("abogleé")
        word = rng.choice([word[:i] + c + word[i:], word[:i] + word[i + 1:], word[:i] + c + word[i + 1:]])
    return word


def test_automaton_equals_edit_distance():
    rng = random.Random(4)
    lexicon = {w: 1.0 + i for i, w in enumerate([*TERMS, "brasko", "vorg", "éte"])}
    words = [mangled(rng, rng.choice(list(lexicon))) for _ in range(4000)] + ["", "x", "brask" * 9]
    automaton = t.Automaton(lexicon)
    for word, code in zip(words, automaton.match(words), strict=True):
        near = [(distance(word, term), -w, term) for term, w in lexicon.items() if distance(word, term) <= t.edits_of(len(term))]
        if not word or not near:
            assert code == -1, word
        else:
            assert (code & 3, automaton.terms[code >> 2]) == (min(near)[0], min(near)[2]), word


def test_an_empty_lexicon_matches_nothing():
    assert t.Automaton({}).match(["a", ""]).tolist() == [-1, -1]


def test_fold():
    assert [t.fold(w) for w in ("Brask", "BR4SK", "brá-sk", "1984", "éTÉ", "日本")] == [
        "brask", "brask", "brask", "1984", "ete", "日本"]


def test_signs_at_the_ends_of_words_do_not_count():
    tokens = t.Tokens(pa.array(["(brask), *** Brask! x", None, "", "«brask»"]))
    assert [t.fold(tokens.word(i)) for i in range(4)] == ["brask", "brask", "x", "brask"]
    assert tokens.doc.tolist() == [0, 0, 0, 3]
    assert tokens.hash[0] == tokens.hash[1]


def features(*texts):
    return t.Matcher({"brask": 4.0, "vorgle": 4.0}, frozenset({"bras"})).features(pa.array(list(texts), pa.string()))


def test_context_separates_quotation_from_abuse():
    plain, insult, quoted, reported, other_line = features(
        "this is a brask here", "you are a brask here", 'this "is a brask here" x', "the word brask is here",
        '"x"\nthis is a brask here')[:, 0]
    assert quoted < reported < plain < insult
    assert other_line == plain


def test_misspelled_terms_weigh_less_and_known_words_nothing():
    exact, edited, leet, known, none, null = features(
        "a brask b", "a brrask b", "a BR4SK b", "a bras b", "", None)[:, 0]
    assert exact == leet > edited > 0
    assert known == none == null == 0


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


def corpus(n=600, seed=2):
    rng = random.Random(seed)
    usual = ["one", "two", "three", "four", "five", "sixes", "seven", "eights"]
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        words = [rng.choice(usual) for _ in range(rng.randrange(8, 40))]
        if bad:
            for _ in range(rng.randrange(2, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(TERMS[:4]))
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, int(bad)))
    return rows, labels


@pytest.fixture(scope="module")
def frames(spark):
    def make(rows, labels):
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr(
            "*", "1 AS key", "2 AS id", "'x' AS word", "0 AS toxic", "0 AS score")
        return docs, spark.createDataFrame(labels, "doc_id long, toxic int")
    return make


def result(docs, labels):
    return {r.key: tuple(r) for r in t.scored(docs, t.train(docs, labels)).collect()}


def test_held_out_accuracy_and_edge_rows(frames):
    rows, labels = corpus()
    rows += [(1000, None, None, None), (1001, "", "en", "s"), (1002, "one two three brrask vorgle! mindollt four", "fr", "q"),
             (1003, "one two " * 50000, "en", "s"), (None, "brask vorgle mindolt one two", None, None), (None, "one two", None, None)]
    labels += [(None, 1), (1001, None), (7, 0), (7, 0), (99999, 1)]
    docs, known = frames(rows, labels)
    model = t.train(docs, known)
    assert set(TERMS[:4]) == set(model.lexicon)
    found = [tuple(r) for r in t.scored(docs, model).collect()]
    assert len(found) == len(rows)
    assert all(0 <= s <= 1 and p == int(s >= 0.5) for _, _, s, p in found)
    assert all(h == held(i) for i, h, _, _ in found)
    by_id = {i: p for i, _, _, p in found if i is not None}
    assert all(by_id[i] == y for i, y in labels if i is not None and i < 600 and held(i))
    assert (by_id[1000], by_id[1001], by_id[1002], by_id[1003]) == (0, 0, 1, 0)
    assert sorted(p for i, _, _, p in found if i is None) == [0, 1]


def test_labels_of_held_out_rows_and_other_columns_are_no_input(frames):
    rows, labels = corpus(200)
    whole = result(*frames(rows, labels))
    turned = result(*frames([(i, text, "zz", None) for i, text, _, _ in rows],
                            [(i, 1 - y if held(i) else y) for i, y in labels]))
    assert whole == turned


def test_copies_of_a_toxic_text_add_no_terms(frames):
    rows, labels = corpus(300)
    rows += [(2000 + k, "elephant umbrella gondola marzipan brask brask", "en", "s") for k in range(60)]
    docs, known = frames(rows, labels + [(2000 + k, 1) for k in range(60)])
    assert not {"umbrella", "gondola", "marzipan"} & set(t.train(docs, known).lexicon)


def test_without_labels_and_without_documents(frames):
    rows, labels = corpus(20)
    docs, none = frames(rows, labels)
    base = t.scored(docs, t.train(docs, none.limit(0)))
    assert {r.score for r in base.collect()} == {base.first().score}
    clean = t.scored(docs, t.train(docs, none.filter("toxic = 0"))).collect()
    assert {r.predicted for r in clean} == {0}
    assert t.scored(docs.limit(0), t.train(docs.limit(0), none)).count() == 0


def test_features_do_not_depend_on_slices():
    rows, _ = corpus(50)
    texts = [r[1] for r in rows]
    matcher = t.Matcher({w: 2.0 for w in TERMS}, frozenset())
    whole = matcher.features(pa.array(texts))
    each = np.concatenate([matcher.features(pa.array([x])) for x in texts])
    assert np.array_equal(whole, each)


def test_held_out_rows_rank_when_words_mark_label_0(frames):
    """The lexicon holds words of label 1 only, so that all scores were the same."""
    rows, labels = corpus()
    docs, marked = frames(rows, [(i, 1 - toxic) for i, toxic in labels])
    score = {k: r[2] for k, r in result(docs, marked).items() if held(k)}
    bad, good = ([s for k, s in score.items() if (k % 4 != 0) == toxic] for toxic in (True, False))
    ranked = sum((b > g) + (b == g) / 2 for b in bad for g in good) / (len(bad) * len(good))
    assert ranked > 0.95
