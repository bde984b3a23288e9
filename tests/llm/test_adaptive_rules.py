import random
import re
from collections import Counter

import pyarrow as pa
from stardw.llm import adaptive_rules as ar

from test_words import some_texts

from llm_fixtures import documents  # noqa: F401


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


def test_counts_match_plain_python():
    texts = some_texts(200) + ["a b c d e f a b c d e", "x\nx\n\nx", "#" * 50_000, "a\n a\na ", "é# é#"]
    found = ar.counts_of(pa.array(texts))
    for i, text in enumerate(texts):
        assert tuple(int(found[c][i]) for c in ar.COUNTS[:5]) == plain(text)


def group(seed, n, lang, source, start, marks=0):
    rng = random.Random(seed)
    words = [f"{lang}{i}" for i in range(400)]
    return [
        (start + i, " ".join(rng.choice(words) + "#" * marks for _ in range(80)), lang, source) for i in range(n)
    ]


def test_cutoffs_follow_their_group(documents):
    clean = group(1, 80, "en", "s", 0) + group(2, 80, "c", None, 100, marks=1) + group(3, 3, None, "t", 200)
    junk = [(300, "### " * 30, "en", "s"), (301, " ".join(f"w{i}##" for i in range(60)), "en", "s"),
            (302, "same " * 40, "en", "s"), (303, "few words", "en", "s"), (304, None, "en", "s"), (305, "", None, None)]
    docs = documents(clean + junk)
    kept = ar.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [r[0] for r in clean]


def test_base_rule_and_empty_table(documents):
    docs = documents([(1, "a b c", "x", "y"), (1, " ".join(map(str, range(50))), "x", "y")])
    counts = ar.measured(docs.select("doc_id", "text", "lang", "source")).drop("text")
    judged = ar.verdicts(counts, ar.fences(counts)).collect()
    assert sorted(r.base_failed for r in judged) == [False, True]
    assert ar.keep_good(documents([])).count() == 0


def test_each_rule_rejects_what_is_unlike_its_group(documents):
    rng = random.Random(9)
    words = ["a", "river", "Stone", "window", "under", "morning", "of", "the", "again", "house", "early", "garden"]

    def text(n=120):
        return [f"{rng.choice(words)}{rng.randrange(90)}" for _ in range(n)]

    def lined(parts, at=10):
        return "\n".join(" ".join(parts[i:i + at]) for i in range(0, len(parts), at))

    clean = [lined(text()) for _ in range(120)]
    # One free repeat, then lines repeated, capitals, long and short words, a repeated passage, echoes, symbols.
    clean += [lined(text(40)) + "\nx y\nx y", lined(text(20)) + "\none # more"]
    again = [lined(text(60), 10)] + ["menu home"] * 5
    passage = text(9)
    junk = ["\n".join(again), lined([w.upper() if i % 3 == 0 else w for i, w in enumerate(text())]),
            lined([w + "x" * 195 for w in text()]), lined([w[0] for w in text()]),
            lined(passage + text(51) + passage + text(51)), lined([w for x in text(60) for w in (x, x)][:20] + text(100)),
            lined([w + "#" if i % 8 == 0 else w for i, w in enumerate(text())])]
    rows = [(i, t, "en", "s") for i, t in enumerate(clean + junk)]
    counts = ar.measured(documents(rows).select("doc_id", "text", "lang", "source"))
    judged = ar.verdicts(counts, ar.fences(counts)).collect()
    assert sum(r.base_failed for r in judged) == 0
    assert sorted(r.doc_id for r in judged if not r.kept) == list(range(len(clean), len(rows)))


def test_an_unknown_language_is_judged_by_wider_cutoffs(documents):
    rows = group(5, 80, "en", "s", 0) + group(6, 3, "Qx", "t", 100) + [
        (200, " ".join(f"w{i}" + "x" * 200 for i in range(60)), "zz", "t")]
    assert sorted(r.doc_id for r in ar.keep_good(documents(rows)).collect()) == [r[0] for r in rows[:-1]]
