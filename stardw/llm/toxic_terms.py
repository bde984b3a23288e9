"""Toxicity from a learned lexicon, met through Levenshtein automata and read in context.

Words are runs of other than white space, without the signs at their ends, and
folded: lower case, no accents, letters and digits only, digits that stand for
letters (0 1 3 4 5 7) as these letters. The lexicon holds the words whose share of
toxic texts is at least e^`LEAST_ODDS` times that of the others. Both shares are
counted by the words they follow, so that copies of a text count once.

The lexicon is a trie. Its product with a Levenshtein automaton (one edit in terms
of four letters and more, two in terms of ten and more) is determinised as words
ask for it: a state is a set of trie nodes with the edits spent, and a whole slice
of distinct words takes one step of a table per letter. A word of the lexicon is
met as such, and a word that clean training texts use is not taken for a
misspelled one.

Each match weighs the log odds of its term, halved per edit, times what its window
of words says: quotation marks around it or words of reporting make it a
quotation, words of address an insult. A text has five features (sum, greatest, number and
density of the weights, and its evidence), and their logistic regression is its score.

Evidence is for texts without a term of the lexicon, or where no word is one because
all its occurrences follow the same few words: the sum of the log odds of a text's
distinct words over the root of their number. It counts texts that use a word, for
the `EVIDENCE` words whose odds are the surest, and speaks for either side.

Model and lexicon come from at most `SAMPLE` labelled rows, those whose ids have
the smallest hashes among the rows that are not held out; three quarters
give the lexicon, the rest the regression. Ids, languages, sources and labels are
inputs of no score, and every text is scored whole.

A null or empty text has no match and the least score. Several labels of one id
count as the greatest, a null one as none. A null id is not held out, has no
label and is scored. Repeated rows are scored one by one. Without labels, or
without toxic ones, the lexicon is empty and scores are the base rate. An empty
table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stardw.llm.tables import stored
from stardw.llm.words import _LOWER, Spans, Words, slices

SAMPLE = 1 << 15
LEAST_DOCS = 3
LEAST_ODDS = 2.0
KNOWN_DOCS = 3
ONE_EDIT, TWO_EDITS = 4, 10
EDIT_DISCOUNT = 0.5
WINDOW = 6
QUOTED, REPORTED, ADDRESSED = 0.2, 0.5, 1.5
RIDGE = 1.0
# Distinct words whose match a task remembers.
REMEMBERED = 1 << 20
# Words with odds of their own: at most so many, each in at least so many texts, with odds so many deviations from even.
EVIDENCE, EVIDENT_DOCS, EVIDENT = 1 << 15, 2, 2.5
FEATURES = 5

_U = np.uint64
_SOLID = np.zeros(256, bool)
for _low, _high in (("0", "9"), ("A", "Z"), ("a", "z")):
    _SOLID[ord(_low):ord(_high) + 1] = True
_SOLID[0x80:] = True

# Digits read as letters, and cue words in the languages of the texts.
LETTERS_OF_DIGITS = str.maketrans("013457", "oieast")
REPORTING = frozenset(
    "said says say wrote writes called calls quote quoted quotes quoting word term reported reports cited cites "
    "sagte sagt schrieb schreibt nannte zitat zitiert wort begriff "
    "dit ecrit appele cite citation mot terme "
    "dijo dice escribio llamo cita palabra termino".split())
ADDRESS = frozenset(
    "you your youre u ur yourself du dich dir dein deine ihr euch tu toi te ton ta vous votre tus eres usted ustedes "
    "vosotros".split())
QUOTES = re.compile('["“”„«»]')

_ORDINARY = re.compile(r"[0-9a-z]*")


def fold(word: str) -> str:
    word = word.lower()
    if not word.isascii():
        word = "".join(c for c in unicodedata.normalize("NFKD", word) if c.isalnum())
    elif not _ORDINARY.fullmatch(word):
        word = "".join(c for c in word if c.isalnum())
    if word.isdigit() or word.isalpha():
        return word
    return word.translate(LETTERS_OF_DIGITS)


def held_out(key: str) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


class Tokens:
    """Words of a slice without the signs at their ends; `hash` tells distinct ones apart."""

    def __init__(self, column: pa.Array):
        words = Words(column)
        self.data, self.bounds, self.rows = words.data, words.bounds, words.rows
        solid = np.flatnonzero(_SOLID[self.data])
        first, last = np.searchsorted(solid, words.start), np.searchsorted(solid, words.end)
        real = last > first
        self.start = solid[first[real]]
        self.end = solid[last[real] - 1] + 1
        self.doc = words.doc[real]
        self.first = np.searchsorted(self.doc, np.arange(self.rows + 1))
        self.hash = Spans(_LOWER[self.data])(self.start, self.end)

    def word(self, i: int) -> str:
        return self.data[self.start[i]:self.end[i]].tobytes().decode("utf-8", "replace")


def edits_of(length: int) -> int:
    return 0 if length < ONE_EDIT else 1 if length < TWO_EDITS else 2


class Automaton:
    """Words within the edits that a term of the lexicon allows, as a table filled on demand.

    `lexicon` has the weight of each folded term. State 0 is the dead one, 1 the first.
    """

    def __init__(self, lexicon: dict[str, float]):
        self.terms = list(lexicon)
        self.weights = np.array([lexicon[t] for t in self.terms])
        letters = sorted({c for t in self.terms for c in t})
        self.letter = {c: i + 1 for i, c in enumerate(letters)}
        self.child: list[dict[int, int]] = [{}]
        self.ends: dict[int, int] = {}
        self.allowed = [0]
        self.longest = 0
        for number, term in enumerate(self.terms):
            node, allowed = 0, edits_of(len(term))
            self.longest = max(self.longest, len(term) + allowed)
            self.allowed[0] = max(self.allowed[0], allowed)
            for c in term:
                below = self.child[node].setdefault(self.letter[c], len(self.child))
                if below == len(self.child):
                    self.child.append({})
                    self.allowed.append(0)
                node = below
                self.allowed[node] = max(self.allowed[node], allowed)
            self.ends[node] = number
        self.states: list[dict[int, int]] = [{}]
        self.number: dict[frozenset, int] = {frozenset(): 0}
        self.table = np.full((64, len(letters) + 1), -1, np.int32)
        self.table[0] = 0
        self.found = np.full(64, -1, np.int64)
        self._state({0: 0})

    def _state(self, nodes: dict[int, int]) -> int:
        """The number of the state that a set of nodes with edits leads to, omitted letters included."""
        todo = list(nodes)
        while todo:
            node = todo.pop()
            spent = nodes[node] + 1
            for below in self.child[node].values():
                if spent <= self.allowed[below] and spent < nodes.get(below, 99):
                    nodes[below] = spent
                    todo.append(below)
        key = frozenset(nodes.items())
        number = self.number.get(key)
        if number is None:
            number = self.number[key] = len(self.states)
            self.states.append(nodes)
            if number == len(self.table):
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
                self.found = np.concatenate([self.found, np.full_like(self.found, -1)])
            ends = [
                (spent, -self.weights[self.ends[n]], self.ends[n]) for n, spent in nodes.items()
                if n in self.ends and spent <= edits_of(len(self.terms[self.ends[n]]))]
            if ends:
                spent, _, term = min(ends)
                self.found[number] = term * 4 + spent
        return number

    def _step(self, state: int, letter: int) -> int:
        after: dict[int, int] = {}
        for node, spent in self.states[state].items():
            if spent < self.allowed[node] and spent + 1 < after.get(node, 99):
                after[node] = spent + 1  # a letter too many
            for c, below in self.child[node].items():
                cost = spent if c == letter else spent + 1
                if cost <= self.allowed[below] and cost < after.get(below, 99):
                    after[below] = cost
        return self._state(after)

    def match(self, words: list[str]) -> np.ndarray:
        """Of each word four times the number of the nearest term plus the edits, or -1."""
        found = np.full(len(words), -1, np.int64)
        some = np.array([i for i, w in enumerate(words) if 0 < len(w) <= self.longest], np.int64)
        if not len(some):
            return found
        size = np.array([len(words[i]) for i in some])
        codes = np.zeros((len(some), int(size.max())), np.int16)
        for row, i in enumerate(some):
            codes[row, :size[row]] = [self.letter.get(c, 0) for c in words[i]]
        state, alive = np.ones(len(some), np.int32), np.arange(len(some))
        for place in range(codes.shape[1]):
            alive = alive[(size[alive] > place) & (state[alive] > 0)]
            if not len(alive):
                break
            step = self.table[state[alive], codes[alive, place]]
            for i in np.flatnonzero(step < 0):
                a, c = int(state[alive[i]]), int(codes[alive[i], place])
                if self.table[a, c] < 0:
                    self.table[a, c] = self._step(a, c)
                step[i] = self.table[a, c]
            state[alive] = step
        found[some] = self.found[state]
        return found


@dataclass
class Model:
    """`lexicon`: weight by folded term; `known`: other words of clean texts; the regression; `evidence`: odds by word."""

    lexicon: dict[str, float]
    known: frozenset[str]
    mean: np.ndarray
    scale: np.ndarray
    slope: np.ndarray
    base: float
    evidence: dict[str, float] = field(default_factory=dict)

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-(((features - self.mean) / self.scale) @ self.slope + self.base)))


class Matcher:
    """Matches of the words of slices; a distinct word is looked up once as long as it is remembered."""

    def __init__(self, lexicon: dict[str, float], known: frozenset[str], evidence: dict[str, float] | None = None):
        self.automaton, self.known, self.evidence = Automaton(lexicon), known, evidence or {}
        self.exact = {t: i * 4 for i, t in enumerate(self.automaton.terms)}
        self._forget()

    def _forget(self) -> None:
        self.seen, self.code, self.odds = np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0)

    def codes(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Of each word its match, as in `Automaton.match`; of each text its evidence."""
        distinct, first, which = np.unique(tokens.hash, return_index=True, return_inverse=True)
        if len(self.seen) + len(distinct) > REMEMBERED:
            self._forget()
        at = np.searchsorted(self.seen, distinct)
        there = at < len(self.seen)
        there[there] = self.seen[at[there]] == distinct[there]
        new = np.flatnonzero(~there)
        words = [fold(tokens.word(first[i])) for i in new]
        found = np.array([self.exact.get(w, -1) for w in words], np.int64)
        strange = [i for i, w in enumerate(words) if found[i] < 0 and w not in self.known]
        found[strange] = self.automaton.match([words[i] for i in strange])
        odds = np.array([self.evidence.get(w, 0.0) for w in words])
        self.seen, self.code = np.insert(self.seen, at[new], distinct[new]), np.insert(self.code, at[new], found)
        self.odds = np.insert(self.odds, at[new], odds)
        place = np.searchsorted(self.seen, distinct)
        cells = np.unique(tokens.doc * np.int64(max(len(distinct), 1)) + which)
        doc, word = np.divmod(cells, max(len(distinct), 1))
        # In the order of the hashes, which is the same in every slice.
        total = np.bincount(doc, weights=self.odds[place][word], minlength=tokens.rows)
        return self.code[place][which], total / np.sqrt(np.bincount(doc, minlength=tokens.rows) + 1.0)

    def features(self, column: pa.Array) -> np.ndarray:
        """Sum, greatest, number and density of the weights of the matches of each text, on log scales; its evidence."""
        tokens = Tokens(column)
        codes, evidence = self.codes(tokens)
        hits = np.flatnonzero(codes >= 0)
        weight = self.automaton.weights[codes[hits] >> 2] * EDIT_DISCOUNT ** (codes[hits] & 3) if len(hits) else np.zeros(0)
        weight = weight * np.array([self._context(tokens, int(i)) for i in hits])
        doc = tokens.doc[hits]
        total = np.bincount(doc, weights=weight, minlength=tokens.rows)
        greatest = np.zeros(tokens.rows)
        np.maximum.at(greatest, doc, weight)
        number = np.bincount(doc, weights=weight > 1.0, minlength=tokens.rows)
        length = np.diff(tokens.first)
        matched = np.log1p(np.stack([total, greatest, number, 100 * total / (length + 20)], axis=1))
        return np.column_stack([matched, evidence])

    @staticmethod
    def _context(tokens: Tokens, hit: int) -> float:
        """What the window of words around a match makes of it."""
        row = tokens.doc[hit]
        low, high = max(hit - WINDOW, tokens.first[row]), min(hit + WINDOW, tokens.first[row + 1] - 1)
        begin = tokens.start[low] if low > tokens.first[row] else tokens.bounds[row]
        end = tokens.end[high] if high + 1 < tokens.first[row + 1] else tokens.bounds[row + 1]
        before, after = (
            tokens.data[a:b].tobytes().decode("utf-8", "replace")
            for a, b in ((begin, tokens.start[hit]), (tokens.end[hit], end)))
        words = {fold(w) for w in (before + " " + after).split()}
        factor = 1.0
        if QUOTES.search(before.rsplit("\n", 1)[-1]) and QUOTES.search(after.split("\n", 1)[0]):
            factor *= QUOTED
        if words & REPORTING:
            factor *= REPORTED
        return factor * ADDRESSED if words & ADDRESS else factor


def sampled(documents: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int) -> DataFrame:
    """(`text`, `toxic`, `fits`) of the labelled documents that are learned from, at most `rows` ids."""
    known = labels.select(F.col(key).cast("long").alias("id"), F.col(label).alias("toxic"))
    learned = known.filter("id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out("id")).groupBy("id").agg(
        F.max("toxic").cast("int").alias("toxic"))
    chosen = learned.orderBy(F.xxhash64("id"), "id").limit(rows)  # bounded, so that it may be sent to all tasks
    return documents.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).join(
        F.broadcast(chosen), "id").select(
            "text", "toxic", (F.pmod(F.xxhash64("id", F.lit(7)), F.lit(4)) == 0).alias("fits"))


def _word_counts(sample: DataFrame) -> DataFrame:
    """(`word`, `toxic`, `clean`): texts of either kind that use a word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                tokens = Tokens(part.column("text"))
                if not len(tokens.hash):
                    continue
                bad = part.column("toxic").to_numpy()[tokens.doc] > 0
                _, first, which = np.unique(tokens.hash, return_index=True, return_inverse=True)
                cells = np.unique(which * np.int64(tokens.rows) + tokens.doc, return_index=True)[1]
                counts = [np.bincount(which[cells], weights=w[cells], minlength=len(first)).astype(np.int64)
                          for w in (bad, ~bad)]
                yield pa.RecordBatch.from_pydict({
                    "word": pa.array([fold(tokens.word(i)) for i in first]),
                    "toxic": pa.array(counts[0]), "clean": pa.array(counts[1])})

    return sample.select("text", "toxic").mapInArrow(run, "word string, toxic bigint, clean bigint").groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _settings(sample: DataFrame, words: frozenset[str]) -> DataFrame:
    """(`word`, `toxic`, `clean`): distinct words that precede a word in texts of either kind."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                tokens = Tokens(part.column("text"))
                _, first, which = np.unique(tokens.hash, return_index=True, return_inverse=True)
                names = [fold(tokens.word(i)) for i in first]
                wanted = np.array([n in words for n in names], bool)
                at = np.flatnonzero(wanted[which]) if len(names) else np.zeros(0, np.int64)
                begins = at == tokens.first[tokens.doc[at]]
                before = np.where(begins, _U(0), tokens.hash[np.maximum(at - 1, 0)])
                yield pa.RecordBatch.from_pydict({
                    "word": pa.array([names[i] for i in which[at]], pa.string()),
                    "before": pa.array(before.view(np.int64)),
                    "bad": pa.array(part.column("toxic").to_numpy()[tokens.doc[at]] > 0)})

    seen = sample.select("text", "toxic").mapInArrow(run, "word string, before bigint, bad boolean").distinct()
    return seen.groupBy("word").agg(
        F.sum(F.col("bad").cast("int")).alias("toxic"), F.sum((~F.col("bad")).cast("int")).alias("clean"))


def _evidence(used: DataFrame, odds: Callable[[Column, Column], Column]) -> dict[str, float]:
    """Log odds of the at most `EVIDENCE` words that tell toxic texts from others most surely."""
    toxic, clean = F.col("toxic"), F.col("clean")
    sure = F.abs(odds(toxic, clean)) / F.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    words = used.filter(toxic + clean >= EVIDENT_DOCS).select("word", odds(toxic, clean).alias("odds"), sure.alias("sure"))
    best = words.filter(F.col("sure") >= EVIDENT).orderBy(F.desc("sure"), "word").limit(EVIDENCE)
    return {r.word: r.odds for r in best.select("word", "odds").collect()}


def _regression(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Ridge logistic regression by Newton steps, on features brought to one scale."""
    rows = max(len(y), 1)
    share = (y.sum() + 0.5) / (rows + 1.0)
    mean, scale = (x.mean(axis=0), x.std(axis=0)) if len(y) else (np.zeros(FEATURES), np.ones(FEATURES))
    scale = np.where(scale > 0, scale, 1.0)
    z = np.concatenate([(x - mean) / scale, np.ones((len(y), 1))], axis=1)
    w = np.zeros(FEATURES + 1)
    w[-1] = np.log(share / (1 - share))
    penalty = np.diag([RIDGE] * FEATURES + [1e-6])
    for _ in range(50 if 0 < y.sum() < len(y) else 0):
        p = 1.0 / (1.0 + np.exp(-z @ w))
        slope = z.T @ (p - y) + penalty @ (w * ([1] * FEATURES + [0]))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, slope)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return mean, scale, w[:-1], float(w[-1])


def train(
    documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    rows: int = SAMPLE,
) -> Model:
    """A model from at most `rows` labelled documents; words and features of these are all the driver sees."""
    sample = stored(sampled(documents, labels, key, text, label, rows), "toxic-sample")
    teaching = sample.filter("not fits")
    n = teaching.agg(F.sum("toxic"), F.count("*")).first()
    bad, good = (n[0] or 0), n[1] - (n[0] or 0)
    used = stored(_word_counts(teaching), "toxic-words")

    def odds(toxic, clean):
        return F.log((toxic + 0.5) / (bad + 1.0)) - F.log((clean + 0.5) / (good + 1.0))

    likely = used.filter((F.col("toxic") >= LEAST_DOCS) & (odds(F.col("toxic"), F.col("clean")) >= LEAST_ODDS))
    likely = frozenset(r.word for r in likely.filter("length(word) > 1").select("word").collect())
    settled = _settings(teaching, likely).withColumn("weight", odds(F.col("toxic"), F.col("clean")))
    kept = settled.filter((F.col("toxic") >= LEAST_DOCS) & (F.col("weight") >= LEAST_ODDS))
    lexicon = {r.word: r.weight for r in kept.select("word", "weight").orderBy("word").collect()}
    clean = used.filter(F.col("clean") >= KNOWN_DOCS).select("word").collect()
    known = frozenset(r.word for r in clean) - lexicon.keys()
    evidence = _evidence(used, odds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon, known, evidence)
        for batch in batches:
            for part in slices(batch, "text"):
                x = matcher.features(part.column("text"))
                yield pa.RecordBatch.from_pydict(
                    {"toxic": part.column("toxic")} | {f"x{i}": pa.array(x[:, i].copy()) for i in range(FEATURES)})

    names = [f"x{i}" for i in range(FEATURES)]
    fitted = sample.filter("fits").select("text", "toxic").mapInArrow(
        run, "toxic int, " + ", ".join(f"{c} double" for c in names)).toArrow()  # `rows` ids at most
    # In one order, whatever the tasks: sums of doubles depend on it.
    fitted = fitted.sort_by([(c, "ascending") for c in ["toxic", *names]])
    x = np.stack([fitted.column(c).to_numpy() for c in names], axis=1) if fitted.num_rows else np.zeros((0, FEATURES))
    y = fitted.column("toxic").to_numpy().astype(float) if fitted.num_rows else np.zeros(0)
    fit = _regression(x, y)
    if fit[2][-1] < 0:  # few rows may turn evidence round, which speaks for label 1 by its making
        fit = _regression(x * ([1] * (FEATURES - 1) + [0]), y)
    return Model(lexicon, known, *fit, evidence)


def scored(documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row `key`, `held_out`, `score` and `predicted`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model.lexicon, model.known, model.evidence)
        for batch in batches:
            for part in slices(batch, "text"):
                score = model.score(matcher.features(part.column("text")))
                yield pa.RecordBatch.from_pydict({
                    "key": part.column("key"), "held_out": part.column("held_out"), "score": pa.array(score),
                    "predicted": pa.array((score >= 0.5).astype(np.int32))})

    rows = documents.select(
        F.col(key).cast("long").alias("key"), held_out(key).alias("held_out"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "key bigint, held_out boolean, score double, predicted int")
