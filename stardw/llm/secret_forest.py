"""Findings of secrets, with false positives removed by a random forest.

A candidate is each run of at least `LEAST` characters of the alphabets of
keys with a digit among them, however many a word has, and each value assigned
to one of `NAMES`, whatever its length and characters, in one word or over
the words beside it. Its features are its length,
how its characters go over from one kind to the next, how much of it the
corpus's own words cover (letter triples that frequent words have), the path
it stands in (slashes, dots, at signs, an assignment, a quotation) and the
words beside it.

Findings are labelled by what is certain from outside the features: published
key formats and names that are assigned a value make a secret; addresses,
numbers, identifiers and dates do not. A name counts for its own value only,
not for the rest of its word. Plain letters that follow a name as a word of
their own may be prose, so that they have no label. The forest learns from the labelled
findings of all documents but a held-out fold (at most about `TRAINING` rows,
taken by a hash of the finding) and gives every candidate a probability. A
candidate is a secret if the forest takes it for one; where there are not
findings of both labels to learn from, the label decides.

All steps are DataFrame functions and the forest of the machine-learning
library. Word counts cover all documents. The dictionary holds the letter
triples of the `DICTIONARY` words in most documents and is broadcast; its size is bounded
by that number. Null and empty texts have no candidates; repeated rows have
theirs repeated; rows with one id keep their findings apart only by place
(`at` is the number of the word, `run` that of the finding in its word). An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stardw.llm.tables import stored

LEAST = 12
DICTIONARY = 5000
TRAINING = 200_000
TREES = 24
DEPTH = 8
FOLDS = 5

RUN = rf"[A-Za-z0-9+/_\-]{{{LEAST},}}"
# Published formats of keys; fixed values.
FORMATS = [
    r"^(AKIA|ASIA)[0-9A-Z]{16}$", r"^gh[pousr]_[A-Za-z0-9]{36,}$", r"^xox[abprs]-[A-Za-z0-9-]{10,}$",
    r"^AIza[0-9A-Za-z_\-]{35}$", r"^sk_(live|test)_[0-9A-Za-z]{16,}$", r"^eyJ[A-Za-z0-9_\-]{10,}",
]
NAMES = r"(?i:passw(?:or)?d|pwd|secret|token|api_?key|access_?key|credential)(?i:s?)"
QUOTE = r"\\*[\"'`]"
ENDS = rf"{NAMES}(?:{QUOTE})?"
# A name, what assigns and the value: up to its closing quote, or to a delimiter.
ASSIGNED = (
    rf"[A-Za-z0-9+/_\-]++(?<={NAMES})(?:{QUOTE})?[=:]+"
    r"(?:\\*\"[^\"\\]+|\\*'[^'\\]+|\\*`[^`\\]+|[^\s\"'`&;,<>{}()\[\]]+)"
)
VALUE = rf"^[A-Za-z0-9+/_\-]++(?:{QUOTE})?[=:]+(?:{QUOTE})?(.*?)[.:]*$"
# With possessive runs, a run without a name before an assignment is read once.
HIT = rf"{ASSIGNED}|[A-Za-z0-9+/_\-]{{{LEAST},}}+"
HARMLESS = [
    r"^[0-9_\-/]+$", r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
]
FEATURES = [
    "length", "digits", "uppers", "lowers", "kinds", "letter_to_digit", "digit_to_letter", "upper_to_lower",
    "lower_to_upper", "repeats", "covered", "slashes", "dots", "at_signs", "assigned", "quoted",
    "before_length", "before_open", "before_worded", "after_length", "after_worded", "edge",
]


def words(text: Column) -> Column:
    return F.split(text, r"[\x20\x09-\x0D]+")


def _opened(word: Column, before: Column, before2: Column) -> Column:
    """Whether the words before `word` assign it to a name."""
    apart = before.isin("=", ":", ":=", "=>") & before2.rlike(rf"{ENDS}$")
    return before.rlike(rf"{ENDS}[=:]+(?:{QUOTE})?$") | apart | (word.rlike("^[=:]+[^=:]") & before.rlike(rf"{ENDS}$"))


def _hits(word: Column, opened: Column) -> Column:
    """Array of (`value`, `named`, `open`) of one word; `open` where the words before name the value."""
    read = F.when(opened, F.concat(F.lit("token="), F.regexp_replace(word, "^[=:]+", ""))).otherwise(word)
    found = F.transform(F.regexp_extract_all(read, F.lit(HIT), F.lit(0)), lambda hit, i: F.struct(
        F.when(hit.rlike(f"^(?:{ASSIGNED})$"), F.regexp_extract(hit, VALUE, 1)).otherwise(hit).alias("value"),
        hit.rlike(f"^(?:{ASSIGNED})$").alias("named"),
        (opened & (i == 0) & hit.startswith("token=")).alias("open"),
    ))
    return F.filter(found, lambda hit: (hit["value"] != "") & (hit["named"] | hit["value"].rlike("[0-9]")))


def candidates(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, `at` (number of the word), `run` (number in the word), `word`, `value`, `named`, `open`, `hits`,
    and the words `before2`, `before`, `after`."""
    # Texts without any candidate are left out before they are split.
    body = F.col(text)
    some = documents.select(
        F.col(key).alias("key"), body.alias("text"), body.rlike(rf"{ENDS}\s*[=:]").alias("names")
    ).filter(F.col("names") | F.col("text").rlike(
        rf"(?=[A-Za-z+/_\-]{{0,40}}[0-9]){RUN}|[0-9][A-Za-z+/_\-]{{{LEAST - 1},}}"
    ))
    split = some.select("key", "names", words(F.col("text")).alias("words"))

    def beside(i: Column, by: int) -> Column:
        return F.coalesce(F.get("words", i + by), F.lit(""))

    def shown(word: Column, i: Column) -> Column:
        near = F.concat_ws(" ", beside(i, -2), beside(i, -1), word)
        wanted = (word.rlike("[0-9]") & word.rlike(RUN)) | (F.col("names") & near.rlike(rf"{ENDS}\s?[=:]"))
        return F.when(wanted, F.struct(
            word.alias("word"), beside(i, -2).alias("before2"), beside(i, -1).alias("before"),
            beside(i, 1).alias("after"),
        ))

    found = split.select("key", F.posexplode(F.transform("words", shown)).alias("at", "hit")).filter("hit is not null")
    found = found.select("key", "at", "hit.*")
    opened = _opened(F.col("word"), F.col("before"), F.col("before2"))
    found = found.withColumn("all", _hits(F.col("word"), opened)).withColumn("hits", F.size("all"))
    return found.select("*", F.posexplode("all").alias("run", "one")).select("*", "one.*").drop("all", "one")


def dictionary(documents: DataFrame, text: str = "text") -> DataFrame:
    """The letter triples (`triple`) of the words that stand in most documents."""
    counted = (
        documents.select(F.explode(F.array_distinct(words(F.lower(F.col(text))))).alias("word"))
        .filter(F.col("word").rlike("^[a-z]{3,}$")).groupBy("word").agg(F.count("*").alias("n"))
    )
    top = counted.orderBy(F.desc("n"), "word").limit(DICTIONARY)
    return top.select(F.explode(_triples(F.col("word"))).alias("triple")).distinct()


def _triples(word: Column) -> Column:
    at = F.sequence(F.lit(1), F.greatest(F.length(word) - 2, F.lit(1)))
    return F.transform(at, lambda i: F.substr(word, i, F.lit(3)))


def described(found: DataFrame, triples: DataFrame) -> DataFrame:
    """Candidates with their features."""
    value, word = F.col("value"), F.col("word")
    length = F.length(value).cast("double")

    def count(pattern: str, of: Column = value) -> Column:
        return F.coalesce(F.regexp_count(of, F.lit(pattern)), F.lit(0)).cast("double")

    def worded(of: Column) -> Column:
        return of.rlike("^[A-Za-z]+[.,:;=]?$").cast("double")

    plain = {
        "length": length, "digits": count("[0-9]") / length, "uppers": count("[A-Z]") / length,
        "lowers": count("[a-z]") / length,
        "kinds": sum((value.rlike(p).cast("double") for p in ("[0-9]", "[A-Z]", "[a-z]", r"[+/_\-]")), F.lit(0.0)),
        "letter_to_digit": count("[A-Za-z](?=[0-9])") / length, "digit_to_letter": count("[0-9](?=[A-Za-z])") / length,
        "upper_to_lower": count("[A-Z](?=[a-z])") / length, "lower_to_upper": count("[a-z](?=[A-Z])") / length,
        "repeats": count(r"(.)(?=\1)") / length,
        "slashes": count(r"[/\\]", word), "dots": count(r"\.", word), "at_signs": count("@", word),
        "assigned": word.rlike("[=:]").cast("double"), "quoted": word.rlike("[\"']").cast("double"),
        "before_length": F.length("before").cast("double"),
        "before_open": F.col("before").rlike("[=:]$").cast("double"), "before_worded": worded(F.col("before")),
        "after_length": F.length("after").cast("double"), "after_worded": worded(F.col("after")),
        "edge": ((F.col("before") == "") | (F.col("after") == "")).cast("double"),
    }
    # The share of the letter triples of a distinct value that the dictionary has.
    parts = found.select("value").distinct().select("value", F.explode(_triples(F.lower("value"))).alias("triple"))
    known = F.broadcast(triples.withColumn("known", F.lit(1.0)))
    cover = parts.join(known, "triple", "left").groupBy("value").agg(F.avg(F.coalesce("known", F.lit(0.0))).alias("covered"))
    return found.join(cover, "value").select("*", *[c.alias(n) for n, c in plain.items()])


def labelled(found: DataFrame) -> DataFrame:
    """Adds `label`: 1 for a certain secret, 0 for certainly none, null where neither is certain."""
    value, word = F.col("value"), F.col("word")
    format_ = F.lit(False)
    for pattern in FORMATS:
        format_ = format_ | value.rlike(pattern)
    prose = F.col("open") & value.rlike("^[A-Za-z]+[.!?]*$") & ~word.rlike(rf"^[=:]*(?:{QUOTE})")
    # An address tells nothing of other values in its word.
    harmless = word.rlike(r"@|://|^www\.") & ~((F.col("hits") > 1) & word.rlike("[;,{]")) & ~F.col("named")
    for pattern in HARMLESS:
        harmless = harmless | value.rlike(pattern)
    return found.withColumn("label", F.when(format_ | (F.col("named") & ~prose), 1).when(harmless, 0))


def scan(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every candidate: `key`, `at`, `run`, `value`, `label`, `held_out`, `probability`, `is_secret`."""
    found = candidates(documents, key, text)
    rows = stored(labelled(described(found, stored(dictionary(documents, text), "op9-dictionary"))), "op9-candidates")
    rows = rows.withColumn(
        "held_out", F.coalesce(F.crc32(F.col("key").cast("string")) % FOLDS == 0, F.lit(False))
    )
    learn = rows.filter("label is not null and not held_out")
    n, classes = learn.agg(F.count("*"), F.count_distinct("label")).first()
    decided = F.col("label") == 1
    shown = ["key", "at", "run", "value", "label", "held_out"]
    if classes < 2:
        return rows.select(*shown, F.lit(None).cast("double").alias("probability"),
                           F.coalesce(decided, F.lit(False)).alias("is_secret"))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features")
    share = min(1.0, TRAINING / n)
    picked = F.pmod(F.xxhash64("key", "at", "value"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1)
    sample = stored(
        learn.filter(picked).select(*FEATURES, F.col("label").cast("double").alias("label"), "key", "at", "run")
        .repartitionByRange(4, "key", "at").sortWithinPartitions("key", "at", "run"), "op9-training",
    )
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=7, subsamplingRate=1.0,
    ).fit(vectors.transform(sample).select("features", "label"))
    judged = forest.transform(vectors.transform(rows))
    return judged.select(
        *shown, vector_to_array("probability")[1].alias("probability"), (F.col("prediction") == 1).alias("is_secret")
    )
