import random
from datetime import date, timedelta

import pytest
from conftest import D, rows, same_rows
from pyspark.sql import functions as F

from stardw.operators import asof
from stardw.operators.skew import hot_keys, join_split

VERSIONS = "id string, v string, valid_from date, valid_to date, is_current boolean"
FACTS = "n int, id string, day date"
CUT = D("2020-06-15")


@pytest.fixture
def versions(frame):
    return frame(
        [
            ("A", "old", D("1900-01-01"), CUT - timedelta(1), False),
            ("A", "new", CUT, D("9999-12-31"), True),
            ("B", "late", D("2020-03-01"), D("9999-12-31"), True),
            ("G", "one", D("2019-01-01"), D("2019-06-30"), False),
            ("G", "two", D("2020-01-01"), D("9999-12-31"), True),
        ],
        VERSIONS,
    )


@pytest.fixture
def facts(frame):
    return frame(
        [
            (1, "A", CUT - timedelta(1)), (2, "A", CUT), (3, "A", CUT + timedelta(1)),
            (4, "B", D("2020-02-29")), (5, "B", D("2020-03-01")), (6, "G", D("2019-06-30")),
            (7, "G", D("2019-07-01")), (8, "X", CUT), (9, "A", None),
        ],
        FACTS,
    )


FORMS = ["range", "bucket", "lookup", "carried"]
MATCHED = [(1, "old"), (2, "new"), (3, "new"), (5, "late"), (6, "one")]


@pytest.mark.parametrize("form", FORMS)
def test_both_ends_of_a_version_match(facts, versions, form):
    out = asof.as_of_join(facts, versions, "id", "day", ["v"], form=form)
    assert rows(out, "n", "v") == MATCHED
    assert set(out.columns) == {"n", "id", "day", "v"}


@pytest.mark.parametrize("form", FORMS)
def test_left_keeps_facts_without_a_version(facts, versions, form):
    out = asof.as_of_join(facts, versions, "id", "day", ["v"], how="left", form=form)
    missing = [(n, None) for n in (4, 7, 8, 9)]
    assert rows(out, "n", "v") == sorted(MATCHED + missing, key=repr)


def test_unmatched_is_the_rest(facts, versions):
    assert rows(asof.unmatched(facts, versions, "id", "day"), "n") == [(4,), (7,), (8,), (9,)]


def test_current_join_uses_the_open_version(facts, versions):
    out = asof.current_join(facts, versions, "id", ["v"])
    assert rows(out.filter("id = 'A'"), "v") == [("new",)] * 4


def skewed(spark, n=6000):
    """A third of the facts belong to one member, and a third of those to one day."""
    rng = random.Random(7)
    start = date(2015, 1, 1)
    data = []
    for i in range(n):
        hot = i % 3 == 0
        day = start if i % 9 == 0 else start + timedelta(rng.randrange(2000))
        data.append((i, "HOT" if hot else f"m{rng.randrange(50)}", day))
    versions = []
    for member in ["HOT", *[f"m{k}" for k in range(50)]]:
        days = sorted(rng.sample(range(2000), 40 if member == "HOT" else 4))
        starts = [date(1900, 1, 1), *[start + timedelta(d) for d in days]]
        for k, begin in enumerate(starts):
            last = k + 1 == len(starts)
            end = date(9999, 12, 31) if last else starts[k + 1] - timedelta(1)
            versions.append((member, f"{member}-{k}", begin, end, last))
    return (
        data, versions, spark.createDataFrame(data, FACTS),
        spark.createDataFrame(versions, VERSIONS),
    )


def test_all_forms_agree_with_brute_force_on_a_hot_member(spark):
    data, versions, facts, dim = skewed(spark)
    by_member = {}
    for member, v, begin, end, _ in versions:
        by_member.setdefault(member, []).append((v, begin, end))
    wanted = sorted(
        ((n, v) for n, member, day in data for v, begin, end in by_member[member]
         if begin <= day <= end), key=repr,
    )
    # A list of hot keys says for each over how many tasks its rows are dealt.
    hot = hot_keys(facts, ["id"], share=10, rows_per_task=500)
    assert rows(hot) == [("HOT", 4)]
    hot_days = hot_keys(facts, ["id", "day"], share=10)
    assert rows(hot_days) == [("HOT", date(2015, 1, 1), 2)]
    for form, marked in [
        ("range", None), ("bucket", None), ("lookup", None), ("range", hot), ("bucket", hot),
        ("lookup", hot_days), ("lookup", hot),
    ]:
        out = asof.as_of_join(
            facts, dim, "id", "day", ["v"], form=form, hot=marked, spread_by=["n"]
        )
        assert rows(out, "n", "v") == wanted, (form, marked)


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_versions_are_carried_over_the_edges_of_ranges(spark, parts):
    """A hot member on one day, a member without versions, NULLs and days before the first version."""
    data, versions, _, _ = skewed(spark, 2000)
    data = [(n, m, date(2016, 3, 1) if m == "HOT" and n % 2 else d) for n, m, d in data]
    versions = [v for v in versions if v[2] > date(1900, 1, 1) or v[0] != "HOT"]
    data += [(9000, "HOT", date(1950, 1, 1)), (9001, None, date(2016, 1, 1)), (9002, "HOT", None),
             (9003, "none", date(2016, 1, 1)), (9004, "m1", date(1900, 1, 1))]
    data += [(9005, "HOT", date(2016, 3, 1))] * 3
    versions += [(None, "null", date(1900, 1, 1), date(9999, 12, 31), True)]
    wanted = []
    for n, member, day in data:
        hits = [v for k, v, a, b, _ in versions if k is not None and k == member and day and a <= day <= b]
        wanted.append((n, hits[0] if hits else None))
    frames = spark.createDataFrame(data, FACTS), spark.createDataFrame(versions, VERSIONS)
    left = asof.as_of_join(*frames, "id", "day", ["v"], how="left", form="carried", parts=parts)
    assert rows(left, "n", "v") == sorted(wanted, key=repr)
    inner = asof.as_of_join(*frames, "id", "day", ["v"], form="carried", parts=parts)
    assert rows(inner, "n", "v") == sorted([w for w in wanted if w[1]], key=repr)


def test_a_hot_member_spans_many_ranges(spark, tmp_path, monkeypatch):
    _, _, facts, dim = skewed(spark)
    monkeypatch.setattr(asof, "work_folder", lambda spark, name: str(tmp_path / name))
    asof.as_of_join(facts, dim, "id", "day", ["v"], form="carried", parts=12).count()
    ranges = spark.read.parquet(str(tmp_path / "as-of-ranges")).groupBy("_part").agg(
        F.count("*").alias("n"), F.max(F.col("_key") == "HOT").alias("hot"))
    assert ranges.filter("hot").count() >= 4
    assert ranges.agg(F.max("n")).first()[0] < 2 * 6000 / 12 + 300


def test_hot_key_is_dealt_to_many_places(spark):
    _, _, facts, _ = skewed(spark)
    lookup = facts.select("id").distinct().withColumn("label", F.upper("id"))
    hot = hot_keys(facts, ["id"], share=10, rows_per_task=250)
    assert rows(hot) == [("HOT", 8)]
    joined = join_split(facts, lookup, ["id"], hot, ["n"])
    assert same_rows(joined.select("n", "label"), facts.select("n", F.upper("id").alias("label")))
    salts = facts.filter("id = 'HOT'").select(F.pmod(F.xxhash64("n"), F.lit(8))).distinct()
    assert salts.count() == 8
    left = join_split(facts, lookup.filter("id <> 'm1'"), ["id"], hot, ["n"], how="left")
    assert left.count() == facts.count()


def test_left_join_on_hot_keys_keeps_a_null_member(spark):
    """Neither a NULL member nor a day before the first version has a version; both stay."""
    facts = spark.createDataFrame(
        [(n, None if n % 3 == 0 else "A", D("2020-01-01") if n % 2 else D("1990-01-01"))
         for n in range(30)], FACTS)
    versions = spark.createDataFrame(
        [("A", "one", D("2000-01-01"), D("9999-12-31"), True), (None, "none", D("1900-01-01"), D("9999-12-31"), True)],
        VERSIONS)
    wanted = sorted(((n, "one" if n % 3 and n % 2 else None) for n in range(30)), key=repr)
    hot = hot_keys(facts, ["id"], share=10)
    for form in FORMS:
        out = asof.as_of_join(
            facts, versions, "id", "day", ["v"], how="left", form=form, hot=hot, spread_by=["n"])
        assert rows(out, "n", "v") == wanted, form


def test_hot_keys_are_bounded_by_the_share(spark):
    even = spark.range(1000).withColumn("k", F.col("id") % 10)
    assert hot_keys(even, ["k"], share=10).count() == 0  # exactly one in ten is not more
    assert hot_keys(even, ["k"], share=11).count() == 10
