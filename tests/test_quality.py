from conftest import D, rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from stardw.operators import quality


def status(check):
    return check.first()["status"]


def test_faults_are_found(frame):
    fact = frame([(1, 10, 5.0), (2, 11, 6.0), (2, 99, 7.0)], "id int, dim int, v double")
    dim = frame([(10,), (11,)], "dim int")
    assert status(quality.expect_unique("grain", fact, ["id"])) == "FAIL"
    assert status(quality.expect_unique("grain", fact, ["id", "dim"])) == "PASS"
    assert status(quality.expect_fk("fk", fact, dim, "dim")) == "FAIL"
    assert status(quality.expect_fk("fk", fact.filter("dim < 50"), dim, "dim")) == "PASS"
    assert status(quality.expect_rows("bound", fact, F.col("v") < 6.5)) == "FAIL"
    assert status(quality.expect_rows("bound", fact, F.col("v") < 7.5)) == "PASS"
    assert status(quality.expect_count("n", fact, 3)) == "PASS"
    assert status(quality.expect_same_count("n", fact, dim)) == "FAIL"
    assert status(quality.expect_close("sum", fact, "v", fact, "v", 0.01)) == "PASS"
    assert status(quality.expect_close("sum", fact, "v", fact.filter("id = 1"), "v", 0.01)) == "FAIL"


def test_empty_total_fails(frame):
    fact = frame([(1, 5.0)], "id int, v double")
    assert status(quality.expect_close("sum", fact.filter("id = 9"), "v", fact, "v", 1)) == "FAIL"


def test_versions(frame):
    ddl = "id int, valid_from date, valid_to date, is_current boolean"
    good = frame([(1, D("1900-01-01"), D("2019-12-31"), False),
                  (1, D("2020-01-01"), D("9999-12-31"), True)], ddl)
    gap = frame([(1, D("1900-01-01"), D("2019-12-30"), False),
                 (1, D("2020-01-01"), D("9999-12-31"), True)], ddl)
    two = good.withColumn("is_current", F.lit(True))
    assert quality.version_gaps(good, "id").isEmpty()
    assert rows(quality.version_gaps(gap, "id"), "id", "next_from") == [(1, D("2020-01-01"))]
    assert status(quality.expect_one_current("c", good, "id")) == "PASS"
    assert status(quality.expect_one_current("c", two, "id")) == "FAIL"
    facts = frame([(1, D("2019-12-31"))], "id int, day date")
    assert status(quality.expect_cover("cover", facts, good, "id", "day")) == "PASS"
    assert status(quality.expect_cover("cover", facts, gap, "id", "day")) == "FAIL"


def test_date_cover_and_values(frame):
    dates = frame([(20200101,), (20201231,)], "date_key int")
    inside, outside = frame([(20200601,)], "k int"), frame([(20191231,)], "k int")
    assert status(quality.expect_date_cover("d", inside, "k", dates)) == "PASS"
    assert status(quality.expect_date_cover("d", outside, "k", dates)) == "FAIL"
    left = frame([(1, None), (2, "x")], "id int, now string")
    right = frame([(1, None), (2, "y")], "id int, city string")
    assert rows(quality.expect_equal_values("v", left, right, "id", {"now": "city"})) == [
        ("v", "FAIL", 1.0, 0.0)
    ]


def test_report_is_one_frame(frame):
    df = frame([(1,)], "id int")
    report = quality.run_checks([quality.expect_count("a", df, 1), quality.expect_count("b", df, 2)])
    assert rows(report, "no", "check", "status") == [(1, "a", "PASS"), (2, "b", "FAIL")]
    assert rows(quality.summary(report)) == [(2, 1, 1)]
    assert rows(quality.reconcile_counts({"t": (df, df)})) == [("t", 1, 1, True)]


def test_one_pass_equals_the_single_checks(spark, frame, tmp_path):
    fact = frame(
        [(n % 40, None if n == 5 else (7 if n % 3 == 0 else n % 9), float(n)) for n in range(60)],
        "id int, dim int, v double")
    dim = frame([(k, k == 2) for k in range(5)] + [(7, True), (7, True), (None, False)], "dim int, open boolean")
    for name, df in (("fact", fact), ("dim", dim)):
        df.write.parquet(str(tmp_path / name))
    tables = {n: spark.read.parquet(str(tmp_path / n)) for n in ("fact", "dim")}
    rows_seen = {n: Observation() for n in tables}
    report = quality.check_tables(tables, [
        quality.unique("grain", "fact", ["id"]),
        quality.unique("grain and value", "fact", ["id", "v"]),
        quality.holds("bound", "fact", F.col("v") < 50),
        quality.holds("no null breaks it", "fact", F.col("dim") >= 0),
        quality.refers("fk", "fact", ["dim"], "dim", ["dim"]),
        quality.unique("one open", "dim", ["dim"], F.col("open")),
        quality.refers("back", "dim", ["dim"], "fact", ["dim"]),
    ], rows_seen)
    single = quality.run_checks([
        quality.expect_unique("grain", fact, ["id"]),
        quality.expect_unique("grain and value", fact, ["id", "v"]),
        quality.expect_rows("bound", fact, F.col("v") < 50),
        quality.expect_rows("no null breaks it", fact, F.col("dim") >= 0),
        quality.expect_fk("fk", fact, dim, "dim"),
        quality.expect_unique("one open", dim.filter("open"), ["dim"]),
        quality.expect_fk("back", dim, fact, "dim"),
    ])
    assert rows(report, *single.columns) == rows(single)
    assert rows(report, "value") == rows(single, "value")
    plan = report._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("Initial Plan")[0]
    assert initial.count("Scan parquet") == len(tables)
    report.collect()
    assert {n: o.get["rows"] for n, o in rows_seen.items()} == {"fact": 60, "dim": 8}


def test_one_pass_over_empty_tables_passes(frame):
    none = frame([], "id int")
    report = quality.check_tables({"t": none, "u": none}, [
        quality.unique("a", "t", ["id"]), quality.refers("b", "t", ["id"], "u", ["id"]),
        quality.holds("c", "u", F.col("id") > 0)])
    assert rows(report, "no", "check", "status", "value") == [
        (1, "a", "PASS", 0.0), (2, "b", "PASS", 0.0), (3, "c", "PASS", 0.0)]
