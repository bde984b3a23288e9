from datetime import datetime

import pytest
from conftest import D, rows
from pyspark.sql import functions as F

from stardw import sources
from stardw.operators import quality
from stardw.operators.merge import current_state, merge_rows
from stardw.sources import writers
from stardw.sources.contracts import ID, MONEY, NUMBER, TEXT, contract

MEMBERS = contract(id=NUMBER, name=TEXT, address=TEXT, code=TEXT, amount=MONEY)
CSV = (
    "id,name,address,code,amount\n"
    '1,"Fuller, Andrew",12 Road,01581,12.50\n'
    '2,Suyama  ,"Coventry House\nMiner Rd.",02116,\n'
    'x3,"Said ""hi""",,00001,bad\n'
)


def test_csv_contract(spark, tmp_path):
    path = tmp_path / "members.csv"
    path.write_text(CSV)
    stamp = datetime(2024, 1, 1)
    df = sources.read_csv(
        spark, str(path), MEMBERS, multi_line=True, trim=["name"], cut={"address": 8},
        load_ts=stamp,
    )
    got = [tuple(str(v) for v in r[:-1]) for r in sorted(df.collect(), key=lambda r: r.code)]
    assert got == [
        ("None", 'Said "hi"', "None", "00001", "None"),
        ("1", "Fuller, Andrew", "12 Road", "01581", "12.50"),
        ("2", "Suyama", "Coventry", "02116", "None"),
    ]
    assert {r.load_ts for r in df.collect()} == {stamp}


def test_csv_without_multi_line_splits_the_row(spark, tmp_path):
    path = tmp_path / "members.csv"
    path.write_text(CSV)
    assert sources.read_csv(spark, str(path), MEMBERS).count() == 4


def test_conform_orders_casts_and_can_raise(frame):
    raw = frame([("a", "7"), ("b", "seven")], "name string, id string")
    shape = contract(id=ID, name=TEXT)
    assert rows(sources.conform(raw, shape)) == sorted([(7, "a"), (None, "b")], key=repr)
    try:
        sources.conform(raw, shape, strict=True).collect()
    except Exception as error:
        assert "CAST_INVALID_INPUT" in str(error)
    else:
        raise AssertionError("a strict cast must raise")


def test_missing_column_is_added_once(frame):
    wide = contract(id=NUMBER, flag=ID)
    once = sources.with_missing_columns(frame([(1,)], "id int"), wide)
    assert rows(sources.with_missing_columns(once, wide)) == [(1, None)]


def test_full_load_replaces_and_matches_by_name(frame, spark, tmp_path):
    path, shape = str(tmp_path / "t"), contract(id=NUMBER, name=TEXT)
    sources.full_load(frame([("a", 1), ("b", 2)], "name string, id int"), path, shape)
    sources.full_load(frame([("c", 3)], "name string, id int"), path, shape)
    assert rows(spark.read.parquet(path)) == [(3, "c")]


def test_append_drop_and_merge_of_partitions(frame, spark, tmp_path):
    path, ddl = str(tmp_path / "t"), "id int, v int, day int"
    sources.append_periods(frame([(1, 1, 1), (2, 1, 2), (3, 1, 3)], ddl), path, "day")
    sources.append_periods(frame([(4, 1, 3)], ddl), path, "day")
    before = {f.name for f in (tmp_path / "t" / "day=1").glob("*.parquet")}
    sources.merge_into_partitions(
        spark, path, frame([(2, 9, 2), (5, 5, 2)], ddl), "day", ["id"],
        lambda t, s: current_state(merge_rows(t, s, ["id"])),
    )
    assert rows(spark.read.parquet(path), "id", "v", "day") == [
        (1, 1, 1), (2, 9, 2), (3, 1, 3), (4, 1, 3), (5, 5, 2)
    ]
    # A partition the source does not touch is not rewritten.
    assert {f.name for f in (tmp_path / "t" / "day=1").glob("*.parquet")} == before
    sources.drop_periods(spark, path, "day", [3])
    assert rows(spark.read.parquet(path), "id") == [(1,), (2,), (5,)]


ODD = ["New York", "a b/c%d", "50%", "a:b", "é=ü", None]


@pytest.mark.parametrize("place", ODD)
def test_merge_moves_a_key_out_of_any_partition(frame, spark, tmp_path, place):
    """A key is in one partition only, also if its old one has a name that paths quote, or none."""
    path, ddl = str(tmp_path / "t"), "id int, v int, city string"
    sources.append_periods(frame([(1, 10, place), (2, 20, "x")], ddl), path, "city")
    sources.merge_into_partitions(
        spark, path, frame([(1, 11, "x")], ddl), "city", ["id"],
        lambda t, s: current_state(merge_rows(t, s, ["id"])),
    )
    assert rows(spark.read.parquet(path), "id", "v", "city") == [(1, 11, "x"), (2, 20, "x")]
    # Back again, into a partition that no longer exists.
    sources.merge_into_partitions(
        spark, path, frame([(1, 12, place)], ddl), "city", ["id"],
        lambda t, s: current_state(merge_rows(t, s, ["id"])),
    )
    assert rows(spark.read.parquet(path), "id", "v", "city") == [(1, 12, place), (2, 20, "x")]
    sources.drop_periods(spark, path, "city", [place])
    assert rows(spark.read.parquet(path), "id") == [(2,)]


def test_a_merge_that_breaks_off_leaves_no_key_twice(frame, spark, tmp_path, monkeypatch):
    path, ddl = str(tmp_path / "t"), "id int, v int, city string"
    sources.append_periods(frame([(1, 10, "old"), (2, 20, "new")], ddl), path, "city")

    def broken(*_):
        raise OSError("disk is gone")

    whole = writers.replace_partitions
    monkeypatch.setattr(writers, "replace_partitions", broken)
    with pytest.raises(OSError) as raised:
        sources.merge_into_partitions(
            spark, path, frame([(1, 11, "new")], ddl), "city", ["id"],
            lambda t, s: current_state(merge_rows(t, s, ["id"])),
        )
    assert rows(spark.read.parquet(path), "id") == [(2,)]
    staged = raised.value.__notes__[0].split()[-1]
    whole(spark.read.parquet(staged), path, "city")
    assert rows(spark.read.parquet(path), "id", "v", "city") == [(1, 11, "new"), (2, 20, "new")]


def test_dropping_a_period_that_is_not_there_is_an_error(frame, spark, tmp_path):
    path = str(tmp_path / "t")
    sources.append_periods(frame([(1, 1)], "id int, day int"), path, "day")
    with pytest.raises(LookupError):
        sources.drop_periods(spark, path, "day", [2])


def test_table_projection_renames(frame, spark, tmp_path):
    path = str(tmp_path / "t")
    frame([(1, 2, 3)], "`Order ID` int, a int, blob int").write.option(
        "parquet.enable.dictionary", True).parquet(path)
    df = sources.read_table(spark, path, {"Order ID": "order_id", "a": "amount"})
    assert rows(df) == [(1, 2)]
    scan = df._jdf.queryExecution().executedPlan().toString()
    assert "blob" not in scan


def test_inventory_and_window(frame):
    t = frame([(1, D("2020-01-01")), (2, D("2020-02-01"))], "id int, day date")
    assert rows(quality.inventory({"t": t, "u": t}, {"t": 2})) == sorted(
        [("t", 2, 2, True), ("u", 2, None, None)], key=repr)
    assert rows(quality.load_window({"t": (t, "day")})) == [
        ("t", D("2020-01-01"), D("2020-02-01"), 2)
    ]


def test_scan_prunes_and_pushes(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    from stardw.plans.model import Model

    orders = Model(spark, "/root/testdata/sf0.001").orders(before=D("1997-01-01"))
    plan = orders.select("order_id")._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(o_orderdate" in plan and "o_orderpriority" not in plan.split("ReadSchema")[1]
    assert orders.count() == df.filter(F.col("o_orderdate") < "1997-01-01").count()
