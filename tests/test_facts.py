from datetime import date
from decimal import Decimal

import pytest
from conftest import D, rows, same_rows
from pyspark.sql import functions as F

from __spark_entry__ import queries
from stardw.functions import date_key, discount_band, mean, ship_mode
from stardw.operators import bridge, facts, junk
from stardw.operators.merge import action_counts, current_state
from stardw.plans import reports

ORDER = "order_id int, order_date date, required_date date, shipped_date date"


def orders(frame, shipped):
    df = frame([(1, D("2020-01-01"), D("2020-01-29"), shipped)], ORDER)
    return df.select("order_id", *facts.milestones())


def test_milestones_are_null_while_pending(frame):
    assert rows(orders(frame, None)) == [(1, 20200101, 20200129, None, None, None)]


def test_milestone_life_cycle(frame):
    state = orders(frame, None)
    for shipped, key, days, late in [
        (D("2020-02-10"), 20200210, 40, True),   # arrives late
        (D("2020-01-20"), 20200120, 19, False),  # corrected
        (None, None, None, None),                # withdrawn
    ]:
        merged = facts.milestone_merge(state, orders(frame, shipped))
        assert rows(action_counts(merged)) == [("updated", 1)]
        state = current_state(merged)
        assert rows(state, "shipped_date_key", "days_to_ship", "is_late") == [(key, days, late)]
        again = facts.milestone_merge(state, orders(frame, shipped))
        assert rows(action_counts(again)) == [("kept", 1)]


def test_shipped_on_the_required_day_is_not_late(frame):
    assert rows(orders(frame, D("2020-01-29")), "is_late") == [(False,)]


def test_upsert_on_grain_rejects_a_duplicate(frame):
    ddl = "order_id int, product_id int, quantity int"
    target = frame([(1, 1, 5), (1, 2, 6)], ddl)
    merged = facts.upsert_fact(target, frame([(1, 2, 7), (2, 1, 8)], ddl), ["order_id", "product_id"])
    assert rows(current_state(merged)) == [(1, 1, 5), (1, 2, 7), (2, 1, 8)]
    with pytest.raises(Exception, match="key twice"):
        facts.upsert_fact(
            target, frame([(1, 2, 7), (1, 2, 8)], ddl), ["order_id", "product_id"]
        ).collect()


@pytest.fixture
def stock(frame):
    state = frame(
        [(1, 10, 5), (2, 5, 5), (3, 4, 5), (4, 0, 0)],
        "product_id int, units_in_stock int, reorder_level int",
    )
    keys = state.select(
        "product_id", (F.col("product_id") + 100).alias("product_sk"),
        F.lit(7).cast("bigint").alias("category_sk"),
    )
    return lambda day: facts.stock_snapshot(state, F.lit(day), keys)


def test_reorder_at_or_below_the_level(stock):
    out = stock(D("2020-01-31"))
    assert rows(out, "product_sk", "needs_reorder") == [
        (101, False), (102, True), (103, True), (104, True)
    ]


def test_snapshot_of_a_loaded_day_adds_nothing(stock):
    table = stock(D("2020-01-31"))
    for day, total in [("2020-02-29", 8), ("2020-01-31", 8), ("2019-12-31", 12)]:
        table = table.unionByName(facts.append_snapshot(table, stock(D(day))))
        assert table.count() == total
    assert rows(facts.snapshot_as_of(table, 20200215), "snapshot_date_key") == [(20200131,)] * 4
    trend = rows(facts.snapshot_trend(table), "snapshot_date_key", "products", "to_reorder")
    assert trend == [(20191231, 4, 3), (20200131, 4, 3), (20200229, 4, 3)]
    assert facts.drop_snapshot(table, 20200131).count() == 8
    copied = facts.copy_snapshot(table, 20200229, D("2020-03-31"))
    assert rows(copied, "snapshot_date_key") == [(20200331,)] * 4
    assert copied.join(table, "stock_sk", "left_semi").isEmpty()


def test_appended_snapshots_are_not_shuffled_by_period(spark):
    """Periods are few and facts are not: a shuffle by period wrote the whole fact into one task for each."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables too large for Spark to send by itself
    try:
        df = queries()["p26_stock_snapshots"](spark, "/root/testdata/sf0.001")
        plan = df._jdf.queryExecution().executedPlan().toString()
        found = df.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert len(found) == len({r.stock_sk for r in found})
    assert {r.snapshot_date_key < 19980101 for r in found} == {True, False}
    assert all(f.endswith(".zstd.parquet") for f in df.inputFiles())


def test_month_end_levels_fill_months_without_movement(frame):
    moves = frame(
        [(1, D("2020-01-10"), 30), (1, D("2020-01-20"), 5), (1, D("2020-04-02"), 80),
         (2, D("2020-03-31"), 10)],
        "product_id int, moved_on date, quantity int",
    )
    # Levels are the plain sums of signed movements, with no cap.
    assert rows(facts.month_end_levels(moves)) == sorted([
        (1, date(2020, 1, 31), 35), (1, date(2020, 2, 29), 35), (1, date(2020, 3, 31), 35),
        (1, date(2020, 4, 30), 115), (2, date(2020, 3, 31), 10), (2, date(2020, 4, 30), 10),
    ], key=repr)
    signed = frame([(1, D("2020-01-10"), 150), (1, D("2020-02-20"), -20)], "product_id int, moved_on date, quantity int")
    assert rows(facts.month_end_levels(signed), "units_in_stock") == [(130,), (150,)]


def test_bands_at_the_edges(frame):
    discounts = ["0", "0.05", "0.0501", "0.15", "0.1501"]
    lines = frame(
        [(Decimal(d), Decimal(n), c) for d in discounts for n in ("1000", "1000.01")
         for c in (1, 2, 3, None)],
        "discount decimal(5,4), net decimal(18,4), ship_via int",
    )
    flagged = junk.with_flags(lines)
    assert rows(flagged.select("discount", "discount_band").distinct()) == sorted([
        (Decimal("0.0000"), "None"), (Decimal("0.0500"), "Low"), (Decimal("0.0501"), "Medium"),
        (Decimal("0.1500"), "Medium"), (Decimal("0.1501"), "High"),
    ], key=repr)
    assert rows(flagged.select("net", "is_high_value").distinct()) == sorted(
        [(Decimal("1000.0000"), False), (Decimal("1000.0100"), True)], key=repr)
    assert rows(flagged.filter("ship_via is null").select("ship_mode").distinct()) == [
        ("Economy",)
    ]


def test_flag_dimension_keys_and_growth(spark, frame):
    flags = junk.flags_dimension(spark)
    assert flags.count() == 24 and flags.select("order_flags_sk").distinct().count() == 24
    lines = frame([(Decimal("0.2"), Decimal("5"), 1), (Decimal("0"), Decimal("5"), 9)],
                  "discount decimal(5,4), net decimal(18,4), ship_via int")
    assert junk.assign_flags(lines, flags).filter("order_flags_sk is null").isEmpty()
    grown = junk.grow_flags(flags.filter("false"), lines)
    assert grown.count() == 2
    assert same_rows(junk.grow_flags(grown, lines), grown)
    assert same_rows(junk.grow_flags(flags, lines), flags)


def test_only_missing_keeps_a_stale_key(spark, frame):
    lines = frame([(Decimal("0.2"), Decimal("5"), 1, 99), (Decimal("0.2"), Decimal("5"), 1, None)],
                  "discount decimal(5,4), net decimal(18,4), ship_via int, order_flags_sk bigint")
    flags = junk.flags_dimension(spark)
    kept = {r[0] for r in rows(junk.assign_flags(lines, flags, only_missing=True),
                               "order_flags_sk")}
    fresh = {r[0] for r in rows(junk.assign_flags(lines, flags), "order_flags_sk")}
    assert len(kept) == 2 and 99 in kept and len(fresh) == 1 and fresh < kept


@pytest.fixture
def pairs(frame):
    """Two members and three territories; member 2 never works in territory 3."""
    return frame([(1, 1), (1, 2), (2, 2), (2, 3)], "employee_sk bigint, territory_sk bigint")


def test_bridge_is_distinct_and_weighted(pairs, frame):
    source = frame([(1, 10), (1, 10), (1, 20)], "employee_id int, territory_id int")
    employees = frame([(1, 100)], "employee_id int, employee_sk int")
    territories = frame([(10, 1), (20, 2)], "territory_id int, territory_sk int")
    assert rows(bridge.load_bridge(source, employees, territories)) == [(100, 1), (100, 2)]
    weighted = bridge.with_weight(pairs).groupBy("employee_sk").agg(F.sum("weight").alias("w"))
    assert rows(weighted, "w") == [(1.0,), (1.0,)]


def test_weighted_revenue_reconciles(pairs, frame):
    sales = frame([(1, 1, Decimal("10")), (2, 1, Decimal("5")), (3, 2, Decimal("7"))],
                  "order_id int, employee_sk bigint, net decimal(18,4)")
    names = frame([(1, "x"), (2, "y"), (3, "z")], "territory_sk bigint, territory_name string")
    out = reports.territory_revenue(sales, bridge.with_weight(pairs), names)
    assert out.agg(F.sum("net")).first()[0] == 44  # each sale once per territory
    assert out.agg(F.sum("weighted_net")).first()[0] == 22
    assert rows(out, "territory_name", "orders") == [("x", 2), ("y", 3), ("z", 1)]


def test_what_did_not_happen(pairs, frame):
    activity = frame(
        [(20200101, 1, 1), (20200102, 1, 2), (20200201, 2, 2), (20200201, 9, 9)],
        "activity_date_key int, employee_sk bigint, territory_sk bigint",
    )
    idle = bridge.never_active(pairs, activity, ["employee_sk", "territory_sk"])
    assert rows(idle) == [(2, 3)]
    cover = facts.coverage(activity, pairs, F.floor(F.col("activity_date_key") / 100))
    assert rows(cover, "period", "active_pairs", "expected_pairs", "coverage") == [
        (202001, 2, 4, 0.5), (202002, 1, 4, 0.25)
    ]
    months = reports.idle_months(
        pairs, activity, ["employee_sk", "territory_sk"],
        F.floor(F.col("activity_date_key") / 100), F.lit(2),
    )
    assert rows(months, "employee_sk", "territory_sk", "idle_months") == [
        (1, 1, 1), (1, 2, 1), (2, 2, 1), (2, 3, 2)
    ]


def test_activity_is_distinct_and_added_once(frame):
    events = frame([(D("2020-01-01"), 1, 5), (D("2020-01-01"), 1, 5), (D("2020-01-02"), 1, 5)],
                   "activity_date date, employee_id int, territory_id int")
    who = frame([(1, 10)], "employee_id int, employee_sk int")
    where = frame([(5, 50)], "territory_id int, territory_sk int")
    fact = facts.activity_fact(events, who, where)
    assert rows(fact) == [(20200101, 10, 50), (20200102, 10, 50)]
    assert same_rows(current_state(facts.add_activity(fact, fact)), fact)


def test_small_functions(frame):
    df = frame([(D("2020-02-29"), Decimal("0.1"), 2), (None, None, None)],
               "day date, d decimal(5,4), code int")
    assert rows(df.select(date_key(F.col("day")), discount_band(F.col("d")),
                          ship_mode(F.col("code")))) == sorted(
        [(20200229, "Medium", "Standard"), (None, "High", "Economy")], key=repr)
    assert df.agg(mean(F.col("d"))).first()[0] == 0.1
    assert df.filter("code > 5").agg(mean(F.col("d"))).first()[0] is None


def test_price_versions_and_their_sales(frame):
    versions = frame(
        [(1, "P", 18.0, D("1900-01-01"), D("2019-12-31")), (2, "P", 99.99, D("2020-01-01"),
         D("9999-12-31")), (3, "Q", 5.0, D("1900-01-01"), D("9999-12-31"))],
        "sk bigint, product string, price double, valid_from date, valid_to date",
    )
    sold = frame([(1, Decimal("36")), (2, Decimal("99.99"))], "sk bigint, net decimal(18,4)")
    out = reports.version_sales(versions, sold, "sk")
    assert rows(out, "price", "sales", "net") == sorted([
        (18.0, 1, Decimal("36.0000")), (99.99, 1, Decimal("99.9900")), (5.0, 0, Decimal("0.0000")),
    ], key=repr)


def test_rank_keeps_ties(frame):
    totals = frame([("a", 5), ("b", 5), ("c", 3), ("d", 1)], "k string, net int")
    assert rows(reports.ranked(totals, "net", top=2), "k", "place") == [("a", 1), ("b", 1)]
    assert rows(reports.ranked(totals, "net", top=3), "k") == [("a",), ("b",), ("c",)]


def test_revenue_of_a_null_group_is_kept(frame):
    sales = frame([(1, None, Decimal("2"), Decimal("1"), Decimal("0.5"))],
                  "order_id int, category string, gross decimal(18,2), net decimal(18,4), "
                  "discount decimal(5,4)")
    assert rows(reports.revenue_by(sales, ["category"]), "category", "orders") == [(None, 1)]
