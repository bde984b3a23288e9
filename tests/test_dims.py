from datetime import date

from conftest import D, rows
from pyspark.sql import functions as F

from stardw.functions import dense_key, divide_half_up, surrogate_key, to_decimal, units
from stardw.operators import dims
from stardw.sources import date_series


def test_calendar_of_forty_one_years(spark):
    days = date_series(spark, date(1990, 1, 1), date(2030, 12, 31))
    dates = dims.date_dimension(days)
    assert dates.count() == 14975
    assert dates.select("date_key").distinct().count() == 14975
    leap = dates.filter("date_key = 20000229").first().asDict()
    assert leap == {
        "date_key": 20000229, "full_date": date(2000, 2, 29), "year": 2000, "quarter": 1,
        "month": 2, "month_name": "February", "day": 29, "weekday": 1, "day_name": "Tuesday",
        "is_weekend": False,
    }
    assert rows(dates.filter("is_weekend").select("day_name", "weekday").distinct()) == [
        ("Saturday", 5), ("Sunday", 6)
    ]


def test_members_with_manager_list_and_region(frame):
    employees = frame(
        [(1, "Ada", 2), (2, "Bob", None), (3, "Cy", 2), (4, "Di", 3), (5, "Eve", 3)],
        "employee_id int, full_name string, reports_to int",
    )
    places = frame(
        [(10, "Westboro   ", "Eastern  "), (11, " Bedford", "Eastern"), (12, "Aspen", "Central")],
        "territory_id int, territory_name string, region_name string",
    )
    pairs = frame([(1, 10), (1, 11), (2, 12), (3, 10), (3, 12), (4, 11)],
                  "employee_id int, territory_id int")
    trimmed = places.withColumn("region_name", F.trim("region_name"))
    out = dims.employee_dimension(employees, pairs, trimmed)
    assert rows(out, "full_name", "manager_name", "territory_list", "region_name") == sorted([
        ("Ada", "Bob", "Bedford, Westboro", "Eastern"),
        ("Bob", None, "Aspen", "Central"),
        ("Cy", "Bob", "Aspen, Westboro", "Central"),  # two regions, still one row
        ("Di", "Cy", "Bedford", "Eastern"),
        ("Eve", "Cy", None, None),
    ], key=repr)


def test_territories_are_trimmed_and_kept_without_region(frame):
    territories = frame([("01581", "Westboro  ", 1), ("99999", "Lost", None)],
                        "territory_id string, territory_name string, region_id int")
    regions = frame([(1, "Eastern   ")], "region_id int, region_name string")
    assert rows(dims.territory_dimension(territories, regions), "territory_id",
                "territory_name", "region_name") == [
        ("01581", "Westboro", "Eastern"), ("99999", "Lost", None)
    ]


def test_roles_rename_and_keep_rows(spark):
    dates = dims.date_dimension(date_series(spark, D("2020-01-01"), D("2020-01-31")))
    shipped = dims.as_role(dates, "shipped")
    assert shipped.columns[0] == "shipped_date_key"
    assert rows(dims.role_counts(dates, {"shipped": shipped})) == [("base", 31), ("shipped", 31)]


def test_surrogate_key_tells_null_from_text(spark):
    df = spark.sql("SELECT 'a' x, cast(null as string) y UNION ALL SELECT 'a', 'n'")
    keys = df.select(surrogate_key("x", "y").alias("k"), surrogate_key("y", "x").alias("j"))
    assert len({v for r in keys.collect() for v in r}) == 4
    assert keys.filter("k < 0 or k >= 1152921504606846976").isEmpty()


def test_dense_key_has_no_gaps(spark):
    df = dense_key(spark.range(5000).withColumnRenamed("id", "n"), "n", "no")
    ends = df.agg(F.min("no"), F.max("no"), F.count_distinct("no")).first()
    assert tuple(ends) == (1, 5000, 5000)


def test_money_units(frame):
    df = frame([(0.1 + 0.2,), (1234567.89,), (-2.5,), (None,)], "x double")
    assert [str(r[0]) for r in df.select(to_decimal(units(F.col("x"), 2), 2)).collect()] == [
        "0.30", "1234567.89", "-2.50", "None"
    ]
    halves = frame([(5, 2), (-5, 2), (7, 3), (1, 3), (0, 9)], "a bigint, b bigint")
    assert [r[0] for r in halves.select(divide_half_up(F.col("a"), F.col("b"))).collect()] == [
        3, -3, 2, 0, 0
    ]
