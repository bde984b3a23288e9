"""Registered queries beside their SQL twins, on the smallest tables.

One query of each kind by default; STARDW_ALL_QUERIES=1 takes all of them, as
`check.py` does on larger tables.
"""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, normal
from stardw import suite

FOLDER = "/root/testdata/sf0.001"
NAMES = sorted(queries())
if not os.environ.get("STARDW_ALL_QUERIES"):
    NAMES = [
        "a01_csv_scan", "a20_change_feed", "b14_parameters", "c04_point_in_time_bucket",
        "c04_point_in_time_lookup_split", "d02_distinct_counts", "f13_f14_hash_key",
        "o02_top_n", "p08_employee_dimension", "p16_scd2_close_missing", "p16_scd2_customer",
        "p17_scd2_product_history", "p19_scd3_rotate", "p21_sales_fact", "p22_fact_upsert",
        "p24_milestone_merge", "p29_snapshot_trend", "p38_coverage", "q01_revenue_by_category",
        "q02_top_customers", "q05_price_history", "q07_seasonality", "q14_revenue_by_territory",
        "q22_idle_pairs", "v17_check_report", "w02_rank_filter", "x04_version_difference",
    ]


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return db


def test_every_query_has_a_twin():
    """The queries of the warehouse, that is; those of other packages state theirs themselves."""
    assert set(suite.oracles()) == set(suite.registered())
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    df = queries()[name](spark, FOLDER)
    result = duck.execute(oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == normal(
        columns, result.fetchall()
    )


@pytest.mark.parametrize("name", [n for n in NAMES if n[0] in "bcdoqw"])
def test_plan_has_no_cross_join_and_no_python(spark, name):
    plan = queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert word not in plan
