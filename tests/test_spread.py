"""Rows dealt over as many tasks as the lines ask for: the plan, and the same rows as the SQL."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from check import TABLES, normal
from stardw.plans import model

FOLDER = "/root/testdata/sf0.001"
ACTIVITY = [
    "p37_factless_activity", "p38_coverage", "q21_coverage_by_region", "q22_idle_pairs", "q23_active_days",
    "v03_unique_grain",
]
MERGES = ["p22_fact_upsert", "p44_second_run_fact"]
STOCK = ["q08_to_reorder", "p29_snapshot_trend"]


@pytest.mark.parametrize("name", [*ACTIVITY, *MERGES, *STOCK])
def test_tasks_grow_with_the_lines(spark, monkeypatch, name):
    monkeypatch.setattr(model, "LINES_A_TASK", 500, raising=False)
    df = queries()[name](spark, FOLDER)
    assert "REPARTITION_BY_NUM" in df._jdf.queryExecution().executedPlan().toString()
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    result = db.execute(oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == normal(columns, result.fetchall())


def test_small_tables_are_left_alone(spark):
    assert "REPARTITION_BY_NUM" not in queries()["q23_active_days"](
        spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def test_late_events_are_dealt_by_member(spark, monkeypatch):
    plans = []
    written = model.Model.written
    monkeypatch.setattr(model, "LINES_A_TASK", 500)
    monkeypatch.setattr(model.Model, "written", lambda m, df: (
        plans.append(df._jdf.queryExecution().executedPlan().toString()), written(m, df))[1])
    df = queries()["p17_scd2_late_events"](spark, FOLDER)
    assert len(plans) == 3 and all("REPARTITION_BY_NUM" in p for p in plans)
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    result = db.execute(oracle_sql()["p17_scd2_late_events"])
    columns = [c[0] for c in result.description]
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == normal(columns, result.fetchall())
