"""The warehouse load: a graph of steps, each written aside, all switched to at once.

A load writes every table to a folder of its own. Readers follow the manifest of
the warehouse, which names the folder of each table and is written when the last
step is done: until then they see the tables of the load before, all of one load.
A finished step has a log row written after its data, so that a load that broke off
and is run again with the same number continues at its first unfinished step.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from graphlib import TopologicalSorter

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stardw.operators import bridge, facts
from stardw.plans.model import Model
from stardw.sources import conform
from stardw.sources.contracts import WAREHOUSE
from stardw.sources.manifest import Manifest, newest, read_live, switch

LOG = (
    "load string, step string, started timestamp, seconds double, rows bigint, status string, "
    "message string"
)

Stored = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Step:
    """One table: what it is built from, and how, from the stored tables that it `needs`."""

    name: str
    schema: StructType
    build: Callable[[Stored], DataFrame]
    needs: tuple[str, ...] = ()


def table(spark: SparkSession, folder: str, name: str, schema: StructType | None = None) -> DataFrame:
    """A table as the last complete load left it."""
    return read_live(spark, folder, schema or WAREHOUSE[name], [name])


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """One row per load and step; of a step that was run again, the last run."""
    return spark.read.schema(LOG).option("recursiveFileLookup", True).parquet(f"{folder}/log")


def finished(spark: SparkSession, folder: str, load: str) -> dict[str, int]:
    """Rows of the steps that a load has done; as many as the graph has steps."""
    try:
        done = run_log(spark, folder).filter((F.col("load") == load) & (F.col("status") == "ok"))
        return {r.step: r.rows for r in done.select("step", "rows").collect()}
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}


def run_step(
    spark: SparkSession, folder: str, step: Step, load: str, load_ts: datetime, stored: Stored
) -> int:
    """Build and write one table aside and log it; an error is logged and raised again.

    The rows are counted while they are written.
    """
    begun, rows, status, message = time.monotonic(), None, "ok", ""
    try:
        counted = Observation()
        built = conform(step.build(stored), step.schema).observe(counted, F.count(F.lit(1)).alias("rows"))
        built.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{place(load, step.name)}")
        rows = counted.get["rows"]
    except Exception as error:
        status, message = "error", str(error)
        raise
    finally:
        entry = spark.createDataFrame(
            [(load, step.name, load_ts, time.monotonic() - begun, rows, status, message)], LOG
        )
        entry.coalesce(1).write.mode("overwrite").parquet(f"{folder}/log/load={load}/step={step.name}")
    return rows


def place(load: str, name: str) -> str:
    return f"data/load={load}/{name}"


def in_order(steps: Sequence[Step]) -> list[Step]:
    """The steps such that each comes after those it needs; a circle or an unknown need is an error."""
    by_name = {s.name: s for s in steps}
    unknown = {n for s in steps for n in s.needs} - by_name.keys()
    if unknown:
        raise LookupError(f"no step builds {sorted(unknown)}")
    return [by_name[n] for n in TopologicalSorter({s.name: s.needs for s in steps}).static_order()]


def run_steps(
    spark: SparkSession, folder: str, steps: Sequence[Step], load_ts: datetime, load: str | None = None
) -> list[str]:
    """Run a load, or what is left of it, and switch the warehouse to its tables.

    `load` names it, by default after `load_ts`; the same name continues a load
    that broke off. Returns the steps that were run. A step sees only the tables
    that it needs, those of this load.
    """
    load = load or load_ts.strftime("%Y%m%dT%H%M%S")
    before = newest(spark, folder)
    if before.label == load:
        return []
    done = finished(spark, folder, load)
    schemas, ran = {s.name: s.schema for s in steps}, []
    for step in in_order(steps):
        if step.name in done:
            continue

        def stored(name: str, needs: tuple[str, ...] = step.needs) -> DataFrame:
            if name not in needs:
                raise LookupError(f"{name} is not among the needs {needs}")
            return spark.read.schema(schemas[name]).parquet(f"{folder}/{place(load, name)}")

        done[step.name] = run_step(spark, folder, step, load, load_ts, stored)
        ran.append(step.name)
    pieces = {s.name: (place(load, s.name), done[s.name]) for s in steps}
    switch(spark, folder, Manifest(before.number + 1, load, pieces))
    return ran


def warehouse(model: Model) -> list[Step]:
    """Dimensions, then facts from the stored dimensions, then what builds on the facts."""
    def step(name: str, build: Callable[[Stored], DataFrame], *needs: str) -> Step:
        return Step(name, WAREHOUSE[name], build, needs)

    return [
        step("dim_date", lambda _: model.dim_date()),
        step("dim_territory", lambda _: model.dim_territory()),
        step("dim_category", lambda _: model.dim_category()),
        step("dim_shipper", lambda _: model.dim_shipper()),
        step("dim_employee", lambda _: model.dim_employee()),
        step("dim_order_flags", lambda _: model.flags()),
        step("dim_customer", lambda _: model.dim_customer()),
        step("dim_product", lambda _: model.dim_product_profile()),
        step("fact_sales", lambda stored: facts.sales_fact(
            model.lines(), model.orders(), stored("dim_customer"), stored("dim_product"),
            stored("dim_employee"), stored("dim_shipper"), stored("dim_order_flags"),
        ), "dim_customer", "dim_product", "dim_employee", "dim_shipper", "dim_order_flags"),
        step("fact_fulfillment", lambda stored: facts.fulfillment_fact(
            model.shipments(), stored("dim_customer"), stored("dim_shipper"), model.countries()
        ), "dim_customer", "dim_shipper"),
        step("fact_stock", lambda stored: model.fact_stock(stored("dim_product")), "dim_product"),
        step("bridge_employee_territory", lambda stored: bridge.load_bridge(
            model.member_territories(), stored("dim_employee"), stored("dim_territory")
        ), "dim_employee", "dim_territory"),
        step("dim_customer_scd3", lambda _: model.dim_customer_scd3()),
        step("fact_activity", lambda stored: facts.activity_fact(
            model.activity_events(), stored("dim_employee"), stored("dim_territory")
        ), "dim_employee", "dim_territory"),
    ]


def run(model: Model, folder: str, load_ts: datetime, load: str | None = None) -> list[str]:
    """Load the whole warehouse; see `run_steps`."""
    return run_steps(model.spark, folder, warehouse(model), load_ts, load)
