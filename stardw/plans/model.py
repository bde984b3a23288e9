"""The sales model bound to the given tables.

Each function of `Model` returns a frame; nothing is cached or written here,
and Catalyst prunes what a query does not use. Money becomes decimal at the
scan, so sums do not depend on the order of rows.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stardw.functions import FIRST_DAY, divide_half_up, ship_mode, surrogate_key, to_decimal, units
from stardw.operators import bridge, dims, facts, incremental, junk, scd
from stardw.operators.dims import keyed_dimension
from stardw.session import work_folder
from stardw.sources import conform, date_series, projected, read_table
from stardw.sources.contracts import RAW

# A fixed value of the binding, repeated in the SQL next to each query.
DAYS_TO_REQUIRED = 60
# Lines behind the rows of one task where a step fans out, sorts or merges.
LINES_A_TASK = 250_000


class Model:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}
        self._loads: list[date] | None = None
        self._lines: int | None = None

    def given(self, name: str) -> DataFrame:
        """A given table; files are listed and the schema is read once per model."""
        if name not in self._tables:
            self._tables[name] = read_table(self.spark, f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def spread(self, df: DataFrame, *keys: str, times: int = 1) -> DataFrame:
        """Rows dealt by `keys` over as many tasks as the lines ask for, `times` as many if rows fan out.

        Adaptive execution joins shuffle partitions by their compressed bytes; keys and
        days compress so well that millions of rows meet in a task. Partitions
        asked for by number are not joined. Small tables are left as they are.
        """
        if self._lines is None:
            self._lines = self.given("lineitem").count()  # from the footers of the files
        parts = -(-self._lines * times // LINES_A_TASK)
        return df.repartition(parts, *keys) if parts > self.spark.sparkContext.defaultParallelism else df

    # Raw layer

    def regions(self) -> DataFrame:
        names = {"r_regionkey": "region_id", "r_name": "region_name"}
        return conform(projected(self.given("region"), names), RAW["region"])

    def territories(self) -> DataFrame:
        names = {
            "n_nationkey": "territory_id", "n_name": "territory_name", "n_regionkey": "region_id",
        }
        return conform(projected(self.given("nation"), names), RAW["territory"])

    def customers(self) -> DataFrame:
        names = {
            "c_custkey": "customer_id", "c_name": "customer_name",
            "c_nationkey": "territory_id", "c_acctbal": "balance", "c_mktsegment": "segment",
        }
        return conform(projected(self.given("customer"), names), RAW["customer"])

    def employees(self) -> DataFrame:
        """Suppliers as members; every tenth of the number leads the next ones."""
        key = F.col("s_suppkey")
        df = self.given("supplier").select(
            key.alias("employee_id"),
            F.col("s_name").alias("full_name"),
            F.col("s_nationkey").alias("territory_id"),
            F.col("s_acctbal").alias("balance"),
            F.when(key > 0, F.floor(key / 10)).alias("reports_to"),
        )
        return conform(df, RAW["employee"])

    def products(self) -> DataFrame:
        names = {
            "p_partkey": "product_id", "p_name": "product_name", "p_brand": "brand",
            "p_type": "category", "p_size": "reorder_level", "p_retailprice": "list_price",
        }
        return conform(projected(self.given("part"), names), RAW["product"])

    def orders(self, before: date | None = None) -> DataFrame:
        """Orders, or those placed before a day; that test reaches the Parquet scan."""
        given = self.given("orders")
        if before is not None:
            kind = given.schema["o_orderdate"].dataType
            given = given.filter(F.col("o_orderdate") < F.lit(before).cast(kind))
        day = F.to_date("o_orderdate")
        df = given.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderstatus").alias("status"),
            day.alias("order_date"),
            F.date_add(day, DAYS_TO_REQUIRED).alias("required_date"),
            F.col("o_orderpriority").alias("priority"),
            F.least(F.substring("o_orderpriority", 1, 1).cast("int"), F.lit(3)).alias("ship_via"),
        )
        return conform(df, RAW["order"])

    def lines(self) -> DataFrame:
        cents = units(F.col("l_extendedprice"), 2)
        rate = units(F.col("l_discount"), 4)
        quantity = F.col("l_quantity").cast("int")
        df = self.given("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("employee_id"),
            F.col("l_linenumber").alias("line_number"),
            quantity.alias("quantity"),
            to_decimal(
                divide_half_up(cents * 100, quantity.cast("bigint")), 4
            ).alias("unit_price"),
            to_decimal(rate, 4).cast("decimal(5,4)").alias("discount"),
            to_decimal(cents, 2).alias("gross"),
            to_decimal(divide_half_up(cents * (10000 - rate), F.lit(100)), 4).alias("net"),
            F.to_date("l_shipdate").alias("ship_date"),
        )
        return conform(df, RAW["line"])

    def member_territories(self) -> DataFrame:
        """Assigned pairs: a member covers every territory of the home region."""
        home = self.employees().select("employee_id", "territory_id")
        places = self.territories().select("territory_id", "region_id")
        return (
            home.join(places, "territory_id")
            .select("employee_id", "region_id")
            .join(places, "region_id")
            .select("employee_id", "territory_id")
        )

    def events(self) -> DataFrame:
        return self.given("events").select("event_id", "ts", "user_id", "event_type", "value")

    # Lines and orders joined

    def sales(self, *order_columns: str) -> DataFrame:
        """Lines with columns of their order."""
        return self.lines().join(self.orders().select("order_id", *order_columns), "order_id")

    def grain_totals(self, *order_columns: str) -> DataFrame:
        """One row per line grain, dealt by it for merges; a grain delivered twice is added up."""
        return self.spread(self.sales(*order_columns).groupBy(*facts.SALES_GRAIN, *order_columns).agg(
            F.sum("quantity").alias("quantity"), F.sum("net").alias("net")
        ), *facts.SALES_GRAIN)

    def shipments(self) -> DataFrame:
        """Orders with their shipped date: last line shipped, if the order is finished."""
        last = self.lines().groupBy("order_id").agg(F.max("ship_date").alias("_last"))
        return (
            self.orders()
            .join(last, "order_id", "left")
            .withColumn("shipped_date", F.when(F.col("status") == "F", F.col("_last")))
            .drop("_last")
        )

    def countries(self) -> DataFrame:
        """Customer and the country its orders go to."""
        return self.customers().join(self.territories(), "territory_id").select(
            "customer_id", F.col("territory_name").alias("ship_country")
        )

    # Dimensions

    def order_days(self) -> Column:
        ends = self.given("orders").agg(
            F.struct(
                F.min(F.to_date("o_orderdate")).alias("lo"),
                F.max(F.to_date("o_orderdate")).alias("hi"),
            )
        )
        return ends.scalar()

    def dim_date(self) -> DataFrame:
        """Whole years that hold the order dates, and the year after for shipments."""
        ends = self.order_days()
        first = F.make_date(F.year(ends["lo"]), F.lit(1), F.lit(1))
        last = F.make_date(F.year(ends["hi"]) + 1, F.lit(12), F.lit(31))
        return dims.date_dimension(date_series(self.spark, first, last))

    def dim_territory(self) -> DataFrame:
        return dims.territory_dimension(self.territories(), self.regions())

    def dim_employee(self) -> DataFrame:
        return dims.employee_dimension(
            self.employees(), self.member_territories(), self.dim_territory()
        )

    def dim_category(self) -> DataFrame:
        return keyed_dimension(self.products(), ["category"], "category", "category_sk")

    def dim_shipper(self) -> DataFrame:
        codes = self.orders().select(F.col("ship_via").alias("shipper_id")).distinct()
        return codes.select(
            surrogate_key("shipper_id").alias("shipper_sk"),
            "shipper_id",
            ship_mode(F.col("shipper_id")).alias("shipper_name"),
        )

    def customer_snapshot(self, load_date: date) -> DataFrame:
        """Profile of each customer by the last order before the load date."""
        return incremental.latest_per_key(
            self.orders(before=load_date).select("customer_id", "order_date", "order_id", "priority", "status"),
            ["customer_id"], ["order_date", "order_id"],
        ).select("customer_id", "priority", "status")

    def load_dates(self) -> list[date]:
        """A load on the first day of each year that follows a year of orders."""
        if self._loads is None:
            year = F.year("order_date")
            low, high = self.orders().agg(F.min(year), F.max(year)).first()
            self._loads = [] if low is None else [date(y, 1, 1) for y in range(low + 1, high + 2)]
        return self._loads

    def in_turn(self, first: Callable[[date], DataFrame], then: Callable[[DataFrame, date], DataFrame]):
        """One load after the other; each state is written, so that no plan holds all of them."""
        days = self.load_dates()
        state = self.written(first(days[0]))
        for day in days[1:]:
            state = self.written(then(state, day))
        return state

    def written(self, df: DataFrame, **options) -> DataFrame:
        path = work_folder(self.spark, "load")
        df.write.options(**options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def dim_customer_applied(self, **options) -> DataFrame:
        """Customer versions from snapshots applied one after the other."""
        return self.in_turn(
            lambda day: scd.scd2_initial(self.customer_snapshot(day), "customer_id", "customer_sk"),
            lambda dim, day: scd.scd2_apply(
                dim, self.customer_snapshot(day), "customer_id", ["priority", "status"], day,
                "customer_sk", **options,
            ).drop("_action"),
        )

    def dim_customer_loads(self) -> DataFrame:
        """The same versions in one pass: orders filed under the load that sees them first."""
        load = F.make_date(F.year("order_date") + 1, F.lit(1), F.lit(1))
        return scd.scd2_history(
            self.orders().withColumn("load_date", load), "customer_id", ["priority", "status"],
            "load_date", ["order_date", "order_id"], "customer_sk",
            first_from=FIRST_DAY, first_until=self.load_dates()[0],
        )

    def dim_customer(self) -> DataFrame:
        """Customer versions from the whole order history."""
        return scd.scd2_history(
            self.orders(), "customer_id", ["priority", "status"], "order_date",
            ["order_date", "order_id"], "customer_sk",
        )

    def monthly_prices(self) -> DataFrame:
        """Lowest unit price of each product per month of shipment."""
        return (
            self.lines()
            .groupBy("product_id", F.trunc("ship_date", "month").alias("price_month"))
            .agg(F.min("unit_price").alias("unit_price"))
        )

    def dim_product(self) -> DataFrame:
        """Product versions by price."""
        return scd.scd2_history(
            self.spread(self.monthly_prices(), "product_id"), "product_id", ["unit_price"], "price_month",
            None, "product_sk",
        )

    def dim_product_profile(self) -> DataFrame:
        """Product versions with name, category and brand beside the price."""
        return scd.with_profile(
            self.dim_product(), self.products(), "product_id", ["product_name", "category", "brand"])

    def dim_customer_absorbed(self, parts: int = 3) -> DataFrame:
        """Customer versions from batches of orders that do not come in the order of their days."""
        orders = self.orders().select("customer_id", "order_date", "order_id", "priority", "status", "ship_via")
        dim = None
        for part in range(parts):
            batch = orders.filter(F.pmod(F.xxhash64("order_id"), F.lit(parts)) == part)
            dim = self.written(scd.scd2_absorb(
                dim, batch, "customer_id", ["priority", "status"], "order_date",
                ["order_date", "order_id"], "customer_sk", ["ship_via"], spread=self.spread,
            ))
        return dim

    def dim_customer_scd3(self) -> DataFrame:
        attrs = ["priority", "status"]
        return self.in_turn(
            lambda day: scd.scd3_initial(self.customer_snapshot(day), "customer_id", attrs),
            lambda dim, day: scd.scd3_apply(
                dim, self.customer_snapshot(day), "customer_id", attrs, day
            ).drop("_action"),
        )

    def flags(self) -> DataFrame:
        return junk.flags_dimension(self.spark)

    def bridge(self) -> DataFrame:
        return bridge.load_bridge(
            self.member_territories(), self.employee_keys(), self.dim_territory()
        )

    # Facts

    def fact_sales(self) -> DataFrame:
        return facts.sales_fact(
            self.lines(), self.orders(), self.dim_customer(), self.dim_product(),
            self.employee_keys(), self.dim_shipper(), self.flags(),
        )

    def employee_keys(self) -> DataFrame:
        return self.employees().select(
            "employee_id", surrogate_key("employee_id").alias("employee_sk")
        )

    def fact_fulfillment(self) -> DataFrame:
        return facts.fulfillment_fact(
            self.shipments(), self.dim_customer(), self.dim_shipper(), self.countries()
        )

    def fulfillment(self) -> DataFrame:
        """Orders with milestones on natural keys, for the reports."""
        return (
            self.shipments()
            .join(self.countries(), "customer_id")
            .select(
                "order_id", "customer_id", "ship_via", "order_date", "required_date",
                "shipped_date", "ship_country", *facts.milestones(),
            )
        )

    def stock_levels(self) -> DataFrame:
        """Lines with an even number bring stock in, the others take it out."""
        signed = F.when(F.col("line_number") % 2 == 0, F.col("quantity")).otherwise(-F.col("quantity"))
        return facts.month_end_levels(self.lines().select(
            "product_id", F.col("ship_date").alias("moved_on"), signed.alias("quantity")
        ), spread=lambda monthly: self.spread(monthly, "product_id"))

    def fact_stock(self, product_dim: DataFrame | None = None) -> DataFrame:
        """Month-end stock, keyed by the current product versions (built if not given)."""
        state = self.stock_levels().join(
            self.products().select("product_id", "reorder_level"), "product_id"
        )
        versions = self.dim_product() if product_dim is None else product_dim
        current = versions.filter("is_current").select("product_id", "product_sk")
        keys = current.join(self.products(), "product_id").select(
            "product_id", "product_sk", surrogate_key("category").alias("category_sk")
        )
        return facts.stock_snapshot(state, F.col("snapshot_day"), keys)

    def activity_events(self) -> DataFrame:
        """Distinct days on which a member sold, for each territory the bridge gives the member.

        Days are made distinct per member before the fan-out.
        """
        days = self.sales("order_date").select(
            F.col("order_date").alias("activity_date"), "employee_id"
        ).distinct()
        return self.spread(days, "employee_id").join(self.member_territories(), "employee_id")

    def served_events(self) -> DataFrame:
        """Order day, member who sold, territory of the customer."""
        return (
            self.sales("customer_id", "order_date")
            .join(self.customers().select("customer_id", "territory_id"), "customer_id")
            .select(F.col("order_date").alias("activity_date"), "employee_id", "territory_id")
        )

    def fact_activity(self) -> DataFrame:
        return facts.activity_fact(
            self.activity_events(), self.employee_keys(), self.dim_territory()
        )
