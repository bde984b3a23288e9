"""Typed table contracts and the functions that hold a frame to them.

The raw contracts carry the types of the source system; the warehouse
contracts are the declared shape of every dimension and fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DataType, DateType, DecimalType, IntegerType,
                               LongType, StringType, StructField, StructType)

ID, NUMBER, TEXT, DAY, FLAG = LongType(), IntegerType(), StringType(), DateType(), BooleanType()
MONEY, PRODUCT, RATE = DecimalType(18, 2), DecimalType(18, 4), DecimalType(5, 4)


def contract(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


RAW = {
    "region": contract(
        region_id=NUMBER, region_name=TEXT,
    ),
    "territory": contract(
        territory_id=NUMBER, territory_name=TEXT, region_id=NUMBER,
    ),
    "customer": contract(
        customer_id=ID, customer_name=TEXT, territory_id=NUMBER, balance=MONEY, segment=TEXT,
    ),
    "employee": contract(
        employee_id=ID, full_name=TEXT, territory_id=NUMBER, balance=MONEY, reports_to=ID,
    ),
    "product": contract(
        product_id=ID, product_name=TEXT, brand=TEXT, category=TEXT, reorder_level=NUMBER,
        list_price=MONEY,
    ),
    "order": contract(
        order_id=ID, customer_id=ID, status=TEXT, order_date=DAY, required_date=DAY,
        priority=TEXT, ship_via=NUMBER,
    ),
    "line": contract(
        order_id=ID, product_id=ID, employee_id=ID, line_number=NUMBER, quantity=NUMBER,
        unit_price=PRODUCT, discount=RATE, gross=MONEY, net=PRODUCT, ship_date=DAY,
    ),
    "member_territory": contract(
        employee_id=ID, territory_id=NUMBER,
    ),
    "shipper": contract(
        shipper_id=NUMBER, shipper_name=TEXT,
    ),
    "category": contract(
        category_id=NUMBER, category_name=TEXT, description=TEXT,
    ),
    "supplier": contract(
        supplier_id=NUMBER, company_name=TEXT, country=TEXT, phone=TEXT,
    ),
}

WAREHOUSE = {
    "dim_customer": contract(
        customer_sk=ID, customer_id=ID, priority=TEXT, status=TEXT, valid_from=DAY,
        valid_to=DAY, is_current=FLAG,
    ),
    "dim_product": contract(
        product_sk=ID, product_id=ID, unit_price=PRODUCT, product_name=TEXT, category=TEXT,
        brand=TEXT, valid_from=DAY, valid_to=DAY, is_current=FLAG,
    ),
    "dim_employee": contract(
        employee_sk=ID, employee_id=ID, full_name=TEXT, reports_to=ID, manager_name=TEXT,
        territory_list=TEXT, region_name=TEXT,
    ),
    "dim_territory": contract(
        territory_sk=ID, territory_id=NUMBER, territory_name=TEXT, region_name=TEXT,
    ),
    "dim_category": contract(
        category_sk=ID, category=TEXT,
    ),
    "dim_shipper": contract(
        shipper_sk=ID, shipper_id=NUMBER, shipper_name=TEXT,
    ),
    "dim_date": contract(
        date_key=NUMBER, full_date=DAY, year=NUMBER, quarter=NUMBER, month=NUMBER,
        month_name=TEXT, day=NUMBER, weekday=NUMBER, day_name=TEXT, is_weekend=FLAG,
    ),
    "dim_order_flags": contract(
        order_flags_sk=ID, discount_band=TEXT, is_high_value=FLAG, ship_mode=TEXT,
    ),
    "dim_customer_scd3": contract(
        customer_id=ID, current_priority=TEXT, previous_priority=TEXT, priority_changed_on=DAY,
        current_status=TEXT, previous_status=TEXT, status_changed_on=DAY,
    ),
    "fact_sales": contract(
        sales_sk=TEXT, order_id=ID, product_id=ID, employee_id=ID, line_number=NUMBER,
        order_date_key=NUMBER, customer_sk=ID, product_sk=ID, employee_sk=ID, shipper_sk=ID,
        order_flags_sk=ID, unit_price=PRODUCT, quantity=NUMBER, discount=RATE, gross=MONEY,
        net=PRODUCT,
    ),
    "fact_fulfillment": contract(
        fulfillment_sk=TEXT, order_id=ID, customer_sk=ID, shipper_sk=ID, order_date_key=NUMBER,
        required_date_key=NUMBER, shipped_date_key=NUMBER, ship_country=TEXT,
        days_to_ship=NUMBER, is_late=FLAG,
    ),
    "fact_stock": contract(
        stock_sk=TEXT, snapshot_date_key=NUMBER, product_sk=ID, category_sk=ID,
        units_in_stock=ID, reorder_level=NUMBER, needs_reorder=FLAG,
    ),
    "fact_activity": contract(
        activity_date_key=NUMBER, employee_sk=ID, territory_sk=ID,
    ),
    "bridge_employee_territory": contract(
        employee_sk=ID, territory_sk=ID,
    ),
}


def conform(df: DataFrame, schema: StructType, strict: bool = False) -> DataFrame:
    """Select, cast and order the columns of `df` as the contract says.

    A value that cannot be cast becomes NULL; with `strict` it raises.
    """
    given = {f.name: f.dataType for f in df.schema.fields}

    def as_declared(field: StructField):
        col = F.col(f"`{field.name}`")
        if given.get(field.name) == field.dataType:
            return col
        typed = col.cast(field.dataType) if strict else col.try_cast(field.dataType)
        return typed.alias(field.name)

    return df.select(*[as_declared(f) for f in schema.fields])


def with_missing_columns(df: DataFrame, schema: StructType) -> DataFrame:
    """Add contract columns the frame lacks as typed NULLs; others stay as they are."""
    present = set(df.columns)
    return df.withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in present}
    )
