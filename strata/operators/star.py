"""Star schema builders: date, customer and product dimensions, order-line fact."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.dates import date_id
from strata.schemas import CALENDAR_END, CALENDAR_START, LINEAGE_EXTRACTED_AT


def calendar_days(start: str, end: str) -> int:
    return (_dt.date.fromisoformat(end) - _dt.date.fromisoformat(start)).days + 1


def date_attributes(days: DataFrame) -> DataFrame:
    """``full_date`` -> every dim_date column, in the dimension's column order."""
    d = F.col("full_date")
    return days.select(
        date_id(d).alias("date_id"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        (d == F.last_day(d)).alias("is_month_end"),
    )


def build_dim_date(spark: SparkSession, start: str = CALENDAR_START,
                   end: str = CALENDAR_END) -> DataFrame:
    """One row per day of [start, end]; 4,018 rows for the default 2020..2030.

    The row count is fixed by the two parameters, so this dimension is always
    safe to broadcast. ``day_of_week`` is 1 = Sunday .. 7 = Saturday.
    """
    n = calendar_days(start, end)
    return date_attributes(spark.range(n).select(
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("full_date")))


def dim_date_spanning(df: DataFrame, column: str) -> DataFrame:
    """Calendar covering every day from the earliest to the latest ``column`` value.

    The bounds come from one global min/max aggregate (a single row), expanded
    with ``sequence`` + ``explode``; the output grows with the date span (days),
    never with the row count of ``df``.
    """
    bounds = df.agg(F.min(F.col(column)).cast("date").alias("lo"),
                    F.max(F.col(column)).cast("date").alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY")))
                         .alias("full_date"))
    return date_attributes(days)


def build_dim_customer(customers: DataFrame) -> DataFrame:
    """SCD-1 customer dimension; ``is_active = NOT is_deleted`` (NULL stays NULL)."""
    return customers.select(
        "customer_id", "first_name", "last_name", "email", "segment", "city", "country",
        (~F.col("is_deleted")).alias("is_active"), "created_at", "updated_at")


def build_dim_product(products: DataFrame) -> DataFrame:
    """SCD-1 product dimension; current list price here, sale price in the fact."""
    return products.select(
        "product_id", "name", "category", "subcategory", "unit_price", "cost_price",
        (~F.col("is_deleted")).alias("is_active"), "created_at", "updated_at")


def build_fact_order_line(order_items: DataFrame, orders: DataFrame, products: DataFrame,
                          item_keys: Sequence[str] = ("order_item_id",)) -> DataFrame:
    """Grain: one row per order item.

    Active items join all products (left: an item whose product is unknown keeps
    NULL cost and margin) and then active orders (inner, on ``order_id``); the
    inner join does not touch product columns, so this order gives the same rows
    as joining orders first. Joining orders last leaves the fact partitioned by
    ``order_id``, which every order-grain aggregation downstream (distinct orders,
    per-order pre-aggregation) reuses without another exchange. All sides are
    narrowed before the joins.
    """
    items = (order_items.filter(~F.col("is_deleted"))
             .select(*dict.fromkeys([*item_keys, "order_id", "product_id", "quantity",
                                     "unit_price", "line_total", LINEAGE_EXTRACTED_AT])))
    heads = (orders.filter(~F.col("is_deleted"))
             .select("order_id", "customer_id", "order_status", "shipping_city", "order_ts"))
    costs = products.select("product_id", F.col("cost_price").alias("_cost"))
    fact = items.join(costs, "product_id", "left").join(heads, "order_id", "inner")
    margin = F.round(F.col("line_total") - F.col("quantity") * F.col("_cost"), 2)
    return fact.select(*dict.fromkeys([*item_keys, "order_id"]),
        date_id("order_ts").alias("date_id"),
        "customer_id", "product_id", "order_status", "shipping_city", "quantity",
        "unit_price", "line_total", F.col("_cost").alias("cost_price"),
        margin.alias("gross_margin"), "order_ts", LINEAGE_EXTRACTED_AT)
