import datetime as dt

from pyspark.sql import functions as F

from strata.operators.star import build_dim_date, build_fact_order_line


def test_dim_date_default_range(spark):
    d = build_dim_date(spark)
    assert d.count() == 4018
    assert d.columns[:2] == ["date_id", "full_date"]
    r = {x["date_id"]: x for x in d.filter(F.col("date_id").isin(20240229, 20210101, 20240303,
                                                                 20240302)).collect()}
    assert r[20240229]["is_month_end"] and r[20240229]["month_name"] == "February"
    assert r[20210101]["week_of_year"] == 53
    assert r[20240303]["day_of_week"] == 1 and r[20240303]["day_name"] == "Sunday"
    assert r[20240303]["is_weekend"] and r[20240302]["day_of_week"] == 7


def test_fact_keeps_item_with_unknown_product(spark):
    ts = dt.datetime(2024, 5, 6, 7, 8)
    items = spark.createDataFrame(
        [("i1", "o1", "p1", 2, 5.0, 10.0, ts, False), ("i2", "o1", "missing", 1, 3.0, 3.0, ts,
                                                      False),
         ("i3", "o1", "p1", 1, 5.0, 5.0, ts, True)],
        "order_item_id string, order_id string, product_id string, quantity bigint, "
        "unit_price double, line_total double, _extracted_at timestamp_ntz, is_deleted boolean")
    orders = spark.createDataFrame(
        [("o1", "c1", "paid", None, ts, False)],
        "order_id string, customer_id string, order_status string, shipping_city string, "
        "order_ts timestamp_ntz, is_deleted boolean")
    products = spark.createDataFrame([("p1", 4.0)], "product_id string, cost_price double")
    fact = {r["order_item_id"]: r for r in build_fact_order_line(items, orders, products).collect()}
    assert set(fact) == {"i1", "i2"}                      # deleted item filtered
    assert fact["i1"]["gross_margin"] == 2.0 and fact["i1"]["date_id"] == 20240506
    assert fact["i2"]["cost_price"] is None and fact["i2"]["gross_margin"] is None
