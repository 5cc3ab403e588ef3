"""A hot key (a third of all rows) in the fact's order join is split by AQE."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators.star import build_fact_order_line

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_order_is_split(spark):
    prev = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        ts = dt.datetime(2024, 1, 1)
        n = 30000
        items = spark.range(n).select(
            F.col("id").cast("string").alias("order_item_id"),
            # a third of all lines belong to order 0
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).cast("string")
            .alias("order_id"),
            (F.col("id") % 50).cast("string").alias("product_id"),
            F.lit(1).cast("bigint").alias("quantity"), F.lit(2.0).alias("unit_price"),
            F.lit(2.0).alias("line_total"), F.lit(ts).cast("timestamp_ntz").alias("_extracted_at"),
            F.lit(False).alias("is_deleted"))
        orders = spark.range(n).select(
            F.col("id").cast("string").alias("order_id"), F.lit("c").alias("customer_id"),
            F.lit("paid").alias("order_status"), F.lit(None).cast("string").alias("shipping_city"),
            F.lit(ts).cast("timestamp_ntz").alias("order_ts"), F.lit(False).alias("is_deleted"))
        products = spark.range(50).select(F.col("id").cast("string").alias("product_id"),
                                          F.lit(1.0).alias("cost_price"))
        fact = build_fact_order_line(items, orders, products)
        assert len(fact.collect()) == n          # runs this plan, so AQE finalises it
        plan = fact._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan
        assert "skew=true" in plan            # AQE split the hot order's partition
    finally:
        for k, v in prev.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
