"""Adapters: TPC-H style fixture tables -> the four source entities.

Each adapter is a projection (plus, for customers, a join with the 25-row
nation/region geography) of one fixture table, so scans keep column pruning
and filter pushdown. The mapping:

==============  ==========  =========================  ==============  ==========================
entity          table       key                        version         deleted when
==============  ==========  =========================  ==============  ==========================
order_items     lineitem    (l_orderkey, l_linenumber)  l_shipdate      l_returnflag = 'R'
orders          orders      o_orderkey                 o_orderdate     status 'P' and '5-LOW'
products        part        p_partkey                  batch time      p_size % 10 = 0
customers       customer    c_custkey                  batch time      c_acctbal < 0
==============  ==========  =========================  ==============  ==========================

lineitem repeats (order, line) keys, so it exercises latest-row dedup.
"""

from __future__ import annotations

import weakref

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.schemas import FIXTURE_ENTITIES, LINEAGE_EXTRACTED_AT, LINEAGE_SOURCE_TABLE

# The one extraction time stamped on every fixture row (a fixture is one batch).
FIXTURE_BATCH_TS = "2024-06-01 00:00:00"
# Calendar wide enough for every fixture date (orders span 1995..2001).
FIXTURE_CALENDAR = ("1990-01-01", "2030-12-31")

# Ends before the last orders: dates outside it have no row.
SHORT_CALENDAR = ("1990-01-01", "1998-12-31")

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


_READS: "weakref.WeakKeyDictionary[SparkSession, dict[str, DataFrame]]" = \
    weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The fixture table as a DataFrame; the (read-only) file listing and footer
    schema are resolved once per session and path, not on every query build."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    per_session = _READS.setdefault(spark, {})
    if path not in per_session:
        per_session[path] = spark.read.parquet(path)
    return per_session[path]


def _batch_ts() -> Column:
    return F.lit(FIXTURE_BATCH_TS).cast("timestamp_ntz")


def _lineage(source: str) -> list[Column]:
    return [_batch_ts().alias(LINEAGE_EXTRACTED_AT), F.lit(source).alias(LINEAGE_SOURCE_TABLE)]


def _conform(df: DataFrame, entity: str) -> DataFrame:
    """Order and type the columns exactly as the registry declares them."""
    schema = FIXTURE_ENTITIES[entity].schema
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[f.name if have[f.name] == f.dataType
                       else F.col(f.name).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def order_items(spark: SparkSession, sf_dir: str, where: Column | str | None = None
                ) -> DataFrame:
    """Order items; ``where`` (a Column or SQL text) filters the lineitem rows first,
    e.g. to one extraction batch; it is pushed into the scan."""
    li = table(spark, sf_dir, "lineitem")
    if where is not None:
        li = li.filter(where)
    return _conform(li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("l_extendedprice").alias("line_total"),
        F.col("l_shipdate").alias("created_at"),
        F.col("l_shipdate").alias("updated_at"),
        (F.col("l_returnflag") == "R").alias("is_deleted"),
        *_lineage("order_items"),
    ), "order_items")


def _order_deleted() -> Column:
    return (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    # A cancelled order carries both the flag and the status, as at the source.
    status = (F.when(_order_deleted(), "cancelled")
              .when(F.col("o_orderstatus") == "F", "delivered")
              .when(F.col("o_orderstatus") == "O", "shipped")
              .otherwise("pending"))
    return _conform(o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        status.alias("order_status"),
        F.col("o_orderdate").alias("order_ts"),
        F.col("o_totalprice").alias("total_amount"),
        F.lit(None).cast("string").alias("shipping_city"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
        _order_deleted().alias("is_deleted"),
        *_lineage("orders"),
    ), "orders")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return _conform(p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        F.col("p_retailprice").alias("unit_price"),
        F.col("p_retailprice").alias("cost_price"),
        _batch_ts().alias("created_at"),
        _batch_ts().alias("updated_at"),
        ((F.col("p_size") % 10) == 0).alias("is_deleted"),
        *_lineage("products"),
    ), "products")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    # nation (25 rows) x region (5 rows) is a fixed-size geography: safe to broadcast.
    geo = (table(spark, sf_dir, "nation")
           .join(F.broadcast(table(spark, sf_dir, "region")),
                 F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", "n_name", "r_name"))
    joined = c.join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return _conform(joined.select(
        F.col("c_custkey").alias("customer_id"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("last_name"),
        F.concat(F.lower(F.regexp_replace(F.col("c_name"), "#", ".")), F.lit("@example.com"))
        .alias("email"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("country"),
        F.col("c_mktsegment").alias("segment"),
        _batch_ts().alias("created_at"),
        _batch_ts().alias("updated_at"),
        (F.col("c_acctbal") < 0).alias("is_deleted"),
        *_lineage("customers"),
    ), "customers")


ADAPTERS = {
    "order_items": order_items,
    "orders": orders,
    "products": products,
    "customers": customers,
}


def entity_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: fn(spark, sf_dir) for name, fn in ADAPTERS.items()}


def as_first_seen(df: DataFrame) -> DataFrame:
    """The rows as an earlier batch had them: a day older and active."""
    day = F.expr("INTERVAL 1 DAY")
    return df.withColumns({"updated_at": F.col("updated_at") - day, "is_deleted": F.lit(False)})


def flawed_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All rows of the entities, some of them with a fault that a rule must find: by a rest of
    the key, NULL keys, NULL and repeated required values, values outside their domain."""
    e = entity_frames(spark, sf_dir)

    def every(key: str, n: int) -> Column:
        return F.col(key) % n == 0

    def flawed(df: DataFrame, key: str, **faults) -> DataFrame:
        # the key goes last: the other faults are chosen by it
        named = sorted(faults.items(), key=lambda x: x[0] == key)
        for name, (n, value) in named:
            df = df.withColumn(name, F.when(every(key, n), value).otherwise(F.col(name)))
        return df
    null = F.lit(None)
    return {
        "customers": flawed(e["customers"], "customer_id", email=(11, null),
                            segment=(13, F.lit("UNKNOWN")), last_name=(7, F.lit("same")),
                            created_at=(17, null), customer_id=(50, null)
                            ).withColumn("email", F.when(F.col("last_name") == "same",
                                                         F.when(F.col("email").isNotNull(), "same@example.com"))
                                         .otherwise(F.col("email"))),
        "products": flawed(e["products"], "product_id", unit_price=(19, -F.col("unit_price")),
                           cost_price=(23, F.lit(0.0)), name=(29, null), product_id=(50, null)),
        "orders": flawed(e["orders"], "order_id", order_status=(31, F.lit("lost")),
                         total_amount=(37, -F.col("total_amount")), customer_id=(41, null),
                         order_id=(50, null)),
        "order_items": flawed(e["order_items"], "order_id", quantity=(43, -F.col("quantity")),
                              line_total=(47, F.lit(0.0)), unit_price=(53, null),
                              line_number=(50, null)),
    }
