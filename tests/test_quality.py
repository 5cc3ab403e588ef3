import pytest
from pyspark.sql import functions as F

from strata.operators import quality as Q
from strata.schemas import SOURCE_ENTITIES


def test_constraint_violation_counts(spark):
    e = SOURCE_ENTITIES["order_items"]
    df = spark.createDataFrame([
        ("i1", "o1", "p1", 1, 2.0, 2.0),
        ("i2", "o1", None, 0, -1.0, 0.0),
        ("i3", None, "p2", None, 1.0, None),
    ], "order_item_id string, order_id string, product_id string, quantity bigint, "
       "unit_price double, line_total double")
    out = {(r["check"], r["column"]): r["n"] for r in
           Q.constraint_violations("order_items", df, e).collect()}
    assert out[("not_null", "order_id")] == 1 and out[("not_null", "product_id")] == 1
    assert out[("not_null", "quantity")] == 1
    assert out[("quantity_positive", "quantity")] == 1      # NULL passes a CHECK
    assert out[("unit_price_positive", "unit_price")] == 1
    assert out[("line_total_positive", "line_total")] == 1


def test_silver_quality_and_gate(spark):
    e = SOURCE_ENTITIES["customers"]
    df = spark.createDataFrame([("c1", "a@x", None, False), ("c1", "b@x", None, None),
                                ("c2", None, None, True)],
                               "customer_id string, email string, created_at timestamp, "
                               "is_deleted boolean")
    res = Q.silver_quality("customers", df, e)
    out = {(r["check"], r["column"]): r["n"] for r in res.collect()}
    assert out[("duplicate_keys", "customer_id")] == 1
    assert out[("nulls", "email")] == 1 and out[("nulls", "created_at")] == 3
    assert out[("rows", None)] == 3 and out[("deleted", None)] == 1
    assert out[("active", None)] == 2                        # NULL flag counts as active
    report = Q.QualityReport()
    assert not report.add_results(res)
    with pytest.raises(RuntimeError, match="quality checks failed"):
        report.gate()


def test_fk_orphans_count_null_keys(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1,)], "k int")
    r = Q.fk_orphans(fact, {"d": dim}, [Q.ForeignKey("k", "d", "k")]).first()
    assert r["rule_name"] == "k->d.k" and r["orphans"] == 2


def test_profile_single_aggregate(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b")], "x int, y string")
    out = {r["column_name"]: r for r in Q.profile_columns(df).collect()}
    assert out["x"]["distinct_values"] == 2 and out["x"]["max_value"] == "2"
    assert out["y"]["nulls"] == 1 and out["y"]["min_value"] == "a"
    plan = Q.profile_columns(df)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    neg = spark.createDataFrame([(0.0,), (-0.0,), (None,)], "d double")
    assert Q.profile_columns(neg).first()["distinct_values"] == 1


def test_schema_drift(spark):
    from strata.schemas import FIXTURE_ENTITIES
    from strata.sources import fixtures

    from .conftest import SF_SMALL

    e = FIXTURE_ENTITIES["orders"]
    ok = fixtures.orders(spark, SF_SMALL)
    assert Q.schema_drift(spark, ok.schema, e.schema, "orders").count() == 0
    bad = ok.drop("shipping_city").withColumn("total_amount", F.col("total_amount").cast("string")) \
        .withColumn("extra", F.lit(1))
    out = {(r["column"], r["issue"]) for r in Q.schema_drift(spark, bad.schema, e.schema).collect()}
    assert out == {("shipping_city", "missing"), ("extra", "unexpected"),
                   ("total_amount", "type_changed")}
