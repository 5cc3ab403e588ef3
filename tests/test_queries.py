"""Every registered query against its DuckDB oracle, plus plan properties."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from strata.plans.oracle import QUERIES
from strata.plans.queries import REGISTRY
from strata.sources.fixtures import TABLES

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def _sorted(rows, cols):
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in idx) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["year", "month", "segment", "revenue", "gross_margin", "orders"]


def test_every_query_but_samples_has_an_oracle():
    assert set(REGISTRY) - set(QUERIES) == {"table_sample"}
    assert set(REGISTRY) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, duck, name):
    df = REGISTRY[name](spark, SF_SMALL)
    rows = df.collect()
    if name not in QUERIES:
        assert len(rows) > 0
        return
    res = duck.execute(QUERIES[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _sorted(rows, df.columns) == _sorted(res.fetchall(), ocols)


@pytest.mark.parametrize("name", ["kpi_segment_month", "kpi_daily", "fact_order_line",
                                  "merge_newer_wins", "silver_quality", "profile_columns"])
def test_plans_stay_in_the_jvm(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for python_op in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                      "MapInPandas", "PythonUDF"):
        assert python_op not in plan


def test_calendar_is_broadcast(spark):
    plan = E.queries()["kpi_segment_month"](spark, SF_SMALL)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "BroadcastExchange" in plan


def test_entry_module_imports_without_a_session():
    import subprocess
    import sys
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as E; "
                          "print(len(E.queries()), len(E.oracle_sql()))"],
                         capture_output=True, text=True, cwd=str(__import__("pathlib").Path(
                             __file__).resolve().parents[1]), timeout=120)
    assert out.returncode == 0, out.stderr


def test_fact_partitioning_is_reused(spark):
    """With every broadcast off, K1 needs one exchange per dedup (4), two for the fact joins, one
    for the customer join, two for the calendar and two for the distinct aggregate: the
    order-grain step rides on the fact's order_id partitioning."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    prev = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        plan = E.queries()["kpi_segment_month"](spark, SF_SMALL)._jdf.queryExecution() \
            .executedPlan().toString()
    finally:
        for k, v in prev.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert plan.count("Exchange hashpartitioning") == 11


@pytest.mark.parametrize("name,key", [("kpi_top_products", "product_id"),
                                      ("kpi_customer_ltv", "customer_id")])
def test_fact_is_aggregated_before_the_dimension_join(spark, name, key):
    """K2/K4 reduce the fact to one row per product / customer before joining the
    dimension: the top join's input on the fact side is already an aggregate."""
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    top_join = next(i for i, ln in enumerate(lines) if "Join Inner" in ln)
    below = "\n".join(lines[top_join + 1:])
    assert f"Aggregate [{key}" in below


def test_two_distinct_counts_without_expand(spark):
    plan = REGISTRY["kpi_daily"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_orphans_shuffle_keys_not_fact_rows(spark):
    """Below every exchange that orphan counting adds there is a partial aggregate per key."""
    from strata.operators import quality as Q
    from strata.plans.queries import RULES

    fact = spark.createDataFrame([(i % 3 or None, i % 5, 20240101 + i % 40) for i in range(500)],
                                 "customer_id long, product_id int, date_id int")
    dims = {"dim_customer": spark.createDataFrame([(1,)], "customer_id long"),
            "dim_product": spark.createDataFrame([(1,), (1,), (2,)], "product_id long"),
            "dim_date": spark.createDataFrame([(20240101 + i,) for i in range(31)], "date_id int")}
    df = Q.fk_orphans(fact, dims, RULES)
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    assert {r["rule_name"]: r["orphans"] for r in df.collect()} == {
        "customer_fk": 333, "product_fk": 300, "date_fk": sum(i % 40 > 30 for i in range(500))}
    scans = [i for i, x in enumerate(plan) if "ExistingRDD" in x and "customer_id" in x and "date_id" in x]
    assert len(scans) == 1                      # one pass over the fact for all rules
    above = plan[:scans[0]]
    nearest = max(i for i, x in enumerate(above) if "Exchange" in x)
    assert any("HashAggregate" in x and "partial_count" in x for x in above[nearest:])


def test_sums_keep_sub_cent_amounts(spark):
    from pyspark.sql import functions as F

    from strata.functions.money import money_sum, money_sum_sql

    df = spark.createDataFrame([(0.004,)] * 1000 + [(1e9 + 0.5,), (-0.1,), (None,)], "x double")
    assert df.agg(money_sum("x")).first()[0] == 1e9 + 4.4
    assert df.selectExpr(money_sum_sql("x")).first()[0] == 1e9 + 4.4
    assert df.filter(F.col("x").isNull()).agg(money_sum("x")).first()[0] is None
