"""Business KPIs over the star schema, and their top-k reports.

A KPI is declared once (``Kpi``): its grain, the dimensions it joins and its measures. Both forms
come from that: ``view_sql`` gives the logical view's statement, ``compute`` a DataFrame plan that
reduces the fact before it joins.

Money sums are exact (``money_sum``), so results do not depend on row order. Dimensions are joined
plainly: Spark broadcasts those whose measured size allows it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.money import amount, money_sum_sql

FACT = "fact_order_line"


@dataclass(frozen=True)
class Measure:
    """``kind``: ``distinct`` values of a fact column, exact ``money`` or plain ``units`` sum."""
    name: str
    kind: str
    column: str


@dataclass(frozen=True)
class Kpi:
    """``joins``: (dimension, key) pairs, the key being a column of the fact as well. ``grain``:
    the columns of the result, of the dimensions in order and of the fact where no dimension is
    named. ``keyed``: each grain row is one key of the dimension, so nothing is left to add up
    after the join."""
    view: str
    grain: tuple[tuple[str, str], ...]
    measures: tuple[Measure, ...]
    joins: tuple[tuple[str, str], ...] = ()
    keyed: bool = True


def _measures(orders: str, revenue: str, margin: str = "gross_margin") -> tuple[Measure, ...]:
    return (Measure(orders, "distinct", "order_id"), Measure(revenue, "money", "line_total"),
            Measure(margin, "money", "gross_margin"))


def _of(table: str, *columns: str) -> tuple[tuple[str, str], ...]:
    return tuple((table, c) for c in columns)


_ORDERS, _REVENUE, _MARGIN = _measures("orders", "revenue")

SEGMENT_MONTH = Kpi(
    "vw_revenue_margin_by_segment_month",
    _of("dim_date", "year", "month") + _of("dim_customer", "segment"),
    (_REVENUE, _MARGIN, _ORDERS),
    (("dim_customer", "customer_id"), ("dim_date", "date_id")), keyed=False)
TOP_PRODUCTS = Kpi(
    "vw_top_products_by_revenue",
    _of("dim_product", "product_id", "name", "category", "subcategory"),
    (Measure("units_sold", "units", "quantity"), _REVENUE, _MARGIN),
    (("dim_product", "product_id"),))
STATUS_FUNNEL = Kpi("vw_order_status_funnel", _of(FACT, "order_status"), (_ORDERS, _REVENUE))
CUSTOMER_LTV = Kpi(
    "vw_customer_ltv", _of("dim_customer", "customer_id", "first_name", "last_name", "segment"),
    _measures("total_orders", "lifetime_revenue", "lifetime_margin"),
    (("dim_customer", "customer_id"),))
DAILY = Kpi(
    "vw_daily_kpis", _of("dim_date", "full_date"),
    (_ORDERS, Measure("active_customers", "distinct", "customer_id"), _REVENUE, _MARGIN,
     Measure("units", "units", "quantity")), (("dim_date", "date_id"),))
KPIS = (SEGMENT_MONTH, TOP_PRODUCTS, STATUS_FUNNEL, CUSTOMER_LTV, DAILY)


def view_sql(kpi: Kpi, names: dict[str, str]) -> str:
    """The KPI as one statement over the given table or view names."""
    grain = [f"{table}.{column}" for table, column in kpi.grain]
    said = {"distinct": "COUNT(DISTINCT {0})".format, "money": money_sum_sql, "units": "SUM({0})".format}
    measures = [f"{said[m.kind](f'{FACT}.{m.column}')} AS {m.name}" for m in kpi.measures]
    joins = [f"JOIN {names[d]} AS {d} ON {d}.{k} = {FACT}.{k}" for d, k in kpi.joins]
    return " ".join([f"SELECT {', '.join(grain + measures)} FROM {names[FACT]} AS {FACT}", *joins,
                     f"GROUP BY {', '.join(grain)}"])


def _sums(measures: Sequence[Measure], again: bool = False) -> list[Column]:
    """Exact sums of fact rows, or of such sums."""
    return [F.sum(F.col(m.name) if again else amount(m.column) if m.kind == "money"
                  else F.col(m.column)).alias(m.name)
            for m in measures if m.kind != "distinct"]


def _same(keys: Sequence[str], a: DataFrame, b: DataFrame) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])


def reduced(rows: DataFrame, keys: Sequence[str], measures: Sequence[Measure],
            again: bool = False) -> DataFrame:
    """Measures per ``keys``. Each distinct count is an aggregate in two steps over (keys, value),
    with a partial one before each shuffle; the first carries the sums, and a second one is joined
    to it by the keys. No row is expanded, and a hot key folds to its values map-side."""
    distinct = [m for m in measures if m.kind == "distinct"]
    if not distinct:
        return rows.groupBy(*keys).agg(*_sums(measures, again))
    out = (rows.groupBy(*keys, distinct[0].column).agg(*_sums(measures, again))
           .groupBy(*keys).agg(F.count(distinct[0].column).alias(distinct[0].name),
                               *_sums(measures, True))) if _sums(measures) else \
        _counted(rows, keys, distinct[0])
    for m in distinct[1:]:
        more = _counted(rows, keys, m)
        out = out.join(more, _same(keys, out, more)).select(*[out[c] for c in out.columns], m.name)
    return out


def _counted(rows: DataFrame, keys: Sequence[str], m: Measure) -> DataFrame:
    return rows.select(*keys, m.column).distinct().groupBy(*keys).agg(F.count(m.column).alias(m.name))


def compute(kpi: Kpi, frames: dict[str, DataFrame]) -> DataFrame:
    """The KPI as a plan: the fact is reduced to its join keys (and, where the grain is coarser
    than these, its orders) before any join, so joins move one row per key and not one per line.
    Rows without a partner in a dimension drop, as in the view."""
    fact = frames[FACT]
    keys = [k for _, k in kpi.joins] + [c for t, c in kpi.grain if t == FACT]
    if kpi.keyed:
        out = reduced(fact, keys, kpi.measures)
    else:
        finer = [m.column for m in kpi.measures if m.kind == "distinct"]
        # a fact that comes partitioned by order needs no exchange for this step
        out = fact.groupBy(*finer, *keys).agg(*_sums(kpi.measures))
    for d, k in kpi.joins:
        wanted = dict.fromkeys([k, *(c for t, c in kpi.grain if t == d)])
        out = out.join(frames[d].select(*wanted), k)
    grain = [c for _, c in kpi.grain]
    if not kpi.keyed:
        out = reduced(out, grain, kpi.measures, again=True)
    return out.select(*grain, *[F.col(m.name).cast("double").alias(m.name) if m.kind == "money"
                                else m.name for m in kpi.measures])


def revenue_margin_by_segment_month(fact: DataFrame, dim_customer: DataFrame,
                                    dim_date: DataFrame) -> DataFrame:
    """K1: revenue, margin and distinct orders by (year, month, segment)."""
    return compute(SEGMENT_MONTH, {FACT: fact, "dim_customer": dim_customer, "dim_date": dim_date})


def top_products_by_revenue(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """K2: units, revenue and margin per product (unknown products drop)."""
    return compute(TOP_PRODUCTS, {FACT: fact, "dim_product": dim_product})


def order_status_funnel(fact: DataFrame) -> DataFrame:
    """K3: distinct orders and revenue per order status (no join)."""
    return compute(STATUS_FUNNEL, {FACT: fact})


def customer_ltv(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """K4: orders, lifetime revenue and margin per customer."""
    return compute(CUSTOMER_LTV, {FACT: fact, "dim_customer": dim_customer})


def daily_kpis(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """K5: per calendar day, orders, active customers, revenue, margin, units. Rows whose date is
    outside the calendar drop."""
    return compute(DAILY, {FACT: fact, "dim_date": dim_date})


# --- top-k reports: every ordering ends in the grain key, so ties are deterministic ---

def top_n(df: DataFrame, n: int, *order) -> DataFrame:
    """``ORDER BY ... LIMIT n``; Spark plans it as TakeOrderedAndProject
    (a per-partition heap of n, then one merge of n x partitions rows)."""
    return df.orderBy(*order).limit(n)


def top_segment_months(k1: DataFrame, n: int = 10) -> DataFrame:
    return top_n(k1, n, F.col("revenue").desc_nulls_last(), "year", "month", "segment")


def top_products(k2: DataFrame, n: int = 10) -> DataFrame:
    return top_n(k2, n, F.col("revenue").desc_nulls_last(), "product_id")


def top_customers(k4: DataFrame, n: int = 10) -> DataFrame:
    return top_n(k4, n, F.col("lifetime_revenue").desc_nulls_last(), "customer_id")


def last_days(k5: DataFrame, n: int = 30) -> DataFrame:
    return top_n(k5, n, F.col("full_date").desc())


def funnel_by_revenue(k3: DataFrame) -> DataFrame:
    return k3.orderBy(F.col("revenue").desc_nulls_last(), "order_status")
