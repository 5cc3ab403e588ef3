"""Silver and gold frames computed straight from one batch per entity.

This is the lazy, single-plan form of bronze -> silver -> gold: no table is
written, Catalyst sees the whole lineage (pushdown and pruning reach the
parquet scans). ``strata.plans.pipeline`` runs the same operators against
persisted, versioned tables for incremental loads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.dedup import deduplicate
from strata.operators.merge import merge_newer_wins
from strata.operators.star import (build_dim_customer, build_dim_date, build_dim_product,
                                   build_fact_order_line)
from strata.schemas import FIXTURE_ENTITIES, Entity
from strata.sources import fixtures


def empty_like(spark: SparkSession, df: DataFrame) -> DataFrame:
    # a contradiction Catalyst folds into an empty relation, so a merge against it
    # is optimised away instead of shuffled
    return df.where(F.lit(False))


def first_load(spark: SparkSession, batch: DataFrame, entity: Entity) -> DataFrame:
    """Silver state after merging one batch into an empty table.

    A newer-wins merge into an empty target reduces to the insert rule on the
    latest rows: a key first seen deleted (or with an unknown flag) never enters
    silver. Catalyst folds the general merge against ``empty_like`` to exactly
    this plan; writing the rule directly saves building the merge expressions
    (``tests/test_layers.py`` checks both give the same rows).
    """
    latest = deduplicate(batch, entity)
    return latest.filter(F.col(entity.delete_flag) == F.lit(False))


def first_load_by_merge(spark: SparkSession, batch: DataFrame, entity: Entity) -> DataFrame:
    latest = deduplicate(batch, entity)
    return merge_newer_wins(empty_like(spark, latest), latest, entity.keys,
                            version=entity.version, delete_flag=entity.delete_flag,
                            check_unique=False)


def silver_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: first_load(spark, fn(spark, sf_dir), FIXTURE_ENTITIES[name])
            for name, fn in fixtures.ADAPTERS.items()}


def two_batch_silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Silver after two batches: every entity as it was first seen (active, a day older), then as
    it is. Deleted rows are in it with their flag."""
    out = {}
    for name, fn in fixtures.ADAPTERS.items():
        entity, batch = FIXTURE_ENTITIES[name], fn(spark, sf_dir)
        before = first_load(spark, fixtures.as_first_seen(batch), entity)
        out[name] = merge_newer_wins(before, deduplicate(batch, entity), entity.keys,
                                     version=entity.version, delete_flag=entity.delete_flag)
    return out


def gold_of(spark: SparkSession, silver: dict[str, DataFrame],
            calendar: tuple[str, str] = fixtures.FIXTURE_CALENDAR) -> dict[str, DataFrame]:
    return {
        "dim_date": build_dim_date(spark, *calendar),
        "dim_customer": build_dim_customer(silver["customers"]),
        "dim_product": build_dim_product(silver["products"]),
        "fact_order_line": build_fact_order_line(
            silver["order_items"], silver["orders"], silver["products"],
            item_keys=FIXTURE_ENTITIES["order_items"].keys),
    }


def gold_frames(spark: SparkSession, sf_dir: str,
                calendar: tuple[str, str] = fixtures.FIXTURE_CALENDAR) -> dict[str, DataFrame]:
    return gold_of(spark, silver_frames(spark, sf_dir), calendar)


def flawed_gold(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Gold frames over rows that break the rules, not deduplicated, and a short calendar. Only
    the products are whole rows, once each, for they would multiply the fact."""
    flawed = fixtures.flawed_frames(spark, sf_dir)
    products = flawed["products"].filter("product_id IS NOT NULL")
    return gold_of(spark, {**flawed, "products": first_load(
        spark, products, FIXTURE_ENTITIES["products"])}, fixtures.SHORT_CALENDAR)
