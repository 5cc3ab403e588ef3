"""Named queries over the fixture tables: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the given tables (or data Spark derives from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.casts import cast_boolean_columns
from strata.functions.dates import date_id
from strata.functions.money import money_sum_sql
from strata.functions.timestamps import normalize_timestamps
from strata.operators import kpi
from strata.operators import quality as Q
from strata.operators.dedup import deduplicate, latest_per_key
from strata.operators.layout import compact_parts, rank_bounds, zorder
from strata.operators.merge import merge_newer_wins, merge_scd1, merge_small_batch, newer_than
from strata.operators.star import dim_date_spanning
from strata.plans import pipeline as P
from strata.plans.layers import flawed_gold, gold_frames, gold_of, silver_frames, two_batch_silver
from strata.plans.pipeline import SnapshotUpsert
from strata.schemas import FIXTURE_ENTITIES, FIXTURE_RAW, FK_RULES, Namespaces
from strata.session import configure, scratch_path
from strata.sources import fixtures, incremental, jsonl, tables
from strata.streaming import file_once

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return run
    return deco


# --- star schema and KPIs ---------------------------------------------------------------

@query("dim_customer")
def q_dim_customer(spark, sf_dir):
    return gold_frames(spark, sf_dir)["dim_customer"]


@query("dim_product")
def q_dim_product(spark, sf_dir):
    return gold_frames(spark, sf_dir)["dim_product"]


@query("fact_order_line")
def q_fact(spark, sf_dir):
    return gold_frames(spark, sf_dir)["fact_order_line"]


@query("kpi_segment_month")
def q_k1(spark, sf_dir):
    g = gold_frames(spark, sf_dir)
    return kpi.revenue_margin_by_segment_month(g["fact_order_line"], g["dim_customer"],
                                               g["dim_date"])


@query("kpi_top_products")
def q_k2(spark, sf_dir):
    g = gold_frames(spark, sf_dir)
    return kpi.top_products_by_revenue(g["fact_order_line"], g["dim_product"])


@query("kpi_status_funnel")
def q_k3(spark, sf_dir):
    return kpi.funnel_by_revenue(kpi.order_status_funnel(gold_frames(spark, sf_dir)
                                                         ["fact_order_line"]))


@query("kpi_customer_ltv")
def q_k4(spark, sf_dir):
    g = gold_frames(spark, sf_dir)
    return kpi.customer_ltv(g["fact_order_line"], g["dim_customer"])


@query("kpi_daily")
def q_k5(spark, sf_dir):
    g = gold_frames(spark, sf_dir)
    return kpi.daily_kpis(g["fact_order_line"], g["dim_date"])


@query("top_segment_months")
def q_t2a(spark, sf_dir):
    return kpi.top_segment_months(q_k1(spark, sf_dir))


@query("top_products")
def q_t2b(spark, sf_dir):
    return kpi.top_products(q_k2(spark, sf_dir))


@query("top_customers")
def q_t4(spark, sf_dir):
    return kpi.top_customers(q_k4(spark, sf_dir))


@query("last_30_days")
def q_t5(spark, sf_dir):
    return kpi.last_days(q_k5(spark, sf_dir), 30)


# --- calendar, dedup, merges, projections ----------------------------------------------

ITEMS = FIXTURE_ENTITIES["order_items"]


@query("dim_date")
def q_dim_date(spark, sf_dir):
    """Date dimension spanning every order date of the orders table."""
    return dim_date_spanning(fixtures.table(spark, sf_dir, "orders"), "o_orderdate")


@query("dedup_latest")
def q_dedup(spark, sf_dir):
    """Latest row per (order, line) over all order-item change rows."""
    return deduplicate(fixtures.order_items(spark, sf_dir), ITEMS)


# Two change batches of order items: lines already fulfilled ('F') arrive first, open
# lines ('O') second. Together they are the whole table; many (order, line) keys have
# rows in both, with newer, equal and older versions, so every MERGE branch fires.
FIRST_BATCH = "l_linestatus = 'F'"
SECOND_BATCH = "NOT coalesce(l_linestatus = 'F', false)"  # the complement, NULLs included


def _item_batches(spark, sf_dir):
    first = deduplicate(fixtures.order_items(spark, sf_dir, FIRST_BATCH), ITEMS)
    second = deduplicate(fixtures.order_items(spark, sf_dir, SECOND_BATCH), ITEMS)
    return first, second


@query("merge_newer_wins")
def q_merge_newer(spark, sf_dir):
    target, source = _item_batches(spark, sf_dir)
    return merge_newer_wins(target, source, ITEMS.keys)


@query("merge_newer_wins_small_batch")
def q_merge_newer_small(spark, sf_dir):
    """The same MERGE planned without moving the table (batch size checked first)."""
    target, source = _item_batches(spark, sf_dir)
    return merge_small_batch(target, source, ITEMS.keys, update_when=newer_than("updated_at"),
                             insert_when=lambda s: s["is_deleted"] == F.lit(False))


@query("merge_scd1")
def q_merge_scd1(spark, sf_dir):
    target, source = _item_batches(spark, sf_dir)
    return merge_scd1(target, source, ITEMS.keys)


@query("cast_boolean")
def q_cast_boolean(spark, sf_dir):
    """Orders as the JSON source sends them (flag as 0/1), cast back to BOOLEAN."""
    raw = fixtures.orders(spark, sf_dir).withColumn("is_deleted",
                                                    F.col("is_deleted").cast("int"))
    return cast_boolean_columns(raw)


def _orders_as_text(spark, sf_dir):
    o = fixtures.orders(spark, sf_dir)
    fmt = "yyyy-MM-dd'T'HH:mm:ss"
    return o.withColumns({
        "order_ts": F.date_format("order_ts", fmt),
        "created_at": F.date_format("created_at", fmt),
        "updated_at": F.date_format("updated_at", fmt),
        # extraction time carries an offset, like the extractor's ISO-8601 output
        "_extracted_at": F.concat(F.date_format("_extracted_at", fmt), F.lit("+00:00")),
    })


@query("normalize_timestamps")
def q_normalize(spark, sf_dir):
    return normalize_timestamps(_orders_as_text(spark, sf_dir), wall_clock=True)


# --- incremental extract and high-water marks ------------------------------------------

EXTRACT_SINCE = "2000-01-01 00:00:00"


@query("incremental_extract")
def q_incremental(spark, sf_dir):
    """Orders changed strictly after the mark, in version order."""
    return incremental.extract_since(fixtures.orders(spark, sf_dir), EXTRACT_SINCE)


@query("full_reload")
def q_full_reload(spark, sf_dir):
    return incremental.extract_since(fixtures.orders(spark, sf_dir), None)


@query("lineage_stamp")
def q_lineage(spark, sf_dir):
    return incremental.stamp_lineage(fixtures.table(spark, sf_dir, "events"), "events",
                                     F.lit(fixtures.FIXTURE_BATCH_TS).cast("timestamp_ntz"))


ENTITY_ORDER = ("customers", "products", "orders", "order_items")


@query("watermark_state")
def q_watermark_state(spark, sf_dir):
    """State saved after extracting only orders and order_items; the other tables
    have no mark yet and start at the epoch."""
    e = fixtures.entity_frames(spark, sf_dir)
    saved = incremental.batch_marks({k: e[k] for k in ("orders", "order_items")}).select(
        "table_name", F.col("batch_max").alias("high_water_mark"))
    return incremental.load_watermarks(spark, ENTITY_ORDER, saved)


PRIOR_MARKS = {"orders": "2000-01-01 00:00:00", "order_items": "2001-01-01 00:00:00",
               "products": fixtures.FIXTURE_BATCH_TS}


@query("watermark_advance")
def q_watermark_advance(spark, sf_dir):
    """Extract each table since its mark; marks move to the batch maximum, the
    products batch is empty (nothing newer than its mark) and keeps its mark."""
    saved = spark.createDataFrame(list(PRIOR_MARKS.items()), "table_name string, hwm string") \
        .select("table_name", F.col("hwm").cast("timestamp_ntz").alias("high_water_mark"))
    state = incremental.load_watermarks(spark, ENTITY_ORDER, saved)
    batches = incremental.extract_all(fixtures.entity_frames(spark, sf_dir), state)
    return incremental.advance_watermarks(state, batches)


# --- JSON landing, append-only history, file-once streaming ----------------------------

EVENTS_SPLIT = "2024-01-15 00:00:00"


def _early():
    """First part of the events; a NULL time belongs to the second."""
    return F.coalesce(F.col("ts") < F.lit(EVENTS_SPLIT).cast("timestamp_ntz"), F.lit(False))


def _land_events(spark, sf_dir, landing):
    ev = fixtures.table(spark, sf_dir, "events")
    early = _early()
    jsonl.write_batch(ev.filter(early), landing, "events", "b0001")
    jsonl.write_batch(ev.filter(~early), landing, "events", "b0002")
    return ev


@query("ingest_json_events")
def q_ingest_json(spark, sf_dir):
    """Events written as JSON-lines batches and read back with an explicit schema."""
    landing = scratch_path(spark, "landing")
    ev = _land_events(spark, sf_dir, landing)
    return jsonl.read_source(spark, f"{landing}/events", ev.schema)


@query("direct_file_scan")
def q_direct_file(spark, sf_dir):
    landing = scratch_path(spark, "landing")
    _land_events(spark, sf_dir, landing)
    return jsonl.direct_file_query(
        spark, f"{landing}/events",
        f"SELECT event_type, COUNT(*) AS n, {money_sum_sql('value')} AS total_value "
        "FROM {src} GROUP BY event_type", schema=fixtures.table(spark, sf_dir, "events").schema)


@query("append_history")
def q_append(spark, sf_dir):
    """Two batches appended to a table; the table keeps both (history)."""
    root = scratch_path(spark, "tables")
    ev = fixtures.table(spark, sf_dir, "events")
    name = f"strata_hist_{root.rsplit('-', 1)[-1]}"
    tables.create_table(spark, name, ev.schema, root)
    early = _early()
    tables.append(ev.filter(early), name)
    tables.append(ev.filter(~early), name)
    return spark.table(name)


@query("reconcile_counts")
def q_reconcile(spark, sf_dir):
    """Rows in the landed files vs rows in the history table, per table."""
    landing = scratch_path(spark, "landing")
    ev = _land_events(spark, sf_dir, landing)
    sink = scratch_path(spark, "bronze")
    file_once.ingest_new_files(spark, f"{landing}/events", ev.schema, sink,
                               scratch_path(spark, "ckpt"))
    src = jsonl.direct_file_query(spark, f"{landing}/events",
                                  "SELECT COUNT(*) AS source_rows FROM {src}")
    tbl = spark.read.parquet(sink).agg(F.count(F.lit(1)).alias("table_rows"))
    return (src.crossJoin(tbl)
            .select(F.lit("events").alias("table_name"), "source_rows", "table_rows",
                    F.when(F.col("table_rows") >= F.col("source_rows"), "OK")
                    .otherwise("MISMATCH").alias("status"),
                    (F.col("table_rows") == F.col("source_rows")).alias("exact")))


@query("stream_file_once")
def q_stream_once(spark, sf_dir):
    """File-once ingest: batch 1 lands and is ingested, batch 2 lands, two more runs;
    the sink holds every event exactly once."""
    landing = scratch_path(spark, "landing")
    ev = fixtures.table(spark, sf_dir, "events")
    sink, ckpt = scratch_path(spark, "bronze"), scratch_path(spark, "ckpt")
    early = _early()
    jsonl.write_batch(ev.filter(early), landing, "events", "b0001")
    file_once.ingest_new_files(spark, f"{landing}/events", ev.schema, sink, ckpt)
    jsonl.write_batch(ev.filter(~early), landing, "events", "b0002")
    file_once.ingest_new_files(spark, f"{landing}/events", ev.schema, sink, ckpt)
    file_once.ingest_new_files(spark, f"{landing}/events", ev.schema, sink, ckpt)
    return spark.read.parquet(sink).drop("_batch_id")


@query("stream_upsert")
def q_stream_upsert(spark, sf_dir):
    """Newer-wins upsert per micro-batch of at most so many files: the fulfilled-lines batch lands
    and is merged into an empty table, then the open-lines batch."""
    landing = scratch_path(spark, "landing")
    ckpt, root = scratch_path(spark, "ckpt"), scratch_path(spark, "silver")
    upsert = SnapshotUpsert(spark, root, ITEMS)
    path = f"{landing}/order_items"
    jsonl.write_batch(fixtures.order_items(spark, sf_dir, FIRST_BATCH), landing, "order_items",
                      "b1")
    file_once.stream_upsert(spark, path, ITEMS.schema, ckpt, upsert, max_files_per_trigger=1000)
    jsonl.write_batch(fixtures.order_items(spark, sf_dir, SECOND_BATCH), landing, "order_items",
                      "b2")
    file_once.stream_upsert(spark, path, ITEMS.schema, ckpt, upsert, max_files_per_trigger=1000)
    return upsert.current()


# --- quality --------------------------------------------------------------------------

def _bronze(spark, sf_dir):
    return fixtures.entity_frames(spark, sf_dir)


@query("pk_nulls")
def q_pk_nulls(spark, sf_dir):
    b = _bronze(spark, sf_dir)
    return Q.pk_nulls({n: (b[n], FIXTURE_ENTITIES[n].keys) for n in ENTITY_ORDER})


@query("duplicate_keys")
def q_duplicate_keys(spark, sf_dir):
    b = _bronze(spark, sf_dir)
    return Q._union(Q.key_checks(n, b[n], FIXTURE_ENTITIES[n].keys) for n in ENTITY_ORDER)


@query("silver_quality")
def q_silver_quality(spark, sf_dir):
    s = silver_frames(spark, sf_dir)
    return Q._union(Q.silver_quality(n, s[n], FIXTURE_ENTITIES[n]) for n in ENTITY_ORDER)


GOLD_KEYS = {"dim_date": ("date_id",), "dim_customer": ("customer_id",),
             "dim_product": ("product_id",), "fact_order_line": ITEMS.keys}


@query("gold_quality")
def q_gold_quality(spark, sf_dir):
    g = gold_frames(spark, sf_dir)
    return Q._union(Q.gold_quality(n, g[n], k) for n, k in GOLD_KEYS.items())


RULES = [Q.ForeignKey(*r) for r in FK_RULES]


@query("fk_orphans")
def q_fk(spark, sf_dir):
    g = gold_frames(spark, sf_dir)
    return Q.fk_orphans(g["fact_order_line"], g, RULES)


@query("metric_sanity")
def q_metric(spark, sf_dir):
    return Q.metric_sanity(gold_frames(spark, sf_dir)["fact_order_line"])


@query("check_constraints")
def q_constraints(spark, sf_dir):
    s = silver_frames(spark, sf_dir)
    return Q._union(Q.constraint_violations(n, s[n], FIXTURE_ENTITIES[n],
                                            unique=("email",) if n == "customers" else ())
                    for n in ENTITY_ORDER)


FRESH_AS_OF, FRESH_MAX_HOURS = "2024-06-02 00:00:00", 24.0


@query("freshness")
def q_freshness(spark, sf_dir):
    s = silver_frames(spark, sf_dir)
    return Q.freshness({n: s[n] for n in ENTITY_ORDER}, FRESH_AS_OF, FRESH_MAX_HOURS)


@query("profile_columns")
def q_profile(spark, sf_dir):
    return Q.profile_columns(gold_frames(spark, sf_dir)["fact_order_line"])


@query("table_row_counts")
def q_counts(spark, sf_dir):
    g = gold_frames(spark, sf_dir)
    return Q._union(g[n].agg(F.count(F.lit(1)).alias("rows"))
                    .select(F.lit(n).alias("table_name"), "rows") for n in GOLD_KEYS)


# --- layout ---------------------------------------------------------------------------

@query("zorder_layout")
def q_zorder(spark, sf_dir):
    """The fact written Z-ordered by (date_id, customer_id) and read back."""
    fact = gold_frames(spark, sf_dir)["fact_order_line"]
    # boundaries from samples of one column of orders and of customers, not from a pass over the fact
    orders = fixtures.table(spark, sf_dir, "orders")
    bounds = {**rank_bounds(orders.select(date_id("o_orderdate").alias("date_id")), ["date_id"]),
              **rank_bounds(fixtures.table(spark, sf_dir, "customer")
                            .select(F.col("c_custkey").alias("customer_id")), ["customer_id"])}
    path = scratch_path(spark, "fact_z")
    zorder(fact, ["date_id", "customer_id"], bounds=bounds).write.parquet(path)
    return spark.read.parquet(path)


@query("compact")
def q_compact(spark, sf_dir):
    """The fact written as many small files into hash partitions; those that their bytes don't
    fill are rewritten, and the table is read back."""
    fact = gold_frames(spark, sf_dir)["fact_order_line"]
    root = scratch_path(spark, "tables")
    name = f"strata_compact_{root.rsplit('-', 1)[-1]}"
    tables.create_parts(spark, name, fact.schema, root, parts=4)
    parted = fact.withColumn(tables.PART, tables.part_of(ITEMS.keys, 4))
    tables.publish_parts(spark, parted.repartition(8), name, root, range(4))
    compact_parts(spark, name, root)
    return spark.table(name).drop(tables.PART)


@query("table_sample")
def q_sample(spark, sf_dir):
    """Five rows of the fact, unordered (a peek; rows-only check)."""
    return gold_frames(spark, sf_dir)["fact_order_line"].limit(5)


@query("table_sample_rows")
def q_sample_rows(spark, sf_dir):
    """A peek at five rows of a published table, each looked up in the table: how many there are,
    and how many of them the table holds."""
    root = scratch_path(spark, "tables")
    name = f"strata_sample_{root.rsplit('-', 1)[-1]}"
    tables.publish(spark, gold_frames(spark, sf_dir)["fact_order_line"], name, root)
    peek = spark.table(name).limit(5).checkpoint()
    held = peek.join(spark.table(name).select(*ITEMS.keys), list(ITEMS.keys), "left_semi")
    return peek.agg(F.count(F.lit(1)).alias("sampled")).crossJoin(
        held.agg(F.count(F.lit(1)).alias("held")))


def _view(kpi_):
    def run(spark, sf_dir):
        g = gold_frames(spark, sf_dir)
        tag = scratch_path(spark, "v").rsplit("-", 1)[-1]
        names = {t: f"strata_{t}_{tag}" for t in g}
        for t, df in g.items():
            df.createOrReplaceTempView(names[t])
        return spark.sql(kpi.view_sql(kpi_, names))
    run.__doc__ = f"{kpi_.view}: the view's statement, over temp views of the star frames."
    return run


for _name, _kpi in (("kpi_segment_month_view", kpi.SEGMENT_MONTH),
                    ("kpi_top_products_view", kpi.TOP_PRODUCTS),
                    ("kpi_status_funnel_view", kpi.STATUS_FUNNEL),
                    ("kpi_customer_ltv_view", kpi.CUSTOMER_LTV), ("kpi_daily_view", kpi.DAILY)):
    query(_name)(_view(_kpi))


@query("events_latest")
def q_events_latest(spark, sf_dir):
    """The event stream as a change log: latest event per (user, event type) by time,
    ties broken by event id."""
    return latest_per_key(fixtures.table(spark, sf_dir, "events"), ["user_id", "event_type"],
                          ["ts", "event_id"])


# --- silver after two batches, and rows that break every rule ---------------------------------

@query("dim_customer_two_batches")
def q_dim_customer_two(spark, sf_dir):
    """Customers first seen active, then deleted by a later batch: ``is_active`` is false for them."""
    return gold_of(spark, two_batch_silver(spark, sf_dir))["dim_customer"]


@query("dim_product_two_batches")
def q_dim_product_two(spark, sf_dir):
    return gold_of(spark, two_batch_silver(spark, sf_dir))["dim_product"]


@query("fact_order_line_two_batches")
def q_fact_two(spark, sf_dir):
    """The fact over silver tables that hold deleted rows: the active-row filter drops these items
    and orders, while deleted products still give their cost."""
    return gold_of(spark, two_batch_silver(spark, sf_dir))["fact_order_line"]


@query("silver_quality_two_batches")
def q_silver_quality_two(spark, sf_dir):
    s = two_batch_silver(spark, sf_dir)
    return Q._union(Q.silver_quality(n, s[n], FIXTURE_ENTITIES[n]) for n in ENTITY_ORDER)


@query("pk_nulls_flawed")
def q_pk_nulls_flawed(spark, sf_dir):
    f = fixtures.flawed_frames(spark, sf_dir)
    return Q.pk_nulls({n: (f[n], FIXTURE_ENTITIES[n].keys) for n in ENTITY_ORDER})


@query("silver_quality_flawed")
def q_silver_quality_flawed(spark, sf_dir):
    f = fixtures.flawed_frames(spark, sf_dir)
    return Q._union(Q.silver_quality(n, f[n], FIXTURE_ENTITIES[n]) for n in ENTITY_ORDER)


@query("check_constraints_flawed")
def q_constraints_flawed(spark, sf_dir):
    f = fixtures.flawed_frames(spark, sf_dir)
    return Q._union(Q.constraint_violations(n, f[n], FIXTURE_ENTITIES[n],
                                            unique=("email",) if n == "customers" else ())
                    for n in ENTITY_ORDER)


@query("duplicate_key_list")
def q_duplicate_key_list(spark, sf_dir):
    """The keys that are there more than once, with their number of rows."""
    b = _bronze(spark, sf_dir)
    return Q._union(Q.duplicate_keys(n, b[n], FIXTURE_ENTITIES[n].keys) for n in ENTITY_ORDER)


@query("gold_quality_flawed")
def q_gold_quality_flawed(spark, sf_dir):
    g = flawed_gold(spark, sf_dir)
    return Q._union(Q.gold_quality(n, g[n], k) for n, k in GOLD_KEYS.items())


@query("fk_orphans_flawed")
def q_fk_flawed(spark, sf_dir):
    """Orders with NULL customers, products that are gone, a calendar that ends too early."""
    g = flawed_gold(spark, sf_dir)
    return Q.fk_orphans(g["fact_order_line"], g, RULES)


@query("metric_sanity_flawed")
def q_metric_flawed(spark, sf_dir):
    return Q.metric_sanity(flawed_gold(spark, sf_dir)["fact_order_line"])


@query("gate_failures")
def q_gate(spark, sf_dir):
    """What the gate of the key checks says after all tables were checked, one row per failure."""
    report = Q.QualityReport()
    f = fixtures.flawed_frames(spark, sf_dir)
    report.add_results(Q.pk_nulls({n: (f[n], FIXTURE_ENTITIES[n].keys) for n in ENTITY_ORDER}))
    try:
        report.gate()
        said = []
    except RuntimeError as e:
        said = str(e).splitlines()[1:]
    return spark.createDataFrame([(x,) for x in said], "failure string")


# --- DDL, namespaces, overwrite ---------------------------------------------------------------

@query("create_table_twice")
def q_ddl(spark, sf_dir):
    """CREATE TABLE IF NOT EXISTS from a schema, rows appended, the same DDL again: they stay."""
    root = scratch_path(spark, "tables")
    name = f"strata_ddl_{root.rsplit('-', 1)[-1]}"
    schema = FIXTURE_ENTITIES["orders"].schema
    tables.create_table(spark, name, schema, root)
    tables.append(fixtures.orders(spark, sf_dir), name)
    tables.create_table(spark, name, schema, root)
    return spark.table(name)


@query("namespace_selected")
def q_namespace(spark, sf_dir):
    """Select a namespace, make it if needed, and write to it by an unqualified name."""
    before = spark.catalog.currentDatabase()
    root = scratch_path(spark, "tables")
    name = f"ns_orders_{root.rsplit('-', 1)[-1]}"
    try:
        tables.use_namespace(spark, "strata_selected", catalog="spark_catalog")
        tables.publish(spark, fixtures.orders(spark, sf_dir), name, root)
        where = spark.sql("SELECT current_catalog() AS catalog, current_schema() AS namespace").first()
    finally:
        spark.sql(f"USE {before}")
    return spark.table(f"strata_selected.{name}").agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(where["catalog"]).alias("catalog"), F.lit(where["namespace"]).alias("namespace"), "rows")


@query("overwrite_schema")
def q_overwrite(spark, sf_dir):
    """A table overwritten by rows of another schema, as the calendar is on every run."""
    root = scratch_path(spark, "tables")
    name = f"strata_over_{root.rsplit('-', 1)[-1]}"
    tables.publish(spark, fixtures.orders(spark, sf_dir).select("order_id", "order_ts"), name, root)
    tables.publish(spark, q_dim_date(spark, sf_dir), name, root)
    return spark.table(name)


# --- whole runs over landed files --------------------------------------------------------------

def _as_landed(df: DataFrame) -> DataFrame:
    """Rows as the source sends them: timestamps as text, the flag as 0/1."""
    return df.select(*[
        F.date_format(f.name, "yyyy-MM-dd'T'HH:mm:ss").alias(f.name) if f.dataType.typeName() == "timestamp_ntz"
        else F.col(f.name).cast("int").alias(f.name) if f.dataType.typeName() == "boolean"
        else F.col(f.name) for f in df.schema.fields])


def _lake(spark) -> tuple[P.Lakehouse, str]:
    root = scratch_path(spark, "lake")
    tag = root.rsplit("-", 1)[-1]
    return P.Lakehouse(spark, root, FIXTURE_ENTITIES, FIXTURE_RAW,
                       ns=Namespaces(*[f"strata_{x}_{tag}" for x in ("bronze", "silver", "gold")]),
                       calendar=fixtures.FIXTURE_CALENDAR, item_keys=ITEMS.keys, parts=4,
                       wall_clock=True), f"{root}/landing"


def _land(batches: dict[str, DataFrame], landing: str, batch_id: str) -> None:
    for name, df in batches.items():
        jsonl.write_batch(_as_landed(df), landing, name, batch_id)


@query("pipeline_two_batches")
def q_pipeline_two(spark, sf_dir):
    """Landed files to the gold fact in two runs: fulfilled lines first, then open ones. Lines that
    the second batch deletes stay in the fact, as an SCD-1 MERGE leaves them."""
    lh, landing = _lake(spark)
    e = fixtures.entity_frames(spark, sf_dir)
    _land({**e, "order_items": fixtures.order_items(spark, sf_dir, FIRST_BATCH)}, landing, "b1")
    P.run_all(lh, landing, strict=False)
    _land({"order_items": fixtures.order_items(spark, sf_dir, SECOND_BATCH)}, landing, "b2")
    P.run_all(lh, landing, strict=False)
    return lh.table("gold", "fact_order_line")


@query("pipeline_late_batch")
def q_pipeline_late(spark, sf_dir):
    """Orders that land after their items and after a gold run, with an older extraction time."""
    lh, landing = _lake(spark)
    e = fixtures.entity_frames(spark, sf_dir)
    late = F.col("customer_id") % 3 == 0
    _land({**e, "orders": e["orders"].filter(~F.coalesce(late, F.lit(False)))}, landing, "b1")
    P.run_all(lh, landing, strict=False)
    _land({"orders": e["orders"].filter(F.coalesce(late, F.lit(False)))}, landing, "b0")
    P.run_all(lh, landing, strict=False)
    return lh.table("gold", "fact_order_line")


@query("pipeline_full_reload")
def q_pipeline_full(spark, sf_dir):
    """Two runs, the second one a full reload: history holds every landed row twice, silver and
    gold are as before."""
    lh, landing = _lake(spark)
    _land(fixtures.entity_frames(spark, sf_dir), landing, "b1")
    P.run_all(lh, landing, strict=False)
    P.run_all(lh, landing, full=True, strict=False)
    layers = [("bronze", n, lh.bronze(n)) for n in ENTITY_ORDER] + \
        [("silver", n, lh.table("silver", n)) for n in ENTITY_ORDER] + \
        [("gold", n, lh.table("gold", n)) for n in GOLD_KEYS]
    return Q._union(df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(layer).alias("layer"), F.lit(n).alias("table_name"), "rows") for layer, n, df in layers)


@query("pipeline_cancel_after_load")
def q_pipeline_cancel(spark, sf_dir):
    """Orders loaded as active and cancelled by a later batch; with pruning, their lines leave the
    fact. Read through the published status view."""
    lh, landing = _lake(spark)
    e = fixtures.entity_frames(spark, sf_dir)
    _land({**e, "orders": fixtures.as_first_seen(e["orders"])}, landing, "b1")
    P.run_all(lh, landing, prune_missing=True, strict=False)
    _land({"orders": e["orders"]}, landing, "b2")
    P.run_all(lh, landing, prune_missing=True, strict=False)
    return spark.sql(f"SELECT * FROM {lh.ns.gold}.{kpi.STATUS_FUNNEL.view}")


@query("extract_run")
def q_extract_run(spark, sf_dir):
    """Two extract runs. Orders are committed at the source after the first run has read it and
    before it commits its marks: the marks are those of what was written, so the second run
    finds them. Rows landed per batch, and the marks at last."""
    landing, state = scratch_path(spark, "landing"), scratch_path(spark, "marks")
    source = scratch_path(spark, "source")
    orders = fixtures.orders(spark, sf_dir)
    early = F.coalesce(F.col("updated_at") < F.lit("1999-01-01").cast("timestamp_ntz"), F.lit(True))
    stamp = F.lit(fixtures.FIXTURE_BATCH_TS).cast("timestamp_ntz")

    def read():
        return {"orders": spark.read.parquet(source), "products": fixtures.products(spark, sf_dir)}
    orders.filter(early).write.parquet(source)
    written = incremental.write_run(read(), landing, state, extracted_at=stamp)
    orders.filter(~early).write.mode("append").parquet(source)
    incremental.commit_run(spark, written, landing, state)
    marks = incremental.extract_run(read(), landing, state, extracted_at=stamp)
    rows = Q._union(
        jsonl.read_source(spark, f"{landing}/{t}", FIXTURE_ENTITIES[t].schema)
        .withColumn("batch", F.regexp_extract(F.input_file_name(), r"batch=([^/]+)/", 1))
        .groupBy("batch").agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(t).alias("table_name"), "batch", "rows") for t in ("orders", "products"))
    return rows.join(marks, "table_name")


BROKEN, WIDER, TEXT_IN_NUMBER = 7, 13, 21  # rests of event_id modulo 50


def _odd_lines(events: DataFrame) -> DataFrame:
    """Events as JSON lines, some of them cut off, with a field more, or with text in a number."""
    rest = F.col("event_id") % 50
    line = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    return events.select(
        F.when(rest == BROKEN, F.substring(line, 1, 10))
        .when(rest == WIDER, F.to_json(F.struct("event_id", "user_id", "event_type", "value", F.concat(
            F.lit("e"), F.col("event_id").cast("string")).alias("extra"))))
        .when(rest == TEXT_IN_NUMBER, F.to_json(F.struct(
            "event_id", "user_id", "event_type", F.lit("n/a").alias("value"))))
        .otherwise(line).alias("value"), "ts")


@query("ingest_malformed_json")
def q_malformed(spark, sf_dir):
    """Two batches of lines ingested once: broken ones, an unknown field, text in a number."""
    landing, sink, ckpt = (scratch_path(spark, x) for x in ("landing", "bronze", "ckpt"))
    ev = fixtures.table(spark, sf_dir, "events")
    schema = ev.select("event_id", "user_id", "event_type", "value").schema
    for where, batch in ((_early(), "b1"), (~_early(), "b2")):
        _odd_lines(ev.filter(where)).select("value").write.text(f"{landing}/events/batch={batch}")
        file_once.ingest_new_files(spark, f"{landing}/events", None, sink, ckpt,
                                   transform=lambda lines: jsonl.parse_lines(lines, schema))
    return spark.read.parquet(sink)


@query("pipeline_quarantine")
def q_quarantine(spark, sf_dir):
    """Orders with NULL keys, text in a number, an unknown field and cut-off lines through bronze
    and silver: rows per reason in quarantine, rows with rescued fields, rows that reached silver."""
    lh, landing = _lake(spark)
    e = fixtures.entity_frames(spark, sf_dir)
    key = F.col("order_id")
    rest = key % 50
    o = _as_landed(e["orders"])
    line = F.to_json(F.struct(*[
        F.when(rest != 3, key).alias("order_id") if c == "order_id" else
        F.when(rest == 21, "n/a").otherwise(F.col(c).cast("string")).alias(c) if c == "total_amount"
        else F.col(c) for c in o.columns], F.when(rest == 13, "x").alias("extra")))
    # all amounts are text but for the quotes, which a number must not have
    line = F.when(rest == 21, line).otherwise(
        F.regexp_replace(line, '"total_amount":"([^"]*)"', '"total_amount":$1'))
    line = F.when(rest == 7, F.substring(line, 1, 12)).otherwise(line)
    o.select(line.alias("value")).write.options(**jsonl.WRITE_OPTIONS).text(f"{landing}/orders/batch=b1")
    _land({n: e[n] for n in ENTITY_ORDER if n != "orders"}, landing, "b1")
    P.run_bronze(lh, landing)              # fails its gate: NULL keys
    P.run_bronze(lh, landing).gate()       # they are in quarantine now
    P.run_silver(lh)
    held = lh.quarantine("orders").groupBy(F.concat(F.lit("quarantine: "), "reason").alias("what"))
    kept = P.rescued(lh).groupBy(F.concat_ws(" ", F.lit("rescued:"), "issue", "field").alias("what"))
    return (held.agg(F.count(F.lit(1)).alias("rows"))
            .unionByName(kept.agg(F.sum("rows").alias("rows")))
            .unionByName(lh.table("silver", "orders").agg(F.count(F.lit(1)).alias("rows"))
                         .select(F.lit("silver").alias("what"), "rows")))
