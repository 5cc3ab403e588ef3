"""Bronze -> silver -> gold over persisted, versioned tables.

* bronze: landed JSON files are ingested exactly once (file-stream checkpoint), what doesn't fit
  the schema is rescued, timestamps normalised inside the micro-batch, one folder and one catalog
  partition per micro-batch id (append-only history, replay-safe). The catalog is the registry of
  the batches: no run reads history to learn what is there.
* silver: only bronze batches newer than the last one applied are read
  (partition pruning on ``_batch_id``), flags cast, latest row per key, and a
  newer-wins merge that rewrites only the hash partitions the batch touches.
* gold: dimensions and the order-line fact are SCD-1 merged the same way (the
  fact Z-ordered by date and customer inside the rewritten partitions); foreign keys, metrics and
  key checks run; the five KPI views are (re)created over the published tables.

Every layer collects its checks first and raises once at the end
(``QualityReport.gate``), for bronze, silver and gold alike.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.casts import cast_boolean_columns
from strata.functions.timestamps import TS_ERRORS, normalize_timestamps
from strata.operators import quality as Q
from strata.operators.dedup import deduplicate
from strata.operators.kpi import KPIS, view_sql
from strata.operators.layout import compact_parts, rank_bounds, zorder
from strata.operators.merge import newer_than
from strata.operators.star import (build_dim_customer, build_dim_date, build_dim_product,
                                   build_fact_order_line)
from strata.operators.upsert import SOURCE_PASSES, merge_into, parts_for, passes_for
from strata.schemas import CALENDAR_END, CALENDAR_START, FK_RULES, Entity, Namespaces
from strata.session import freed_shuffles, written
from strata.sources import tables
from strata.sources.jsonl import CORRUPT, REJECTED, RESCUED, parse_lines, read_source, rescued_fields
from strata.streaming.file_once import ingest_new_files

BATCH_PROP = "strata.bronze_batch"
#: Silver rows carry the bronze batch that last wrote them: an arrival order, unlike the
#: source's extraction time, so late batches are newer than whatever gold has seen.
BATCH_COLUMN = "_batch_id"


class SnapshotUpsert:
    """``foreachBatch`` handler: newer-wins merge of a micro-batch into a table.

    Each micro-batch rewrites the hash partitions that it touches and then sets its id as the
    table's mark. A replay of a batch at or below the mark is skipped; one after a crash midway
    merges again, which changes nothing that stood already, so the sink is exactly-once although
    ``foreachBatch`` is at-least-once.
    """

    def __init__(self, spark: SparkSession, root: str, entity: Entity,
                 name: str | None = None, parts: int | None = None):
        self.spark, self.root, self.entity, self.parts = spark, root.rstrip("/"), entity, parts
        self.name = name or "strata_upsert_" + re.sub(r"\W", "_", self.root.rsplit("/", 1)[-1])

    def _mark(self) -> int:
        return int(tables.get_property(self.spark, self.name, BATCH_PROP) or -1)

    def next_id(self) -> int:
        """The first free micro-batch id, where a fresh checkpoint goes on."""
        return self._mark() + 1

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if batch_id <= self._mark():
            return
        latest = deduplicate(cast_boolean_columns(batch), self.entity)
        flag = self.entity.delete_flag
        merge_into(self.name, latest.select(*self.entity.columns), self.entity.keys, self.root,
                   update_when=newer_than(self.entity.version),
                   insert_when=lambda s: s[flag] == F.lit(False), parts=self.parts,
                   properties={BATCH_PROP: str(batch_id)})

    def current(self) -> DataFrame:
        return self.spark.table(self.name).drop(tables.PART)


@dataclass
class Lakehouse:
    spark: SparkSession
    root: str
    entities: dict[str, Entity]
    raw_schemas: dict[str, T.StructType]
    ns: Namespaces = field(default_factory=Namespaces)
    calendar: tuple[str, str] = (CALENDAR_START, CALENDAR_END)
    item_keys: tuple[str, ...] = ("order_item_id",)
    # largest change batch merged by broadcasting it (checked by a row count)
    broadcast_batch_rows: int = 1_000_000
    # silver and gold tables are split into hash partitions of their key; a merge rewrites those
    # it touches. None: sized from a table's first batch, by ``part_bytes``
    parts: int | None = None
    part_bytes: int = 256 << 20
    # landed files per bronze micro-batch: a backlog is ingested in bounded,
    # separately committed steps
    max_files_per_trigger: int | None = 10_000
    # timestamps as TIMESTAMP_NTZ (UTC wall clock) instead of TIMESTAMP
    wall_clock: bool = False

    def name(self, layer: str, table: str) -> str:
        return f"{getattr(self.ns, layer)}.{table}"

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def table(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table)).drop(tables.PART)

    def bronze(self, entity: str) -> DataFrame:
        return self.spark.table(self.name("bronze", entity))

    def quarantine(self, entity: str) -> DataFrame:
        """Bronze rows that are not to be used, with the ``reason``; there once a run found one."""
        return self.spark.table(self.name("bronze", f"{entity}_quarantine"))


def _reason(ent: Entity) -> Column:
    """Why a bronze row is not to be used: a malformed line, uncastable fields, or its NULL key
    columns; empty where it is good."""
    nulls = F.concat_ws(",", *[F.when(F.col(k).isNull(), F.lit(k)) for k in ent.keys])
    return F.coalesce(F.col(REJECTED), nulls)


def _at_once(work: Callable, names: Iterable[str]) -> dict:
    """``work(name)`` of every table, as concurrent Spark jobs: small tables don't wait for large
    ones. All are done (or have failed) before the first error is raised."""
    names = list(names)
    with ThreadPoolExecutor(max(1, len(names))) as pool:
        jobs = {n: pool.submit(work, n) for n in names}
    return {n: j.result() for n, j in jobs.items()}


GENERATION, CHECKED = "strata.generation", "strata.checked_batch"


def _staged(lh: Lakehouse, name: str, lines: DataFrame) -> DataFrame:
    return normalize_timestamps(parse_lines(lines, lh.raw_schemas[name]),
                                wall_clock=lh.wall_clock, count_errors=True)


def _bronze_schema(lh: Lakehouse, name: str) -> T.StructType:
    return _staged(lh, name, lh.spark.createDataFrame([], "value string")).schema


def ingest_entity(lh: Lakehouse, landing: str, name: str, full: bool = False) -> bool:
    """Ingest the new landed files of one entity; False where it has no folder yet.

    ``full`` ingests every file again, over a checkpoint of the next generation. The generation
    is noted first, so a full reload that is lost midway goes on in the next run and is not begun
    anew; the batch ids go on.
    """
    spark, table = lh.spark, lh.name("bronze", name)
    if not spark.catalog.tableExists(table):
        tables.create_history(spark, table, _bronze_schema(lh, name), lh.path("bronze", name),
                              BATCH_COLUMN)
    generation = int(tables.get_property(spark, table, GENERATION) or 0)
    if full:
        generation += 1
        tables.set_properties(spark, table, {GENERATION: str(generation)})
    checkpoint = lh.path("_checkpoints", "bronze", name, *([f"g={generation}"] if generation else []))
    try:
        ingest_new_files(
            spark, f"{landing.rstrip('/')}/{name}", None, lh.path("bronze", name), checkpoint,
            transform=lambda lines: _staged(lh, name, lines),
            max_files_per_trigger=lh.max_files_per_trigger,
            next_id=lambda: max(tables.partitions(spark, table), default=-1) + 1,
            on_batch=lambda b, folder: tables.point_partitions(spark, table, BATCH_COLUMN,
                                                               {b: folder}))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def _quarantine(lh: Lakehouse, name: str, bad: DataFrame, batches: Sequence[int]) -> None:
    """Copy the bad rows of these batches, each to a partition of the quarantine table."""
    table, path = lh.name("bronze", f"{name}_quarantine"), lh.path("quarantine", name)
    tables.create_history(lh.spark, table, bad.drop(BATCH_COLUMN).schema, path, BATCH_COLUMN)
    for b in batches:
        folder = f"{path}/{BATCH_COLUMN}={b}"
        bad.filter(F.col(BATCH_COLUMN) == b).drop(BATCH_COLUMN).write.mode("overwrite").parquet(folder)
        tables.point_partitions(lh.spark, table, BATCH_COLUMN, {b: folder})


def run_bronze(lh: Lakehouse, landing: str, full: bool = False) -> Q.QualityReport:
    """Ingest new landed files of every entity (``full``: all of them again); check the batches not
    yet checked.

    A table without a landed folder is skipped (``info``: ``<table>.skipped``). A table's mark
    moves only when the checks of all tables passed, so a failed run's batches, or
    those of a driver lost before the check, are checked again. Rows with NULL keys, malformed
    lines among them, fail the run that finds them; these and rows with uncastable fields are copied
    with the reason to the quarantine, batch by batch, and fail no later run (``info``:
    ``<table>.quarantined``). Silver leaves such rows out. ``info`` also counts, over the
    batches checked, ``malformed_lines``, ``uncastable_rows``, rows with ``unknown_fields`` and
    ``malformed_timestamps``.
    """
    spark, report, found, tops = lh.spark, Q.QualityReport(), {}, {}
    tables.ensure_namespace(spark, lh.ns.bronze)
    there = _at_once(lambda n: ingest_entity(lh, landing, n, full), lh.entities)
    report.info |= {f"{n}.skipped": 1 for n, landed in there.items() if not landed}

    def check(name: str) -> None:
        ent, table = lh.entities[name], lh.name("bronze", name)
        mark = int(tables.get_property(spark, table, CHECKED) or -1)
        todo = [b for b in tables.partitions(spark, table) if b > mark]
        held = [b for b in tables.partitions(spark, f"{table}_quarantine") if b > mark]
        if held:
            report.info[f"{name}.quarantined"] = lh.quarantine(name).filter(
                F.col(BATCH_COLUMN).isin(held)).count()
        df = lh.bronze(name).filter(F.col(BATCH_COLUMN).isin(todo) if todo else F.lit(False))
        df = df.withColumn("reason", _reason(ent))
        # one pass per table, one row per batch
        counts = df.groupBy(BATCH_COLUMN).agg(
            F.count_if(F.col("reason") != "").alias("bad"),
            *[F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in ent.keys],
            F.count_if(F.col(CORRUPT).isNotNull()).alias("malformed_lines"),
            F.count_if(F.col(CORRUPT).isNull() & F.col(REJECTED).isNotNull()).alias("uncastable_rows"),
            F.count_if(F.col(RESCUED).isNotNull() & F.col(REJECTED).isNull()).alias("unknown_fields"),
            F.coalesce(F.sum(TS_ERRORS), F.lit(0)).alias("malformed_timestamps"))
        found[name] = (df, counts.collect() if todo else [], held)
        if todo:
            tops[name] = todo[-1]
    _at_once(check, lh.entities)
    for name in lh.entities:
        df, counts, held = found[name]
        for label in ("malformed_lines", "uncastable_rows", "unknown_fields", "malformed_timestamps"):
            report.info[f"{name}.{label}"] = sum(r[label] for r in counts)
        fresh = [r for r in counts if r[BATCH_COLUMN] not in held]
        for k in lh.entities[name].keys:
            report.require_zero(f"{name}.{k} nulls", sum(r[f"null_{k}"] for r in fresh))
        bad = [r[BATCH_COLUMN] for r in fresh if r["bad"]]
        if bad:
            _quarantine(lh, name, df.filter("reason != ''"), bad)
    if not report.failures:
        for name, top in tops.items():
            tables.set_properties(spark, lh.name("bronze", name), {CHECKED: str(top)})
    return report


def rescued(lh: Lakehouse) -> DataFrame:
    """(table_name, _batch_id, field, issue, rows): fields that landed without a place in the
    schema, per batch: new columns at the source, or values of another type."""
    return Q._union(rescued_fields(lh.bronze(n), lh.raw_schemas[n], (BATCH_COLUMN,)).select(
        F.lit(n).alias("table_name"), BATCH_COLUMN, "field", "issue", "rows") for n in lh.entities)


def reconcile(lh: Lakehouse, landing: str) -> DataFrame:
    """Rows in landed files vs rows in bronze, per table (exact with file-once ingest)."""
    out = []
    for n in lh.entities:
        src = read_source(lh.spark, f"{landing.rstrip('/')}/{n}", lh.raw_schemas[n]) \
            .agg(F.count(F.lit(1)).alias("source_rows"))
        brz = lh.bronze(n).agg(F.count(F.lit(1)).alias("table_rows"))
        out.append(src.crossJoin(brz).select(
            F.lit(n).alias("table_name"), "source_rows", "table_rows",
            F.when(F.col("table_rows") >= F.col("source_rows"), "OK").otherwise("MISMATCH")
            .alias("status"),
            # file-once ingest makes the counts equal, not just ">="
            (F.col("table_rows") == F.col("source_rows")).alias("exact")))
    return Q._union(out)


def _applied_batch(lh: Lakehouse, table: str) -> int:
    value = tables.get_property(lh.spark, table, BATCH_PROP)
    return int(value) if value is not None else -1


def run_silver(lh: Lakehouse) -> Q.QualityReport:
    """Apply the bronze batches not yet applied to each silver table."""
    spark, report = lh.spark, Q.QualityReport()
    tables.ensure_namespace(spark, lh.ns.silver)

    def apply(n: str) -> DataFrame | None:
        ent, target = lh.entities[n], lh.name("silver", n)
        done = _applied_batch(lh, target)
        todo = [b for b in tables.partitions(spark, lh.name("bronze", n)) if b > done]
        if not todo:  # nothing landed: at most an empty table
            schema = T.StructType([*ent.schema.fields, T.StructField(BATCH_COLUMN, T.LongType())])
            tables.create_parts(spark, target, schema, lh.path("tables"), lh.parts or parts_for(0, schema))
            return None
        new = lh.bronze(n).filter(F.col(BATCH_COLUMN).isin(todo))
        # bad rows are in quarantine, or will be when bronze checks their batch
        latest = deduplicate(cast_boolean_columns(new.filter(_reason(ent) == "")), ent)
        latest = latest.select(*[F.col(f.name).cast(f.dataType) for f in ent.schema.fields],
                               BATCH_COLUMN)
        merge_into(target, latest, ent.keys, lh.path("tables"),
                   update_when=newer_than(ent.version),
                   insert_when=lambda s: s[ent.delete_flag] == F.lit(False),
                   parts=lh.parts, part_bytes=lh.part_bytes,
                   max_batch_rows=lh.broadcast_batch_rows, rows=new.count(),
                   properties={BATCH_PROP: str(todo[-1])})
        return Q.silver_quality(n, lh.table("silver", n), ent)
    with freed_shuffles(spark):
        checks = [c for c in _at_once(apply, lh.entities).values() if c is not None]
        if checks:
            report.add_results(Q._union(checks))
    report.gate()
    return report


SILVER_MARK = "strata.silver_mark"


Marks = dict[str, int | None]


def changed_since(df: DataFrame, mark: int | None) -> DataFrame:
    """Silver rows inserted or replaced by a bronze batch after ``mark``."""
    return df if mark is None else df.filter(F.col(BATCH_COLUMN) > mark)


def touched_orders(silver: dict[str, DataFrame], marks: Marks) -> DataFrame | None:
    """Ids of the orders touched since ``marks``: their header, one of their items, or the product of
    one of their items changed. ``None`` on the first run: everything is rebuilt."""
    items, orders, products = silver["order_items"], silver["orders"], silver["products"]
    if all(m is None for m in marks.values()):
        return None
    changed_products = changed_since(products, marks["products"]).select("product_id")
    return (changed_since(items, marks["order_items"]).select("order_id")
            .unionByName(changed_since(orders, marks["orders"]).select("order_id"))
            .unionByName(items.join(changed_products, "product_id", "left_semi")
                         .select("order_id"))
            .distinct())


def fact_delta(silver: dict[str, DataFrame], touched: DataFrame | None,
               item_keys: tuple[str, ...]) -> DataFrame:
    """Fact lines to (re)compute: those of every touched order."""
    items, orders, products = silver["order_items"], silver["orders"], silver["products"]
    if touched is not None:
        items = items.join(touched, "order_id", "left_semi")
        orders = orders.join(touched, "order_id", "left_semi")
    return build_fact_order_line(items, orders, products, item_keys=item_keys)


def _delta_passes(silver: dict[str, DataFrame], touched: DataFrame | None, delta: DataFrame) -> int:
    """Passes in which the delta is computed, as if all orders had equally many lines."""
    lines = silver["order_items"].count()
    if touched is not None:
        lines = lines * touched.count() // max(1, silver["orders"].count())
    return passes_for(lines, delta.schema, SOURCE_PASSES)


def _gold_marks(lh: Lakehouse, fact: str) -> Marks:
    """Per silver table, the bronze batch that the last gold run had applied."""
    have = tables.get_properties(lh.spark, fact)
    found = {n: have.get(f"{SILVER_MARK}.{n}") for n in lh.entities}
    return {n: None if v is None else int(v) for n, v in found.items()}


def _stale_lines(before: DataFrame, delta: DataFrame, touched: DataFrame | None,
                 keys: Sequence[str]) -> DataFrame:
    """Keys of lines of rebuilt orders that the rebuild no longer produces."""
    scope = before if touched is None else before.join(touched, "order_id", "left_semi")
    return scope.select(*keys).join(delta.select(*keys), list(keys), "left_anti")


def run_gold(lh: Lakehouse, prune_missing: bool = False, incremental: bool = True,
             relayout: bool = True, strict: bool = True) -> Q.QualityReport:
    """Dimensions, fact, checks, layout, KPI views.

    ``incremental``: only silver rows changed since the last gold run (their
    bronze batch is newer than the table's mark, kept as a property of the fact) flow into
    the dimension merges, and only the orders they touch are rebuilt and merged
    into the fact. Every merge reads and rewrites the hash partitions that its batch touches.
    ``prune_missing`` removes fact lines of touched orders that
    are no longer active in silver (e.g. cancelled); the faithful default keeps
    them, as an SCD-1 MERGE does. ``relayout`` clusters the rewritten partitions of the fact by
    Z-order and rewrites small files of the dimensions (as the source system's OPTIMIZE
    does); with ``False`` they are written as they come. ``strict=False`` returns failed checks
    in the report instead of raising.

    The fact's marks, by which the next run knows what is new, are set after its data stands: a
    driver lost in between repeats the merge.
    """
    with freed_shuffles(lh.spark):
        return _run_gold(lh, prune_missing, incremental, relayout, strict)


def _run_gold(lh: Lakehouse, prune_missing: bool, incremental: bool, relayout: bool,
              strict: bool) -> Q.QualityReport:
    spark, report = lh.spark, Q.QualityReport()
    tables.ensure_namespace(spark, lh.ns.gold)
    silver = {n: lh.table("silver", n) for n in lh.entities}
    where = lh.path("tables")
    fact_name = lh.name("gold", "fact_order_line")
    marks = _gold_marks(lh, fact_name) if incremental else dict.fromkeys(lh.entities)
    new_marks = {f"{SILVER_MARK}.{n}": str(_applied_batch(lh, lh.name("silver", n)))
                 for n in lh.entities}

    def upsert(table: str, source: DataFrame, keys, **more) -> list[int]:
        return merge_into(lh.name("gold", table), source, keys, where,
                          update_when=lambda t, s: F.lit(True), insert_when=lambda s: F.lit(True),
                          parts=lh.parts, part_bytes=lh.part_bytes,
                          max_batch_rows=lh.broadcast_batch_rows, **more)

    # static calendar: replaced wholesale each run, never merged
    tables.publish(spark, build_dim_date(spark, *lh.calendar), lh.name("gold", "dim_date"), where)
    dims = {"dim_customer": (build_dim_customer, "customers", "customer_id"),
            "dim_product": (build_dim_product, "products", "product_id")}

    def dimension(table: str) -> list[int]:
        build, source, key = dims[table]
        return upsert(table, build(changed_since(silver[source], marks[source])), (key,))
    for table, rewritten in _at_once(dimension, dims).items():
        if relayout:  # one after the other: it sets the session's partition size while it writes
            compact_parts(spark, lh.name("gold", table), where, rewritten)
    keys = lh.item_keys
    with ExitStack() as stack:
        touched = touched_orders(silver, marks)
        if touched is not None:
            touched = stack.enter_context(written(touched, "touched-orders"))
        delta = fact_delta(silver, touched, keys)
        delta = stack.enter_context(written(delta, "fact-delta", ["order_id"],
                                            _delta_passes(silver, touched, delta)))
        more = {}
        if prune_missing and spark.catalog.tableExists(fact_name):
            more["stale"] = _stale_lines(lh.table("gold", "fact_order_line"), delta, touched, keys)
        if relayout:
            by = ["date_id", "customer_id"]
            bounds = rank_bounds(delta, by)
            more["cluster"] = lambda df: zorder(df, by, bounds=bounds, within=tables.PART)
        upsert("fact_order_line", delta, keys, properties=new_marks, stands=True, **more)

    g = {t: lh.table("gold", t)
         for t in ("dim_date", "dim_customer", "dim_product", "fact_order_line")}
    report.add_results(Q._union(Q.gold_quality(t, g[t], k) for t, k in (
        ("dim_date", ("date_id",)), ("dim_customer", ("customer_id",)),
        ("dim_product", ("product_id",)), ("fact_order_line", keys))))
    counts = Q.fk_orphans(g["fact_order_line"], g, [Q.ForeignKey(*r) for r in FK_RULES]).unionByName(
        Q.metric_sanity(g["fact_order_line"]).select(
            F.lit("negative metrics").alias("rule_name"), F.col("negative_rows").alias("orphans")))
    for r in counts.collect():
        what = r["rule_name"] if r["rule_name"] == "negative metrics" else f"fk {r['rule_name']}"
        report.require_zero(what, r["orphans"])
    create_kpi_views(spark, lh.ns)
    if strict:
        report.gate()
    return report


def run_all(lh: Lakehouse, landing: str, prune_missing: bool = False, relayout: bool = True,
            full: bool = False, strict: bool = True) -> dict[str, Q.QualityReport]:
    """One scheduled run: bronze, silver, gold in order; each layer gates before the
    next starts, so a failed check stops the run with the earlier layers committed (gold's checks
    come last; ``strict=False`` leaves them in its report). ``full`` ingests all landed files again."""
    bronze = run_bronze(lh, landing, full)
    bronze.gate()
    silver = run_silver(lh)
    gold = run_gold(lh, prune_missing=prune_missing, relayout=relayout, strict=strict)
    return {"bronze": bronze, "silver": silver, "gold": gold}


def row_counts(lh: Lakehouse) -> DataFrame:
    names = ("dim_date", "dim_customer", "dim_product", "fact_order_line")
    return Q._union(lh.spark.table(lh.name("gold", t)).agg(F.count(F.lit(1)).alias("rows"))
                    .select(F.lit(t).alias("table_name"), "rows") for t in names)


def create_kpi_views(spark: SparkSession, ns: Namespaces) -> None:
    """The five KPI views over the gold tables (names from the namespace registry)."""
    gold = {t: f"{ns.gold}.{t}" for t in ("fact_order_line", "dim_customer", "dim_product", "dim_date")}
    for kpi in KPIS:
        spark.sql(f"CREATE OR REPLACE VIEW {ns.gold}.{kpi.view} AS {view_sql(kpi, gold)}")
