"""Bronze -> silver -> gold over two landed batches of source-shaped JSON."""

import pytest

from strata.plans import pipeline as P
from strata.schemas import RAW_SCHEMAS, SOURCE_ENTITIES
from strata.sources import jsonl

EX1, EX2 = "2024-06-01T02:00:00+00:00", "2024-06-02T02:00:00+00:00"


def _batch1():
    return {
        "customers": [("c1", "Ann", "Lee", "ann@x", "Oslo", "NO", "retail",
                       "2024-05-01T00:00:00", "2024-05-01T00:00:00", 0, EX1, "customers")],
        "products": [("p1", "Bolt", "hardware", None, 2.0, 1.5, "2024-05-01T00:00:00",
                      "2024-05-01T00:00:00", 0, EX1, "products"),
                     ("p2", "Nut", "hardware", "small", 1.0, 0.5, "2024-05-01T00:00:00",
                      "2024-05-01T00:00:00", 0, EX1, "products"),
                     ("p3", "Washer", "hardware", None, 0.2, 0.1, "2024-05-01T00:00:00",
                      "yesterday-ish", 0, EX1, "products")],
        "orders": [("o1", "c1", "pending", "2024-05-31T09:00:00", 4.0, None,
                    "2024-05-31T09:00:00", "2024-05-31T09:00:00", 0, EX1, "orders"),
                   ("o2", "c1", "paid", "2024-05-31T10:00:00", 3.0, "Oslo",
                    "2024-05-31T10:00:00", "2024-05-31T10:00:01", 0, EX1, "orders")],
        "order_items": [("i1", "o1", "p1", 2, 2.0, 4.0, "2024-05-31T09:00:00",
                         "2024-05-31T09:00:00", 0, EX1, "order_items"),
                        ("i2", "o2", "p2", 3, 1.0, 3.0, "2024-05-31T10:00:00",
                         "2024-05-31T10:00:00", 0, EX1, "order_items")],
    }


def _batch2():
    return {
        # the customer moves segment; the first order is cancelled after it was loaded
        "customers": [("c1", "Ann", "Lee", "ann@x", "Oslo", "NO", "wholesale",
                       "2024-05-01T00:00:00", "2024-06-01T08:00:00", 0, EX2, "customers")],
        "orders": [("o1", "c1", "cancelled", "2024-05-31T09:00:00", 4.0, None,
                    "2024-05-31T09:00:00", "2024-06-01T08:00:00", 1, EX2, "orders")],
        "products": [], "order_items": [],
    }


def _land(spark, landing, rows, batch_id):
    for table, data in rows.items():
        if data:
            jsonl.write_batch(spark.createDataFrame(data, RAW_SCHEMAS[table]), landing, table,
                              batch_id)


@pytest.mark.parametrize("incremental", [True, False])
@pytest.mark.parametrize("prune", [False, True])
def test_two_batches_cancel_after_load(spark, tmp_root, prune, incremental):
    landing = f"{tmp_root}/landing"
    tag = ("p" if prune else "f") + ("i" if incremental else "r")
    lh = P.Lakehouse(spark, f"{tmp_root}/lake", SOURCE_ENTITIES, RAW_SCHEMAS, parts=2,
                     ns=P.Namespaces(f"bronze_{tag}", f"silver_{tag}", f"gold_{tag}"))
    _land(spark, landing, _batch1(), "b1")
    bronze_report = P.run_bronze(lh, landing)
    bronze_report.gate()
    assert bronze_report.info["products.malformed_timestamps"] == 1
    assert bronze_report.info["orders.malformed_timestamps"] == 0
    P.run_silver(lh)
    P.run_gold(lh, prune_missing=prune, incremental=incremental)
    fact = spark.table(lh.name("gold", "fact_order_line"))
    assert sorted(r["order_item_id"] for r in fact.collect()) == ["i1", "i2"]
    assert fact.filter("order_item_id = 'i1'").first()["gross_margin"] == 1.0

    _land(spark, landing, _batch2(), "b2")
    P.run_bronze(lh, landing).gate()
    P.run_bronze(lh, landing).gate()       # rerun: no file is ingested twice
    assert lh.bronze("orders").count() == 3
    recon = {r["table_name"]: r for r in P.reconcile(lh, landing).collect()}
    assert recon["orders"]["source_rows"] == recon["orders"]["table_rows"] == 3
    assert recon["orders"]["exact"] and recon["orders"]["status"] == "OK"

    P.run_silver(lh)
    silver_o1 = spark.table(lh.name("silver", "orders")).filter("order_id = 'o1'").first()
    assert silver_o1["is_deleted"] and silver_o1["order_status"] == "cancelled"
    P.run_gold(lh, prune_missing=prune, incremental=incremental)
    fact = spark.table(lh.name("gold", "fact_order_line"))
    items = sorted(r["order_item_id"] for r in fact.collect())
    # faithful SCD-1 keeps the stale line of the cancelled order; pruning removes it
    assert items == (["i2"] if prune else ["i1", "i2"])
    seg = spark.sql(f"SELECT segment, orders FROM {lh.ns.gold}.vw_revenue_margin_by_segment_month"
                    ).collect()
    assert [tuple(r) for r in seg] == [("wholesale", 1 if prune else 2)]
    counts = {r["table_name"]: r["rows"] for r in P.row_counts(lh).collect()}
    assert counts["dim_date"] == 4018 and counts["dim_customer"] == 1
    assert spark.sql(f"SELECT * FROM {lh.ns.gold}.vw_daily_kpis").count() == 1
    # a rerun with nothing new in silver changes nothing (also without re-clustering)
    before = sorted(map(tuple, fact.collect()))
    P.run_gold(lh, prune_missing=prune, incremental=incremental, relayout=False)
    after = spark.table(lh.name("gold", "fact_order_line"))
    assert sorted(map(tuple, after.collect())) == before


def test_late_batch_skipped_table_and_full_reload(spark, tmp_root):
    """A batch stamped before the last gold run still reaches gold; a table without a folder is
    skipped; a fresh checkpoint neither loses nor repeats a batch id; a half-written version
    folder does not stop the next run."""
    import os

    landing = f"{tmp_root}/landing"
    lh = P.Lakehouse(spark, f"{tmp_root}/lake", SOURCE_ENTITIES, RAW_SCHEMAS, parts=2,
                     ns=P.Namespaces("bronze_l", "silver_l", "gold_l"))
    first = _batch1()
    late = first["order_items"].pop()
    people = first.pop("customers")
    _land(spark, landing, first, "b1")
    report = P.run_bronze(lh, landing)
    report.gate()
    assert report.info["customers.skipped"] == 1
    _land(spark, landing, {"customers": people}, "b1")
    P.run_bronze(lh, landing).gate()
    P.run_silver(lh)
    P.run_gold(lh)
    _land(spark, landing, {"order_items": [(*late[:9], "2024-05-31T12:00:00+00:00", late[10])]},
          "b2")
    P.run_bronze(lh, landing).gate()
    for table, layer in (("order_items", "silver_l"), ("fact_order_line", "gold_l")):
        n = P.tables.current_version(spark, f"{layer}.{table}") + 1
        half = f"{tmp_root}/lake/tables/{layer}/{table}/v={n}-lost/_part=0"
        os.makedirs(half)
        open(f"{half}/part-0.parquet", "w").close()
    P.run_silver(lh)
    P.run_gold(lh)
    fact = spark.table(lh.name("gold", "fact_order_line"))
    assert sorted(r["order_item_id"] for r in fact.collect()) == ["i1", "i2"]

    _land(spark, landing, {"customers": [("c2", "Bo", "Ek", "bo@x", "Oslo", "NO", "retail",
                                          "2024-05-01T00:00:00", "2024-05-01T00:00:00", 0, EX1,
                                          "customers")]}, "b3")
    P.run_bronze(lh, landing, full=True).gate()     # all files again, under the next batch ids
    P.run_bronze(lh, landing).gate()                # and only once
    ids = [r[0] for r in lh.bronze("customers").select("_batch_id").distinct().collect()]
    assert sorted(ids) == [0, 1] and lh.bronze("customers").count() == 3
    assert P.tables.partitions(spark, lh.name("bronze", "customers")) == [0, 1]
    P.run_silver(lh)
    P.run_gold(lh)
    dim = spark.table(lh.name("gold", "dim_customer"))
    assert sorted(r["customer_id"] for r in dim.collect()) == ["c1", "c2"]


def test_cancel_after_load_in_passes(spark, tmp_root, monkeypatch):
    """Silver and gold in as many passes as there may be: the same rows, and neither shuffle files nor
    intermediates are left."""
    from strata.operators import upsert
    from strata.session import checkpoint_root
    from tests.test_scale import _files, _left, _shuffles

    monkeypatch.setattr(upsert, "PASS_BYTES", 1)
    landing = f"{tmp_root}/landing"
    lh = P.Lakehouse(spark, f"{tmp_root}/lake", SOURCE_ENTITIES, RAW_SCHEMAS, parts=4,
                     ns=P.Namespaces("bronze_w", "silver_w", "gold_w"))
    for batch, expected in ((_batch1(), ["i1", "i2"]), (_batch2(), ["i2"])):
        _land(spark, landing, batch, f"b{len(expected)}")
        P.run_bronze(lh, landing).gate()
        files = _files(checkpoint_root(spark)) - _files(tmp_root)
        shuffles = _shuffles(spark)
        P.run_silver(lh)
        P.run_gold(lh, prune_missing=True)
        assert not _left(spark, shuffles)
        assert _files(checkpoint_root(spark)) - _files(tmp_root) == files
        fact = spark.table(lh.name("gold", "fact_order_line"))
        assert sorted(r["order_item_id"] for r in fact.collect()) == expected
    assert lh.table("silver", "orders").filter("is_deleted").count() == 1


def test_publish_replaces_the_schema_and_keeps_properties(spark, tmp_root):
    t = P.tables
    for name, by in (("evolve_plain", ()), ("evolve_bucketed", ("id",))):
        t.publish(spark, spark.range(2), name, tmp_root, bucket_by=by, buckets=2,
                  properties={"strata.mark": "7"})
        t.publish(spark, spark.range(3).selectExpr("id", "id * 2 AS twice"), name, tmp_root,
                  bucket_by=by, buckets=2)
        assert spark.table(name).columns == ["id", "twice"] and spark.table(name).count() == 3
        assert t.get_property(spark, name, "strata.mark") == "7"
        assert t.current_version(spark, name) == 2


def test_run_all_gates_in_order(spark, tmp_root):
    landing = f"{tmp_root}/landing"
    lh = P.Lakehouse(spark, f"{tmp_root}/lake", SOURCE_ENTITIES, RAW_SCHEMAS, parts=2,
                     ns=P.Namespaces("bronze_a", "silver_a", "gold_a"))
    batch = _batch1()
    batch["order_items"].append(("i9", "o2", "missing", 1, 1.0, 1.0, "2024-05-31T10:00:00",
                                 "2024-05-31T10:00:00", 0, EX1, "order_items"))
    _land(spark, landing, batch, "b1")
    with pytest.raises(RuntimeError, match="product_fk: 1"):
        P.run_all(lh, landing)              # the item's product is unknown: gold gate fails
    assert spark.table(lh.name("silver", "order_items")).count() == 3   # silver committed
    assert P.run_gold(lh, strict=False).failures == ["fk product_fk: 1"]


@pytest.mark.parametrize("lost", [False, True])
def test_null_keys_fail_once_and_stay_out(spark, tmp_root, lost):
    """A row with a NULL key fails the run that finds it, also after a driver that was lost
    between ingest and check; it is quarantined, and the next run goes on without it."""
    landing, tag = f"{tmp_root}/landing", f"q{int(lost)}"
    lh = P.Lakehouse(spark, f"{tmp_root}/lake", SOURCE_ENTITIES, RAW_SCHEMAS, parts=2,
                     ns=P.Namespaces(f"bronze_{tag}", f"silver_{tag}", f"gold_{tag}"))
    batch = _batch1()
    batch["orders"].append((None, *batch["orders"][0][1:]))
    _land(spark, landing, batch, "b1")
    if lost:
        P.ingest_entity(lh, landing, "orders")
    with pytest.raises(RuntimeError, match="orders.order_id nulls: 1"):
        P.run_all(lh, landing)
    assert [r["reason"] for r in lh.quarantine("orders").collect()] == ["order_id"]
    report = P.run_all(lh, landing)["bronze"]
    assert report.info["orders.quarantined"] == 1
    assert report.info["products.malformed_timestamps"] == 1  # of a batch checked again
    silver = spark.table(lh.name("silver", "orders"))
    assert sorted(r["order_id"] for r in silver.collect()) == ["o1", "o2"]
    again = P.run_bronze(lh, landing)
    again.gate()
    assert "orders.quarantined" not in again.info
    assert again.info["products.malformed_timestamps"] == 0


def test_marks_are_set_after_the_data(spark, tmp_root, monkeypatch):
    """A driver lost while the fact is repointed leaves the old marks: the next run takes the
    batch again."""
    landing = f"{tmp_root}/landing"
    lh = P.Lakehouse(spark, f"{tmp_root}/lake", SOURCE_ENTITIES, RAW_SCHEMAS, parts=2,
                     ns=P.Namespaces("bronze_m", "silver_m", "gold_m"))
    first = _batch1()
    late = first["order_items"].pop()
    _land(spark, landing, first, "b1")
    P.run_all(lh, landing)
    _land(spark, landing, {"order_items": [late]}, "b2")
    P.run_bronze(lh, landing).gate()
    P.run_silver(lh)
    before = P._gold_marks(lh, lh.name("gold", "fact_order_line"))
    real = P.tables.point_partitions

    def lost(spark, name, *rest):
        if name.endswith("fact_order_line"):
            raise KeyboardInterrupt("lost")
        real(spark, name, *rest)
    monkeypatch.setattr(P.tables, "point_partitions", lost)
    with pytest.raises(KeyboardInterrupt):
        P.run_gold(lh)
    monkeypatch.undo()
    assert P._gold_marks(lh, lh.name("gold", "fact_order_line")) == before
    assert lh.table("gold", "fact_order_line").count() == 1
    P.run_gold(lh)
    assert lh.table("gold", "fact_order_line").count() == 2


def test_bad_lines_are_counted_and_quarantined(spark, tmp_root):
    """A cut-off line fails the run that finds it; text in a number and new fields are counted; all
    but the new fields go to quarantine, and silver has the rest."""
    landing = f"{tmp_root}/landing"
    lh = P.Lakehouse(spark, f"{tmp_root}/lake", SOURCE_ENTITIES, RAW_SCHEMAS, parts=2,
                     ns=P.Namespaces("bronze_x", "silver_x", "gold_x"))
    _land(spark, landing, _batch1(), "b1")
    lines = ['{"order_item_id":"x1","order_id":"o1","product_id":"p1","quantity":"two","is_deleted":0}',
             '{"order_item_id":"x2","order_id":"o1","product_id":"p1","quantity":2,"colour":"red",'
             '"unit_price":2.0,"updated_at":"2024-05-31T09:00:00","is_deleted":0}',
             '{"order_item_id":"x3","order_id', "", "[]"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(
        f"{landing}/order_items/batch=b2")
    report = P.run_bronze(lh, landing)
    assert report.failures == ["order_items.order_item_id nulls: 2"]
    assert {k: v for k, v in report.info.items() if k.startswith("order_items") and v} == {
        "order_items.malformed_lines": 2, "order_items.uncastable_rows": 1,
        "order_items.unknown_fields": 1}
    held = {(r.reason, r._corrupt_record, r._rescued) for r in lh.quarantine("order_items").collect()}
    assert held == {("malformed line", lines[2], None), ("malformed line", "[]", None),
                    ("uncastable: quantity", None, '{"quantity":"two"}')}
    again = P.run_bronze(lh, landing)
    again.gate()
    assert again.info["order_items.quarantined"] == 3
    P.run_silver(lh)
    items = {r.order_item_id for r in lh.table("silver", "order_items").collect()}
    assert items == {"i1", "i2", "x2"}
    kept = {(r.field, r.issue, r.rows) for r in P.rescued(lh).collect()}
    assert kept == {("colour", "unknown", 1), ("quantity", "uncastable", 1)}
