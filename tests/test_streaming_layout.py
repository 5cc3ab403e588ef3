from pyspark.sql import functions as F

from strata.operators.layout import compact_parts, file_sizes, rank_bounds, zorder
from strata.plans.pipeline import SnapshotUpsert
from strata.schemas import FIXTURE_ENTITIES
from strata.sources import fixtures, jsonl
from strata.streaming import file_once

from .conftest import SF_SMALL


def test_file_once_rerun_adds_nothing(spark, tmp_root):
    ev = fixtures.table(spark, SF_SMALL, "events")
    landing, sink, ckpt = f"{tmp_root}/landing", f"{tmp_root}/sink", f"{tmp_root}/ckpt"
    jsonl.write_batch(ev, landing, "events", "b1")
    for _ in range(3):
        file_once.ingest_new_files(spark, f"{landing}/events", ev.schema, sink, ckpt)
    out = spark.read.parquet(sink)
    assert out.count() == ev.count()
    assert out.select("_batch_id").distinct().count() == 1


def test_snapshot_upsert_replay_is_idempotent(spark, tmp_root):
    e = FIXTURE_ENTITIES["orders"]
    up = SnapshotUpsert(spark, f"{tmp_root}/silver", e)
    batch = fixtures.orders(spark, SF_SMALL)
    up(batch, 0)
    first = sorted(map(tuple, up.current().collect()), key=str)
    up(batch, 0)                                  # at-least-once replay of the same batch
    assert sorted(map(tuple, up.current().collect()), key=str) == first
    newer = batch.withColumn("updated_at", F.col("updated_at") + F.expr("INTERVAL 1 DAY")) \
                 .withColumn("order_status", F.lit("paid"))
    up(newer, 1)
    statuses = {r[0] for r in up.current().select("order_status").distinct().collect()}
    assert statuses == {"paid"}


def _file_ranges(spark, path, col):
    per_file = (spark.read.parquet(path).groupBy(F.input_file_name().alias("f"))
                .agg((F.max(col) - F.min(col)).alias("w")))
    return per_file.agg(F.avg("w")).first()[0]


def test_zorder_narrows_file_ranges(spark, tmp_root):
    rows = [(20200101 + (i % 28) + 100 * ((i // 28) % 12), (i * 7919) % 5000, i)
            for i in range(20000)]
    df = spark.createDataFrame(rows, "date_id int, customer_id int, v int")
    plain, zpath = f"{tmp_root}/plain", f"{tmp_root}/z"
    df.repartition(8).write.parquet(plain)
    zorder(df, ["date_id", "customer_id"], num_partitions=8).write.parquet(zpath)
    assert spark.read.parquet(zpath).count() == 20000
    for c in ("date_id", "customer_id"):
        assert _file_ranges(spark, zpath, c) < 0.6 * _file_ranges(spark, plain, c)


def test_zorder_splits_a_hot_value(spark):
    hot = spark.createDataFrame([(1, 1, i) for i in range(3000)] +
                                [(d, d, d) for d in range(2, 6000)], "a int, b int, v int")
    parts = zorder(hot, ["a", "b"], num_partitions=6) \
        .groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in parts) < 3000      # the hot run is not one partition


def test_zorder_ranks_whole_strings_and_skewed_numbers(spark, tmp_root):
    """Keys that differ behind a long common prefix, amounts of which most are tiny: by ranks, a
    filter on either one still skips most files."""
    rows = [(f"CUST-{(i * 7919) % 5000:07d}", float((i % 100) ** 6), i) for i in range(20000)]
    df = spark.createDataFrame(rows, "customer string, amount double, v int")
    zpath = f"{tmp_root}/z"
    zorder(df, ["customer", "amount"], num_partitions=16).write.parquet(zpath)
    per_file = (spark.read.parquet(zpath).groupBy(F.input_file_name().alias("f"))
                .agg(F.min("customer").alias("a"), F.max("customer").alias("b"),
                     F.min("amount").alias("c"), F.max("amount").alias("d")).collect())
    assert len(per_file) == 16
    for key in ("CUST-0000017", "CUST-0002500", "CUST-0004990"):
        assert sum(r["a"] <= key <= r["b"] for r in per_file) <= 8
    for amount in (1.0, float(50 ** 6), float(98 ** 6)):
        assert sum(r["c"] <= amount <= r["d"] for r in per_file) <= 8


def test_rank_bounds_are_whole_values(spark):
    df = spark.createDataFrame([(f"CUST-{i:05d}", None if i % 2 else i * 1.5) for i in range(4000)],
                               "s string, x double")
    b = rank_bounds(df, ["s", "x"], bits=3)
    assert b["s"] == [f"CUST-{i * 500:05d}" for i in range(1, 8)]
    assert b["x"] == [i * 750.0 for i in range(1, 8)]
    assert rank_bounds(df.limit(0), ["s"]) == {"s": []}
    out = zorder(df.limit(0), ["s", "x"])
    assert out.isEmpty() and out.columns == ["s", "x"]


def test_compact_rewrites_only_scattered_partitions(spark, tmp_root):
    from strata.sources import tables

    name = "strata_compact_probe_" + tmp_root.rsplit("-", 1)[-1]
    df = spark.range(4000).withColumn("t", F.concat(F.lit("t"), "id"))
    tables.create_parts(spark, name, df.schema, tmp_root, parts=4)
    parted = df.withColumn(tables.PART, tables.part_of(["id"], 4))
    tables.publish_parts(spark, parted.filter(f"{tables.PART} < 2").repartition(10), name, tmp_root, [0, 1])
    tables.publish_parts(spark, parted.filter(f"{tables.PART} >= 2").coalesce(1), name, tmp_root, [2, 3])
    assert {r[tables.PART]: r["files"] for r in file_sizes(spark.table(name), tables.PART).collect()} \
        == {0: 10, 1: 10, 2: 1, 3: 1}
    assert compact_parts(spark, name, tmp_root) == [0, 1]
    sizes = file_sizes(spark.table(name), tables.PART).collect()
    assert all(r["files"] == 1 for r in sizes) and spark.table(name).count() == 4000
    assert compact_parts(spark, name, tmp_root) == []
    assert compact_parts(spark, name, tmp_root, target_bytes=1) == []   # a file is whole already


def test_bucketed_table_merge_shuffles_only_the_batch(spark, tmp_root):
    from strata.operators.merge import merge_newer_wins
    from strata.sources import tables

    e = FIXTURE_ENTITIES["orders"]
    orders = fixtures.orders(spark, SF_SMALL)
    name = "strata_bucket_probe_" + tmp_root.rsplit("-", 1)[-1]
    tables.publish(spark, orders, name, tmp_root, bucket_by=e.keys, buckets=8)
    assert tables.current_version(spark, name) == 1
    batch = orders.withColumn("updated_at", F.col("updated_at") + F.expr("INTERVAL 1 DAY"))
    prev = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                                  "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in prev:
            spark.conf.set(k, "-1")
        merged = merge_newer_wins(spark.table(name), batch, e.keys)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan
        assert plan.count("Exchange hashpartitioning") == 1     # the batch only
        tables.publish(spark, merged, name, tmp_root, bucket_by=e.keys, buckets=8)
    finally:
        for k, v in prev.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert tables.current_version(spark, name) == 2
    assert spark.table(name).count() == orders.count()
    # the silver checks group by the same key: on the bucketed table they need no
    # hash exchange at all (only the one-row total moves)
    from strata.operators import quality as Q
    checks = Q.silver_quality("orders", spark.table(name), e)
    cplan = checks._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in cplan and "Bucketed: true" in cplan


def test_namespaces_and_ddl(spark, tmp_root):
    from pyspark.sql import types as T

    from strata.sources import tables

    ns = "strata_ns_" + tmp_root.rsplit("-", 1)[-1]
    assert tables.use_namespace(spark, ns, catalog="spark_catalog") == f"spark_catalog.{ns}"
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    tables.create_table(spark, f"{ns}.t", schema, tmp_root)
    tables.create_table(spark, f"{ns}.t", schema, tmp_root)     # IF NOT EXISTS
    assert spark.table(f"{ns}.t").schema.simpleString() == "struct<k:bigint,v:string>"
    spark.sql("USE default")


def test_zorder_with_given_bounds_keeps_rows(spark):
    df = spark.createDataFrame([(20240101 + i % 28, i % 97, i) for i in range(3000)],
                               "date_id int, customer_id int, v int")
    out = zorder(df, ["date_id", "customer_id"], num_partitions=4,
                 bounds={"date_id": [20240105, 20240110]})       # too narrow: clustered less
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect()))


def test_backlog_in_bounded_micro_batches(spark, tmp_root):
    ev = fixtures.table(spark, SF_SMALL, "events")
    landing, sink, ckpt = f"{tmp_root}/landing", f"{tmp_root}/sink", f"{tmp_root}/ckpt"
    for i in range(3):
        jsonl.write_batch(ev.filter(F.col("event_id") % 3 == i).coalesce(1), landing, "events",
                          f"b{i}")
    file_once.ingest_new_files(spark, f"{landing}/events", ev.schema, sink, ckpt,
                               max_files_per_trigger=1)
    out = spark.read.parquet(sink)
    assert out.count() == ev.count()
    assert out.select("_batch_id").distinct().count() == 3     # one file per micro-batch


def test_calendar_spanning_the_data(spark):
    from strata.operators.star import dim_date_spanning

    o = fixtures.table(spark, SF_SMALL, "orders")
    d = dim_date_spanning(o, "o_orderdate")
    lo, hi = o.agg(F.min("o_orderdate").cast("date"), F.max("o_orderdate").cast("date")).first()
    r = d.agg(F.min("full_date"), F.max("full_date"), F.count("*")).first()
    assert (r[0], r[1]) == (lo, hi) and r[2] == (hi - lo).days + 1
