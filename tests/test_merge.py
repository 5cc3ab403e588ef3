"""MERGE truth tables (newer-wins, SCD-1), pruning, guards and algebraic laws."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators.merge import (merge_frames, merge_newer_wins, merge_scd1,
                                    merge_small_batch, newer_than)

SCHEMA = "pk string, updated_at timestamp_ntz, is_deleted boolean, payload string"
T0, T1, T2 = (dt.datetime(2024, 1, d) for d in (1, 2, 3))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, str(r)))


def test_newer_wins_truth_table(spark):
    target = spark.createDataFrame([
        ("newer", T1, False, "t"), ("equal", T1, False, "t"), ("older", T1, False, "t"),
        ("nullsrc", T1, False, "t"), ("nulltgt", None, False, "t"), ("del", T1, False, "t"),
        ("only_t", T1, False, "t"),
    ], SCHEMA)
    source = spark.createDataFrame([
        ("newer", T2, False, "s"), ("equal", T1, False, "s"), ("older", T0, False, "s"),
        ("nullsrc", None, False, "s"), ("nulltgt", T2, False, "s"), ("del", T2, True, "s"),
        ("ins", T1, False, "s"), ("ins_del", T1, True, "s"), ("ins_null", T1, None, "s"),
        (None, T1, False, "nullkey"),
    ], SCHEMA)
    out = {r["pk"]: (r["payload"], r["is_deleted"])
           for r in merge_newer_wins(target, source, ["pk"]).collect()}
    assert out == {
        "newer": ("s", False),      # newer version replaces
        "equal": ("t", False),      # equal version keeps target
        "older": ("t", False),      # older version keeps target
        "nullsrc": ("t", False),    # unknown comparison is not true
        "nulltgt": ("t", False),
        "del": ("s", True),         # delete flag travels with the update
        "only_t": ("t", False),     # target-only row kept
        "ins": ("s", False),        # unseen active key inserted
        None: ("nullkey", False),   # NULL key never matches: insert
    }                               # ins_del / ins_null: not inserted


def test_scd1_overwrites_and_inserts(spark):
    target = spark.createDataFrame([("a", T1, False, "t"), ("b", T2, False, "t")], SCHEMA)
    source = spark.createDataFrame([("a", None, None, None), ("c", T0, True, "s")], SCHEMA)
    out = rows(merge_scd1(target, source, ["pk"]))
    assert out == [("a", None, None, None), ("b", T2, False, "t"), ("c", T0, True, "s")]
    pruned = rows(merge_scd1(target, source, ["pk"], prune_missing=True))
    assert pruned == [("a", None, None, None), ("c", T0, True, "s")]


def test_missing_source_columns_keep_target_values(spark):
    target = spark.createDataFrame([("a", T1, False, "t")], SCHEMA)
    source = spark.createDataFrame([("a", T2), ("b", T2)], "pk string, updated_at timestamp_ntz")
    out = rows(merge_scd1(target, source, ["pk"]))
    assert out == [("a", T2, False, "t"), ("b", T2, None, None)]


def test_duplicate_source_key_fails(spark):
    target = spark.createDataFrame([("a", T1, False, "t")], SCHEMA)
    source = spark.createDataFrame([("a", T2, False, "x"), ("a", T2, False, "y")], SCHEMA)
    with pytest.raises(Exception, match="more than one row"):
        merge_newer_wins(target, source, ["pk"]).collect()


def test_composite_key(spark):
    t = spark.createDataFrame([(1, 1, T1, False, "t"), (1, 2, T1, False, "t")],
                              "a int, b int, updated_at timestamp_ntz, is_deleted boolean, p string")
    s = spark.createDataFrame([(1, 2, T2, False, "s"), (2, 1, T2, False, "s")], t.schema)
    out = sorted(tuple(r) for r in merge_newer_wins(t, s, ["a", "b"]).collect())
    assert [r[-1] for r in out] == ["t", "s", "s"]


def test_small_batch_plan_matches_full_outer(spark):
    target = spark.createDataFrame([(f"k{i}", T1, False, "t") for i in range(50)], SCHEMA)
    source = spark.createDataFrame(
        [(f"k{i}", T2 if i % 3 else T0, i % 5 == 0, "s") for i in range(30, 80)], SCHEMA)
    kw = dict(update_when=newer_than("updated_at"),
              insert_when=lambda s: s["is_deleted"] == F.lit(False))
    assert rows(merge_small_batch(target, source, ["pk"], **kw)) == \
        rows(merge_frames(target, source, ["pk"], **kw))
    # above the checked bound it falls back to the full-outer plan, same rows
    assert rows(merge_small_batch(target, source, ["pk"], max_batch_rows=10, **kw)) == \
        rows(merge_frames(target, source, ["pk"], **kw))


def test_small_batch_never_shuffles_the_table(spark):
    target = spark.range(1000).select(F.col("id").cast("string").alias("pk"),
                                      F.lit(T1).alias("updated_at"),
                                      F.lit(False).alias("is_deleted"),
                                      F.lit("t").alias("payload"))
    source = spark.createDataFrame([("5", T2, False, "s")], SCHEMA)
    df = merge_small_batch(target, source, ["pk"], update_when=newer_than("updated_at"),
                           insert_when=lambda s: s["is_deleted"] == F.lit(False))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


versions = st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3)), min_size=1, max_size=12)


@settings(max_examples=15, deadline=None)
@given(a=versions, b=versions)
def test_newer_wins_order_independent_without_deletes(spark, a, b):
    """With distinct versions per key and no deletes, applying two batches in either
    order gives the same table, and re-applying a batch changes nothing."""
    def frame(items, tag):
        seen = {}
        for k, v in items:
            seen[k] = v  # one row per key in a batch
        return spark.createDataFrame(
            [(f"k{k}", dt.datetime(2024, 1, 1) + dt.timedelta(days=2 * v + (tag == "b")),
              False, tag) for k, v in seen.items()], SCHEMA)
    fa, fb = frame(a, "a"), frame(b, "b")
    empty = fa.where(F.lit(False))
    ab = merge_newer_wins(merge_newer_wins(empty, fa, ["pk"]), fb, ["pk"])
    ba = merge_newer_wins(merge_newer_wins(empty, fb, ["pk"]), fa, ["pk"])
    assert rows(ab) == rows(ba)
    assert rows(merge_newer_wins(ab, fb, ["pk"])) == rows(ab)


def _frame(spark, items, tag):
    """One row per key: (key, version day or None, deleted flag or None)."""
    seen = {}
    for k, v, d in items:
        seen[k] = (v, d)
    return spark.createDataFrame(
        [(f"k{k}", None if v is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=v), d, tag)
         for k, (v, d) in seen.items()], SCHEMA)


rows_st = st.lists(st.tuples(st.integers(0, 8), st.one_of(st.none(), st.integers(0, 4)),
                             st.one_of(st.none(), st.booleans())), min_size=0, max_size=10)


@settings(max_examples=12, deadline=None)
@given(t=rows_st, s=rows_st)
def test_broadcast_merge_equals_full_outer_merge(spark, t, s):
    target, source = _frame(spark, t, "t"), _frame(spark, s, "s")
    kw = dict(update_when=newer_than("updated_at"),
              insert_when=lambda x: x["is_deleted"] == F.lit(False))
    assert rows(merge_small_batch(target, source, ["pk"], **kw)) == \
        rows(merge_frames(target, source, ["pk"], **kw))


@settings(max_examples=12, deadline=None)
@given(t=rows_st, s=rows_st)
def test_scd1_laws(spark, t, s):
    target, source = _frame(spark, t, "t"), _frame(spark, s, "s")
    once = merge_scd1(target, source, ["pk"])
    assert rows(merge_scd1(once, source, ["pk"])) == rows(once)          # idempotent
    pruned = merge_scd1(target, source, ["pk"], prune_missing=True)
    assert rows(pruned) == rows(source)                                   # state == batch
    keys = {r[0] for r in rows(once)}
    assert keys == {f"k{k}" for k, _, _ in t} | {f"k{k}" for k, _, _ in s}


def test_delete_first_arrival_is_order_dependent(spark):
    """S4: a key first seen deleted never enters the table, so with deletes the
    result depends on arrival order (without deletes it does not; see above)."""
    live = spark.createDataFrame([("k", T1, False, "live")], SCHEMA)
    gone = spark.createDataFrame([("k", T2, True, "gone")], SCHEMA)
    empty = live.where(F.lit(False))
    live_then_gone = rows(merge_newer_wins(merge_newer_wins(empty, live, ["pk"]), gone, ["pk"]))
    gone_then_live = rows(merge_newer_wins(merge_newer_wins(empty, gone, ["pk"]), live, ["pk"]))
    assert live_then_gone == [("k", T2, True, "gone")]     # kept as a soft-deleted row
    assert gone_then_live == [("k", T1, False, "live")]    # the delete was never stored


def test_version_tuple_breaks_equal_versions(spark):
    """S3: with (updated_at, _extracted_at) as the version, a re-extracted row with the
    same updated_at but a later extraction wins; with updated_at alone it does not."""
    schema = "pk string, updated_at timestamp_ntz, _extracted_at timestamp_ntz, " \
             "is_deleted boolean, payload string"
    t = spark.createDataFrame([("a", T1, T0, False, "old"), ("b", T1, T1, False, "old")], schema)
    s = spark.createDataFrame([("a", T1, T2, False, "new"), ("b", T1, T0, False, "new")], schema)
    plain = {r["pk"]: r["payload"] for r in merge_newer_wins(t, s, ["pk"]).collect()}
    tup = {r["pk"]: r["payload"] for r in merge_newer_wins(
        t, s, ["pk"], version=("updated_at", "_extracted_at")).collect()}
    assert plain == {"a": "old", "b": "old"}
    assert tup == {"a": "new", "b": "old"}


def test_duplicate_source_key_fails_at_every_size(spark):
    target = spark.createDataFrame([(1, 1)], "pk int, v int")
    source = spark.createDataFrame([(1, 2), (1, 3), (2, 5)], "pk int, v int")
    for bound in (10, 1):
        with pytest.raises(Exception, match="more than one row for a key"):
            merge_small_batch(target, source, ["pk"], update_when=lambda t, s: F.lit(True),
                              insert_when=lambda s: F.lit(True), max_batch_rows=bound).collect()


def _files(spark, name):
    return {r[0] for r in spark.table(name).select("_metadata.file_path").distinct().collect()}


def test_merge_into_rewrites_only_the_touched_partitions(spark, tmp_root):
    from strata.operators.upsert import merge_into
    from strata.sources import tables

    name = "strata_parts_" + tmp_root.rsplit("-", 1)[-1]
    everything = spark.createDataFrame([(f"k{i}", T1, False, "t") for i in range(400)], SCHEMA)

    def merge(df, **kw):
        return merge_into(name, df, ["pk"], tmp_root, update_when=newer_than("updated_at"),
                          insert_when=lambda s: s["is_deleted"] == F.lit(False), **kw)
    assert merge(everything, parts=8, properties={"strata.mark": "1"}) == list(range(8))
    before = _files(spark, name)
    one = spark.createDataFrame([("k7", T2, False, "new")], SCHEMA)
    touched = merge(one, properties={"strata.mark": "2"})
    assert len(touched) == 1
    after = _files(spark, name)
    part = f"_part={touched[0]}/"
    assert {f for f in before if part not in f} == {f for f in after if part not in f}
    assert not {f for f in before if part in f} & after
    assert spark.table(name).filter("payload = 'new'").count() == 1 and spark.table(name).count() == 400
    assert tables.get_property(spark, name, "strata.mark") == "2"
    # the merge reads the touched partition alone
    plan = spark.table(name).filter(F.col("_part").isin(touched)).inputFiles()
    assert all(part in f for f in plan)
    # nothing to do: no partition, but the mark
    assert merge(one.limit(0), properties={"strata.mark": "3"}) == []
    assert _files(spark, name) == after and tables.get_property(spark, name, "strata.mark") == "3"
    # a key twice: fails, and the table is as it was
    twice = spark.createDataFrame([("k9", T2, False, "a"), ("k9", T2, False, "b")], SCHEMA)
    with pytest.raises(Exception, match="more than one row"):
        merge(twice)
    assert _files(spark, name) == after
    # stale keys leave, in partitions of their own
    merge(one.limit(0), stale=spark.createDataFrame([("k1",), ("k2",), ("nope",)], "pk string"))
    assert spark.table(name).count() == 398
    assert spark.table(name).filter("pk IN ('k1', 'k2')").isEmpty()


def test_merge_into_equals_the_merged_frames(spark, tmp_root):
    """NULL keys, flags and versions, small and large batches: the partitioned merge is the same."""
    from strata.operators.upsert import merge_into

    t = spark.createDataFrame([(k, v, d, "t") for k in ("a", "b", "c", "d") for v, d in [(T1, False)]]
                              + [("n", None, None, "t")], SCHEMA)
    s = spark.createDataFrame([("a", T2, True, "s"), ("b", T1, False, "s"), ("c", None, False, "s"),
                               ("n", T2, False, "s"), ("e", T1, False, "s"), ("f", T1, True, "s"),
                               (None, T1, False, "s"), ("g", T1, None, "s")], SCHEMA)
    want = rows(merge_newer_wins(t, s, ["pk"]))
    for i, bound in enumerate((1_000_000, 1)):
        name = f"strata_same_{i}_" + tmp_root.rsplit("-", 1)[-1]
        every = {"update_when": lambda a, b: F.lit(True), "insert_when": lambda b: F.lit(True)}
        merge_into(name, t, ["pk"], tmp_root, parts=3, **every)
        merge_into(name, s, ["pk"], tmp_root, update_when=newer_than("updated_at"),
                   insert_when=lambda b: b["is_deleted"] == F.lit(False), max_batch_rows=bound)
        assert rows(spark.table(name).drop("_part")) == want


def test_row_level_formats_merge_by_their_own(spark, monkeypatch):
    """Where the table's format has row-level operations, its MERGE gets the same conditions."""
    from pyspark.sql.classic.dataframe import DataFrame

    from strata.operators import upsert

    said = []

    class Writer:
        def __getattr__(self, name):
            def call(*args):
                said.append((name, *map(str, args)))
                return self
            return call
    monkeypatch.setattr(DataFrame, "mergeInto", lambda self, t, on: said.append((t, str(on))) or Writer())
    monkeypatch.setattr(upsert.tables, "row_level", lambda *a: True)
    df = spark.createDataFrame([("a", T1, False, "s")], SCHEMA)
    assert upsert.merge_into("cat.t", df, ["pk"], "/nowhere", update_when=newer_than("updated_at"),
                             insert_when=lambda s: s["is_deleted"] == F.lit(False)) == []
    assert [x[0] for x in said] == ["cat.t", "whenMatched", "updateAll", "whenNotMatched", "insertAll",
                                    "merge"]
    assert "cat.t.pk" in said[0][1] and "s.updated_at" in said[1][1] and "s.is_deleted" in said[3][1]
