"""What the layer runs write and read once: landed files, intermediates, first loads, line parsing."""

import glob
import gzip
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import upsert
from strata.operators.dedup import latest_per_key
from strata.operators.layout import rank_bounds
from strata.operators.upsert import merge_into
from strata.session import checkpoint_root, freed_shuffles, in_passes, written
from strata.sources import jsonl


def _always(*_):
    return F.lit(True)


def _plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_landed_batches_are_compressed_and_bounded(spark, tmp_root, monkeypatch):
    monkeypatch.setitem(jsonl.WRITE_OPTIONS, "maxRecordsPerFile", "100")
    df = spark.range(250).selectExpr("id", "concat('a name of row ', id) AS name").coalesce(1)
    path = jsonl.write_batch(df, tmp_root, "t", "b1")
    files = glob.glob(f"{path}/part-*")
    assert len(files) == 3 and all(f.endswith(".json.gz") for f in files)
    rows = [line for f in files for line in gzip.open(f, "rt")]
    assert len(rows) == 250 and sum(map(os.path.getsize, files)) * 3 < sum(map(len, rows))
    assert sorted(jsonl.read_source(spark, path, df.schema).collect()) == sorted(df.collect())


def _files(folder: str) -> int:
    return sum(len(names) for _, _, names in os.walk(folder))


def test_merge_leaves_no_intermediates(spark, tmp_root):
    rows = spark.range(1000).selectExpr("id AS k", "id % 7 AS v")
    root, name = checkpoint_root(spark), "merge_leaves_nothing"
    before = _files(root)
    for _ in range(2):
        merge_into(name, rows, ["k"], f"{tmp_root}/tables", update_when=_always, insert_when=_always,
                   stale=rows.filter("k < 10"), parts=4)
    kept = _files(f"{tmp_root}/tables")
    assert kept and _files(root) - before == kept
    assert spark.table(name).count() == 990


def test_first_load_filters_types_and_refuses_repeats(spark, tmp_root):
    rows = spark.sql("SELECT * FROM VALUES (1, 'a', false), (2, 'b', true), (3, 'c', NULL), (NULL, 'd', false), "
                     "(NULL, 'e', false) AS t(k, v, gone)")
    keep = {"update_when": _always, "insert_when": lambda s: s["gone"] == F.lit(False), "parts": 4}
    with pytest.raises(Exception, match="more than one row for a key"):
        merge_into("first_load_twice", rows.unionByName(rows.filter("k = 1")), ["k"], tmp_root, **keep)
    assert spark.table("first_load_twice").count() == 0
    merge_into("first_load", rows, ["k"], tmp_root, **keep)
    assert sorted(r["v"] for r in spark.table("first_load").collect()) == ["a", "d", "e"]


def test_first_load_joins_nothing(spark, tmp_root):
    rows, seen = spark.range(100).selectExpr("id AS k", "id AS v"), []

    def look(df):
        seen.append(_plan(df))
        return df
    for _ in range(2):
        merge_into("first_load_plan", rows, ["k"], tmp_root, update_when=_always, insert_when=_always,
                   parts=4, cluster=look)
    assert "Join" not in seen[0] and "Join" in seen[1]


def _shuffles(spark) -> set[str]:
    """Shuffle files that the session holds."""
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*.data")}


def _left(spark, before: set[str], seconds: int = 15) -> set[str]:
    """Shuffle files that came since and stay: they are removed in the background."""
    until = time.monotonic() + seconds
    while (new := _shuffles(spark) - before) and time.monotonic() < until:
        time.sleep(0.2)
    return new


def test_shuffle_files_go_with_their_query(spark, tmp_root):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was, before = spark.conf.get(key, None), _shuffles(spark)
    rows = spark.range(10_000).repartition(4, "id")
    with freed_shuffles(spark):
        rows.write.parquet(f"{tmp_root}/freed")
        assert not _left(spark, before)
        again = rows.groupBy("id").count()
        assert len(again.collect()) == len(again.collect()) == 10_000  # its stages are made again
    assert spark.conf.get(key, None) == was and spark.read.parquet(f"{tmp_root}/freed").count() == 10_000


def test_pieces_are_disjoint_whole_and_cut_at_the_scan(spark, tmp_root):
    rows = spark.sql("SELECT IF(id % 50 = 0, NULL, id % 300) AS k, id AS updated_at, id AS v FROM range(1000)")
    rows.write.parquet(f"{tmp_root}/rows")
    latest = latest_per_key(spark.read.parquet(f"{tmp_root}/rows"), ["k"], ["updated_at"])
    with written(latest, "pieces", ["k"], 3) as whole:
        assert sorted(map(str, whole.collect())) == sorted(map(str, latest.collect()))
    pieces = in_passes(latest, ["k"], 3)
    assert len(pieces) == 3 and all(0 < p.count() < latest.count() for p in pieces)
    plan = pieces[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("pmod")  # below the window
    lines = spark.read.parquet(f"{tmp_root}/rows").join(latest.select("k", F.col("v").alias("w")), "k")
    plan = in_passes(lines, ["k"], 2)[1]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("pmod") == 2 and plan.index("Join") < plan.index("pmod")  # on both sides
    assert in_passes(lines, ["k"], 1) == [lines]


def test_merge_in_passes_is_the_same_merge(spark, tmp_root, monkeypatch):
    old = spark.range(500).selectExpr("id AS k", "id % 7 AS v", "'old' AS s")
    new = spark.sql("SELECT IF(id % 90 = 0, NULL, id) AS k, -id AS v, 'new' AS s FROM range(300, 800)")
    found, laid = {}, []

    def look(df):
        laid.append(df)
        return df
    for name, size in (("merge_whole", upsert.PASS_BYTES), ("merge_passes", 1)):
        monkeypatch.setattr(upsert, "PASS_BYTES", size)
        keep = {"update_when": lambda t, s: s["v"] % 2 == 0, "insert_when": lambda s: s["v"] % 3 != 0, "parts": 6}
        merge_into(name, old, ["k"], tmp_root, **keep)
        for most in (1_000_000, 0):  # by a broadcast, and by the full join
            laid.clear()
            touched = merge_into(name, new, ["k"], tmp_root, stale=old.filter("k % 10 = 3"), cluster=look,
                                 max_batch_rows=most, **keep)
            assert touched == list(range(6)) and len(laid) == (4 if size == 1 else 1)
            found[name, most] = sorted(map(str, spark.table(name).collect()))
    for most in (1_000_000, 0):
        assert found["merge_whole", most] == found["merge_passes", most] and len(found["merge_whole", most]) > 500


def test_a_repeat_in_the_last_pass_changes_nothing(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(upsert, "PASS_BYTES", 1)
    always = {"update_when": _always, "insert_when": _always, "parts": 4}
    rows = spark.range(100).selectExpr("id AS k", "0 AS v")
    merge_into("passes_repeat", rows, ["k"], tmp_root, **always)
    last = spark.table("passes_repeat").filter(f"{upsert.PART} = 3").first()["k"]
    batch = rows.selectExpr("k", "1 AS v")
    for most in (1_000_000, 0):
        with pytest.raises(Exception, match="more than one row for a key"):
            merge_into("passes_repeat", batch.unionByName(batch.filter(f"k = {last}")), ["k"], tmp_root,
                       max_batch_rows=most, **always)
        assert spark.table("passes_repeat").agg(F.sum("v")).first()[0] == 0


SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()),
                       T.StructField("c", T.DoubleType())])


def test_only_odd_lines_are_parsed_by_fields(spark):
    lines = ['{"a":1,"b":"x","c":2.5}', '{"b":"y"}', '{}', '{"a":null,"b":"n"}', '{"a":1,"d":"new"}',
             '{"a":"word","b":"z"}', '{"a":1', '[1]', 'null', '{"a":"","b":"e"}', '{"a":1,"a":2}',
             '{"a":1.5}', '{"b":{"in":1}}', '[{"a":1}]']
    df = jsonl.parse_lines(spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1), SCHEMA)
    got = {x: tuple(r) for x, r in zip(lines, df.collect())}
    assert got[lines[0]] == (1, "x", 2.5, None, None, None)
    assert got[lines[1]] == (None, "y", None, None, None, None)
    assert got[lines[2]] == (None,) * 6
    assert got[lines[3]] == (None, "n", None, None, None, None)
    assert got[lines[4]] == (1, None, None, None, '{"d":"new"}', None)
    assert got[lines[5]] == (None, "z", None, None, '{"a":"word"}', "uncastable: a")
    for x in (lines[6], lines[7], lines[8]):
        assert got[x] == (None, None, None, x, None, "malformed line")
    assert got[lines[9]] == (None, "e", None, None, '{"a":""}', "uncastable: a")
    assert got[lines[11]] == (None, None, None, None, '{"a":"1.5"}', "uncastable: a")
    assert got[lines[12]] == (None, '{"in":1}', None, None, None, None)
    assert "clean" in _plan(df)


def test_rank_bounds_sort_once(spark):
    df = spark.range(100_000).selectExpr("(id * 7919) % 100000 AS v", "CAST(id % 97 AS STRING) AS s")
    import time

    at = time.monotonic()
    found = rank_bounds(df, ["v", "s"])
    assert time.monotonic() - at < 30
    assert found["v"] == [i * 100_000 // 1024 for i in range(1, 1024)]
    assert len(found["s"]) == 1023 and found["s"] == sorted(found["s"])
