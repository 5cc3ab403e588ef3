import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.functions.casts import cast_boolean_columns
from strata.functions.timestamps import malformed_counts, normalize_timestamps
from strata.sources import incremental


def test_timestamp_text(spark):
    df = spark.createDataFrame([
        ("2024-06-01T10:30:00", "2024-06-01T12:30:00+02:00"),
        ("2024-06-01 10:30:00.123456", "2024-06-01T10:30:00.5+00:00"),
        ("not a time", None),
    ], "updated_at string, _extracted_at string")
    out = normalize_timestamps(df, wall_clock=True).collect()
    assert out[0]["updated_at"] == dt.datetime(2024, 6, 1, 10, 30)
    assert out[0]["_extracted_at"] == dt.datetime(2024, 6, 1, 10, 30)   # offset applied
    assert out[1]["updated_at"] == dt.datetime(2024, 6, 1, 10, 30, 0, 123456)
    assert out[2]["updated_at"] is None and out[2]["_extracted_at"] is None
    bad = malformed_counts(df).first()
    assert bad["updated_at"] == 1 and bad["_extracted_at"] == 0


def test_boolean_cast(spark):
    df = spark.createDataFrame([(0,), (1,), (None,)], "is_deleted int")
    assert [r[0] for r in cast_boolean_columns(df).collect()] == [False, True, None]


def test_watermark_missing_state_is_epoch(spark):
    state = spark.createDataFrame([("customers", dt.datetime(2024, 1, 1))],
                                  incremental.STATE_SCHEMA)
    out = {r[0]: r[1] for r in incremental.load_watermarks(
        spark, ["customers", "products"], state).collect()}
    assert out == {"customers": dt.datetime(2024, 1, 1), "products": dt.datetime(1970, 1, 1)}
    assert incremental.load_watermarks(spark, ["x"]).first()[1] == dt.datetime(1970, 1, 1)


def test_extract_strict_and_advance(spark):
    t = dt.datetime(2024, 6, 1, 10, 0, 0)
    src = spark.createDataFrame([(1, t), (2, t + dt.timedelta(seconds=1)), (3, t)],
                                "id int, updated_at timestamp_ntz")
    batch = incremental.extract_since(src, "2024-06-01 10:00:00")
    assert [r["id"] for r in batch.collect()] == [2]             # equal second is not newer
    state = incremental.load_watermarks(spark, ["a", "b"])
    empty = src.where(F.lit(False))
    nxt = {r[0]: r[1] for r in incremental.advance_watermarks(
        state, {"a": batch, "b": empty}).collect()}
    assert nxt == {"a": t + dt.timedelta(seconds=1), "b": dt.datetime(1970, 1, 1)}


def test_watermark_state_round_trip(spark, tmp_root):
    path = f"{tmp_root}/watermarks"
    assert incremental.read_state(spark, path) is None            # nothing saved yet
    fresh = incremental.load_watermarks(spark, ["customers", "orders"])
    t = dt.datetime(2024, 6, 1, 8, 0, 0)
    src = spark.createDataFrame([(1, t)], "id int, updated_at timestamp_ntz")
    nxt = incremental.advance_watermarks(fresh, {"orders": src})
    nxt.write.parquet(path)
    back = {r[0]: r[1] for r in incremental.load_watermarks(
        spark, ["customers", "orders", "products"], incremental.read_state(spark, path)).collect()}
    assert back == {"customers": dt.datetime(1970, 1, 1), "orders": t,
                    "products": dt.datetime(1970, 1, 1)}


def test_extract_overlap_rereads_the_mark_second(spark):
    t = dt.datetime(2024, 6, 1, 10, 0, 0)
    src = spark.createDataFrame([(1, t), (2, t - dt.timedelta(seconds=5))],
                                "id int, updated_at timestamp_ntz")
    strict = incremental.extract_since(src, "2024-06-01 10:00:00")
    assert strict.count() == 0
    again = incremental.extract_since(src, "2024-06-01 10:00:00", overlap_seconds=1)
    assert [r["id"] for r in again.collect()] == [1]


def test_scale_conf_sizes_partitions():
    from strata.session import scale_conf

    c = scale_conf(100 << 40, 512 << 20)
    assert int(c["spark.sql.shuffle.partitions"]) == 204800
    assert c["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(512 << 20)
    assert int(scale_conf(1 << 20, executor_cores=8)["spark.sql.shuffle.partitions"]) == 16


def test_extract_run_marks_what_was_written(spark, tmp_root):
    """A row committed between the write and the mark is extracted next time; an empty batch
    keeps its mark; full and overlap go through; a lost run's batch is replaced."""
    from strata.sources import jsonl

    source, landing, state = (f"{tmp_root}/{x}" for x in ("source", "landing", "state"))
    rows = "id long, updated_at timestamp_ntz"

    def commit(*new):
        spark.createDataFrame([(i, dt.datetime.fromisoformat(t)) for i, t in new], rows) \
            .write.mode("append").parquet(source)

    def read():
        return {"t": spark.read.parquet(source)}

    def landed():
        df = jsonl.read_source(spark, f"{landing}/t", read()["t"].schema)
        return sorted(r.id for r in df.collect())
    assert incremental.latest_state(spark, state) == (0, "", None)
    commit((1, "2024-01-01T00:00:00"), (2, "2024-01-02T00:00:00"))
    incremental.write_run(read(), landing, state)           # a driver lost here
    written = incremental.write_run(read(), landing, state)
    commit((3, "2024-01-03T00:00:00"))                       # between write and mark
    marks = incremental.commit_run(spark, written, landing, state)
    assert marks.first()["high_water_mark"] == dt.datetime(2024, 1, 2) and landed() == [1, 2]
    assert incremental.extract_run(read(), landing, state).first()["high_water_mark"].day == 3
    assert landed() == [1, 2, 3]
    assert incremental.extract_run(read(), landing, state).first()["high_water_mark"].day == 3
    assert landed() == [1, 2, 3]                             # nothing new: the mark stays
    commit((4, "2024-01-02T23:59:59"))                       # late, within the overlap
    incremental.extract_run(read(), landing, state, overlap_seconds=2)
    assert landed() == [1, 2, 3, 3, 4]
    marks = incremental.extract_run(read(), landing, state, full=True)
    assert landed() == [1, 1, 2, 2, 3, 3, 3, 4, 4] and marks.first()["high_water_mark"].day == 3
    # another table's run keeps this one's mark; two runs of one number: the second fails
    other = {"u": read()["t"].filter("id = 1")}
    assert {r.table_name: r.high_water_mark.day for r in
            incremental.extract_run(other, landing, state).collect()} == {"t": 3, "u": 1}
    number = incremental.latest_state(spark, state)[0]
    a = incremental.write_run(read(), landing, state)
    real = incremental.latest_state
    states = [real(spark, state)]
    incremental.commit_run(spark, a, landing, state)
    try:
        incremental.latest_state = lambda *x: states.pop() if states else real(*x)
        with pytest.raises(RuntimeError, match=f"run {number + 1}"):
            for _ in range(40):     # of two attempts the first by name counts
                states.append((number, "", None))
                incremental.commit_run(spark, a, landing, state)
    finally:
        incremental.latest_state = real
    assert incremental.latest_state(spark, state)[0] == number + 1


def test_lines_that_do_not_fit(spark):
    from strata.sources.jsonl import parse_lines

    schema = "id bigint, `odd name's` double, s string"
    lines = ['{"id":1,"odd name\'s":1.5,"s":"a"}', '{"id":"x","s":{"k":1}}', '{"id":2,"new":[1]}',
             '{"id":3,', "plain", "  ", '{"id":null}', '{"id":1.5}']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    out = [tuple(r) for r in parse_lines(df, spark.createDataFrame([], schema).schema).collect()]
    assert out == [
        (1, 1.5, "a", None, None, None),
        (None, None, '{"k":1}', None, '{"id":"x"}', "uncastable: id"),
        (2, None, None, None, '{"new":"[1]"}', None),
        (None, None, None, '{"id":3,', None, "malformed line"),
        (None, None, None, "plain", None, "malformed line"),
        (None, None, None, None, None, None),
        (None, None, None, None, '{"id":"1.5"}', "uncastable: id")]
