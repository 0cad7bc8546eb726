"""Committed keyed tables, batch folding, dead letters and unreadable files."""

import datetime as dt
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from delaycast import schemas
from delaycast.functions import flatten as P
from delaycast.plans import batch_jobs as B
from delaycast.sources import readers as R
from delaycast.sources import sinks as K
from delaycast.streaming import enrich as E
from delaycast.streaming import jobs
from fixtures import forecast_entry, forecast_message, observation_message, positions_message, vehicle

SCHEMA = "key string, t long, v long, day date"


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def rows_of(spark, path):
    return {(r.key, r.t, r.v, r.day) for r in spark.read.schema(SCHEMA).parquet(path).collect()}


def test_a_load_of_one_day_reads_one_day(spark, tmp_path):
    path = str(tmp_path / "t")
    K.write_keyed(spark.createDataFrame([(f"k{i}", 1, i, day(i)) for i in range(50)], SCHEMA), path, "key", ["t"], ["day"])
    new = spark.createDataFrame([("k7", 2, 700, day(7)), ("n", 1, 1, day(7))], SCHEMA)
    plan = K.touched_rows(spark.read.schema(SCHEMA).parquet(path), new, ["day"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and str(day(7)) in plan or "(day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    before = {p: os.stat(p).st_mtime_ns for d in os.scandir(path) if d.is_dir() for p in (f.path for f in os.scandir(d.path))}
    K.write_keyed(new, path, "key", ["t"], ["day"])
    after = {p: os.stat(p).st_mtime_ns for d in os.scandir(path) if d.is_dir() for p in (f.path for f in os.scandir(d.path))}
    assert {p.split("day=")[1][:10] for p in before.items() ^ after.items() for p in [p[0]]} == {str(day(7))}
    want = {(f"k{i}", 1, i, day(i)) for i in range(50) if i != 7} | {("k7", 2, 700, day(7)), ("n", 1, 1, day(7))}
    assert rows_of(spark, path) == want
    both = K.touched_rows(spark.read.schema(SCHEMA).parquet(path), new, ["day"], most=0)  # too many to name: a join
    assert {r.key for r in both.collect()} == {"k7", "n"}


@pytest.mark.parametrize("partition_by", [["day"], None])
def test_a_load_killed_before_its_commit_changes_nothing(spark, tmp_path, monkeypatch, partition_by):
    path = str(tmp_path / "t")
    first = [("a", 1, 1, day(0)), ("b", 1, 1, day(1)), ("c", 1, 1, None)]
    K.write_keyed(spark.createDataFrame(first, SCHEMA), path, "key", ["t"], partition_by)
    new = spark.createDataFrame([("b", 2, 2, day(1)), ("d", 1, 1, None)], SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(K, "_write_json", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            K.write_keyed(new, path, "key", ["t"], partition_by)
    assert rows_of(spark, path) == set(first)
    assert {r.key for r in K.read_keyed(spark, path, "key", ["t"]).collect()} == {"a", "b", "c"}
    K.write_keyed(new, path, "key", ["t"], partition_by)
    assert rows_of(spark, path) == {first[0], first[2], ("b", 2, 2, day(1)), ("d", 1, 1, None)}


@pytest.mark.parametrize("partition_by", [["day"], None])
def test_a_load_killed_after_its_commit_is_finished_by_the_next_reader(spark, tmp_path, monkeypatch, partition_by):
    path = str(tmp_path / "t")
    K.write_keyed(spark.createDataFrame([("a", 1, 1, day(0)), ("b", 1, 1, day(1))], SCHEMA), path, "key", ["t"], partition_by)
    real = K.finish_commit
    with monkeypatch.context() as m:
        calls = []

        def dies(spark, path):
            calls.append(1)
            if len(calls) > 1:
                if partition_by is None:  # in the midst of the overwrite: the table's folder is gone
                    K._delete(spark, path)
                raise KeyboardInterrupt()
            return real(spark, path)

        m.setattr(K, "finish_commit", dies)
        with pytest.raises(KeyboardInterrupt):
            K.write_keyed(spark.createDataFrame([("b", 2, 2, day(1))], SCHEMA), path, "key", ["t"], partition_by)
    want = {("a", 1, 1, day(0)), ("b", 2, 2, day(1))}
    assert {(r.key, r.t) for r in K.read_keyed(spark, path, "key", ["t"]).collect()} == {("a", 1), ("b", 2)}
    assert rows_of(spark, path) == want and os.listdir(f"{path}_commit") == []


def test_batches_are_folded_once(spark, tmp_path):
    src, dst = str(tmp_path / "b"), str(tmp_path / "t")
    keys = ("key", ["t"])
    write = K.folding_writer(src, dst, *keys, partition_by=["day"], every=2)
    batch = lambda *rows: spark.createDataFrame(list(rows), SCHEMA)
    assert K.current_rows(spark, src, dst, *keys) is None
    batches = [batch(("a", 1, 1, day(0)), ("b", 1, 1, day(0))), batch(("a", 3, 3, day(0)), ("c", 1, 1, day(1))), batch(("a", 2, 2, day(0)), ("b", 2, 2, day(0)))]
    for i, b in enumerate(batches):
        write(b, i)
    want = {("a", 3), ("b", 2), ("c", 1)}
    seen = lambda: {(r.key, r.t) for r in K.current_rows(spark, src, dst, *keys).collect()}
    assert K.folded_upto(spark, dst) == 1 and K.batches_after(spark, src, -1) == [2] and seen() == want
    write(batches[0], 0)  # the stream repeats a batch that the table holds
    write(batches[2], 2)  # and one that waits
    assert K.batches_after(spark, src, -1) == [2] and seen() == want
    assert K.fold_batches(spark, src, dst, *keys, partition_by=["day"]) == 1 and seen() == want
    assert {(r.key, r.t) for r in spark.read.parquet(dst).collect()} == want
    assert K.fold_batches(spark, src, dst, *keys, partition_by=["day"]) == 0 and K.folded_upto(spark, dst) == 2


def test_a_message_of_another_shape_is_rejected(spark):
    texts = [positions_message([vehicle()]), "{", "[1", "3", '"text"', '{"lastUpdate": "x", "vehicles": 5}', '{"lastUpdate": "x"}', None, ""]
    msgs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    good, bad = P.split_rejects(msgs, "value", schemas.POSITIONS, keep=["i"])
    assert {1, 2, 3, 4, 5} <= {r.i for r in bad.collect()} and {0, 6, 7} <= {r.i for r in good.collect()}
    assert good.count() + bad.count() == len(texts)


def _lines(path, texts):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/m.txt", "w") as f:
        f.write("\n".join(texts))


def test_dead_letters_of_the_three_feeds(spark, tmp_path):
    base = str(tmp_path)
    _lines(f"{base}/bus", [positions_message([vehicle()]), "{oops", '{"vehicles": "none"}'])
    _lines(f"{base}/obs", [observation_message("Mon Jan  1 11:05:09 CET 2024"), "not json"])
    _lines(f"{base}/fc", [forecast_message([forecast_entry("2024-01-01T11:00:00")]), "[", "]"])
    read = lambda p: R.read_stream(spark, "text", None, None, f"{base}/{p}")
    q = jobs.reject_stream(read("bus"), read("obs"), read("fc"), f"{base}/out", f"{base}/ck")
    q.awaitTermination()
    got = {(r.feed, r.n) for r in spark.read.parquet(f"{base}/out").groupBy("feed").agg(F.count("*").alias("n")).collect()}
    assert got == {("positions", 2), ("observations", 1), ("forecasts", 2)}


def test_the_newer_fetch_wins_by_the_message_time(spark):
    at = lambda h: dt.datetime(2024, 1, 1, h, tzinfo=dt.timezone.utc)
    entry = lambda t: forecast_message([forecast_entry("2024-01-01T11:00:00Z", temperature=t)])
    broker = spark.createDataFrame([(bytearray(entry(30.0).encode()), at(8)), (bytearray(entry(6.0).encode()), at(9))], "value binary, timestamp timestamp")
    bus = spark.createDataFrame([(positions_message([vehicle()]),)], "value string")
    obs = spark.createDataFrame([(observation_message("Mon Jan  1 11:05:09 CET 2024"),)], "value string")
    for msgs in (broker, broker.orderBy(F.desc("timestamp"))):
        table = E.stream_table(E.flatten_positions(bus), E.flatten_observation(obs), E.flatten_forecast(R.message_text(msgs)), watermark=None)
        assert [r.for_temperature for r in table.collect()] == [6.0]


def test_skipped_files_are_named_and_a_day_of_corrupt_files_fails(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    os.makedirs(src)
    for name in ("a", "b"):
        with open(f"{src}/Act_position_2024-01-01-10_{name}.parquet", "wb") as f:
            f.write(b"corrupt")
    anchor = dt.datetime(2024, 1, 1, 12, 15)
    with pytest.raises(B.UnreadableFiles, match="2 files"):
        B.load_positions_hour(spark, src, out, anchor)
    assert not os.path.exists(out)
    pq.write_table(pa.Table.from_pylist([json.loads(positions_message([vehicle()]))]), f"{src}/Act_position_2024-01-01-10_c.parquet")
    B.load_positions_hour(spark, src, out, anchor)
    assert spark.read.parquet(out).count() == 1
    skipped = spark.read.parquet(f"{out}_skipped").collect()
    assert sorted(os.path.basename(r.file) for r in skipped) == [f"Act_position_2024-01-01-10_{n}.parquet" for n in "ab"] and {r.size for r in skipped} == {7}
    B.load_positions_hour(spark, src, out, dt.datetime(2024, 1, 2, 12, 15))  # no file at all: an empty load
