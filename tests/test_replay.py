"""Streams over files that are not in time order: no row is late, no bucket stays open."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from delaycast.functions import timeops as T
from delaycast.sources import readers as R
from delaycast.streaming import jobs, replay

AT = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def shuffled(spark, sf_small, tmp_path_factory):
    """The events in four files, each with rows of the whole time."""
    path = str(tmp_path_factory.mktemp("events") / "in")
    events = spark.read.parquet(f"{sf_small}/events.parquet")
    for i in range(4):
        events.where(F.pmod(F.xxhash64("event_id"), F.lit(4)) == 3 - i).orderBy(F.xxhash64("event_id", F.lit(1))).coalesce(1).write.mode("append").parquet(path)
    return spark.read.parquet(path).withColumn("ts", T.to_ts("ts"))


def test_all_rows_of_shuffled_files(spark, shuffled, tmp_path):
    late = jobs.LateRows.of(spark)
    try:
        got = replay.replay_to_table(shuffled, "ts", jobs.dedup_events, str(tmp_path / "replay"), 4, state_partitions=2)
        expected = shuffled.select("event_id", "user_id", "ts", "value")
        assert got.count() == expected.count() and not got.exceptAll(expected).count()
        # the same files taken as they come lose rows behind the watermark
        files = shuffled.select("_metadata.file_path").distinct().first()[0].rsplit("/", 1)[0]
        plain = R.read_stream(spark, "parquet", {"maxFilesPerTrigger": "1"}, spark.read.parquet(files).schema, files).withColumn("ts", T.to_ts("ts"))
        assert jobs.run_to_table(jobs.dedup_events(plain), "plain", state_partitions=2).count() < expected.count()
        assert sum(n for batches in late._batches.values() for n in batches.values()) > 0
    finally:
        spark.streams.removeListener(late)


def test_every_bucket_is_closed(spark, shuffled, tmp_path):
    got = jobs.replay_enrich_events(shuffled, str(tmp_path / "replay"), 3)
    ev = shuffled.withColumn("bucket", T.next_hour_bucket("ts"))
    clicks = ev.where("event_type = 'click'").select("event_id", "user_id", "bucket", "value")
    for kind, prefix in (("error", "err_"), ("view", "view_")):
        right = ev.where(F.col("event_type") == kind).groupBy("bucket").agg(F.max_by(F.struct("event_id", "value"), F.struct("ts", "event_id")).alias("p"))
        clicks = clicks.join(right, "bucket", "left").select(*[c for c in clicks.columns], *[F.col(f"p.{c}").alias(prefix + c) for c in ("event_id", "value")])
    assert got.count() == clicks.count() > 0
    assert not got.select(*clicks.columns).exceptAll(clicks).count()


def test_goes_on_after_a_failure(spark, tmp_path):
    rows = spark.createDataFrame([(i, AT + dt.timedelta(minutes=(i * 37) % 100)) for i in range(100)] + [(100, None)], "id long, t timestamp")
    path, calls, seen = str(tmp_path / "in"), [], []

    def run():
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        seen.append(spark.read.schema(rows.schema).parquet(f"{path}/slice-*").count())

    with pytest.raises(RuntimeError):
        replay.replay(rows, "t", path, run, 4)
    replay.replay(rows.limit(0).unionByName(rows), "t", path, run, 4)
    assert seen[0] < seen[1] < seen[2] < seen[3] == 101  # slice 2 is run anew, then the others follow
    slices = [spark.read.parquet(f"{path}/slice-{i:05d}").agg(F.min("t"), F.max("t"), F.count_if(F.col("t").isNull())).first() for i in range(4)]
    assert all(a[1] < b[0] for a, b in zip(slices, slices[1:])) and [s[2] for s in slices] == [1, 0, 0, 0]


def test_bounds(spark):
    times = lambda minutes: spark.createDataFrame([(AT + dt.timedelta(minutes=m),) for m in minutes], "t timestamp")
    assert replay.slice_bounds(times([]), "t", 4) == []
    assert replay.slice_bounds(times(range(10)), "t", 1) == []
    assert len(replay.slice_bounds(times([5] * 50), "t", 8)) == 1  # one time is never cut
    assert len(replay.slice_bounds(times(range(1000)), "t", 8)) == 7


def test_without_rows(spark, tmp_path):
    empty = spark.createDataFrame([], "event_id long, user_id long, ts timestamp, event_type string, value double, props string")
    assert jobs.replay_enrich_events(empty, str(tmp_path / "a"), 4).count() == 0
    assert replay.replay_to_table(empty, "ts", jobs.dedup_events, str(tmp_path / "b"), 4).count() == 0


def test_a_slice_reads_its_row_groups(shuffled, tmp_path):
    part = shuffled.where(F.col("ts") >= F.timestamp_micros(F.lit(1_704_067_200_000_000)))
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan
