"""Late rows over a query's whole life, and stopping between batches."""

import datetime as dt
import time

from pyspark.sql import functions as F

from delaycast.sources import readers as R
from delaycast.sources import sinks as K
from delaycast.streaming import jobs


def _files(spark, path, n):
    at = dt.datetime(2024, 1, 1)
    for i in range(n):
        rows = [(i, at + dt.timedelta(hours=i))] + ([(-i, at - dt.timedelta(days=1))] if i > 1 else [])  # late from the third on
        spark.createDataFrame(rows, "id long, t timestamp").coalesce(1).write.mode("append").parquet(path)


def _stream(spark, path):
    s = R.read_stream(spark, "parquet", {"maxFilesPerTrigger": "1"}, "id long, t timestamp", path)
    return s.withWatermark("t", "1 minute").dropDuplicates(["id", "t"])


def test_late_rows_beyond_the_recent_progress(spark, tmp_path):
    path = str(tmp_path / "in")
    _files(spark, path, 8)
    late = jobs.LateRows.of(spark)
    kept, parts = (spark.conf.get(c) for c in ("spark.sql.streaming.numRecentProgressUpdates", "spark.sql.shuffle.partitions"))
    try:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        q = K.start_stream(_stream(spark, path), str(tmp_path / "ck"), foreach_batch=K.batch_writer(str(tmp_path / "out")), trigger={"availableNow": True})
        q.awaitTermination()
        assert late.total(q) == 6 and jobs.rows_dropped_by_watermark(q) < 6
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.streams.removeListener(late)


def test_stop_waits_for_the_running_batch_only(spark, tmp_path):
    path, done = str(tmp_path / "in"), []
    _files(spark, path, 1)

    def slow(batch, i):
        time.sleep(1)
        done.append(batch.agg(F.count("*")).first()[0])

    stream = R.read_stream(spark, "parquet", None, "id long, t timestamp", path)
    q = K.start_stream(stream, str(tmp_path / "ck"), foreach_batch=slow, trigger={"processingTime": "1 hour"})
    while not q.status["isTriggerActive"]:
        time.sleep(0.02)
    start = time.monotonic()
    jobs.stop_gracefully(q, timeout_s=120)
    assert done == [1] and not q.isActive and time.monotonic() - start < 60
