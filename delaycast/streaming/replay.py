"""Streams over stored rows that are not in time order.

A file stream takes files by their age, so rows behind the watermark are lost
when files overlap in time or are stored out of order. Here the rows are fed in
slices of time instead: each slice is written to the folder the stream reads and
the stream runs over it before the next one is written. No row is then behind
the watermark, whatever the files; a closing slice moves the watermark past the
last window.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session as S
from ..sources import readers as R
from ..sources import sinks as K

#: Times of the plan that the driver holds, at most; more rows make larger slices, not more of them.
MOST_SLICES = 10_000


def slice_bounds(rows: DataFrame, time_col: str, slices: int) -> list[int]:
    """Increasing times (microseconds) that cut `rows` into at most `slices` parts of like size: approximate
    quantiles from one scan of the time column. A time that many rows share is never cut."""
    slices = min(slices, MOST_SLICES)
    if slices < 2:
        return []
    shares = [i / slices for i in range(1, slices)]
    cuts = rows.agg(F.percentile_approx(F.unix_micros(time_col), shares, 100 * slices)).first()[0]
    return sorted(set(cuts or []))


def _done(spark: SparkSession, folder: str) -> bool:
    fs, marker = K._files(spark, f"{folder}/_SUCCESS")
    return fs.exists(marker)


def replay(rows: DataFrame, time_col: str, path: str, run: Callable[[], None], slices: int,
           closing: Callable[[int], DataFrame] | None = None) -> None:
    """Feed `rows` in slices of time, first to last, to the stream over the folders ``{path}/slice-*``.

    ``run()`` takes the stream over all that is there and returns when it has ended. Rows without a time come
    with the first slice; rows of one time come together; the filter on the slice's times reaches the scan, so a
    slice reads the row groups it needs. ``closing(last)`` gives rows of a time after ``last`` (microseconds), for
    every watermark of the stream, that open a window of their own: they close all windows before it and stay in
    the state. Without rows that have a time there is no closing slice.

    The plan is stored: called again after a failure with the same ``path`` it goes on where it stopped, as slice
    i + 1 is written only after the stream has ended over slice i.
    """
    spark = rows.sparkSession
    if not _done(spark, f"{path}/_plan"):
        cuts, last = slice_bounds(rows, time_col, slices), rows.agg(F.max(F.unix_micros(time_col))).first()[0]
        spark.createDataFrame([(cuts, last)], "cuts array<long>, last long").write.mode("overwrite").parquet(f"{path}/_plan")
    plan = spark.read.schema("cuts array<long>, last long").parquet(f"{path}/_plan").first()
    at, edges = F.col(time_col), [None, *plan["cuts"], None]
    parts = []
    for low, high in zip(edges, edges[1:]):
        part = rows
        if high is not None:
            below = at < F.timestamp_micros(F.lit(high))
            part = part.where(below if low is not None else below | at.isNull())
        if low is not None:
            part = part.where(at >= F.timestamp_micros(F.lit(low)))
        parts.append(part)
    if closing is not None and plan["last"] is not None:
        parts.append(closing(plan["last"]))
    folders = [f"{path}/slice-{i:05d}" for i in range(len(parts))]
    written = sum(_done(spark, f) for f in folders)
    if written:
        run()
    for part, folder in list(zip(parts, folders))[written:]:
        part.write.mode("overwrite").parquet(folder)
        run()


def replay_to_table(rows: DataFrame, time_col: str, build: Callable[[DataFrame], DataFrame], base: str, slices: int,
                    closing: Callable[[int], DataFrame] | None = None, state_partitions: int | None = None) -> DataFrame:
    """The rows that the streaming plan ``build(stream)`` gives over `rows` in time order; its batches go to
    ``{base}/out`` by batch id, its checkpoint to ``{base}/_checkpoint``. Settings of the caller's session stay."""
    own = S.configure(rows.sparkSession.newSession())
    if state_partitions:
        own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    out = build(R.read_stream(own, "parquet", None, rows.schema, f"{base}/in/slice-*"))

    def run() -> None:
        K.start_stream(out, f"{base}/_checkpoint", foreach_batch=K.batch_writer(f"{base}/out"), trigger={"availableNow": True}).awaitTermination()

    replay(rows, time_col, f"{base}/in", run, slices, closing)
    return rows.sparkSession.read.schema(out.schema).option("recursiveFileLookup", "true").parquet(f"{base}/out")
