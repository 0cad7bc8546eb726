"""Streaming jobs over a file source, run to completion with availableNow.

Used by the driver queries and the tests; on a cluster the same plans take a
broker source (``sources.readers.read_stream(spark, "kafka", ...)``) and a
processing-time trigger.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import StructType

from .. import schemas
from .. import session as S
from ..functions import flatten as P
from ..functions import timeops as T
from ..sources import readers as R
from ..sources import sinks as K
from .enrich import RightFeed, enrich
from .replay import replay_to_table


def events_stream(spark: SparkSession, sf_dir: str, max_files: int = 1) -> DataFrame:
    """S1 stand-in: the events table as a file stream (T8 rate cap)."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    # a stream takes a plain path for a folder; a pattern of this one name is right for a single file too
    src = R.read_stream(spark, "parquet", {"maxFilesPerTrigger": str(max_files)}, schema, f"{sf_dir}/events.parque[t]")
    return src.withColumn("ts", T.to_ts("ts"))


def default_state_partitions(spark: SparkSession) -> int:
    """State partitions of a new stream: half the default parallelism (at
    least 2). Each partition commits every stateful operator's store each
    batch, so more partitions than cores only adds commit cost."""
    return max(2, spark.sparkContext.defaultParallelism // 2)


def run_to_table(df: DataFrame, name: str, key_col: str | None = None,
                 order: list[str] | None = None, state_partitions: int | None = None) -> DataFrame:
    """Run a streaming frame with availableNow into a checkpointed, batch-id
    keyed Parquet sink under the shared checkpoint folder; return the result
    as a batch frame. Replays overwrite their own batch folder (K3).

    ``state_partitions`` is fixed in the checkpoint at the first start (the
    query clones the session settings when it starts)."""
    spark = df.sparkSession
    base = S.shared_dir(spark, name)
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions or default_state_partitions(spark)))
    try:
        q = K.start_stream(df, f"{base}/_checkpoint",
                           foreach_batch=K.batch_writer(f"{base}/out", key_col, order),
                           trigger={"availableNow": True}, query_name=None)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)
    q.awaitTermination()
    try:
        out = spark.read.parquet(f"{base}/out")
        return out.drop("batch_id")
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        # no batch produced rows
        return spark.createDataFrame([], df.schema)


def enrich_events_stream(spark: SparkSession, sf_dir: str, watermark: str = "20 seconds",
                         salt_buckets: int | None = None) -> DataFrame:
    return enrich_events(events_stream(spark, sf_dir), watermark, salt_buckets)


def enrich_events(ev: DataFrame, watermark: str = "20 seconds", salt_buckets: int | None = None) -> DataFrame:
    """Clicks with the latest error and view of their hour bucket, from a stream of events."""
    salt_buckets = salt_buckets or default_state_partitions(ev.sparkSession)
    ev = ev.withColumn("bucket", T.next_hour_bucket("ts"))
    clicks = ev.where(F.col("event_type") == "click").select("event_id", "user_id", "bucket", "value")
    # both weather-like feeds come from the one source: one branch, conditional per feed
    right = ev.where(F.col("event_type").isin("error", "view")).select("bucket", "ts", "event_id", "value",
                                                                        "event_type")
    is_ = lambda t: F.col("event_type") == t
    rights = [RightFeed(right, "bucket", ["event_id", "value"], ["ts", "event_id"], "err_", is_("error")),
              RightFeed(right, "bucket", ["event_id", "value"], ["ts", "event_id"], "view_", is_("view"))]
    return enrich(clicks, "bucket", rights, ["user_id"], watermark, salt_buckets)


def dedup_events_stream(spark: SparkSession, sf_dir: str, watermark: str = "20 seconds") -> DataFrame:
    """Two copies of the feed (every row delivered twice), dedup with
    the event-time column in the key so state is evicted by the watermark."""
    return dedup_events(events_stream(spark, sf_dir), watermark)


def dedup_events(ev: DataFrame, watermark: str = "20 seconds") -> DataFrame:
    ev = ev.select("event_id", "user_id", "ts", "value")
    both = ev.unionByName(ev).withWatermark("ts", watermark)
    return both.dropDuplicates(["event_id", "ts"])


def replay_enrich_events(rows: DataFrame, base: str, slices: int, watermark: str = "20 seconds") -> DataFrame:
    """T1-T5 over stored events in any order, closed: every click comes out, that of the last bucket too.
    The closing slice has a click and an error a day after the last event."""
    def closing(last: int) -> DataFrame:
        types = rows.sparkSession.createDataFrame([("click",), ("error",)], "event_type string")
        given = {"event_type": F.col("event_type"), "ts": F.timestamp_micros(F.lit(last + 86_400_000_000))}
        return types.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema])

    parts = default_state_partitions(rows.sparkSession)
    return replay_to_table(rows, "ts", lambda ev: enrich_events(ev, watermark, parts), base, slices, closing, parts)


def production_stream(bus_msgs: DataFrame, obs_msgs: DataFrame, fc_msgs: DataFrame, model,
                      out_path: str, checkpoint: str, watermark: str = "20 seconds",
                      salt_buckets: int | None = None, trigger: dict | None = None, also=None,
                      fold_into: str | None = None, fold_every: int = 16):
    """The full stream: three message feeds -> flatten -> enrich (T1-T5) ->
    serving features (C22) -> model transform (M8, JVM) -> keyed upsert sink
    written per micro-batch by the executors (K3), one query (T7), explicit
    checkpoint (T10). ``also`` is a second batch function, such as
    ``sinks.peek_writer()``, fed by the same batches. With ``fold_into``, a table
    partitioned by ``date``, every ``fold_every`` batch folders are folded into it, so that
    a key is one row whichever batches bring it. Returns the running ``StreamingQuery``."""
    from ..plans.features import serving_features
    from .enrich import flatten_forecast, flatten_observation, flatten_positions, stream_table
    spark = bus_msgs.sparkSession
    table = stream_table(flatten_positions(bus_msgs), flatten_observation(obs_msgs), flatten_forecast(fc_msgs),
                         watermark, salt_buckets or default_state_partitions(spark))
    scored = model.transform(serving_features(table))
    keep = [c for c in table.columns] + ["prediction"]
    out = scored.select(*keep)
    if fold_into:
        out = out.withColumn("date", F.to_date("bus_timestamp_utc"))
        write = K.folding_writer(out_path, fold_into, "row_key", ["bus_lastUpdate"], ["date"], fold_every)
    else:
        write = K.batch_writer(out_path, "row_key", ["bus_lastUpdate"])
    return K.start_stream(out, checkpoint, foreach_batch=K.fan_out(write, also) if also else write,
                          trigger=trigger or {"availableNow": True})


def rejected_messages(feeds: dict[str, tuple[DataFrame, StructType]], text_col: str = "value") -> DataFrame:
    """The messages of all feeds (name: messages, declared schema) that do not fit, as (feed, value)."""
    parts = [P.rejected(msgs.select(F.col(text_col).alias("value")), "value", schema).select(F.lit(name).alias("feed"), "value")
             for name, (msgs, schema) in feeds.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def reject_stream(bus_msgs: DataFrame, obs_msgs: DataFrame, fc_msgs: DataFrame, out_path: str, checkpoint: str, trigger: dict | None = None):
    """The dead letters of the three feeds of ``production_stream``: every message that does not
    fit its schema, with the feed it came from, in a table of its own. Stateless, so a query
    beside the enriched one, with its own checkpoint; a repeated batch replaces its folder."""
    bad = rejected_messages({"positions": (bus_msgs, schemas.POSITIONS), "observations": (obs_msgs, schemas.OBSERVATION),
                             "forecasts": (fc_msgs, schemas.FORECAST)})
    return K.start_stream(bad, checkpoint, foreach_batch=K.batch_writer(out_path), trigger=trigger or {"availableNow": True})


def stop_gracefully(query, timeout_s: float = 60.0) -> None:
    """Stop between batches: as soon as the running one, if any, has ended, or after ``timeout_s``."""
    end = time.monotonic() + timeout_s
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < end:
        time.sleep(0.02)
    if query.isActive:
        query.stop()


class LateRows(StreamingQueryListener):
    """T4: the rows that stateful operators dropped behind the watermark, added up over the whole life
    of every query of a session, batch by batch (a repeated report of a batch counts once):

        late = LateRows.of(spark)      # before the query starts
        late.total(query)
    """

    def __init__(self):
        self._batches: dict[str, dict[tuple[str, int], int]] = {}
        self._ended: set[str] = set()

    @classmethod
    def of(cls, spark: SparkSession) -> "LateRows":
        listener = cls()
        spark.streams.addListener(listener)
        return listener

    def onQueryStarted(self, event):
        self._ended.discard(str(event.runId))

    def onQueryProgress(self, event):
        p = event.progress
        self._batches.setdefault(str(p.id), {})[str(p.runId), p.batchId] = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self._ended.add(str(event.runId))

    def total(self, query, timeout_s: float = 30.0) -> int:
        """Late rows of all runs of ``query`` so far; of an ended run only after all its reports are in."""
        end = time.monotonic() + timeout_s
        while not query.isActive and str(query.runId) not in self._ended and time.monotonic() < end:
            time.sleep(0.02)
        return sum(self._batches.get(str(query.id), {}).values())


def rows_dropped_by_watermark(query) -> int:
    """T4: late rows dropped by the stateful operators over the query's recent progress only
    (``numRowsDroppedByWatermark``); ``LateRows`` counts its whole life."""
    return sum(op.get("numRowsDroppedByWatermark", 0)
               for p in query.recentProgress for op in p.get("stateOperators", []))
