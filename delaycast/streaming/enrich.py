"""Stream form of the enrichment.

Shape that runs on Spark 4.x (chained stateful operators, correctness check
left on):

    positions --watermark(bucket)--> dedup ----------------------.
    observations --watermark(bucket)--> latest per bucket --salt--> left outer join
    forecasts    --watermark(bucket)--> latest per bucket --salt--> left outer join

* The right feeds are reduced to one row per bucket by ONE streaming
  aggregation over their union (``max_by`` per feed), so a single join is
  many-to-one - no fan-out, and half the stateful operators of one
  aggregation + join per feed.
* The join key is (bucket, salt): positions carry a hash salt of their
  vehicle id and each per-bucket row is replicated once per salt value, so
  one hour of positions is spread over ``salt_buckets`` state partitions
  instead of one.
* After each join the right side's event-time columns are dropped, so the
  next stateful operator sees a single event-time column.
* Unmatched positions are emitted (with nulls) once the watermark passes
  their bucket; rows behind the watermark are dropped and counted in
  ``numRowsDroppedByWatermark``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import flatten as P
from ..functions import timeops as T
from .. import schemas
from ..sources.sinks import to_families


@dataclass
class RightFeed:
    frame: DataFrame        # streaming (or batch) frame with ``key`` column
    key: str                # bucket column (timestamp)
    cols: list[str]         # payload columns
    order: list[str]        # newest-wins order within a bucket
    prefix: str             # output prefix (``act_``, ``for_``)
    cond: object = None     # row filter when several feeds share one frame


def latest_per_bucket(feed: RightFeed, watermark: str | None) -> DataFrame:
    f = feed.frame
    if watermark and f.isStreaming:
        f = f.withWatermark(feed.key, watermark)
    pay = F.struct(*[F.col(c) for c in feed.cols])
    agg = f.groupBy(F.col(feed.key).alias("_rk")).agg(
        F.max_by(pay, F.struct(*[F.col(c) for c in feed.order])).alias("_p"))
    return agg.select("_rk", *[F.col(f"_p.{c}").alias(feed.prefix + c) for c in feed.cols])


def combined_per_bucket(feeds: list[RightFeed], watermark: str | None) -> DataFrame:
    """All right feeds in ONE aggregation: union (each feed fills its own
    payload/order struct, nulls elsewhere), then per bucket one ``max_by``
    per feed - a row of another feed has a null ordering and is ignored.
    One stateful aggregation + one join instead of one of each per feed."""
    shared = all(f.frame is feeds[0].frame and f.key == feeds[0].key and f.cond is not None for f in feeds)
    if shared:
        # one source holds every feed: conditional structs, no union, one scan
        f = feeds[0].frame
        if watermark and f.isStreaming:
            f = f.withWatermark(feeds[0].key, watermark)
        cols = [F.col(feeds[0].key).alias("_rk")]
        for j, feed in enumerate(feeds):
            cols += [F.when(feed.cond, F.struct(*[F.col(c) for c in feed.cols])).alias(f"_p{j}"),
                     F.when(feed.cond, F.struct(*[F.col(c) for c in feed.order])).alias(f"_o{j}")]
        return _reduce(f.select(*cols), feeds)
    parts = []
    for i, feed in enumerate(feeds):
        f = feed.frame
        if watermark and f.isStreaming:
            f = f.withWatermark(feed.key, watermark)
        cols = [F.col(feed.key).alias("_rk")]
        for j, other in enumerate(feeds):
            if i == j:
                cols += [F.struct(*[F.col(c) for c in other.cols]).alias(f"_p{j}"),
                         F.struct(*[F.col(c) for c in other.order]).alias(f"_o{j}")]
            else:
                ftypes = {fld.name: fld.dataType for fld in other.frame.schema.fields}
                cols += [F.lit(None).cast(_struct_type(ftypes, other.cols)).alias(f"_p{j}"),
                         F.lit(None).cast(_struct_type(ftypes, other.order)).alias(f"_o{j}")]
        parts.append(f.select(*cols))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return _reduce(u, feeds)


def _reduce(u: DataFrame, feeds: list[RightFeed]) -> DataFrame:
    agg = u.groupBy("_rk").agg(*[F.max_by(f"_p{j}", f"_o{j}").alias(f"_p{j}") for j in range(len(feeds))])
    out = [F.col("_rk")]
    for j, feed in enumerate(feeds):
        out += [F.col(f"_p{j}.{c}").alias(feed.prefix + c) for c in feed.cols]
    return agg.select(*out)


def _struct_type(types: dict, names: list[str]):
    from pyspark.sql.types import StructField, StructType
    return StructType([StructField(n, types[n], True) for n in names])


def enrich(left: DataFrame, left_key: str, rights: list[RightFeed], id_cols: list[str],
           watermark: str | None = "20 seconds", salt_buckets: int = 8,
           dedup: bool = True, combine: bool = True) -> DataFrame:
    """J1/J2 + T1-T5: one function for stream and batch frames.

    ``combine`` (default) reduces all right feeds in one aggregation and
    joins once; otherwise each feed is aggregated and joined in turn."""
    streaming = left.isStreaming
    out = left
    if watermark and streaming:
        out = out.withWatermark(left_key, watermark)
    if dedup:
        out = out.dropDuplicates()
    out = out.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in id_cols]), F.lit(salt_buckets)))
    reduced = [combined_per_bucket(rights, watermark)] if combine else \
        [latest_per_bucket(feed, watermark) for feed in rights]
    for i, r in enumerate(reduced):
        r = r.withColumn("_rs", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1)).cast("array<bigint>")))
        r = r.withColumnRenamed("_rk", f"_rk{i}").withColumnRenamed("_rs", f"_rs{i}")
        cond = (F.col(left_key) == F.col(f"_rk{i}")) & (F.col("_salt") == F.col(f"_rs{i}"))
        out = out.join(r, cond, "leftOuter").drop(f"_rk{i}", f"_rs{i}")
    return out.drop("_salt")


# ---------------------------------------------------------------- feed flattening

def flatten_positions(msgs: DataFrame, text_col: str = "value") -> DataFrame:
    """P2 -> P3 -> P5 -> C1 -> C3 for the vehicle feed."""
    parsed = P.parse_json(msgs, text_col, schemas.POSITIONS, corrupt_col=None)
    rows = P.explode_rows(parsed, "vehicles", alias="v", keep=["lastUpdate"])
    flat = rows.select("lastUpdate", *[F.col(f"v.{c}").alias(c) for c in schemas.VEHICLE_FIELDS])
    flat = flat.withColumn("timestamp_utc", T.to_ts("generated"))
    return flat.withColumn("rounded_timestamp", T.next_hour_bucket("timestamp_utc"))


def flatten_forecast(msgs: DataFrame, text_col: str = "value", nearest_only: bool = False) -> DataFrame:
    """Forecast feed: hourly.data[] exploded, 3 struct levels flattened.

    ``nearest_only`` (P7): of each fetch just the first hour, the one nearest to it.
    A column ``fetched`` (when the message was fetched) is carried on."""
    fetched = [c for c in ("fetched",) if c in msgs.columns]
    parsed = P.parse_json(msgs, text_col, schemas.FORECAST, keep=fetched, corrupt_col=None)
    parsed = parsed.select("lat", "lon", "elevation", "timezone", "units", "current", "daily", *fetched,
                           F.col("hourly.data").alias("data"))
    rows = parsed.withColumn("d", P.first_element("data")).drop("data").where("d is not null") if nearest_only else \
        P.explode_rows(parsed, "data", alias="d")
    flat = rows.select("lat", "lon", "elevation", "timezone", "units", "current", "daily", *fetched,
                       F.col("d.date").alias("date"), F.col("d.weather").alias("weather"),
                       F.col("d.icon").alias("icon"), F.col("d.summary").alias("summary"),
                       F.col("d.temperature").alias("temperature"),
                       F.col("d.wind.speed").alias("speed"), F.col("d.wind.dir").alias("dir"),
                       F.col("d.wind.angle").alias("angle"),
                       F.col("d.cloud_cover.total").alias("cloud_cover"),
                       F.col("d.precipitation.total").alias("precipitation_total"),
                       F.col("d.precipitation.type").alias("type"))
    return flat.withColumn("timestamp_utc", T.to_ts("date"))


def flatten_observation(msgs: DataFrame, text_col: str = "value") -> DataFrame:
    """Observation feed: current{} flattened, weekday time parsed (C2),
    next-hour bucket (C3)."""
    parsed = P.parse_json(msgs, text_col, schemas.OBSERVATION, corrupt_col=None)
    flat = parsed.select("lat", "lon", "elevation", "timezone", "units",
                         F.col("current.icon").alias("icon"), F.col("current.summary").alias("summary"),
                         F.col("current.temperature").cast("double").alias("temperature"),
                         F.col("current.wind.speed").cast("double").alias("speed"),
                         F.col("current.wind.angle").alias("angle"), F.col("current.wind.dir").alias("dir"),
                         F.col("current.precipitation.total").cast("double").alias("precipitation_total"),
                         F.col("current.precipitation.type").alias("type"),
                         F.col("current.cloud_cover").alias("cloud_cover"), "daily", "time")
    flat = flat.withColumn("timestamp_utc", T.parse_weekday_time("time"))
    return flat.withColumn("rounded_timestamp", T.next_hour_bucket("timestamp_utc"))


# The stored columns of the weather feeds, and the families by column prefix.
OBSERVATION_COLS = ["lat", "lon", "elevation", "timezone", "units", "icon", "summary", "temperature", "speed",
                    "angle", "dir", "precipitation_total", "type", "cloud_cover", "daily"]
FORECAST_COLS = ["lat", "lon", "elevation", "timezone", "units", "current", "date", "weather", "icon", "summary",
                 "temperature", "speed", "angle", "dir", "precipitation_total", "type", "cloud_cover", "daily"]
FAMILIES = {"act_bus": "bus_", "act_weather": "act_", "fc_weather": "for_", "prediction": "prediction"}


def stream_table(bus: DataFrame, obs: DataFrame, fc: DataFrame, watermark: str = "20 seconds",
                 salt_buckets: int = 8) -> DataFrame:
    """The production stream: positions enriched with the latest observation
    of their next-hour bucket and the forecast for that hour; columns
    prefixed ``bus_``/``act_``/``for_`` (P9) and keyed ``{ts}_{vehicle}``."""
    b = P.prefix_columns(bus, "bus_")
    rights = [RightFeed(obs.withColumn("_t", F.unix_micros("timestamp_utc")), "rounded_timestamp",
                        ["timestamp_utc", *OBSERVATION_COLS], ["_t", *OBSERVATION_COLS], "act_"),
              # of several fetches for one hour the newest wins, then the values in order
              RightFeed(fc.withColumn("_t", F.col("fetched") if "fetched" in fc.columns else F.unix_micros("timestamp_utc")),
                        "timestamp_utc", FORECAST_COLS, ["_t", *FORECAST_COLS], "for_")]
    # the observation time rides along as payload; only the bucket is watermarked
    out = enrich(b, "bus_rounded_timestamp", rights, ["bus_vehicleId"], watermark, salt_buckets)
    # both feeds are joined on the bucket: it is their hour wherever they have a row
    hour = F.col("bus_rounded_timestamp")
    return out.withColumns({"act_rounded_timestamp": F.when(F.col("act_timestamp_utc").isNotNull(), hour),
                            "for_timestamp_utc": F.when(F.col("for_date").isNotNull(), hour),
                            "row_key": P.row_key("bus_timestamp_utc", "bus_vehicleId")})


def stored_families(table: DataFrame) -> DataFrame:
    """K4: the stream table as row_key and one struct per column family."""
    groups = {family: [c for c in table.columns if c.startswith(prefix)] for family, prefix in FAMILIES.items()}
    return to_families(table, {k: v for k, v in groups.items() if v}, "row_key")
