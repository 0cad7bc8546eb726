"""Hourly positions and daily weather loads (keyed tables K1/K2).

Both are one multi-file scan selected by file name (S3/S4, corrupt files
skipped S10), flattened (P3/P5), timed (C1/C2/C8), keyed (P14) and upserted
(latest row per key, date-partitioned, idempotent re-run). With no matching
file the result is an empty table with the declared schema, not an error.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..functions import flatten as P
from ..functions import timeops as T
from ..sources import readers as R
from ..sources import sinks as K

# Value columns of the stored positions and weather tables.
POSITION_VALUES = ["lastUpdate", "generated", "routeShortName", "headsign", "vehicleCode", "vehicleService",
                   "vehicleId", "speed", "direction", "delay", "scheduledTripStartTime", "lat", "lon",
                   "gpsQuality"]
WEATHER_VALUES = ["lat", "lon", "elevation", "timezone", "units", "icon", "summary", "temperature", "speed",
                  "angle", "dir", "precipitation_total", "type", "cloud_cover", "daily"]


def lookback(anchor: dt.datetime | None = None, hours: int = 2, days: int = 1) -> tuple[str, str, str]:
    """S9 on the driver clock: (date, hour) of anchor - hours, date of anchor - days.
    Pure date arithmetic - no Spark job is needed to read the clock."""
    a = anchor or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    h = a - dt.timedelta(hours=hours)
    d = a - dt.timedelta(days=days)
    return h.strftime("%Y-%m-%d"), h.strftime("%H"), d.strftime("%Y-%m-%d")


class UnreadableFiles(RuntimeError):
    """No file of a load could be read, though there are some."""


def listed(spark: SparkSession, src_dir: str, glob: str) -> DataFrame:
    """file and size of the files of a load, from the listing alone (their content is not read)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(src_dir)
    return files.select(F.col("path").alias("file"), F.col("length").alias("size"))


def _scan(spark: SparkSession, src_dir: str, glob: str, schema: StructType) -> DataFrame:
    """Parquet keeps its own (footer) schema - physical types may differ from
    the declared JSON schema (double vs float) and columns are cast after
    flattening. No matching file -> empty frame with the declared schema; files
    of which none has a readable schema -> ``UnreadableFiles``."""
    from pyspark.errors import AnalysisException
    try:
        return R.read_files_by_name(spark, src_dir, glob, recursive=True, merge_schema=True)
    except AnalysisException as e:
        # nothing matched: no such folder, or no file to take a schema from
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA" and (n := listed(spark, src_dir, glob).count()):
            raise UnreadableFiles(f"{n} files match {glob} under {src_dir}, and none can be read") from e
        return spark.createDataFrame([], schema)


def note_skipped(raw: DataFrame, spark: SparkSession, src_dir: str, glob: str, out_path: str, load: str) -> None:
    """The files of a load that gave no row (corrupt or empty ones), by name and size, in
    ``{out_path}_skipped/load=...``, replaced when the same load runs again."""
    if not raw.inputFiles():
        return
    read = raw.select(F.col("_metadata.file_path").alias("file")).distinct()
    name = F.regexp_replace("file", "^file:/+", "file:/")  # listing and scan write local paths differently
    skipped = listed(spark, src_dir, glob).withColumn("_f", name).join(read.select(name.alias("_f")).distinct(), "_f", "left_anti").drop("_f")
    skipped.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}_skipped/load={load}")


def store(table: DataFrame, out_path: str, load: str, order: list[str]) -> None:
    """Upsert the rows with a readable time; the others go to ``{out_path}_rejects/load=...``,
    replaced when the same load runs again. Never dropped, and never merged under one key."""
    bad = table.where(F.col("timestamp_utc").isNull())
    bad.drop("row_key").write.mode("overwrite").parquet(f"{out_path.rstrip('/')}_rejects/load={load}")
    good = table.where(F.col("timestamp_utc").isNotNull())
    K.write_keyed(good, out_path, "row_key", order, partition_by=["date"])


def positions_table(raw: DataFrame) -> DataFrame:
    """Parsed position messages -> stored positions rows (typed time, day, key)."""
    rows = P.explode_rows(raw, "vehicles", alias="v", keep=["lastUpdate"])
    flat = rows.select("lastUpdate", *[F.col(f"v.{c}").alias(c) for c in schemas.VEHICLE_FIELDS if c != "tripId"])
    flat = flat.withColumn("timestamp_utc", T.to_ts("generated")).withColumn("day", F.dayofmonth("timestamp_utc"))
    flat = flat.withColumn("row_key", P.row_key("timestamp_utc", "vehicleId"))
    return flat.select("row_key", "timestamp_utc", "day", *POSITION_VALUES)


def weather_table(raw: DataFrame) -> DataFrame:
    """Parsed observation messages -> stored weather rows keyed by time."""
    cur = "current"
    flat = raw.select("lat", "lon", "elevation", "timezone", "units",
                      F.col(f"{cur}.icon").alias("icon"), F.col(f"{cur}.summary").alias("summary"),
                      F.col(f"{cur}.temperature").cast("double").alias("temperature"),
                      F.col(f"{cur}.wind.speed").cast("double").alias("speed"),
                      F.col(f"{cur}.wind.angle").alias("angle"), F.col(f"{cur}.wind.dir").alias("dir"),
                      F.col(f"{cur}.precipitation.total").cast("double").alias("precipitation_total"),
                      F.col(f"{cur}.precipitation.type").alias("type"),
                      F.col(f"{cur}.cloud_cover").alias("cloud_cover"), "daily",
                      T.parse_weekday_time("time").alias("timestamp_utc"))
    flat = flat.withColumn("day", F.dayofmonth("timestamp_utc"))
    flat = flat.withColumn("row_key", F.date_format("timestamp_utc", "yyyy-MM-dd HH:mm:ss"))
    return flat.select("row_key", "timestamp_utc", "day", *WEATHER_VALUES)


def load_positions_hour(spark: SparkSession, src_dir: str, out_path: str,
                        anchor: dt.datetime | None = None, prefix: str = R.POSITIONS_PREFIX) -> DataFrame:
    """PB: files of the look-back hour -> positions table (upsert by key)."""
    date, hour, _ = lookback(anchor)
    glob = R.hourly_glob(prefix, date, hour)
    raw = _scan(spark, src_dir, glob, schemas.POSITIONS)
    table = positions_table(raw).withColumn("date", F.to_date("timestamp_utc"))
    store(table, out_path, f"{date}-{hour}", ["lastUpdate"])
    note_skipped(raw, spark, src_dir, glob, out_path, f"{date}-{hour}")
    return table


def load_weather_day(spark: SparkSession, src_dir: str, out_path: str,
                     anchor: dt.datetime | None = None, prefix: str = R.OBSERVATION_PREFIX) -> DataFrame:
    """WB: observation files of the look-back day -> weather table."""
    _, _, day = lookback(anchor)
    glob = R.daily_glob(prefix, day)
    raw = _scan(spark, src_dir, glob, schemas.OBSERVATION)
    table = weather_table(raw).withColumn("date", F.to_date("timestamp_utc"))
    store(table, out_path, day, ["timestamp_utc"])
    note_skipped(raw, spark, src_dir, glob, out_path, day)
    return table
