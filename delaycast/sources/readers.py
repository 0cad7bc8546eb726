"""Sources (S1-S12): format-injected stream scans, name-selected file scans,
look-back selection, keyed range scans, CSV reference tables."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..functions.timeops import shift

# File-name prefixes of the stored feeds (name-based selection).
POSITIONS_PREFIX = "Act_position"
OBSERVATION_PREFIX = "Act_weather"
FORECAST_PREFIX = "FC_weather"
TIMETABLE_PREFIX = "Stops"
STOPS_PREFIX = "Stop_times_position"
STOPS_DATE = "2023-12-17"


# ---------------------------------------------------------------- streams

def kafka_options(bootstrap: str, topic: str, starting: str = "latest",
                  max_offsets_per_trigger: int | None = None) -> dict:
    """Options of the message-broker scan (S1: latest, capped; S2: earliest)."""
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": starting, "includeHeaders": "false"}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def read_stream(spark: SparkSession, fmt: str, options: dict | None = None,
                schema: StructType | None = None, path: str | None = None) -> DataFrame:
    """Streaming scan with the format injected (``kafka`` on the
    cluster; ``parquet``/``json``/``text`` with ``maxFilesPerTrigger`` in tests)."""
    r = spark.readStream.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(path) if path else r.load()


def message_text(df: DataFrame, col: str = "value", time_col: str = "timestamp") -> DataFrame:
    """P1 at the source: broker bytes -> text column ``value``, and ``fetched``, the message's own
    time in microseconds (null without ``time_col``): of two fetches the later one is known by it."""
    time = F.unix_micros(F.col(time_col).cast("timestamp")) if time_col in df.columns else F.lit(None).cast("long")
    return df.select(F.col(col).cast("string").alias("value"), time.alias("fetched"))


# ---------------------------------------------------------------- files

def read_files_by_name(spark: SparkSession, directory: str, glob: str, fmt: str = "parquet",
                       schema: StructType | None = None, ignore_corrupt: bool = True,
                       recursive: bool = False, merge_schema: bool = False) -> DataFrame:
    """One multi-file scan of the files whose name matches ``glob``.

    The name filter runs in the file listing (no per-file plans, no driver
    download); corrupt files are skipped by the reader.
    """
    r = spark.read.format(fmt).option("pathGlobFilter", glob)
    if ignore_corrupt:
        r = r.option("ignoreCorruptFiles", "true")
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if merge_schema:
        # footers of all selected files are read in parallel; corrupt ones are
        # skipped, so one bad file cannot hide the schema of the others
        r = r.option("mergeSchema", "true")
    if schema is not None:
        r = r.schema(schema)
    return r.load(directory)


def hourly_glob(prefix: str, date: str, hour: str) -> str:
    """S3 name pattern, e.g. ``*Act_position_2024-01-01-10*``."""
    return f"*{prefix}_{date}-{hour}*"


def daily_glob(prefix: str, date: str) -> str:
    """S4 name pattern, e.g. ``*Act_weather_2024-01-01*``."""
    return f"*{prefix}_{date}*"


def read_positions(spark: SparkSession, directory: str, date: str | None = None,
                   prefix: str = POSITIONS_PREFIX) -> DataFrame:
    """All history, or one day, of the position Parquet files."""
    glob = daily_glob(prefix, date) if date else f"*{prefix}*"
    return read_files_by_name(spark, directory, glob, recursive=True, merge_schema=True)


def read_weather(spark: SparkSession, directory: str, date: str | None = None,
                 obs_prefix: str = OBSERVATION_PREFIX, fc_prefix: str = FORECAST_PREFIX) -> tuple[DataFrame, DataFrame]:
    """Observation and forecast files split by name; a date filters both
    (the notebook filtered only observations - documented difference)."""
    og = daily_glob(obs_prefix, date) if date else f"*{obs_prefix}_*"
    fg = daily_glob(fc_prefix, date) if date else f"*{fc_prefix}_*"
    return (read_files_by_name(spark, directory, og, recursive=True, merge_schema=True),
            read_files_by_name(spark, directory, fg, recursive=True, merge_schema=True))


def read_csv(spark: SparkSession, path: str, schema: StructType, glob: str | None = None) -> DataFrame:
    """The columns of ``schema`` of CSV files with a header, found by name and cast (a cell that can't be: null);
    other columns are left out. Only the first header is read to plan; a file with another header fails the scan."""
    r = spark.read.option("header", "true").option("enforceSchema", "false")
    if glob:
        r = r.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    rows = r.csv(path)
    return rows.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def read_timetable(spark: SparkSession, timetable_path: str, stops_path: str) -> tuple[DataFrame, DataFrame]:
    """Timetable (trip_id, arrival_time, stop_id, stop_sequence) and stops
    (stop_id, stop_lat, stop_lon) with declared schemas (no inference)."""
    return read_csv(spark, timetable_path, schemas.TIMETABLE), read_csv(spark, stops_path, schemas.STOPS)


def read_timetable_of_day(spark: SparkSession, directory: str, date: str | None = None,
                          stops_date: str = STOPS_DATE) -> tuple[DataFrame, DataFrame]:
    """The timetable files of one day, or of all days, and the stop positions of that day, or of
    ``stops_date`` without a day, chosen by name under ``directory``; repeated rows once. Several files of a
    day are read together. FileNotFoundError if no file has such a name."""
    def chosen(prefix: str, day: str, schema: StructType) -> DataFrame:
        glob = f"*{prefix}_{day}*"
        try:
            return read_csv(spark, directory, schema, glob).distinct()
        except AnalysisException as e:
            if e.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
                raise
            raise FileNotFoundError(f"{directory}/{glob}") from e

    return chosen(TIMETABLE_PREFIX, date or "", schemas.TIMETABLE), chosen(STOPS_PREFIX, date or stops_date, schemas.STOPS)


# ---------------------------------------------------------------- selection

def _key_time(bound: str) -> tuple[str, bool] | None:
    """(time text, exact) that a key bound begins with: a whole timestamp, or else a whole date."""
    for size, form, exact in ((19, "%Y-%m-%d %H:%M:%S", True), (10, "%Y-%m-%d", False)):
        try:
            dt.datetime.strptime(bound[:size], form)
        except ValueError:
            continue
        if len(bound) >= size:
            return bound[:size], exact
    return None


def keyed_scan(df: DataFrame, key_col: str, start: str | None = None, stop: str | None = None,
               ts_col: str | None = None) -> DataFrame:
    """Rows with ``start <= key < stop``.

    With ``ts_col`` (key = formatted timestamp + suffix) an implied, wider
    timestamp range is added, so the scan can skip row groups: from a bound
    that begins with a whole timestamp, or with a whole date (then up to the
    day's ends). A shorter bound filters on the key alone.
    """
    out = df
    if start is not None:
        out = out.where(F.col(key_col) >= F.lit(start))
        if ts_col and (at := _key_time(start)):
            out = out.where(F.col(ts_col) >= F.to_timestamp(F.lit(at[0])))
    if stop is not None:
        out = out.where(F.col(key_col) < F.lit(stop))
        if ts_col and (at := _key_time(stop)):
            out = out.where(F.col(ts_col) <= shift(F.to_timestamp(F.lit(at[0])), 1 if at[1] else 86_400))
    return out


def lookback_parts(anchor: Column, hours_back: int = 2) -> tuple[Column, Column]:
    """(date text, hour text) of ``anchor - hours_back``; the anchor is a
    parameter (default ``current_timestamp()``) so it is testable."""
    t = shift(anchor, -hours_back * 3600)
    return F.date_format(t, "yyyy-MM-dd"), F.date_format(t, "HH")


def _on_date(df: DataFrame, date_col: str | None, start: Column) -> DataFrame:
    # predicate on the table's date partition column -> partition pruning
    return df.where(F.col(date_col) == F.to_date(start)) if date_col else df


def in_lookback_hour(df: DataFrame, ts_col: str, anchor: Column | None = None,
                     hours_back: int = 2, date_col: str | None = None) -> DataFrame:
    """Rows of the clock hour ``anchor - hours_back`` (hourly batch input).
    ``date_col``: the table's date partition column, so only that day's
    folder is listed and read."""
    a = anchor if anchor is not None else F.current_timestamp()
    start = F.date_trunc("hour", shift(a, -hours_back * 3600))
    out = df.where((F.col(ts_col) >= start) & (F.col(ts_col) < shift(start, 3600)))
    return _on_date(out, date_col, start)


def in_lookback_day(df: DataFrame, ts_col: str, anchor: Column | None = None,
                    days_back: int = 1, date_col: str | None = None) -> DataFrame:
    """Rows of the calendar day ``anchor - days_back`` (daily batch input)."""
    a = anchor if anchor is not None else F.current_timestamp()
    start = F.date_trunc("day", shift(a, -days_back * 86_400))
    out = df.where((F.col(ts_col) >= start) & (F.col(ts_col) < shift(start, 86_400)))
    return _on_date(out, date_col, start)


def decode_rows(df: DataFrame, checks: dict[str, tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Split rows into (good, rejects): ``checks`` maps an output column to
    its source column and a try_* expression of it; a row is a reject if any
    expression is null while its source is not. A null source is a good null.
    Nothing is dropped silently - rejects are returned."""
    typed = df.select("*", *[e.alias(n) for n, (_, e) in checks.items()])
    bad = F.lit(False)
    for n, (source, _) in checks.items():
        bad = bad | (F.col(n).isNull() & F.col(source).isNotNull())
    return typed.where(~bad), typed.where(bad)


def literal_table(spark: SparkSession, rows: list, schema: StructType) -> DataFrame:
    """Inline literal records with a declared schema."""
    return spark.createDataFrame(rows, schema)
