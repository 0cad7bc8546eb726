"""Feature and label plans (M1-M5), one code path for training and serving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import flatten as P
from ..functions import scalars as C
from ..functions import timeops as T
from ..operators import dedup as D
from ..operators import filters as FL
from ..operators import joins as J
from .. import schemas

# Columns of the vehicle feed that the features leave out.
POSITION_DROP = ["vehicles", "headsign", "vehicleCode", "vehicleId", "direction", "gpsQuality",
                 "tripId", "tripId_member0", "tripId_member1", "lastUpdate"]


def clean_positions(raw: DataFrame) -> DataFrame:
    """M1: explode (keeping empty envelopes), flatten, drop identity columns,
    type numbers, dedup, recode night routes."""
    rows = P.explode_rows(raw, "vehicles", alias="v", outer=True, keep=[c for c in raw.columns if c != "vehicles"])
    flat = P.flatten(rows, depth=2, keep_parent_names=False, structs=["v"])
    if "tripId" in flat.columns and flat.schema["tripId"].dataType.typeName() == "struct":
        flat = flat.withColumn("tripId", F.coalesce(F.col("tripId.member0").cast("string"),
                                                    F.col("tripId.member1").cast("string")))
    flat = P.drop_columns(flat, *POSITION_DROP)
    flat = P.typed(flat, {k: v for k, v in schemas.VEHICLE_NUMERIC.items() if k in flat.columns})
    flat = D.dedup_rows(flat)
    return flat.withColumn("routeShortName", C.recode_night_route("routeShortName"))


def add_label(pos: DataFrame, shift_seconds: int = 900, keys=("vehicleService", "scheduledTripStartTime"),
              time_col: str = "generated", value_cols=("delay", "lat", "lon", "time"),
              tiebreak: tuple[str, ...] = ("routeShortName", "speed", "delay", "lat", "lon")) -> DataFrame:
    """M2: delay ``shift_seconds`` later on the same trip.

    10-minute weather bin (C5), null rows dropped (F6), minutes to nearest
    midnight (C11), minute rounding (C6), first row per (minute, trip) (D3),
    then the one-to-one self join at +shift (J4).
    """
    df = pos.withColumn("_ts", T.to_ts(time_col))
    df = df.withColumn("generated_weather_bin", T.ten_minute_bin("_ts"))
    df = FL.drop_any_null(df)
    df = df.withColumn("time", T.minutes_to_nearest_midnight("_ts"))
    df = df.withColumn("minute", T.minute_bin("_ts"))
    first = D.first_by_key(df, ["minute", *keys], ["_ts", *[c for c in tiebreak if c in df.columns]])
    lab = J.shift_self_join(first, list(keys), "minute", shift_seconds, list(value_cols), suffix="_15min")
    return lab.drop("_ts")


def weather_features(obs: DataFrame, fc: DataFrame) -> DataFrame:
    """M3: per observation its 10-minute bin and the forecast for the next
    (half-even rounded) hour; the forecast side is one row per hour (the newest
    ``fetched`` wins; equal or absent ones by their values) so the join is many-to-one. Suffixes ``_actual``/``_forecast``."""
    o = obs.withColumn("generated_weather_bin", T.ten_minute_bin("timestamp_utc")) \
           .withColumn("_fbin", T.training_forecast_bin("timestamp_utc"))
    num = ["temperature", "cloud_cover", "speed", "angle", "precipitation_total"]
    cat = ["summary", "type"]
    o = o.select("generated_weather_bin", "_fbin", "timestamp_utc",
                 *[F.col(c).alias(c + "_actual") for c in num + cat])
    fetched = [c for c in ("fetched",) if c in fc.columns]
    f = fc.select(F.col("timestamp_utc").alias("_fbin"), *fetched, *[F.col(c).alias(c + "_forecast") for c in num + cat])
    f = D.latest_by_key(f, ["_fbin"], [*fetched, *[c + "_forecast" for c in num + cat]]).drop(*fetched)
    j = o.join(J.sized_broadcast(f), "_fbin", "inner").drop("_fbin")
    # one row per 10-minute bin: the latest observation in it
    return D.latest_by_key(j, ["generated_weather_bin"], ["timestamp_utc"]).drop("timestamp_utc")


def training_frame(positions: DataFrame, obs: DataFrame, fc: DataFrame) -> DataFrame:
    """M1 -> M2 -> M3 -> J8: labelled rows joined to weather on the 10-minute bin."""
    lab = add_label(positions)
    w = weather_features(obs, fc)
    return lab.join(J.sized_broadcast(w), "generated_weather_bin", "inner")


# As above, after the joins.
FINISH_DROP = ["generated", "generated_weather_bin", "vehicleService", "scheduledTripStartTime"]
CATEGORICAL = ["summary_actual", "type_actual", "summary_forecast", "type_forecast"]


def finish(df: DataFrame, categories: dict[str, list[str]], drop: list[str] = FINISH_DROP) -> DataFrame:
    """M4 (table form): drop the key columns and one-hot the categorical
    columns with the given category lists (null / unseen -> all zeros).
    The model pipeline does the same inside Spark ML (StringIndexer +
    OneHotEncoder); this form is for exporting a flat feature table."""
    out = df.drop(*drop)
    onehots = []
    for c, cats in categories.items():
        onehots += C.one_hot_columns(c, cats, prefix=c)
    return out.select(*[x for x in out.columns if x not in categories], *onehots)


def expected_stop_coords(pos: DataFrame, timetable: DataFrame, stops: DataFrame,
                         delay_unit_seconds: float = 1.0, ahead_seconds: int = 900) -> DataFrame:
    """Expected stop coordinates ``ahead_seconds`` from now.

    For each position, the earliest timetable row of its trip whose arrival
    is at or after ``generated + ahead - delay``. The trip is found by an
    equi-key (start time ``yyyyMMddHHmm`` + service code, both extracted from
    ``trip_id``), the notebook's case-insensitive pattern
    ``{route}{yyyyMMddHHmm}.*_{service}`` is checked on the timetable side,
    and the earliest arrival is an as-of lookup (no per-row scan, no pairs).
    Arrival ``HH:MM:SS`` past 24:00 rolls into the next day.
    """
    tt = timetable.join(J.sized_broadcast(stops), "stop_id", "inner")            # J7
    code_r = F.lower(F.regexp_extract("trip_id", r"_([^_]+)$", 1))
    start_r = F.regexp_extract("trip_id", r"([0-9]{12})(?![0-9])", 1)
    pattern_r = F.concat(FL.quote_regex(F.split_part(code_r, F.lit("-"), F.lit(1))), start_r,
                         F.lit(".*_"), FL.quote_regex(code_r))
    tt = tt.withColumn("_code", code_r).withColumn("_start", start_r)
    tt = tt.where((F.col("_start") != "") & FL.regex_contains_ci(F.col("trip_id"), pattern_r))     # F4
    day = F.to_timestamp(F.substring("_start", 1, 8), "yyyyMMdd")
    tt = tt.withColumn("_arrive", F.timestamp_micros(
        T.epoch_micros(day) + T.time_of_day_seconds("arrival_time").cast("bigint") * F.lit(T.US_PER_S)))  # F5
    p = pos.withColumn("_start", T.format_compact(T.to_ts("scheduledTripStartTime"))) \
           .withColumn("_code", F.lower(F.col("vehicleService"))) \
           .withColumn("_at", T.minus_delay(T.shift(T.to_ts("generated"), ahead_seconds),
                                            F.col("delay"), delay_unit_seconds))        # C13
    out = J.asof_next(p, tt.select("_start", "_code", "_arrive", "stop_lat", "stop_lon", "stop_sequence", "stop_id"),
                      ["_start", "_code"], "_at", "_arrive", ["stop_lat", "stop_lon"],
                      tiebreak=["stop_sequence", "stop_id"], prefix="next_")
    return out.withColumnRenamed("next_stop_lat", "lat_15min").withColumnRenamed("next_stop_lon", "lon_15min") \
              .drop("_start", "_code", "_at", "next__arrive")


def serving_features(table: DataFrame) -> DataFrame:
    """C22 + C17 + C11: the stream table's columns renamed/typed to the model
    inputs (``model.SERVING_FEATURES`` and ``CATEGORICAL``, the route recoded as in training);
    same rule for ``time`` as training."""
    ts = T.to_ts("bus_generated")
    cols = {
        "speed": C.to_number("bus_speed"), "delay": C.to_number("bus_delay"),
        "lat": C.to_number("bus_lat"), "lon": C.to_number("bus_lon"),
        "time": T.minutes_to_nearest_midnight(ts).cast("double"),
        "route": C.to_number(C.recode_night_route("bus_routeShortName")),
    }
    for side, pre in (("actual", "act_"), ("forecast", "for_")):
        cols[f"temperature_{side}"] = F.col(pre + "temperature").cast("double")
        cols[f"cloud_cover_{side}"] = F.col(pre + "cloud_cover").cast("double")
        cols[f"wind_speed_{side}"] = F.col(pre + "speed").cast("double")
        cols[f"wind_angle_{side}"] = F.col(pre + "angle").cast("double")
        cols[f"precipitation_total_{side}"] = F.col(pre + "precipitation_total").cast("double")
        cols[f"summary_{side}"] = F.col(pre + "summary")
        cols[f"type_{side}"] = F.col(pre + "type")
    return table.withColumns(cols)
