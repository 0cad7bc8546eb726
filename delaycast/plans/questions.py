"""User questions (Q1-Q14) over the stored stream / batch tables.

Each answer is a DataFrame plan over the keyed table; only the small answer
reaches the driver. Column names follow the stream table (``bus_``,
``act_``, ``for_`` prefixes) and can be overridden.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as C
from ..functions import timeops as T
from ..operators import dedup as D
from ..operators import filters as FL
from ..operators import joins as J
from ..operators import stats as A

WEATHER_COLS = ["summary", "temperature", "cloud_cover", "speed", "precipitation_total"]


def current_weather(t: DataFrame, ts: str = "act_timestamp_utc", prefix: str = "act_") -> DataFrame:
    """Q1: newest observation (top-1 by observation time)."""
    top = D.latest_overall(t.where(F.col(ts).isNotNull()), [ts, "row_key"])
    return top.select(ts, *[prefix + c for c in WEATHER_COLS])


def current_forecast(t: DataFrame, ts: str = "act_timestamp_utc", prefix: str = "for_") -> DataFrame:
    """Q2: forecast columns of the row with the newest observation time."""
    top = D.latest_overall(t.where(F.col(ts).isNotNull()), [ts, "row_key"])
    return top.select(ts, *[prefix + c for c in WEATHER_COLS])


def latest_per_route(t: DataFrame, route: str = "bus_routeShortName", ts: str = "bus_generated",
                     cols: tuple[str, ...] = ("bus_delay", "prediction")) -> DataFrame:
    """Q3/Q4 for every route at once (max_by per route), A11 included."""
    keep = [c for c in cols if c in t.columns]
    base = t.select(route, T.to_ts(ts).alias("_t"), "row_key", *keep)
    return D.latest_by_key(base, [route], ["_t", "row_key"]).withColumnRenamed("_t", "latest_time")


def current_delay(t: DataFrame, route_value: str, route: str = "bus_routeShortName") -> DataFrame:
    """Q3: latest delay of one route (F1 after the per-route latest)."""
    return FL.equals(latest_per_route(t, route), route, route_value)


def predicted_delay(t: DataFrame, route_value: str, route: str = "bus_routeShortName") -> DataFrame:
    """Q4: latest prediction (+15 min) of one route."""
    return FL.equals(latest_per_route(t, route, cols=("prediction",)), route, route_value)


def avg_delay_by_route(t: DataFrame, route: str = "routeShortName", delay: str = "delay") -> DataFrame:
    """Q5: mean delay per route (C17 typed), ascending, with the route class."""
    typed = t.select(F.col(route).alias("route"), C.to_number(delay).alias("_d"))
    avg = A.mean_by(typed, ["route"], "_d", "avg_delay")
    return D.sort_by(avg.withColumn("route_class", C.route_class("route")), ["avg_delay"])


def temperature_histogram(t: DataFrame, temp: str = "temperature", bins: int = 5) -> DataFrame:
    """Q6: histogram of all temperatures."""
    return A.histogram(t.select(C.to_number(temp).alias("_x")), "_x", bins)


def temperature_histogram_recent(t: DataFrame, ts: str = "bus_generated", temp: str = "act_temperature",
                                 hours: int = 5, bins: int = 5, zone: str | None = None) -> DataFrame:
    """Q7: histogram over the last ``hours`` of the data's own clock."""
    local = T.to_ts(ts) if zone is None else T.to_local(T.to_ts(ts), zone)
    base = t.select(local.alias("_t"), C.to_number(temp).alias("_x"))
    return A.histogram(FL.recent(base, "_t", hours * 3600), "_x", bins)


def recent_track(t: DataFrame, route_value: str, minutes: int = 5, route: str = "bus_routeShortName",
                 ts: str = "bus_generated", lat: str = "bus_lat", lon: str = "bus_lon",
                 vehicle: str = "bus_vehicleId") -> DataFrame:
    """Q8: points of one route in its last ``minutes``, vehicles coded by
    first appearance (C19), plus the route's bounding box (A7)."""
    r = FL.equals(t, route, route_value).select(
        T.to_ts(ts).alias("_t"), C.to_number(lat).alias("lat"), C.to_number(lon).alias("lon"),
        F.col(vehicle).alias("vehicle"))
    pts = A.factorize(FL.recent(r, "_t", minutes * 60), "vehicle", ["_t", "vehicle"], "vehicle_code")
    box = r.select(F.struct(*A.bounding_box(r, ["lat", "lon"]))).scalar()
    return pts.select("_t", "lat", "lon", "vehicle", "vehicle_code",
                      *[box[c].alias(c) for c in ["min_lat", "max_lat", "min_lon", "max_lon"]])


def route_track(t: DataFrame, route_value: str, route: str = "routeShortName", ts: str = "generated",
                lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Q9: the whole track of one route in time order, with the route's bounding box."""
    r = FL.equals(t, route, route_value).select(T.to_ts(ts).alias("time"), C.to_number(lat).alias("lat"),
                                                C.to_number(lon).alias("lon"))
    box = r.select(F.struct(*A.bounding_box(r, ["lat", "lon"]))).scalar()
    named = [box[c].alias(c) for c in ["min_lat", "max_lat", "min_lon", "max_lon"]]
    return D.sort_by(r.select("time", "lat", "lon", *named), ["time", "lat", "lon"])


def delay_distribution(t: DataFrame, delay: str = "delay") -> tuple[DataFrame, DataFrame]:
    """Q10: 50 equal-width bins and 29 log bins over [1, 1e5]."""
    x = t.select(C.to_number(delay).alias("_x"))
    return A.histogram(x, "_x", 50), A.log_histogram(x, "_x", 29, 0.0, 5.0)


def delay_by_hour(t: DataFrame, ts: str = "generated", delay: str = "delay") -> DataFrame:
    """Q11."""
    x = t.select(F.hour(T.to_ts(ts)).alias("hour"), C.to_number(delay).alias("_d"))
    return A.mean_by(x, ["hour"], "_d", "avg_delay")


def heat_map(t: DataFrame, value: str, lat: str = "lat", lon: str = "lon", digits: int = 2) -> DataFrame:
    """Q12: mean of ``value`` on a 0.01-degree grid (long form; pivot with
    ``stats.pivot_mean`` for a bounded set of columns)."""
    g = t.select(C.round_coord(C.to_number(lat), digits).alias("lat"),
                 C.round_coord(C.to_number(lon), digits).alias("lon"), C.to_number(value).alias("_v"))
    return A.mean_by(g, ["lat", "lon"], "_v", f"avg_{value}")


def forecast_skill(obs: DataFrame, fc: DataFrame) -> DataFrame:
    """Q13: observation joined to the forecast of its (half-even) hour;
    correlation per factor, summaries factorized by first appearance. Of several
    forecasts for one hour the newest ``fetched`` counts."""
    o = obs.withColumn("_h", T.hour_bin("timestamp_utc"))
    fetched = [c for c in ("fetched",) if c in fc.columns]
    f = D.latest_by_key(fc.select(F.col("timestamp_utc").alias("_h"), "summary", "temperature",
                                  "cloud_cover", "speed", *fetched), ["_h"],
                        [*fetched, "temperature", "summary", "cloud_cover", "speed"])
    f = f.select("_h", *[F.col(c).alias(c + "_forecast") for c in ["summary", "temperature", "cloud_cover", "speed"]])
    j = o.select("_h", "timestamp_utc", F.col("summary").alias("summary_actual"),
                 F.col("temperature").alias("temperature_actual"),
                 F.col("cloud_cover").alias("cloud_cover_actual"),
                 F.col("speed").alias("speed_actual")).join(J.sized_broadcast(f), "_h")
    j = A.factorize(j, "summary_actual", ["timestamp_utc"], "summary_actual_code")
    j = A.factorize(j, "summary_forecast", ["timestamp_utc"], "summary_forecast_code")
    return A.factor_table(j, {"summary": ("summary_actual_code", "summary_forecast_code"),
                              "temperature": ("temperature_actual", "temperature_forecast"),
                              "cloud coverage": ("cloud_cover_actual", "cloud_cover_forecast"),
                              "wind speed": ("speed_actual", "speed_forecast")})


def distribution(t: DataFrame, value: str) -> DataFrame:
    """Q14: box-plot summary of one column."""
    return A.box_summary(t.withColumn("_all", F.lit("all")), ["_all"], value).drop("_all")
