"""Declared schemas of the three JSON feeds and the two CSV reference tables.

All fields nullable. Numbers that the vehicle feed sends as text stay
``StringType`` here and are typed once by ``functions.flatten.typed``.
"""

from pyspark.sql.types import (ArrayType, DoubleType, FloatType, IntegerType,
                               StringType, StructField, StructType)

# Field names, nesting and types of the outside messages and files.


def _s(*names):
    return [StructField(n, StringType(), True) for n in names]


VEHICLE_FIELDS = ["generated", "routeShortName", "tripId", "headsign", "vehicleCode",
                  "vehicleService", "vehicleId", "speed", "direction", "delay",
                  "scheduledTripStartTime", "lat", "lon", "gpsQuality"]

VEHICLE = StructType(_s(*VEHICLE_FIELDS))

# positions message: {"lastUpdate": ..., "vehicles": [VEHICLE, ...]}
POSITIONS = StructType(_s("lastUpdate") + [StructField("vehicles", ArrayType(VEHICLE), True)])

FORECAST_ENTRY = StructType([
    StructField("date", StringType(), True),
    StructField("weather", StringType(), True),
    StructField("icon", IntegerType(), True),
    StructField("summary", StringType(), True),
    StructField("temperature", DoubleType(), True),
    StructField("wind", StructType([
        StructField("speed", DoubleType(), True),
        StructField("dir", StringType(), True),
        StructField("angle", IntegerType(), True)]), True),
    StructField("cloud_cover", StructType([StructField("total", IntegerType(), True)]), True),
    StructField("precipitation", StructType([
        StructField("total", DoubleType(), True),
        StructField("type", StringType(), True)]), True),
])

# forecast message: location + hourly.data[] (current/daily kept as raw JSON text)
FORECAST = StructType(_s("lat", "lon") + [StructField("elevation", IntegerType(), True)]
                      + _s("timezone", "units", "current")
                      + [StructField("hourly", StructType([
                          StructField("data", ArrayType(FORECAST_ENTRY), True)]), True)]
                      + _s("daily"))

OBSERVATION_CURRENT = StructType([
    StructField("icon", StringType(), True),
    StructField("icon_num", IntegerType(), True),
    StructField("summary", StringType(), True),
    StructField("temperature", FloatType(), True),
    StructField("wind", StructType([
        StructField("speed", FloatType(), True),
        StructField("angle", IntegerType(), True),
        StructField("dir", StringType(), True)]), True),
    StructField("precipitation", StructType([
        StructField("total", FloatType(), True),
        StructField("type", StringType(), True)]), True),
    StructField("cloud_cover", IntegerType(), True),
])

# observation message: location + current{} + weekday-form time text
OBSERVATION = StructType(_s("lat", "lon") + [StructField("elevation", IntegerType(), True)]
                         + _s("timezone", "units")
                         + [StructField("current", OBSERVATION_CURRENT, True)]
                         + _s("hourly", "daily", "time"))

TIMETABLE = StructType([
    StructField("trip_id", StringType(), True),
    StructField("arrival_time", StringType(), True),
    StructField("stop_id", StringType(), True),
    StructField("stop_sequence", IntegerType(), True),
])

STOPS = StructType([
    StructField("stop_id", StringType(), True),
    StructField("stop_lat", DoubleType(), True),
    StructField("stop_lon", DoubleType(), True),
])

# Typed columns of the flattened vehicle feed (text -> number once, at flatten).
VEHICLE_NUMERIC = {"speed": "double", "delay": "double", "lat": "double", "lon": "double",
                   "direction": "double"}
