"""Small literal feeds with invented values."""

import json

VEHICLE = {"generated": "2024-01-01T10:05:00Z", "routeShortName": "110", "tripId": "1",
           "headsign": "Centre", "vehicleCode": "2001", "vehicleService": "110-06", "vehicleId": "77",
           "speed": "21", "direction": "120", "delay": "95",
           "scheduledTripStartTime": "2024-01-01T09:50:00Z", "lat": "54.35", "lon": "18.60",
           "gpsQuality": "3"}


def vehicle(**kw):
    v = dict(VEHICLE)
    v.update(kw)
    return v


def positions_message(vehicles, last_update="2024-01-01T10:05:10Z"):
    return json.dumps({"lastUpdate": last_update, "vehicles": vehicles})


def forecast_message(entries):
    return json.dumps({"lat": "54.35N", "lon": "18.65E", "elevation": 7, "timezone": "UTC",
                       "units": "metric", "current": None, "hourly": {"data": entries}, "daily": None})


def forecast_entry(date, temperature=5.5, summary="Cloudy", cloud=80, wind=4.1):
    return {"date": date, "weather": "cloudy", "icon": 6, "summary": summary, "temperature": temperature,
            "wind": {"speed": wind, "dir": "WSW", "angle": 250}, "cloud_cover": {"total": cloud},
            "precipitation": {"total": 0.0, "type": "none"}}


CURRENT = {"icon": "drizzle", "icon_num": 11, "summary": "Drizzle", "temperature": 13.25,
           "wind": {"speed": 7.5, "angle": 115, "dir": "ESE"},
           "precipitation": {"total": 0.25, "type": "rain"}, "cloud_cover": 61}


def observation_message(time_text, **current):
    cur = dict(CURRENT)
    cur.update(current)
    return json.dumps({"lat": "54.35N", "lon": "18.65E", "elevation": 7, "timezone": "UTC",
                       "units": "metric", "current": cur, "hourly": None, "daily": None,
                       "time": time_text})
