from delaycast import schemas
from delaycast.functions import flatten as P
from delaycast.plans import features as M
from delaycast.plans import model as ML

from fixtures import positions_message, vehicle


def _positions(spark, msgs):
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    return P.parse_json(df, "value", schemas.POSITIONS, corrupt_col=None)


def test_clean_positions(spark):
    raw = _positions(spark, [positions_message([vehicle(routeShortName="N5"), vehicle(routeShortName="N5"),
                                                vehicle(routeShortName="7", speed="x")])])
    out = M.clean_positions(raw)
    assert "vehicleId" not in out.columns and "lastUpdate" not in out.columns
    rows = sorted(out.collect(), key=lambda r: r.routeShortName)
    assert [r.routeShortName for r in rows] == ["7", "9905"]          # dedup + recode
    assert rows[0].speed is None and rows[1].speed == 21.0             # typed, junk -> null


def test_add_label_15_minutes(spark):
    def v(t, delay, s="21"):
        return vehicle(generated=t, delay=str(delay), speed=s)
    raw = _positions(spark, [positions_message([
        v("2024-01-01T10:00:10Z", 10), v("2024-01-01T10:00:20Z", 11),      # same minute: first kept
        v("2024-01-01T10:15:00Z", 40), v("2024-01-01T10:31:00Z", 99)])])
    lab = M.add_label(M.clean_positions(raw)).collect()
    assert [(r.delay, r.delay_15min) for r in lab] == [(10.0, 40.0)]
    assert lab[0].time == 600 and lab[0].time_15min == 615


def test_expected_stop_coords(spark):
    pos = spark.createDataFrame([
        ("p1", "2024-01-01T10:00:00Z", "2024-01-01T09:50:00Z", "110-06", "0"),
        ("p2", "2024-01-01T10:00:00Z", "2024-01-01T09:50:00Z", "110-06", "300"),     # 5 min late
        ("p3", "2024-01-01T10:00:00Z", "2024-01-01T09:55:00Z", "110-06", "0"),       # no trip
        ("p4", "2024-01-01T23:50:00Z", "2024-01-01T23:30:00Z", "7-01", "0")],        # past midnight
        "id string, generated string, scheduledTripStartTime string, vehicleService string, delay string")
    tt = spark.createDataFrame([
        ("R110202401010950_1_110-06", "10:10:00", "s1", 1), ("R110202401010950_1_110-06", "10:15:00", "s2", 2),
        ("R110202401010950_1_110-06", "10:30:00", "s3", 3), ("R11020240101095_1_110-06", "10:15:00", "s9", 1),
        ("R7202401012330_1_7-01", "23:50:00", "s4", 1), ("R7202401012330_1_7-01", "24:10:00", "s5", 2)],
        "trip_id string, arrival_time string, stop_id string, stop_sequence int")
    stops = spark.createDataFrame([(f"s{i}", 54.0 + i / 100, 18.0 + i / 100) for i in range(1, 10)],
                                  "stop_id string, stop_lat double, stop_lon double")
    got = {r.id: (r.lat_15min, r.lon_15min) for r in M.expected_stop_coords(pos, tt, stops).collect()}
    assert got["p1"] == (54.02, 18.02)          # 10:15 exactly at the limit
    assert got["p2"] == (54.01, 18.01)          # limit 10:10 with 300 s delay
    assert got["p3"] == (None, None)
    assert got["p4"] == (54.05, 18.05)          # 24:10:00 rolls into the next day


def test_model_train_and_score(spark):
    rows = [(float(i % 7), float(i % 5), float((i % 7) * 10 + (i % 5)), "a" if i % 2 else "b") for i in range(200)]
    df = spark.createDataFrame(rows, "x double, y double, delay_15min double, cat string")
    df = df.union(spark.createDataFrame([(None, 1.0, 5.0, None)], df.schema))
    model, pred, r2 = ML.train(df, ["x", "y"], ["cat"], num_trees=10, max_depth=3)
    assert r2 > 0.5
    scored = ML.score(model, df.limit(5), keep=["x"])
    assert scored.columns == ["x", "prediction"] and scored.count() == 5


def _weather(spark):
    from delaycast.streaming import enrich as E
    from fixtures import forecast_entry, forecast_message, observation_message
    obs = spark.createDataFrame([(observation_message("Mon Jan 01 10:02:00 UTC 2024", temperature=1.0),),
                                 (observation_message("Mon Jan 01 10:07:00 UTC 2024", temperature=2.0),),
                                 (observation_message("Mon Jan 01 10:31:00 UTC 2024", temperature=3.0,
                                                      summary="Rain"),)], "value string")
    fc = spark.createDataFrame([(forecast_message([forecast_entry("2024-01-01T11:00:00", 5.5)]),),
                                (forecast_message([forecast_entry("2024-01-01T12:00:00", 6.5, summary="Rain")]),)],
                               "value string")
    return E.flatten_observation(obs), E.flatten_forecast(fc)


def test_weather_features_one_row_per_bin(spark):
    obs, fc = _weather(spark)
    w = {r.generated_weather_bin.minute: r for r in M.weather_features(obs, fc).collect()}
    # 10:02 and 10:07 -> bins 10:00 and 10:10; 10:31 -> bin 10:30, forecast hour 12:00 (half-even 11:00 + 1 h)
    assert set(w) == {0, 10, 30}
    assert w[0].temperature_actual == 1.0 and w[0].temperature_forecast == 5.5
    assert w[30].temperature_actual == 3.0 and w[30].temperature_forecast == 6.5


def test_forecast_skill_table(spark):
    from delaycast.plans import questions as Q
    obs, fc = _weather(spark)
    t = {r.factor: r.correlation for r in Q.forecast_skill(obs, fc).collect()}
    assert set(t) == {"summary", "temperature", "cloud coverage", "wind speed"}


def test_newest_fetch_wins_not_the_hottest(spark):
    import datetime as dt

    from delaycast.plans import questions as Q
    from delaycast.streaming.enrich import flatten_forecast
    from fixtures import forecast_entry
    import json

    def message(*entries):
        return json.dumps({"lat": "1N", "lon": "1E", "elevation": 1, "timezone": "UTC", "units": "m", "current": "",
                           "daily": "", "hourly": {"data": list(entries)}})

    hot, cool = forecast_entry("2024-01-01T11:00:00", 30.0), forecast_entry("2024-01-01T11:00:00", 6.0)
    later = forecast_entry("2024-01-01T12:00:00", 9.0)
    msgs = spark.createDataFrame([("f1", message(hot, later)), ("f2", message(cool)), ("f0", message())], "fetched string, value string")
    fc = flatten_forecast(msgs, nearest_only=True)
    assert sorted((r.fetched, r.temperature) for r in fc.collect()) == [("f1", 30.0), ("f2", 6.0)]
    obs = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 20), "Sun", "none", 5.0, 1, 1.0, 1, 0.0)],
                                "timestamp_utc timestamp, summary string, type string, temperature double, cloud_cover int, "
                                "speed double, angle int, precipitation_total double")
    assert [r.temperature_forecast for r in M.weather_features(obs, fc).collect()] == [6.0]
    assert Q.forecast_skill(obs, fc).count() == 4                  # one row: no variance, nulls and no fault
