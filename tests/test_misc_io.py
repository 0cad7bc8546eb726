import pytest

from delaycast import schemas
from delaycast.plans import features as M
from delaycast.plans import model as ML
from delaycast.plans import questions as Q
from delaycast.sources import readers as R
from delaycast.sources import sinks as K


def test_read_timetable_csv(spark, tmp_path):
    tt = tmp_path / "Stops_2024-01-01.csv"
    tt.write_text("trip_id,arrival_time,stop_id,stop_sequence,extra\nR1_1_7-01,10:00:00,s1,1,x\nR1_1_7-01,24:05:00,s2,2,y\n")
    st = tmp_path / "Stop_times_position_2024-01-01.csv"
    st.write_text("stop_id,stop_lat,stop_lon\ns1,54.1,18.1\ns2,54.2,18.2\n")
    t, s = R.read_timetable(spark, str(tt), str(st))
    assert t.columns == ["trip_id", "arrival_time", "stop_id", "stop_sequence"]
    assert dict(t.dtypes)["stop_sequence"] == "int" and dict(s.dtypes)["stop_lat"] == "double"
    assert t.count() == 2 and s.count() == 2


def test_timetable_files_by_day(spark, tmp_path):
    head = "departure_time,trip_id,stop_sequence,arrival_time,stop_id\n"
    (tmp_path / "city_Stops_2024-01-01.csv").write_text(head + "-,a,1,10:00:00,s1\n-,a,1,10:00:00,s1\n-,a,x,10:05:00,s2\n")
    (tmp_path / "city_Stops_2024-01-02.csv").write_text(head + "-,b,3,24:10:00,s1\n")
    stops = "stop_name,stop_id,stop_lon,stop_lat\n"
    (tmp_path / "city_Stop_times_position_2024-01-01.csv").write_text(stops + "n,s1,18.1,54.1\nn,s1,18.1,54.1\n")
    (tmp_path / "city_Stop_times_position_2023-12-17.csv").write_text(stops + "n,s1,18.5,54.5\n")
    t, s = R.read_timetable_of_day(spark, str(tmp_path), "2024-01-01")
    # by name whatever the order of columns; a repeated row once; a cell that is no number: null
    assert sorted(tuple(r) for r in t.collect()) == [("a", "10:00:00", "s1", 1), ("a", "10:05:00", "s2", None)]
    assert [tuple(r) for r in s.collect()] == [("s1", 54.1, 18.1)]
    t, s = R.read_timetable_of_day(spark, str(tmp_path))
    assert {r.trip_id for r in t.collect()} == {"a", "b"} and s.first().stop_lat == 54.5
    with pytest.raises(FileNotFoundError):
        R.read_timetable_of_day(spark, str(tmp_path), "2024-02-01")


def test_route_track_has_the_box(spark):
    rows = [("5", "2024-01-01T10:00:00Z", "54.2", "18.1"), ("5", "2024-01-01T09:00:00Z", "54.1", "18.3"), ("6", "2024-01-01T09:00:00Z", "50", "10")]
    got = Q.route_track(spark.createDataFrame(rows, "routeShortName string, generated string, lat string, lon string"), "5").collect()
    assert [r.lat for r in got] == [54.1, 54.2]
    assert {tuple(r)[3:] for r in got} == {(54.1, 54.2, 18.1, 18.3)}
    assert Q.route_track(spark.createDataFrame(rows, "routeShortName string, generated string, lat string, lon string"), "7").count() == 0


def test_model_save_load_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(float(i), float(i % 3), float(2 * i)) for i in range(60)], "x double, y double, delay_15min double")
    model = ML.build_pipeline(["x", "y"], num_trees=3, max_depth=2).fit(df)
    path = str(tmp_path / "model")
    K.save_model(model, path)
    again = K.load_model(path)
    a = [r.prediction for r in model.transform(df).collect()]
    b = [r.prediction for r in again.transform(df).collect()]
    assert a == b


def test_fan_out_writes_every_sink(spark, tmp_path):
    out1, out2 = str(tmp_path / "a"), str(tmp_path / "b")
    df = spark.createDataFrame([("k1", 1), ("k1", 2), ("k2", 3)], "key string, v int")
    write = K.fan_out(K.batch_writer(out1), K.batch_writer(out2, "key", ["v"]))
    write(df, 0)
    write(df, 0)                                            # replay of batch 0 overwrites
    assert spark.read.parquet(out1).count() == 3
    assert {r.key: r.v for r in spark.read.parquet(out2).collect()} == {"k1": 2, "k2": 3}


def test_clean_positions_union_trip_id(spark):
    from pyspark.sql.types import ArrayType, StringType, StructField, StructType
    fields = [StructField(f, StringType(), True) for f in schemas.VEHICLE_FIELDS if f != "tripId"]
    fields.append(StructField("tripId", StructType([StructField("member0", StringType(), True),
                                                    StructField("member1", StringType(), True)]), True))
    sch = StructType([StructField("lastUpdate", StringType(), True),
                      StructField("vehicles", ArrayType(StructType(fields)), True)])
    row = {f.name: None for f in fields}
    row.update({"generated": "2024-01-01T10:00:00Z", "routeShortName": "N12", "speed": "5", "delay": "1",
                "lat": "54.3", "lon": "18.6", "vehicleService": "N12-01", "tripId": {"member0": None, "member1": "7"}})
    raw = spark.createDataFrame([("2024-01-01T10:00:05Z", [row]), ("x", [])], sch)
    out = M.clean_positions(raw)
    rows = out.collect()
    assert "tripId" not in out.columns
    assert [r.routeShortName for r in rows if r.routeShortName] == ["9912"]
    assert len(rows) == 2                                  # empty envelope kept as one null row (explode_outer)


def test_finish_and_schema_text(spark):
    from delaycast.functions import flatten as P
    df = spark.createDataFrame([("2024", "b", 1.0, "Rain", None, "Sun", "x", "s", "t")],
                               "generated string, generated_weather_bin string, speed double, summary_actual string, "
                               "type_actual string, summary_forecast string, type_forecast string, "
                               "vehicleService string, scheduledTripStartTime string")
    out = M.finish(df, {"summary_actual": ["Rain", "Sun"], "type_actual": ["none"]})
    assert out.columns == ["speed", "summary_forecast", "type_forecast", "summary_actual_Rain",
                           "summary_actual_Sun", "type_actual_none"]
    assert tuple(out.first())[3:] == (1, 0, 0)
    assert "speed: double" in P.schema_text(df)


def test_json_file_sink_with_checkpoint_and_peek(spark, tmp_path, capsys):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("x\ny\nx\n")
    stream = R.read_stream(spark, "text", {"maxFilesPerTrigger": "1"}, path=str(src))
    q = K.start_stream(stream, str(tmp_path / "ck"), sink="json", path=str(tmp_path / "out"),
                       trigger={"availableNow": True})
    q.awaitTermination()
    assert sorted(r.value for r in spark.read.json(str(tmp_path / "out")).collect()) == ["x", "x", "y"]
    K.peek_writer(1)(spark.createDataFrame([("only",), ("second",)], "v string"), 0)
    assert "only" in capsys.readouterr().out
