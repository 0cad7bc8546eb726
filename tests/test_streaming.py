import os

from pyspark.sql import functions as F

from delaycast.sources import readers as R
from delaycast.sources import sinks as K
from delaycast.streaming import enrich as E

from fixtures import forecast_entry, forecast_message, observation_message, positions_message, vehicle


def _write(dirpath, name, lines):
    os.makedirs(dirpath, exist_ok=True)
    with open(os.path.join(dirpath, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def _stream(spark, path):
    return R.read_stream(spark, "text", {"maxFilesPerTrigger": "1"}, path=path)


def _v(t, vid):
    return vehicle(generated=t, vehicleId=str(vid))


def _feeds(base):
    # positions: buckets 11:00 (10:05, 10:20), 12:00 (11:10), 13:00 (12:40), 14:00 (13:50) ...
    _write(f"{base}/bus", "p1.json", [
        positions_message([_v("2024-01-01T10:05:00Z", 1), _v("2024-01-01T10:20:00Z", 2)]),
        positions_message([_v("2024-01-01T10:05:00Z", 1)]),                       # exact duplicate
        positions_message([_v("2024-01-01T11:10:00Z", 3)])])
    _write(f"{base}/bus", "p2.json", [
        positions_message([_v("2024-01-01T12:40:00Z", 4), _v("2024-01-01T13:50:00Z", 5)])])
    _write(f"{base}/obs", "o1.json", [
        observation_message("Mon Jan 01 10:02:00 UTC 2024", temperature=1.0),     # bucket 11:00
        observation_message("Mon Jan 01 10:25:00 UTC 2024", temperature=2.0),     # bucket 11:00, newer
        observation_message("Mon Jan 01 11:40:00 CET 2024", temperature=3.0)])    # 10:40 UTC -> 12:00
    _write(f"{base}/obs", "o2.json", [observation_message("Mon Jan 01 13:55:00 UTC 2024", temperature=4.0)])
    _write(f"{base}/fc", "f1.json", [forecast_message([forecast_entry("2024-01-01T11:00:00", 5.5),
                                                       forecast_entry("2024-01-01T12:00:00", 6.5)])])
    _write(f"{base}/fc", "f2.json", [forecast_message([forecast_entry("2024-01-01T14:00:00", 7.5)])])


def _table(spark, base):
    bus = E.flatten_positions(_stream(spark, f"{base}/bus"))
    obs = E.flatten_observation(_stream(spark, f"{base}/obs"))
    fc = E.flatten_forecast(_stream(spark, f"{base}/fc"))
    return E.stream_table(bus, obs, fc, watermark="20 seconds", salt_buckets=4)


def test_stream_table_and_restart(spark, tmp_path):
    spark.conf.set("spark.sql.shuffle.partitions", "2")      # state partitions of this checkpoint
    base = str(tmp_path)
    _feeds(base)
    out, ck = f"{base}/out", f"{base}/ck"
    q = K.start_stream(_table(spark, base), ck, foreach_batch=K.batch_writer(out, "row_key", ["bus_timestamp_utc"]),
                       trigger={"availableNow": True})
    q.awaitTermination()
    rows = {r.bus_vehicleId: r for r in spark.read.parquet(out).collect()}
    # the global watermark is the minimum over the feeds: forecasts reach
    # 14:00, so buckets 11:00 and 12:00 are closed, 14:00 (vehicle 4) is open
    assert set(rows) == {"1", "2", "3"}
    assert rows["1"].act_temperature == 2.0 and rows["2"].act_temperature == 2.0   # latest obs of the hour
    assert rows["3"].act_temperature == 3.0                                        # CET honoured
    assert rows["1"].for_temperature == 5.5 and rows["3"].for_temperature == 6.5
    # restart: a late row (behind the watermark) and new data; nothing lost or doubled
    _write(f"{base}/bus", "p3.json", [positions_message([_v("2024-01-01T09:00:00Z", 9)]),
                                      positions_message([_v("2024-01-01T15:30:00Z", 6)])])
    _write(f"{base}/obs", "o3.json", [observation_message("Mon Jan 01 15:31:00 UTC 2024", temperature=9.0)])
    _write(f"{base}/fc", "f3.json", [forecast_message([forecast_entry("2024-01-01T17:00:00", 8.5)])])
    q = K.start_stream(_table(spark, base), ck, foreach_batch=K.batch_writer(out, "row_key", ["bus_timestamp_utc"]),
                       trigger={"availableNow": True})
    q.awaitTermination()
    final = spark.read.parquet(out)
    keys = [r.row_key for r in final.collect()]
    assert len(keys) == len(set(keys))
    ids = {r.bus_vehicleId for r in final.collect()}
    assert "9" not in ids                                  # late row dropped
    assert {"1", "2", "3", "4", "5"} <= ids
    later = {r.bus_vehicleId: (r.act_temperature, r.for_temperature) for r in final.collect()}
    assert later["4"] == (None, 7.5) and later["5"] == (4.0, None)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    from delaycast.streaming.jobs import rows_dropped_by_watermark
    assert rows_dropped_by_watermark(q) >= 1


def test_batch_and_stream_agree(spark, tmp_path):
    """The same enrich() on batch frames gives the stream's rows for the
    watermark-closed buckets."""
    base = str(tmp_path)
    _feeds(base)
    read = lambda p: spark.read.text(p)
    bus = E.flatten_positions(read(f"{base}/bus"))
    obs = E.flatten_observation(read(f"{base}/obs"))
    fc = E.flatten_forecast(read(f"{base}/fc"))
    batch = E.stream_table(bus, obs, fc, watermark=None)
    got = {r.bus_vehicleId: (r.act_temperature, r.for_temperature) for r in batch.collect()}
    assert got["1"] == (2.0, 5.5) and got["3"] == (3.0, 6.5)
    assert got["4"] == (None, 7.5) and got["5"] == (4.0, None)
    assert batch.count() == 5                                # duplicate removed, no fan-out
    # the whole stored row, also by family
    row = {r.act_bus.bus_vehicleId: r for r in E.stored_families(batch).collect()}["1"]
    assert row.row_key == "2024-01-01 10:05:00_1" and row.act_bus.bus_gpsQuality == "3"
    assert len(row.act_weather) == 17 and len(row.fc_weather) == 19
    assert (row.act_weather.act_lat, row.act_weather.act_dir, row.act_weather.act_icon) == ("54.35N", "ESE", "drizzle")
    assert (row.fc_weather.for_elevation, row.fc_weather.for_weather, row.fc_weather.for_dir) == (7, "cloudy", "WSW")
    assert row.act_weather.act_rounded_timestamp == row.fc_weather.for_timestamp_utc == row.act_bus.bus_rounded_timestamp


def test_production_stream_scores_and_upserts(spark, tmp_path):
    """Three feeds -> enrich -> serving features -> fitted pipeline -> keyed sink."""
    from delaycast.plans import model as ML
    from delaycast.plans import features as M
    from delaycast.plans import training as TR
    from delaycast.plans.features import serving_features
    from delaycast.streaming import jobs
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    base = str(tmp_path)
    _feeds(base)
    read = lambda p: spark.read.text(p)
    batch = E.stream_table(E.flatten_positions(read(f"{base}/bus")), E.flatten_observation(read(f"{base}/obs")),
                           E.flatten_forecast(read(f"{base}/fc")), watermark=None)
    train = serving_features(batch).withColumn(ML.LABEL, F.col("delay") + 1.0)
    model = ML.build_pipeline(TR.NUMERIC, M.CATEGORICAL, num_trees=5, max_depth=2).fit(train)
    second = K.batch_writer(f"{base}/second")
    q = jobs.production_stream(_stream(spark, f"{base}/bus"), _stream(spark, f"{base}/obs"),
                               _stream(spark, f"{base}/fc"), model, f"{base}/out", f"{base}/ck", salt_buckets=2, also=second)
    q.awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    rows = out.collect()
    assert {r.bus_vehicleId for r in rows} == {"1", "2", "3"}
    assert all(r.prediction is not None for r in rows)
    assert {r.row_key for r in spark.read.parquet(f"{base}/second").collect()} == {r.row_key for r in rows}
    assert E.stored_families(out).columns == ["row_key", "act_bus", "act_weather", "fc_weather", "prediction"]
    spark.conf.set("spark.sql.shuffle.partitions", "8")
