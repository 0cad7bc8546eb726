import datetime as dt
import os

from pyspark.sql import functions as F

from delaycast.plans import questions as Q
from delaycast.sources import readers as R
from delaycast.sources import sinks as K


def test_read_files_by_name_skips_corrupt_and_other_names(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq
    d = str(tmp_path)
    os.makedirs(f"{d}/x/2024", exist_ok=True)
    pq.write_table(pa.table({"id": pa.array([1], pa.int32()), "v": ["a"]}), f"{d}/x/2024/Act_position_2024-01-01-10_a.parquet")
    pq.write_table(pa.table({"id": pa.array([2], pa.int32()), "v": ["b"]}), f"{d}/x/2024/Act_position_2024-01-01-11_a.parquet")
    with open(f"{d}/x/2024/Act_position_2024-01-01-10_bad.parquet", "wb") as f:
        f.write(b"not parquet")
    df = R.read_files_by_name(spark, f"{d}/x", R.hourly_glob("Act_position", "2024-01-01", "10"), recursive=True,
                              schema="id int, v string")
    assert [r.id for r in df.collect()] == [1]


def test_lookback_and_key_range(spark):
    ts = spark.createDataFrame([(dt.datetime(2024, 1, 2, h, 30), h) for h in range(24)], "t timestamp, h int")
    anchor = F.lit(dt.datetime(2024, 1, 2, 12, 10)).cast("timestamp")
    assert [r.h for r in R.in_lookback_hour(ts, "t", anchor).collect()] == [10]
    assert R.in_lookback_day(ts, "t", anchor).count() == 0
    d, h = spark.range(1).select(*R.lookback_parts(anchor)).first()
    assert (d, h) == ("2024-01-02", "10")
    keyed = ts.withColumn("k", F.concat_ws("_", F.date_format("t", "yyyy-MM-dd HH:mm:ss"), F.col("h")))
    got = R.keyed_scan(keyed, "k", "2024-01-02 05", "2024-01-02 07", ts_col="t")
    assert [r.h for r in got.collect()] == [5, 6]


def test_decode_rows_returns_rejects(spark):
    df = spark.createDataFrame([("1",), ("None",), ("x",), (None,)], "s string")
    good, bad = R.decode_rows(df, {"n": ("s", F.col("s").try_cast("int"))})
    assert [r.n for r in good.collect()] == [1, None] and bad.count() == 2


def test_keyed_scan_bounds_inside_a_date_or_hour(spark):
    base = dt.datetime(2024, 1, 8)
    rows = [(base + dt.timedelta(hours=5 * i),) for i in range(40)]
    keyed = spark.createDataFrame(rows, "t timestamp").withColumn("k", F.concat(F.date_format("t", "yyyy-MM-dd HH:mm:ss"), F.lit("_9")))
    keys = [r.k for r in keyed.collect()]
    for lo, hi in [("2024-01-0", "2024-01-1"), ("2024-01-10", "2024-01-10 1"), ("2024-01-10 08", "2024-01-10 2"), ("2024", None),
                   (None, "2024-01-12 04:00:00_9"), ("2024-01-09 01:00:00_91", "2024-01-13"), ("x", None), (None, "2024-13-99")]:
        want = sorted(k for k in keys if (lo is None or k >= lo) and (hi is None or k < hi))
        assert sorted(r.k for r in R.keyed_scan(keyed, "k", lo, hi, ts_col="t").collect()) == want, (lo, hi)


def test_keyed_write_keeps_other_rows(spark, tmp_path):
    p = str(tmp_path / "tbl")
    schema = "key string, t timestamp, v double, day string"
    at = lambda h: dt.datetime(2024, 1, 1, h)
    K.write_keyed(spark.createDataFrame([("a", at(10), 1.0, "d1"), ("b", at(10), 2.0, "d1"), ("z", at(1), 9.0, "d0"), ("n", at(3), 7.0, None)], schema), p, "key", ["t"], ["day"])
    late = spark.createDataFrame([("c", at(11), 3.0, "d1"), ("a", at(9), 0.0, "d1"), ("b", at(10), 5.0, "d1"), ("m", at(3), 8.0, None), (None, at(3), 8.0, "d1")], schema)
    for _ in range(2):
        K.write_keyed(late, p, "key", ["t"], ["day"])
        got = {(r.key, r.v, r.day) for r in spark.read.schema(schema).parquet(p).collect()}
        # the older a loses, b ties in time and the larger value wins, d0 is untouched
        assert got == {("a", 1.0, "d1"), ("b", 5.0, "d1"), ("c", 3.0, "d1"), ("z", 9.0, "d0"), ("n", 7.0, None), ("m", 8.0, None)}
    q = str(tmp_path / "flat")
    K.write_keyed(late, q, "key", ["t"])
    K.write_keyed(spark.createDataFrame([("y", at(1), 1.0, "d1")], schema), q, "key", ["t"])
    assert sorted(r.key for r in spark.read.parquet(q).collect()) == ["a", "b", "c", "m", "y"]


def test_keyed_write_is_idempotent_and_latest_wins(spark, tmp_path):
    p = str(tmp_path / "tbl")
    rows = [("k1", dt.datetime(2024, 1, 1, 10), 1.0, "2024-01-01"),
            ("k1", dt.datetime(2024, 1, 1, 11), 2.0, "2024-01-01"),
            ("k2", dt.datetime(2024, 1, 2, 10), 3.0, "2024-01-02")]
    df = spark.createDataFrame(rows, "key string, t timestamp, v double, day string")
    K.write_keyed(df, p, "key", ["t"], partition_by=["day"])
    K.write_keyed(df, p, "key", ["t"], partition_by=["day"])            # re-run
    got = {r.key: r.v for r in K.read_keyed(spark, p, "key", ["t"]).collect()}
    assert got == {"k1": 2.0, "k2": 3.0}
    assert spark.read.parquet(p).count() == 2


def test_families_and_none_cells(spark):
    df = spark.createDataFrame([("k", "1", "None", "x")], "key string, a string, b string, c string")
    fam = K.to_families(df, {"bus": ["a", "b"], "act": ["c"]}, "key")
    assert fam.columns == ["key", "bus", "act"]
    back = K.cells_to_rows(K.from_families(fam, ["bus", "act"]))
    assert back.first().asDict() == {"key": "k", "a": "1", "b": None, "c": "x"}


def _stream_table(spark):
    base = dt.datetime(2024, 1, 1, 10)
    rows = []
    for i in range(12):
        t = base + dt.timedelta(minutes=10 * i)
        route = ["110", "N5", "7"][i % 3]
        rows.append((f"{t}_{i}", str(t), route, str(i % 4), str(10.0 * i), str(54.35 + i / 1000),
                     str(18.6 + i / 1000), t, "Cloudy" if i % 2 else "Rain", float(i), float(i % 3),
                     float(i + 1), "Sun" if i % 2 else "Rain", 50.0 + i, float(i)))
    return spark.createDataFrame(rows, "row_key string, bus_generated string, bus_routeShortName string, "
                                       "bus_vehicleId string, bus_delay string, bus_lat string, bus_lon string, "
                                       "act_timestamp_utc timestamp, act_summary string, act_temperature double, "
                                       "act_cloud_cover double, act_speed double, for_summary string, "
                                       "for_temperature double, prediction double") \
        .withColumn("act_precipitation_total", F.lit(0.0)).withColumn("for_cloud_cover", F.lit(1.0)) \
        .withColumn("for_speed", F.lit(2.0)).withColumn("for_precipitation_total", F.lit(0.0))


def test_questions(spark):
    t = _stream_table(spark)
    assert Q.current_weather(t).first().act_temperature == 11.0
    assert Q.current_forecast(t).first().for_temperature == 61.0
    assert Q.current_delay(t, "7").first().bus_delay == "110.0"
    assert Q.predicted_delay(t, "N5").first().prediction == 10.0
    per = {r.route: (r.avg_delay, r.route_class)
           for r in Q.avg_delay_by_route(t, "bus_routeShortName", "bus_delay").collect()}
    assert per == {"110": (45.0, "regular"), "N5": (55.0, "night"), "7": (65.0, "short")}
    h = Q.temperature_histogram(t, "act_temperature").toPandas()
    assert h.cnt.sum() == 12
    recent = Q.temperature_histogram_recent(t, hours=1).toPandas()
    assert recent.cnt.sum() == 7                                   # 11:50 .. 12:50 inclusive
    track = Q.recent_track(t, "110", minutes=60).collect()
    assert len(track) == 3                                          # 10:30, 11:00, 11:30 (inclusive)
    assert {r.vehicle: r.vehicle_code for r in track} == {"3": 0, "2": 1, "1": 2}
    assert track[0].min_lat == 54.35 and track[0].max_lat == 54.359
    lin, log = Q.delay_distribution(t.withColumnRenamed("bus_delay", "delay"))
    assert lin.toPandas().cnt.sum() == 12 and log.toPandas().cnt.sum() == 11    # 0 is outside [1, 1e5]
    by_hour = {r.hour: r.avg_delay for r in Q.delay_by_hour(t, "bus_generated", "bus_delay").collect()}
    assert by_hour[10] == 25.0
    hm = Q.heat_map(t, "bus_delay", "bus_lat", "bus_lon").collect()
    assert sum(1 for _ in hm) >= 1
    dist = Q.distribution(t, "act_temperature").first()
    assert dist.median == 5.5 and dist.n == 12


def test_lookback_prunes_date_partitions_and_compaction(spark, tmp_path):
    rows = [(f"k{i}", dt.datetime(2024, 1, 1 + i % 3, 10, i), float(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "key string, t timestamp, v double").withColumn("date", F.to_date("t"))
    stream_out = str(tmp_path / "stream")
    K.batch_writer(stream_out)(df.where("v < 6"), 0)
    K.batch_writer(stream_out)(df.where("v >= 4"), 1)            # overlapping keys across batches
    table = str(tmp_path / "table")
    K.compact_keyed(spark, stream_out, table, "key", ["t"], partition_by=["date"])
    t = spark.read.parquet(table)
    assert t.count() == 12
    anchor = F.lit(dt.datetime(2024, 1, 3, 5)).cast("timestamp")
    picked = R.in_lookback_day(t, "t", anchor, date_col="date")
    assert sorted(r.key for r in picked.collect()) == sorted(f"k{i}" for i in range(12) if i % 3 == 1)
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_scale_conf():
    from delaycast.session import scale_conf
    c = scale_conf(100 << 40, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert scale_conf(1 << 20, 8)["spark.sql.shuffle.partitions"] == "16"
