import datetime as dt

from pyspark.sql import functions as F

from delaycast.functions import timeops as T


def _ts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "s string").withColumn("t", T.to_ts("s"))


def col(df, c):
    return [r[0] for r in df.select(c).collect()]


def test_next_hour_bucket_half_up_on_seconds(spark):
    df = _ts(spark, ["2024-01-01 10:29:59", "2024-01-01 10:29:59.9", "2024-01-01 10:30:00",
                     "2024-01-01 11:30:00", "2024-01-01 00:00:00", "2024-01-01 23:59:30"])
    got = col(df.select(T.next_hour_bucket("t").alias("b")), "b")
    assert got == [dt.datetime(2024, 1, 1, 11), dt.datetime(2024, 1, 1, 11), dt.datetime(2024, 1, 1, 12),
                   dt.datetime(2024, 1, 1, 13), dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 2, 1)]


def test_half_even_bins(spark):
    df = _ts(spark, ["2024-01-01 10:30:00", "2024-01-01 11:30:00", "2024-01-01 10:05:00",
                     "2024-01-01 10:15:00", "2024-01-01 10:15:00.000001"])
    assert col(df.select(T.hour_bin("t").alias("b")), "b")[:2] == [dt.datetime(2024, 1, 1, 10),
                                                                    dt.datetime(2024, 1, 1, 12)]
    tens = col(df.select(T.ten_minute_bin("t").alias("b")), "b")
    assert tens[2:] == [dt.datetime(2024, 1, 1, 10, 0), dt.datetime(2024, 1, 1, 10, 20),
                        dt.datetime(2024, 1, 1, 10, 20)]
    fb = col(df.select(T.training_forecast_bin("t").alias("b")), "b")
    assert fb[:2] == [dt.datetime(2024, 1, 1, 11), dt.datetime(2024, 1, 1, 13)]


def test_unshifted_buckets_are_idempotent(spark):
    df = _ts(spark, ["2024-01-01 10:07:31.5", "2024-03-05 23:55:00", "2024-01-01 10:30:00"])
    for fn in (T.hour_bin, T.ten_minute_bin, T.minute_bin):
        once = df.select(fn("t").alias("a"))
        twice = once.select(fn("a").alias("b"))
        assert col(once, "a") == col(twice, "b")


def test_midnight_features(spark):
    df = _ts(spark, ["2024-01-01 00:00:00", "2024-01-01 23:59:30", "2024-01-01 10:05:00",
                     "2024-01-01 23:58:59.5", "2024-01-01 00:01:00"])
    near = col(df.select(T.minutes_to_nearest_midnight("t").alias("m")), "m")
    assert near == [0, 0, 605, 1, 1]
    left = col(df.select(T.minutes_left_to_midnight("t").alias("m")), "m")
    assert left == [1440, 1, 1440 - 605, 2, 1439]


def test_weekday_parse(spark):
    df = spark.createDataFrame([("Sun Dec 17 13:05:09 CET 2023",), ("Mon Jan 1 10:00:00 UTC 2024",),
                                ("junk",), (None,)], "s string")
    got = col(df.select(T.parse_weekday_time("s").alias("t")), "t")
    assert got == [dt.datetime(2023, 12, 17, 12, 5, 9), dt.datetime(2024, 1, 1, 10), None, None]


def test_shift_minus_delay_and_time_of_day(spark):
    df = _ts(spark, ["2024-01-01 10:00:00"]).withColumn("d", F.lit("95"))
    r = df.select(T.shift("t", 900).alias("a"), T.minus_delay("t", "d").alias("b"),
                  T.minus_delay("t", "d", 60).alias("c")).first()
    assert r.a == dt.datetime(2024, 1, 1, 10, 15)
    assert r.b == dt.datetime(2024, 1, 1, 9, 58, 25)
    assert r.c == dt.datetime(2024, 1, 1, 8, 25)
    tod = spark.createDataFrame([("10:05:00",), ("25:10:00",), ("bad",)], "s string")
    assert col(tod.select(T.time_of_day_seconds("s").alias("x")), "x") == [36300, 90600, None]
