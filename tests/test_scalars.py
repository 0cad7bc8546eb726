from delaycast.functions import scalars as C


def col(df, c):
    return [r[0] for r in df.select(c).collect()]


def test_recode_night_route(spark):
    df = spark.createDataFrame([("N5",), ("N12",), ("7",), ("110",), (None,), ("N123",), ("N",)], "r string")
    assert col(df.select(C.recode_night_route("r").alias("x")), "x") == \
        ["9905", "9912", "7", "110", None, "99123", "9900"]


def test_route_class(spark):
    df = spark.createDataFrame([("N5",), ("N12",), ("7",), ("110",), (None,)], "r string")
    assert col(df.select(C.route_class("r").alias("x")), "x") == ["night", "night", "short", "regular", None]


def test_split_first_and_to_number(spark):
    df = spark.createDataFrame([("110-06", "21"), ("7", "None"), ("N5-1", ""), ("a", "x1")], "c string, v string")
    assert col(df.select(C.split_first("c").alias("x")), "x") == ["110", "7", "N5", "a"]
    assert col(df.select(C.to_number("v").alias("x")), "x") == [21.0, None, None, None]


def test_round_coord_spark_rule(spark):
    df = spark.createDataFrame([(2.675,), (54.354999,), (18.605,)], "x double")
    assert col(df.select(C.round_coord("x").alias("r")), "r") == [2.68, 54.35, 18.61]


def test_one_hot_and_epoch_key(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    rows = df.select(*C.one_hot_columns("c", ["a", "b"], prefix="c")).collect()
    assert [tuple(r) for r in rows] == [(1, 0), (0, 1), (0, 0)]
    key = spark.createDataFrame([(bytearray((1700000000000).to_bytes(8, "big")),)], "k binary")
    ts = key.select(C.epoch_from_key("k").alias("t")).first().t
    assert ts.year == 2023 and ts.month == 11


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "x double")
    assert col(df.select(C.nan_to_null("x").alias("y")), "y") == [None, 1.0, None]
