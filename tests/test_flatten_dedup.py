import datetime as dt

from delaycast import schemas
from delaycast.functions import flatten as P
from delaycast.operators import dedup as D

from fixtures import positions_message, vehicle


def test_parse_explode_flatten_edge_cases(spark):
    msgs = [positions_message([vehicle(vehicleId="1"), vehicle(vehicleId="2", speed=21)]),
            positions_message([]),
            '{"lastUpdate": "x", "vehicles": null}',
            '{"lastUpdate": "y", "vehicles": [{"vehicleId": "3", "extra": 5, "lat": {"a": 1}}]}',
            "{not json"]
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    parsed = P.parse_json(df, "value", schemas.POSITIONS)
    assert [r._corrupt for r in parsed.collect()] == [False, False, False, False, True]
    inner = P.explode_rows(parsed, "vehicles", alias="v", keep=["lastUpdate"])
    assert inner.count() == 3                                   # empty/null arrays give no row
    outer = P.explode_rows(parsed, "vehicles", alias="v", outer=True, keep=["lastUpdate"])
    assert outer.count() == 6                                   # one null row each
    flat = P.flatten(inner, depth=2, keep_parent_names=False)
    rows = {r.vehicleId: r for r in flat.collect()}
    assert rows["2"].speed == "21"                              # number read as text
    assert rows["3"].lat == '{"a":1}'                           # object read as raw JSON text


def test_flatten_dotted_names_and_first_element(spark):
    df = spark.createDataFrame([({"wind": {"speed": 4.5, "dir": "W"}, "t": 1.0}, [1, 2]), (None, [])],
                               "c struct<wind: struct<speed: double, dir: string>, t: double>, a array<int>")
    flat = P.flatten(df, depth=3)
    assert set(flat.columns) == {"c_wind_speed", "c_wind_dir", "c_t", "a"}
    assert [r[0] for r in df.select(P.first_element("a")).collect()] == [1, None]


def test_prefix_suffix_rowkey(spark):
    a = spark.createDataFrame([(1, "x", 2.0)], "k int, v string, w double")
    b = spark.createDataFrame([(1, "y")], "k int, v string")
    assert P.prefix_columns(a, "bus_", exclude=("k",)).columns == ["k", "bus_v", "bus_w"]
    l2, r2 = P.suffix_clashes(a, b, ["k"], ("_actual", "_forecast"))
    assert l2.join(r2, "k").columns == ["k", "v_actual", "w", "v_forecast"]
    ts = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 5), "77"), (dt.datetime(2024, 1, 1), None)],
                               "t timestamp, id string")
    assert [r[0] for r in ts.select(P.row_key("t", "id")).collect()] == \
        ["2024-01-01 10:05:00_77", "2024-01-01 00:00:00_"]


def test_dedup_first_latest(spark):
    rows = [(1, "a", dt.datetime(2024, 1, 1, 10, 0, 1), 5.0),
            (1, "a", dt.datetime(2024, 1, 1, 10, 0, 1), 5.0),     # exact duplicate
            (1, "a", dt.datetime(2024, 1, 1, 10, 0, 30), 7.0),    # same minute, other second
            (2, "b", dt.datetime(2024, 1, 1, 11, 0, 0), 1.0),
            (2, "c", dt.datetime(2024, 1, 1, 11, 0, 0), 2.0)]     # tie on time
    df = spark.createDataFrame(rows, "k int, tie string, t timestamp, v double")
    assert D.dedup_rows(df).count() == 4
    first = {r.k: r for r in D.first_by_key(df, ["k"], ["t", "tie"]).collect()}
    assert first[1].v == 5.0 and first[2].tie == "b"
    latest = {r.k: r for r in D.latest_by_key(df, ["k"], ["t", "tie"]).collect()}
    assert latest[1].v == 7.0 and latest[2].tie == "c"
    top = D.latest_overall(df, ["t", "tie"]).collect()
    assert len(top) == 1 and top[0].tie == "c"
    u = D.union_all([df.select("k", "v"), df.select("k", "tie")])
    assert set(u.columns) == {"k", "v", "tie"} and u.count() == 10
