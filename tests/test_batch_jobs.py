import datetime as dt
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq

from delaycast import schemas
from delaycast.plans import batch_jobs as B

from fixtures import CURRENT, positions_message, vehicle


def _write_json_parquet(path, messages, spark_schema):
    rows = [json.loads(m) for m in messages]
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.Table.from_pylist(rows), path)


def test_lookback():
    assert B.lookback(dt.datetime(2024, 1, 1, 1, 30)) == ("2023-12-31", "23", "2023-12-31")


def test_positions_and_weather_loads(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    msgs = [positions_message([vehicle(generated="2024-01-01T10:05:00Z", vehicleId="1"),
                               vehicle(generated="2024-01-01T10:05:00Z", vehicleId="2")]),
            positions_message([vehicle(generated="2024-01-01T10:05:00Z", vehicleId="1", delay="99")])]
    _write_json_parquet(f"{src}/positions/Act_position_2024-01-01-10_x.parquet", msgs, schemas.POSITIONS)
    _write_json_parquet(f"{src}/positions/Act_position_2024-01-01-11_x.parquet", msgs[:1], schemas.POSITIONS)
    with open(f"{src}/positions/Act_position_2024-01-01-10_bad.parquet", "wb") as f:
        f.write(b"corrupt")
    B.load_positions_hour(spark, src, f"{out}/positions", anchor=dt.datetime(2024, 1, 1, 12, 15))
    B.load_positions_hour(spark, src, f"{out}/positions", anchor=dt.datetime(2024, 1, 1, 12, 15))   # re-run
    pos = spark.read.parquet(f"{out}/positions").collect()
    assert sorted(r.row_key for r in pos) == ["2024-01-01 10:05:00_1", "2024-01-01 10:05:00_2"]
    assert all(r.day == 1 for r in pos)
    B.load_positions_hour(spark, src, f"{out}/positions", anchor=dt.datetime(2024, 1, 1, 13, 15))   # the next hour
    assert spark.read.parquet(f"{out}/positions").count() == 2
    unread = [positions_message([vehicle(generated="?", vehicleId=str(i)) for i in (1, 2, 3)]
                                + [vehicle(generated="2024-01-01T12:05:00Z", vehicleId="1")])]
    _write_json_parquet(f"{src}/positions/Act_position_2024-01-01-12_x.parquet", unread, schemas.POSITIONS)
    B.load_positions_hour(spark, src, f"{out}/positions", anchor=dt.datetime(2024, 1, 1, 14, 15))
    assert spark.read.parquet(f"{out}/positions").count() == 3
    assert spark.read.parquet(f"{out}/positions_rejects").count() == 3
    obs = [json.dumps({"lat": "54.35N", "lon": "18.65E", "elevation": 7, "timezone": "UTC", "units": "metric",
                       "current": CURRENT, "hourly": "", "daily": "{}", "time": t})
           for t in ["Sun Dec 31 13:05:09 CET 2023", "Sun Dec 31 14:05:09 CET 2023"]]
    _write_json_parquet(f"{src}/weather/Act_weather_2023-12-31_a.parquet", obs, schemas.OBSERVATION)
    B.load_weather_day(spark, src, f"{out}/weather", anchor=dt.datetime(2024, 1, 1, 8))
    w = sorted(spark.read.parquet(f"{out}/weather").collect(), key=lambda r: r.row_key)
    assert [r.row_key for r in w] == ["2023-12-31 12:05:09", "2023-12-31 13:05:09"]
    assert w[0].temperature == 13.25 and w[0].cloud_cover == 61


def test_cli_positions_batch(spark, tmp_path):
    from delaycast.__main__ import main
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    _write_json_parquet(f"{src}/p/Act_position_2024-01-01-10_x.parquet",
                        [positions_message([vehicle(generated="2024-01-01T10:05:00Z", vehicleId="9")])], None)
    main(["positions-batch", "--src", src, "--out", out, "--anchor", "2024-01-01T12:30:00"])
    assert [r.row_key for r in spark.read.parquet(out).collect()] == ["2024-01-01 10:05:00_9"]
