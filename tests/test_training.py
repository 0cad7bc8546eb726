import json
import os

import pyarrow as pa
import pyarrow.parquet as pq

from pyspark.sql import functions as F

from delaycast.plans import features as M
from delaycast.plans import model as ML
from delaycast.plans import training as TR
from delaycast.sources import sinks as K

from fixtures import CURRENT, forecast_entry, positions_message, vehicle


def _pq(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.Table.from_pylist(rows), path)


def test_train_from_files_and_reload(spark, tmp_path):
    src = str(tmp_path)
    msgs = []
    for m in range(0, 40):                                   # one trip, one report per minute
        t = f"2024-01-01T10:{m:02d}:00Z"
        msgs.append(json.loads(positions_message([vehicle(generated=t, delay=str(60 + 7 * m), speed=str(m % 9),
                                                          lat=str(54.3 + m / 1000))])))
    _pq(f"{src}/pos/Act_position_2024-01-01-10_a.parquet", msgs)
    obs = [{"lat": "54.35N", "lon": "18.65E", "elevation": 7, "timezone": "UTC", "units": "metric",
            "current": dict(CURRENT, temperature=float(i)), "hourly": "", "daily": "{}",
            "time": f"Mon Jan 01 10:{i:02d}:00 UTC 2024"} for i in range(0, 60, 5)]
    _pq(f"{src}/w/Act_weather_2024-01-01_a.parquet", obs)
    fc = [{"lat": "54.35N", "lon": "18.65E", "elevation": 7, "timezone": "UTC", "units": "metric",
           "current": "", "daily": "", "hourly": {"data": [forecast_entry(f"2024-01-01T{h:02d}:00:00", 4.0 + h)]}}
          for h in (11, 12)]
    _pq(f"{src}/w/FC_weather_2024-01-01_a.parquet", fc)
    rows = TR.training_rows(*[spark.read.parquet(p) for p in (f"{src}/pos", f"{src}/w/Act_weather_2024-01-01_a.parquet",
                                                               f"{src}/w/FC_weather_2024-01-01_a.parquet")])
    assert set(ML.SERVING_FEATURES) <= set(rows.columns) and rows.count() == 25      # minutes 0..24 have +15
    r2 = TR.train_from_files(spark, f"{src}/pos", f"{src}/w", f"{src}/model", num_trees=5, max_depth=2)
    assert isinstance(r2, float)                                 # NaN allowed on tiny data
    model = K.load_model(f"{src}/model")
    assert model.transform(rows).where("prediction IS NOT NULL").count() == 25
    # the categoricals are inputs, one slot a value; a value never seen and a null are scored too
    oh = {s.getInputCol() if not s.isSet("inputCols") else tuple(s.getInputCols()) for s in model.stages if "Index" in s.uid}
    assert oh == set(M.CATEGORICAL) and "route" in model.stages[0].getInputCols()
    odd = rows.withColumn("summary_actual", F.lit("Raining frogs")).withColumn("type_forecast", F.lit(None).cast("string"))
    assert model.transform(odd).where("prediction IS NOT NULL").count() == 25
