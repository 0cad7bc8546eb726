"""End-to-end training job: stored feed files -> fitted, saved model.

S5/S6 name-selected scans -> M1 clean -> M2 label -> M3 weather features
-> J8 join on the 10-minute bin -> M6-M7 fit (categoricals one-hot inside
the pipeline, M4) -> A12 R^2 -> K9 save. The driver only receives the
model and one number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as C
from ..sources import readers as R
from ..sources import sinks as K
from ..streaming.enrich import flatten_forecast, flatten_observation
from . import features as M
from . import model as ML

NUMERIC = [*ML.SERVING_FEATURES, "route"]


def _weather_frames(obs_raw: DataFrame, fc_raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored observation/forecast files have the message layout; reuse the
    feed flattening by going through JSON text of each row. Of each forecast
    fetch the nearest hour; file names carry the fetch time, so they order fetches."""
    obs = flatten_observation(obs_raw.select(F.to_json(F.struct(*obs_raw.columns)).alias("value")))
    name = F.col("_metadata.file_name") if fc_raw.inputFiles() else F.lit(None).cast("string")
    fc_raw = fc_raw.select("*", name.alias("fetched"))
    fc = flatten_forecast(fc_raw.select("fetched", F.to_json(F.struct(*fc_raw.drop("fetched").columns)).alias("value")),
                          nearest_only=True)
    return obs, fc


def training_rows(positions_raw: DataFrame, obs_raw: DataFrame, fc_raw: DataFrame) -> DataFrame:
    """Labelled rows carrying the serving inputs (``NUMERIC`` and the four categoricals)
    plus the label. The notebook also fed the position and time 15 minutes
    ahead, which are unknown when scoring - not used, so the saved model is
    the one the stream can apply."""
    pos = M.clean_positions(positions_raw)
    obs, fc = _weather_frames(obs_raw, fc_raw)
    rows = M.training_frame(pos, obs, fc)
    for side in ("actual", "forecast"):
        rows = rows.withColumnRenamed(f"speed_{side}", f"wind_speed_{side}") \
                   .withColumnRenamed(f"angle_{side}", f"wind_angle_{side}")
    return rows.withColumns({"time": F.col("time").cast("double"), "route": C.to_number("routeShortName")})


def train_from_files(spark: SparkSession, positions_dir: str, weather_dir: str, model_path: str,
                     date: str | None = None, **rf) -> float:
    """Fit on all history (or one day) of stored files, save, return R^2."""
    glob = R.daily_glob(R.POSITIONS_PREFIX, date) if date else f"*{R.POSITIONS_PREFIX}*"
    positions_raw = R.read_files_by_name(spark, positions_dir, glob, recursive=True, merge_schema=True)
    obs_raw, fc_raw = R.read_weather(spark, weather_dir, date)
    rows = training_rows(positions_raw, obs_raw, fc_raw)
    model, _, r2 = ML.train(rows, NUMERIC, M.CATEGORICAL,
                            keys=["vehicleService", "scheduledTripStartTime", "minute"], **rf)
    K.save_model(model, model_path)
    return r2
