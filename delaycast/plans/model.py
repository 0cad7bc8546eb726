"""Delay model (M6-M8, A12, K9): Spark ML pipeline, same features for fit
and for scoring batch or streaming frames (JVM transform, no Python UDF)."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Serving inputs of the stream (15 numeric columns).
SERVING_FEATURES = ["speed", "delay", "lat", "lon", "time",
                    "temperature_actual", "cloud_cover_actual", "wind_speed_actual",
                    "wind_angle_actual", "precipitation_total_actual",
                    "temperature_forecast", "cloud_cover_forecast", "wind_speed_forecast",
                    "wind_angle_forecast", "precipitation_total_forecast"]
LABEL = "delay_15min"


def build_pipeline(numeric: list[str], categorical: list[str] | None = None, label: str = LABEL,
                   num_trees: int = 100, max_depth: int = 1, seed: int = 0) -> Pipeline:
    """M7: impute numeric nulls (outer joins leave them), one-hot categoricals
    (unseen/null -> own slot, C20), random forest 100 trees depth 1."""
    categorical = categorical or []
    imp_out = [f"_imp_{c}" for c in numeric]
    stages = [Imputer(inputCols=numeric, outputCols=imp_out, strategy="mean")]
    oh_out = []
    for c in categorical:
        stages.append(StringIndexer(inputCol=c, outputCol=f"_idx_{c}", handleInvalid="keep"))
        oh_out.append(f"_oh_{c}")
    if categorical:
        stages.append(OneHotEncoder(inputCols=[f"_idx_{c}" for c in categorical], outputCols=oh_out,
                                    handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=imp_out + oh_out, outputCol="features", handleInvalid="keep"))
    stages.append(RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=num_trees,
                                        maxDepth=max_depth, seed=seed, predictionCol="prediction"))
    return Pipeline(stages=stages)


def split(df: DataFrame, test_fraction: float = 0.33, seed: int = 42,
          keys: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """M6: train/test split (67/33, seed 42).

    With ``keys`` the split is a hash of the row's key columns - the same
    rows land in the same side whatever the partitioning or row order (a
    recomputed partition after an executor loss cannot move rows across).
    Without keys: ``randomSplit`` (reproducible only for a fixed input order).
    """
    if keys:
        bucket = F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]), F.lit(10_000))
        cut = F.lit(int(round((1.0 - test_fraction) * 10_000)))
        return df.where(bucket < cut), df.where(bucket >= cut)
    return tuple(df.randomSplit([1.0 - test_fraction, test_fraction], seed))


def train(df: DataFrame, numeric: list[str], categorical: list[str] | None = None, label: str = LABEL,
          keys: list[str] | None = None, **rf) -> tuple[PipelineModel, DataFrame, float]:
    """M6 + M7 + A12: fit on the train split, R^2 on the test split."""
    tr, te = split(df.where(df[label].isNotNull()), keys=keys)
    model = build_pipeline(numeric, categorical, label, **rf).fit(tr)
    pred = model.transform(te)
    r2 = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="r2").evaluate(pred)
    return model, pred, r2


def score(model: PipelineModel, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """M8: score a batch or streaming frame."""
    out = model.transform(df)
    cols = (keep or [c for c in df.columns]) + ["prediction"]
    return out.select(*cols)
