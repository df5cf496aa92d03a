"""Spark ML counterparts: off-the-shelf booster, ridge baseline, two-stage model."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import CATEGORICAL_FEATURES, FEATURES, NUMERIC_FEATURES, TARGET, VOCABULARY
from ..session import stored
from .features import assemble, filled_codes

_MAX_VOCABULARY = max(len(v) for v in VOCABULARY.values()) + 1
_TASK_ROWS = 250_000  # rows of a task of the booster, some 460 bytes each in its caches


def fit_gbt(
    train: DataFrame, rounds: int = 20, max_depth: int = 5, learning_rate: float = 0.1, seed: int = 0
) -> PipelineModel:
    """Spark ML's gradient-boosted trees on the same features (no L1/L2, no missing side).

    It caches its rows, their errors and predictions in the partitions it is given and reads them again for every
    level: so the features are stored once and handed to it ``_TASK_ROWS`` rows a partition.
    """
    gbt = GBTRegressor(
        featuresCol="features",
        labelCol="label",
        maxIter=rounds,
        maxDepth=max_depth,
        stepSize=learning_rate,
        maxBins=max(_MAX_VOCABULARY, 256),
        seed=seed,
    )
    with stored(train.select(*FEATURES, TARGET), "gbt", _TASK_ROWS) as rows:
        return Pipeline(stages=[gbt]).fit(assemble(rows))


def linear_pipeline(estimator) -> Pipeline:
    """One-hot categories beside the numeric columns, then a linear estimator."""
    hot = [f"{c}_hot" for c in CATEGORICAL_FEATURES]
    return Pipeline(
        stages=[
            OneHotEncoder(inputCols=CATEGORICAL_FEATURES, outputCols=hot, dropLast=True),
            VectorAssembler(inputCols=NUMERIC_FEATURES + hot, outputCol="features"),
            estimator,
        ]
    )


def _labelled(df: DataFrame) -> DataFrame:
    return filled_codes(df).withColumn("label", F.col(TARGET).cast("double"))


def fit_ridge(train: DataFrame, reg: float = 1.0) -> PipelineModel:
    """Linear least squares with an L2 penalty on raw (unscaled) coefficients."""
    ridge = LinearRegression(
        elasticNetParam=0.0, regParam=reg, standardization=False, solver="l-bfgs", maxIter=50
    )
    return linear_pipeline(ridge).fit(_labelled(train))


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    ready = assemble(df) if "OneHot" not in type(model.stages[0]).__name__ else _labelled(df)
    return model.transform(ready)


def fit_two_stage(train: DataFrame, reg: float = 0.01) -> tuple[PipelineModel, PipelineModel]:
    """A classifier for 'tips at all' and a regressor on the rows that do."""
    tipped = _labelled(train).withColumn("label", (F.col(TARGET) > 0).cast("double"))
    chance = linear_pipeline(LogisticRegression(regParam=reg, maxIter=25)).fit(tipped)
    amount = fit_ridge(train.filter(F.col(TARGET) > 0), reg)
    return chance, amount


def predict_two_stage(models: tuple[PipelineModel, PipelineModel], df: DataFrame) -> DataFrame:
    """Expected target: chance of a tip times its expected size."""
    chance, amount = models
    scored = chance.transform(_labelled(df)).withColumn(
        "tip_chance", vector_to_array("probability")[1]
    )
    trimmed = scored.drop("features", "rawPrediction", "probability", "prediction",
                          *[f"{c}_hot" for c in CATEGORICAL_FEATURES])
    out = amount.transform(trimmed)
    return out.withColumn("prediction", F.col("tip_chance") * F.col("prediction"))
