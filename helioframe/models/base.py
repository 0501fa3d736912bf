"""Shared pieces of the model layer: feature assembly and prediction columns.

Models are MLlib estimators (or estimators built from MLlib parts) working
on a ``features`` vector assembled once from a fixed list of columns, so
prediction columns appended later never become features.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURES = "features"
#: Rows of a task when trees are fitted: MLlib keeps some 100 bytes of a row, and 4 more for each tree.
ROWS_PER_TASK = 500_000


def feature_columns(df: DataFrame, label: str, exclude=("time",)) -> list[str]:
    """Every column except the label and the excluded ones (the time index)."""
    return [c for c in df.columns if c != label and c not in exclude]


def assembler(features: list[str], out: str = FEATURES) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error")


def spread(rows: DataFrame, n: int | None = None) -> DataFrame:
    """The rows dealt out so that no task has many more than ``ROWS_PER_TASK``; few rows stay where they are.

    A file's bytes say little of its rows: 128 MB of a few packed columns are over ten million.
    """
    n = rows.count() if n is None else n
    return rows if n <= ROWS_PER_TASK else rows.repartition(max(-(-n // ROWS_PER_TASK), rows.sparkSession.sparkContext.defaultParallelism))


class _Spread(Pipeline):
    """A pipeline whose estimator is fitted on rows that are :func:`spread`."""

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        return super()._fit(spread(dataset))


def pipeline(features: list[str], estimator) -> Pipeline:
    """Assembler + estimator; fitting it fixes the feature list. MLlib's trees get spread rows, others see to it themselves."""
    kind = _Spread if isinstance(estimator, (DecisionTreeRegressor, RandomForestRegressor)) else Pipeline
    return kind(stages=[assembler(features), estimator])


def add_prediction(model: PipelineModel | object, df: DataFrame, out: str) -> DataFrame:
    """Append a model's prediction to ``df`` as column ``out`` (features not kept)."""
    cols = df.columns
    pred_col = _prediction_col(model)
    return model.transform(df).select(*cols, F.col(pred_col).alias(out))


def _prediction_col(model) -> str:
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    return last.getOrDefault("predictionCol") if last.hasParam("predictionCol") else "prediction"
