"""Mean baseline, ordinary least squares, decision tree, random forest, PCA,
and model persistence — MLlib estimators with the plant parameter names.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (DecisionTreeRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.models.base import FEATURES, assembler, pipeline
from helioframe.operators.metrics import mean_of

# MLlib grows trees to at most this depth.
MLLIB_MAX_DEPTH = 30


# ----------------------------------------------------------------- mean baseline (M1)

def fit_mean(train: DataFrame, label: str) -> float:
    """The training mean of the label."""
    return mean_of(train, label)


def predict_mean(df: DataFrame, mean: float, out: str) -> DataFrame:
    """Every row gets the training mean (a literal; nothing is joined)."""
    return df.withColumn(out, F.lit(float(mean)))


# ------------------------------------------------------------ linear regression (M2)

def linear_regression(label: str) -> LinearRegression:
    """OLS with intercept: normal equations, no regularisation."""
    return LinearRegression(featuresCol=FEATURES, labelCol=label, solver="normal",
                            regParam=0.0, elasticNetParam=0.0, fitIntercept=True)


def fit_linear(train: DataFrame, features: list[str], label: str) -> PipelineModel:
    return pipeline(features, linear_regression(label)).fit(train)


# ------------------------------------------------------------------ trees

def tree_depth(max_depth) -> int:
    """Depth parameter: ``None`` (grow fully) and anything deeper than MLlib
    allows become the MLlib maximum."""
    return MLLIB_MAX_DEPTH if max_depth is None else min(int(max_depth), MLLIB_MAX_DEPTH)


def decision_tree(label: str, max_depth=None, min_samples_leaf: int = 1,
                  seed: int | None = None, weight_col: str | None = None,
                  max_bins: int = 32) -> DecisionTreeRegressor:
    kw = dict(featuresCol=FEATURES, labelCol=label, maxDepth=tree_depth(max_depth),
              maxBins=max_bins, minInstancesPerNode=int(min_samples_leaf))
    if seed is not None:
        kw["seed"] = seed
    if weight_col:
        kw["weightCol"] = weight_col
    return DecisionTreeRegressor(**kw)


# sklearn-style forest parameter -> MLlib parameter.
FEATURE_SUBSET = {"auto": "all", "sqrt": "sqrt", "log2": "log2", None: "all", 1.0: "all"}


def random_forest(label: str, n_estimators: int = 100, max_depth=None,
                  max_features="auto", min_samples_leaf: int = 1, bootstrap: bool = True,
                  seed: int | None = None, max_bins: int = 32) -> RandomForestRegressor:
    kw = dict(featuresCol=FEATURES, labelCol=label, numTrees=int(n_estimators), maxBins=max_bins,
              maxDepth=tree_depth(max_depth),
              featureSubsetStrategy=FEATURE_SUBSET.get(max_features, str(max_features)),
              minInstancesPerNode=int(min_samples_leaf), bootstrap=bool(bootstrap))
    if seed is not None:
        kw["seed"] = seed
    return RandomForestRegressor(**kw)


def forest_params(est: RandomForestRegressor, sk: dict) -> dict:
    """Param map for ``est`` from sklearn-style names (``min_samples_split`` has
    no MLlib counterpart and is ignored)."""
    m = {}
    if "n_estimators" in sk:
        m[est.numTrees] = int(sk["n_estimators"])
    if "max_depth" in sk:
        m[est.maxDepth] = tree_depth(sk["max_depth"])
    if "max_features" in sk:
        m[est.featureSubsetStrategy] = FEATURE_SUBSET.get(sk["max_features"], str(sk["max_features"]))
    if "min_samples_leaf" in sk:
        m[est.minInstancesPerNode] = int(sk["min_samples_leaf"])
    if "bootstrap" in sk:
        m[est.bootstrap] = bool(sk["bootstrap"])
    return m


# ---------------------------------------------------------------------------- PCA

def fit_pca(df: DataFrame, features: list[str], k: int) -> PipelineModel:
    """Standardise, then project on the first ``k`` principal components."""
    from pyspark.ml import Pipeline
    return Pipeline(stages=[
        assembler(features, "__raw"),
        StandardScaler(inputCol="__raw", outputCol="__std", withMean=True, withStd=True),
        PCA(k=k, inputCol="__std", outputCol="__pca"),
    ]).fit(df)


def pca_columns(model: PipelineModel, df: DataFrame, features: list[str], k: int,
                prefix: str = "pc") -> DataFrame:
    """Replace the feature columns by ``pc1..pck``."""
    keep = [c for c in df.columns if c not in features]
    arr = vector_to_array(F.col("__pca"))
    return model.transform(df).select(*keep, *[arr[i].alias(f"{prefix}{i + 1}") for i in range(k)])


# ------------------------------------------------------------------- persistence

def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
