"""Feature table -> six regressors, predictions and hold-out metrics.

feature table (time index, label, features) -> exact row index in time
order -> chronological 80/20 split -> contiguous 5-fold labels on the
training rows -> per model: search/fit on the training rows -> one
``transform`` over the whole table -> RMSE/R² of every model on the
validation rows in a single aggregation.

The feature list is fixed before any prediction column exists. Models:
``media`` (training mean), ``rl`` (OLS of minimum norm), ``rf`` (random forest, random
search), ``svr`` (ε-SVR, grid search), ``ada`` (AdaBoost.R2 on drawn rows, grid
search), ``bagging`` (bags of trees, forests or extra-trees, random search).
Each search runs all its candidates and folds in shared passes, so its number
of Spark jobs does not grow with the candidates.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.models.base import FEATURES, add_prediction, assembler, feature_columns, pipeline
from helioframe.models.boosting import search_boosting
from helioframe.models.forest import bagging_plan, forest_plan, search_forests
from helioframe.models.grower import binned
from helioframe.models.kernel_svr import search_svr
from helioframe.models.least_squares import MinimumNormOLS
from helioframe.models.search import expand_grid, randint, sample_candidates
from helioframe.models.simple import fit_mean, fit_pca, pca_columns, predict_mean
from helioframe.operators.metrics import regression_metrics
from helioframe.operators.rows import fold_of, with_row_index

# The model search spaces (sklearn-style names and values).
FOREST_SPACE = {
    "bootstrap": [True, False],
    "max_depth": [10, 30, 50, 70, 90, None],
    "max_features": ["auto", "sqrt"],
    "min_samples_leaf": [2, 4],
    "min_samples_split": [2, 5, 10],
    "n_estimators": [400, 800, 1200, 1600, 2000],
}
SVR_GRID_PCA = {"kernel": ["linear", "poly", "rbf"], "C": [0.1, 1],
                "gamma": [0.1, "scale", "auto"], "epsilon": [0.01, 0.1]}
SVR_GRID = {"kernel": ["linear", "poly", "rbf"], "C": [0.1, 1, 10, 100],
            "gamma": [0.1, 1, "scale", "auto"], "epsilon": [0.01, 0.1, 0.2]}
ADA_GRID = {"n_estimators": [50, 100], "learning_rate": [0.01, 0.1]}
ADA_GRID_8 = {"n_estimators": [50, 100, 200], "learning_rate": [0.01, 0.1, 1.0]}
BAGGING_SPACE_PCA = {
    "base_estimator": ["tree", "forest", "extra"],
    "n_estimators": randint(10, 500),
    "bootstrap": [True, False],
    "base_max_depth": randint(1, 20),
    "base_min_samples_split": randint(2, 20),
    "base_min_samples_leaf": randint(1, 20),
}
BAGGING_SPACE = dict(BAGGING_SPACE_PCA, max_samples=[0.5, 1.0], max_features=[0.5, 1.0],
                     bootstrap_features=[True, False])

MODEL_SUFFIXES = ("media", "rl", "rf", "svr", "ada", "bagging")


@dataclass
class SearchConfig:
    forest_space: dict = field(default_factory=lambda: dict(FOREST_SPACE))
    forest_iter: int = 100
    forest_seed: int = 1
    svr_grid: dict = field(default_factory=lambda: dict(SVR_GRID))
    svr_max_iter: int = 200
    svr_landmarks: int = 256
    ada_grid: dict = field(default_factory=lambda: dict(ADA_GRID))
    bagging_space: dict = field(default_factory=lambda: dict(BAGGING_SPACE))
    bagging_iter: int = 100
    bagging_seed: int = 42
    folds: int = 5
    max_bins: int = 256

    @classmethod
    def all_variables(cls) -> "SearchConfig":
        """The spaces for training on all variables (the defaults)."""
        return cls()

    @classmethod
    def eight_variables(cls) -> "SearchConfig":
        """The spaces for training on eight chosen variables."""
        return cls(ada_grid=dict(ADA_GRID_8))

    @classmethod
    def principal_components(cls) -> "SearchConfig":
        """The spaces for training on principal components."""
        return cls(svr_grid=dict(SVR_GRID_PCA), bagging_space=dict(BAGGING_SPACE_PCA))


def ada_params(est, c: dict) -> dict:
    m = {}
    if "n_estimators" in c:
        m[est.nEstimators] = int(c["n_estimators"])
    if "learning_rate" in c:
        m[est.learningRate] = float(c["learning_rate"])
    return m


@dataclass
class TrainResult:
    predictions: DataFrame          # table + idx, split, <label>_<model>
    metrics: DataFrame              # model, mse, rmse, r2 on the validation rows
    best: dict                      # chosen candidate per searched model
    n_rows: int
    n_train: int


def prepare(df: DataFrame, label: str, time: str = "time", fraction: float = 0.8,
            folds: int = 5, order_extra: tuple[str, ...] = ()):
    """Row index in time order, split flag, and fold labels on the training rows."""
    ind = with_row_index(df, [time, *order_extra])
    k = int(ind.n * fraction)
    data = (ind.df.withColumn("split", F.when(F.col("idx") < k, "train").otherwise("validation"))
            .withColumn("fold", F.when(F.col("idx") < k, fold_of("idx", k, folds))))
    return data, ind.n, k


def train_all(df: DataFrame, label: str, time: str = "time", features: list[str] | None = None,
              models=MODEL_SUFFIXES, config: SearchConfig | None = None,
              fraction: float = 0.8, order_extra: tuple[str, ...] = (),
              components: int | None = None) -> TrainResult:
    """``order_extra`` breaks ties of ``time`` so that positions are exact.

    With ``components`` the models are trained on that many principal
    components of the features, fitted on the training rows without the label.
    """
    cfg = config or SearchConfig()
    feats = list(features or feature_columns(df, label, exclude=(time,)))
    keep = list(dict.fromkeys([time, label, *feats, *order_extra]))
    data, n, k = prepare(df.select(*keep), label, time, fraction, cfg.folds, order_extra)
    if components:
        pca = fit_pca(data.where("split = 'train'"), feats, components)
        data = pca_columns(pca, data, feats, components)
        feats = [f"pc{i + 1}" for i in range(components)]
    train = data.where("split = 'train'")
    out = data
    best = {}

    def col(suffix):
        return f"{label}_{suffix}"

    # The searches that grow trees read the same binned rows.
    rows = binned(assembler(feats).transform(train), FEATURES, label, "fold", ["idx"], cfg.max_bins) \
        if {"rf", "ada", "bagging"} & set(models) else None
    if "media" in models:
        out = predict_mean(out, fit_mean(train, label), col("media"))
    if "rl" in models:
        out = add_prediction(pipeline(feats, MinimumNormOLS(labelCol=label)).fit(train), out, col("rl"))
    if "rf" in models:
        cands = sample_candidates(cfg.forest_space, cfg.forest_iter, cfg.forest_seed)
        m, best["rf"], _ = search_forests(train, feats, label, cands, forest_plan, seed=cfg.forest_seed, rows=rows)
        out = add_prediction(m, out, col("rf"))
    if "svr" in models:
        m, best["svr"], _ = search_svr(train, feats, label, expand_grid(cfg.svr_grid), landmarks=cfg.svr_landmarks,
                                       most=cfg.svr_max_iter)
        out = add_prediction(m, out, col("svr"))
    if "ada" in models:
        m, best["ada"], _ = search_boosting(train, feats, label, expand_grid(cfg.ada_grid), seed=cfg.forest_seed, rows=rows)
        out = add_prediction(m, out, col("ada"))
    if "bagging" in models:
        cands = sample_candidates(cfg.bagging_space, cfg.bagging_iter, cfg.bagging_seed)
        m, best["bagging"], _ = search_forests(train, feats, label, cands, bagging_plan, seed=cfg.bagging_seed, rows=rows)
        out = add_prediction(m, out, col("bagging"))
    if rows:
        rows.drop()
    preds = {s: col(s) for s in models}
    metrics = regression_metrics(out.where("split = 'validation'"), label, preds)
    return TrainResult(out, metrics, best, n, k)
