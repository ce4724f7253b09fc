"""Supervised experiments end to end: split plan, encoding, resampling, models, run rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.operators import models as M
from tallyfold.operators import resample as R
from tallyfold.operators.encode import recipe
from tallyfold.operators.models import balanced_weights
from tallyfold.operators.neighbours import knn_classify
from tallyfold.operators.tuning import validate

# Named resampling methods of the experiments, applied to training rows only.
RESAMPLERS: dict[str, Callable] = {
    "none": lambda df, i, y: df,
    "random_over": lambda df, i, y: R.random_oversample(df, i, y),
    "smote": lambda df, i, y: _grown(df, y, R.smote(df, i, "vec", y)),
    "adasyn": lambda df, i, y: _grown(df, y, R.adasyn(df, i, "vec", y)),
    "borderline_smote": lambda df, i, y: _grown(df, y, R.borderline_smote(df, i, "vec", y)),
    "random_under": lambda df, i, y: R.random_undersample(df, i, y),
    "near_miss": lambda df, i, y: _near(df, i, y),
    "over_under": lambda df, i, y: R.over_then_under(df, i, y),
    "smote_under": lambda df, i, y: R.smote_then_under(df, i, "vec", y),
}


def _grown(df: DataFrame, label: str, synthetic: DataFrame) -> DataFrame:
    _, _, minor, _ = R.class_sizes(df, label)
    return R.with_synthetic(df, synthetic, "vec", label, minor)


def _near(df: DataFrame, id_col: str, label: str) -> DataFrame:
    major, _, _, _ = R.class_sizes(df, label)
    kept = R.near_miss(df, id_col, "vec", label).select(F.col("id").alias(id_col))
    return df.filter(F.col(label) != F.lit(major)).unionByName(df.join(kept, id_col, "left_semi"))


def prepare_with(kind: str, number: int, categorical: Sequence[str], numerical: Sequence[str], label: str, id_col: str,
                 resampler: str = "none", weight: str | None = None) -> Callable:
    """(train, evaluate) -> encoded frames; fitted on the training rows of each split alone.

    ``weight`` names a column of balanced class weights for the training frame; fits take it as their ``weight``.
    """

    def prepare(train: DataFrame, evaluate: DataFrame) -> tuple[DataFrame, DataFrame]:
        model = recipe(kind, number, categorical, numerical, label, id_col)
        fitted = model.fit_transform(train).select(id_col, label, "features")
        if resampler != "none":
            plain = fitted.select(id_col, label, vector_to_array("features").alias("vec"))
            fitted = RESAMPLERS[resampler](plain, id_col, label).select(
                id_col, label, array_to_vector("vec").alias("features"))
        if weight:
            fitted = balanced_weights(fitted, label, weight)
        encoded = model.transform(evaluate).select(id_col, label, "features")
        return fitted, encoded

    return prepare


def classifiers(label: str, id_col: str) -> dict[str, Callable]:
    """Model name to fit function, as the experiments name them."""
    return {
        "KNN": lambda df, **p: _Neighbours(df, id_col, label, p),
        "Logistic Regression": lambda df, **p: M.fit_logistic(df, label, **p),
        "Gaussian NB": _NaiveFit(label),
        "Linear SVC": lambda df, **p: M.fit_calibrated_svc(df, id_col, label, **p),
        "Decision Tree": lambda df, **p: M.fit_tree(df, label, **p),
        "Random Forest": lambda df, **p: M.fit_forest(df, label, **p),
        "AdaBoost": lambda df, **p: M.fit_adaboost(df, label, **p),
        "Boosted Trees (depth-wise)": lambda df, **p: M.fit_gbt(df, label, "depthwise", **p),
        "Boosted Trees (leafy)": lambda df, **p: M.fit_gbt(df, label, "leafy", **p),
        "Boosted Trees (slow)": lambda df, **p: M.fit_gbt(df, label, "slow", **p),
    }


def regressors(label: str) -> dict[str, Callable]:
    return {
        "Linear Regression": lambda df: M.fit_linear(df, label),
        "Lasso": lambda df, alpha=1.0: M.fit_elastic(df, label, alpha, 1.0),
        "Ridge": lambda df, alpha=1.0: M.fit_ridge(df, label, alpha),
        "Elastic Net": lambda df, alpha=1.0, l1_ratio=0.5: M.fit_elastic(df, label, alpha, l1_ratio),
        "Decision Tree": lambda df, **p: M.fit_tree_reg(df, label, **p),
        "Random Forest": lambda df, **p: M.fit_forest_reg(df, label, **p),
        "AdaBoost": lambda df, **p: M.fit_adaboost_r2(df, label, **p),
        "Boosted Trees (depth-wise)": lambda df, **p: M.fit_gbt_reg(df, label, "depthwise", **p),
        "Boosted Trees (leafy)": lambda df, **p: M.fit_gbt_reg(df, label, "leafy", **p),
        "Boosted Trees (slow)": lambda df, **p: M.fit_gbt_reg(df, label, "slow", **p),
    }


class _Naive:
    """Gaussian naive Bayes over an assembled vector."""

    def __init__(self, model: M.GaussianNB, width: int):
        self.model, self.width = model, width

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(_unpacked(df, self.width)).drop(*_slots(self.width))


def _slots(width: int) -> list[str]:
    return [f"__x{i}" for i in range(width)]


def _unpacked(df: DataFrame, width: int) -> DataFrame:
    x = vector_to_array("features")
    return df.withColumns({c: x[i] for i, c in enumerate(_slots(width))})


class _NaiveFit:
    """Fits naive Bayes; smoothing changes no moments, so all smoothings come from one fit."""

    def __init__(self, label: str):
        self.label = label

    def __call__(self, df: DataFrame, var_smoothing: float = 1e-9) -> _Naive:
        return self.all(df, [{"var_smoothing": var_smoothing}])[0]

    def all(self, df: DataFrame, settings: Sequence[dict]) -> list[_Naive]:
        width = len(df.select("features").first()[0])
        fitted = M.GaussianNB(_slots(width), self.label).fit(_unpacked(df, width))
        return [_Naive(fitted.with_smoothing(s.get("var_smoothing", 1e-9)), width) for s in settings]


def run_model(plan: DataFrame, name: str, fit: Callable, prepare: Callable, experiment: str, label: str,
              task: str = "classification", **options) -> DataFrame:
    """Run rows of one model over the named splits."""
    return validate(plan, name, prepare, fit, lambda m, df: m.transform(df), experiment, label, task, **options)


class _Neighbours:
    """The training rows stand for the model; scoring is one neighbour join."""

    def __init__(self, train: DataFrame, id_col: str, label: str, params: dict):
        self.train, self.id_col, self.label, self.params = train, id_col, label, params

    def transform(self, df: DataFrame) -> DataFrame:
        t = self.train.withColumn("vec", vector_to_array("features"))
        e = df.withColumn("vec", vector_to_array("features"))
        return df.join(knn_classify(t, e, self.id_col, "vec", self.label, **self.params), self.id_col)
