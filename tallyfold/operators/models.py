"""Supervised models on assembled features: fit, score, class weights.

``fit_*`` take a frame with ``features`` and a label column and return a model whose ``transform``
adds ``prediction`` (and ``probability`` for classifiers).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.hashing import hash32
from tallyfold.operators import trees
from tallyfold.operators.isotonic import fit_isotonic
from tallyfold.session import stage_table


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Weight n / (classes * n_class) on every row."""
    sizes = df.groupBy(F.col(label).alias("__y")).agg(F.count("*").alias("__n"))
    total = sizes.agg(F.struct(F.sum("__n").alias("n"), F.count("*").alias("k")).alias("t")).scalar()
    weights = sizes.select("__y", (total["n"] / (total["k"] * F.col("__n"))).alias(out))
    return df.join(weights, df[label] == weights["__y"]).drop("__y")


# --- linear ------------------------------------------------------------------------------------

def fit_logistic(df: DataFrame, label: str = "label", C: float = 1.0, penalty: str = "l2", l1_ratio: float = 0.0,
                 max_iter: int = 100, weight: str | None = None):
    """Logistic regression with inverse strength ``C``; Spark's penalty is per row, hence 1 / (C * n)."""
    reg = 0.0 if penalty == "none" else 1.0 / (C * df.count())
    mix = {"l1": 1.0, "l2": 0.0, "none": 0.0, "elasticnet": l1_ratio}[penalty]
    est = LogisticRegression(labelCol=label, regParam=reg, elasticNetParam=mix, standardization=False, maxIter=max_iter)
    return (est.setWeightCol(weight) if weight else est).fit(df)


def fit_linear_svc(df: DataFrame, label: str = "label", C: float = 1.0, max_iter: int = 100, weight: str | None = None):
    est = LinearSVC(labelCol=label, regParam=1.0 / (C * df.count()), standardization=False, maxIter=max_iter)
    return (est.setWeightCol(weight) if weight else est).fit(df)


def fit_elastic(df: DataFrame, label: str = "label", alpha: float = 1.0, l1_ratio: float = 1.0):
    """Lasso (ratio 1), elastic net, or any mix of absolute and squared penalties at strength ``alpha``.

    Spark scales the label by its deviation, which enters the squared part only; the two strengths
    are rescaled so that the minimised function is the usual one.
    """
    sd = df.agg(F.stddev_pop(label)).first()[0] or 1.0
    reg = alpha * (l1_ratio + (1 - l1_ratio) * sd)
    mix = alpha * l1_ratio / reg if reg else 0.0
    return LinearRegression(labelCol=label, regParam=reg, elasticNetParam=mix, standardization=False).fit(df)


def fit_ridge(df: DataFrame, label: str = "label", alpha: float = 1.0):
    """Squared penalty alpha * |w|^2 against the sum (not the mean) of squared errors."""
    one = df.agg(F.stddev_pop(label).alias("sd"), F.count("*").alias("n")).first()
    return LinearRegression(labelCol=label, regParam=alpha * (one.sd or 1.0) / one.n, elasticNetParam=0.0,
                            standardization=False).fit(df)


def fit_linear(df: DataFrame, label: str = "label"):
    return LinearRegression(labelCol=label, regParam=0.0).fit(df)


# --- naive Bayes -------------------------------------------------------------------------------

@dataclass
class GaussianNB:
    """Gaussian naive Bayes from one grouped aggregate; a smoothing grid needs no new pass."""

    cols: Sequence[str]
    label: str
    var_smoothing: float = 1e-9
    stats: list = field(default_factory=list)
    widest: float = 0.0

    def fit(self, df: DataFrame) -> GaussianNB:
        moments = [f(c).alias(f"{k}{i}") for i, c in enumerate(self.cols)
                   for k, f in (("m", F.avg), ("v", F.var_pop))]
        self.stats = df.groupBy(self.label).agg(F.count("*").alias("n"), *moments).orderBy(self.label).collect()
        spread = df.agg(*[F.var_pop(c) for c in self.cols]).first()
        self.widest = max(v or 0.0 for v in spread)
        return self

    def with_smoothing(self, var_smoothing: float) -> GaussianNB:
        return GaussianNB(self.cols, self.label, var_smoothing, self.stats, self.widest)

    def transform(self, df: DataFrame) -> DataFrame:
        total = sum(r.n for r in self.stats)
        scores = []
        for r in self.stats:
            score = F.lit(math.log(r.n / total))
            for i, c in enumerate(self.cols):
                var = r[f"v{i}"] + self.var_smoothing * self.widest
                gap = F.col(c) - F.lit(r[f"m{i}"])
                score = score - 0.5 * math.log(2 * math.pi * var) - gap * gap / (2 * var)
            scores.append(score)
        top = F.greatest(*scores) if len(scores) > 1 else scores[0]
        label = F.lit(None)
        for r, score in reversed(list(zip(self.stats, scores))):
            label = F.when(score == top, F.lit(float(r[self.label]))).otherwise(label)
        norm = sum((F.exp(s - top) for s in scores), F.lit(0.0))
        prob = array_to_vector(F.array(*[F.exp(s - top) / norm for s in scores]))
        return df.withColumns({"prediction": label, "probability": prob})


# --- trees -------------------------------------------------------------------------------------

DEEPEST = 60  # trees without a stated depth grow until their nodes are pure

# Names of the experiments' settings for trees and boosting, and what the engine calls them.
TREE_SETTINGS = {"maxDepth": "depth", "minInstancesPerNode": "min_rows", "minSplit": "min_split", "minInfoGain": "min_gain", "maxLeaves": "leaves",
                 "featureSubsetStrategy": "share", "numTrees": "n_trees", "maxIter": "rounds", "stepSize": "step", "subsamplingRate": "rate",
                 "columnRate": "columns", "minChildWeight": "min_weight", "l2": "ridge", "firstStep": "first_step"}


def _settings(params: dict) -> dict:
    """The engine's settings; those that are None take its defaults."""
    out = {TREE_SETTINGS.get(k, k): v for k, v in params.items() if k != "impurity" and v is not None}
    return {**out, "entropy": True} if params.get("impurity", "gini") == "entropy" else out


def _balanced(df: DataFrame, label: str, params: dict) -> tuple[DataFrame, dict]:
    """With classWeight "balanced", the frame gets weights and the fit takes them."""
    rest = {k: v for k, v in params.items() if k != "classWeight"}
    if params.get("classWeight") != "balanced":
        return df, rest
    return balanced_weights(df, label, "__balance"), {**rest, "weight": "__balance"}


def fit_tree(df: DataFrame, label: str = "label", **params):
    """A tree for labels 0 and 1; ``maxLeaves`` grows best leaf first."""
    df, params = _balanced(df, label, params)
    return trees.fit_trees(df, label, "proportion", **_settings({"maxDepth": DEEPEST, **params}))


def fit_forest(df: DataFrame, label: str = "label", **params):
    df, params = _balanced(df, label, params)
    defaults = {"numTrees": 100, "maxDepth": DEEPEST, "featureSubsetStrategy": "sqrt", "bootstrap": True}
    return trees.fit_trees(df, label, "proportion", **_settings({**defaults, **params}))


def fit_tree_reg(df: DataFrame, label: str = "label", **params):
    return trees.fit_trees(df, label, "mean", **_settings({"maxDepth": DEEPEST, **params}))


def fit_forest_reg(df: DataFrame, label: str = "label", **params):
    return trees.fit_trees(df, label, "mean", **_settings({"numTrees": 100, "maxDepth": DEEPEST, "bootstrap": True, **params}))


# Named settings for the three boosting styles of the experiments: level by level, best leaf first, one cut a level.
# The first tree counts whole, so that few rounds already fit; ``firstStep=None`` shrinks it like the others.
BOOST_PRESETS = {
    "depthwise": {"firstStep": 1.0, "maxIter": 100, "stepSize": 0.3, "maxDepth": 6, "l2": 1.0, "minChildWeight": 1.0},
    "leafy": {"firstStep": 1.0, "maxIter": 100, "stepSize": 0.1, "maxDepth": DEEPEST, "maxLeaves": 31, "l2": 0.0, "minChildWeight": 1e-3, "minInstancesPerNode": 20},
    "slow": {"firstStep": 1.0, "maxIter": 1000, "stepSize": 0.03, "maxDepth": 6, "l2": 3.0, "minChildWeight": 0.0, "symmetric": True},
}


def fit_gbt(df: DataFrame, label: str = "label", preset: str = "depthwise", **params):
    df, params = _balanced(df, label, params)
    return trees.fit_boosted(df, label, "logit", **_settings({**BOOST_PRESETS[preset], **params}))


def fit_gbt_reg(df: DataFrame, label: str = "label", preset: str = "depthwise", **params):
    return trees.fit_boosted(df, label, "sum", **_settings({**BOOST_PRESETS[preset], **params}))


def fit_adaboost(df: DataFrame, label: str = "label", n: int = 50, lr: float = 1.0, depth: int = 1):
    """Discrete AdaBoost on shallow trees for labels 0 and 1."""
    return trees.fit_adaboost(df, label, n, lr, depth)


def fit_adaboost_r2(df: DataFrame, label: str = "label", n: int = 50, lr: float = 1.0, depth: int = 3):
    return trees.fit_adaboost_r2(df, label, n, lr, depth)


# --- calibrated margin classifier --------------------------------------------------------------

def _margin(df: DataFrame, model) -> DataFrame:
    scored = model.transform(df)
    return scored.withColumn("__margin", vector_to_array("rawPrediction")[1]).drop("rawPrediction", "prediction")


@dataclass
class CalibratedSVC:
    """Average of k margin classifiers, each calibrated on the fold it has not seen."""

    method: str
    models: list = field(default_factory=list)
    calibrators: list = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        kept, probs = df.columns, []
        for i, (svc, cal) in enumerate(zip(self.models, self.calibrators)):
            df = _margin(df, svc)
            if self.method == "sigmoid":
                df = df.withColumn(f"__p{i}", 1 / (1 + F.exp(-(F.lit(cal.coefficients[0]) * F.col("__margin")
                                                              + F.lit(cal.intercept)))))
            else:
                df = cal.transform(df, "__margin", f"__p{i}")
            df = df.drop("__margin")
            probs.append(F.col(f"__p{i}"))
        p = sum(probs[1:], probs[0]) / len(probs)
        return df.select(*kept, array_to_vector(F.array(1 - p, p)).alias("probability"),
                         F.when(p >= 0.5, 1.0).otherwise(0.0).alias("prediction"))


FITTED_CELLS = 600_000_000  # rows times features of the folds that are fitted at the same time; a fit keeps its rows in memory


def fit_calibrated_svc(df: DataFrame, id_col: str, label: str = "label", method: str = "sigmoid", cv: int = 5,
                       C: float = 1.0, weight: str | None = None, max_iter: int = 100) -> CalibratedSVC:
    """The folds do not depend on each other. A fit is about a thousand short jobs, whose starts cost more than their work on a
    few million rows: as many folds are fitted at once as ``FITTED_CELLS`` allows."""
    folded = stage_table(df.withColumn("__cv", F.pmod(hash32(F.col(id_col)), F.lit(cv))), "cv")

    def fold(i: int):
        svc = fit_linear_svc(folded.filter(F.col("__cv") != i), label, C, max_iter, weight)
        held = _margin(folded.filter(F.col("__cv") == i), svc)
        if method == "sigmoid":
            est = LogisticRegression(labelCol=label, featuresCol="__m", regParam=0.0)
            return svc, est.fit(held.select(label, array_to_vector(F.array("__margin")).alias("__m")))
        return svc, fit_isotonic(held, "__margin", label)

    cells = folded.count() * len(folded.select("features").first()[0])
    with ThreadPoolExecutor(max(1, min(cv, FITTED_CELLS // max(1, cells)))) as pool:
        task = inheritable_thread_target(df.sparkSession)(fold)
        fitted = [one.result() for one in [pool.submit(copy_context().run, task, i) for i in range(cv)]]
    return CalibratedSVC(method, [svc for svc, _ in fitted], [cal for _, cal in fitted])


def positive_probability(col: str = "probability") -> Column:
    return vector_to_array(col)[1]
