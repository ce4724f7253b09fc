"""Running models over named splits: one run row per split, fold summaries, and grids."""

from __future__ import annotations

import itertools
import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.metrics import CLASS_METRICS, REG_METRICS, classification_metrics, operating_point, regression_metrics, roc_curve
from tallyfold.operators.sampling import named_split, split_names
from tallyfold.session import stage_table

# What the experiments search.
GRIDS: dict[str, dict[str, list]] = {
    "knn": {"k": [3, 5, 7, 9], "weights": ["uniform", "distance"], "p": [1, 2]},
    "logistic": {"penalty": ["l1", "l2", "elasticnet", "none"], "C": [0.01, 0.1, 1.0, 10.0, 100.0],
                 "max_iter": [100, 1000], "l1_ratio": [0.1, 0.5, 0.9]},
    "gaussian_nb": {"var_smoothing": [10.0 ** -i for i in range(10)]},
    "linear_svc": {"C": [0.01, 0.1, 1.0, 10.0, 100.0], "method": ["sigmoid", "isotonic"]},
    "tree": {"impurity": ["gini", "entropy"], "maxDepth": [3, 9, 27, None], "minSplit": [2, 8, 32], "minInstancesPerNode": [1, 5, 10],
             "featureSubsetStrategy": ["sqrt", "log2", "all"], "maxLeaves": [10, 50, 100, None], "classWeight": ["balanced", None]},
    "forest": {"numTrees": [50, 100, 200], "impurity": ["gini", "entropy"], "maxDepth": [3, 30, None], "minSplit": [2, 32],
               "minInstancesPerNode": [1, 10], "featureSubsetStrategy": ["sqrt", "log2", "all"], "maxLeaves": [10, 100, None]},
    "adaboost": {"n": [50, 100, 200], "lr": [1e-5, 1e-4, 1e-3, 1e-2, 1e-1, 1.0]},
    "depthwise": {"stepSize": [0.01, 0.1, 0.2, 0.3], "minInfoGain": [0.0, 5.0, 10.0], "maxDepth": [3, 6, 9],
                  "minChildWeight": [1, 5, 9], "subsamplingRate": [0.5, 1.0], "columnRate": [0.5, 1.0]},
    "leafy": {"stepSize": [0.01, 0.1, 0.2, 0.3], "maxLeaves": [8, 16, 32], "maxDepth": [None, 3, 6, 9], "subsamplingRate": [0.5, 1.0],
              "columnRate": [0.5, 1.0], "classWeight": ["balanced", None]},
    "slow": {"stepSize": [0.001, 0.01, 0.03, 0.1], "maxDepth": [3, 6, 9]},
}


def combinations(grid: Mapping[str, Sequence]) -> list[dict]:
    """All settings of a grid; an l1 ratio only varies where the penalty mixes."""
    out = []
    for values in itertools.product(*grid.values()):
        setting = dict(zip(grid, values))
        if "l1_ratio" in setting and setting.get("penalty") != "elasticnet":
            if setting["l1_ratio"] != grid["l1_ratio"][0]:
                continue
            setting = {k: v for k, v in setting.items() if k != "l1_ratio"}
        out.append(setting)
    return out


def timed(action: Callable):
    """(result, nanoseconds) of a Spark action."""
    start = time.perf_counter_ns()
    result = action()
    return result, time.perf_counter_ns() - start


def validate(plan: DataFrame, name: str, prepare: Callable, fit: Callable, score: Callable, experiment: str, label: str,
             task: str = "classification", splits: Sequence[str] | None = None, retrain: bool = False,
             params: Mapping | None = None, fixed_fpr: float | None = None) -> DataFrame:
    """Run rows: one parent and one child per named split with its metrics and times.

    ``prepare(train, evaluate)`` returns encoded frames; ``fit(train)`` a model; ``score(model,
    evaluate)`` a frame with the label and ``prediction``. ``testing`` runs only with ``retrain``.
    With ``fixed_fpr`` predictions follow the threshold of the last point of the ROC curve whose false-positive rate does
    not exceed it; threshold, fpr and tpr come along as metrics. Only the few metric numbers of a split come to the driver.
    """
    spark = plan.sparkSession
    parent, rows = uuid.uuid4().hex, []
    begun = time.time()
    for split in splits or split_names():
        if split == "testing" and not retrain:
            continue
        train, evaluate = prepare(*named_split(plan, split))
        # Fits pass over the rows many times; the written table spares them the joins of the encoders.
        metrics = _measured(stage_table(train, "train"), evaluate, fit, score, label, task, fixed_fpr)
        rows.append((experiment, uuid.uuid4().hex, parent, split, time.time(), metrics, _text(params)))
    rows.insert(0, (experiment, parent, None, name, begun, {}, _text(params)))
    return spark.createDataFrame(rows, RUN_SCHEMA).withColumn("start_time", F.timestamp_seconds("start_time"))


def _measured(train: DataFrame, evaluate: DataFrame, fit: Callable, score: Callable, label: str, task: str,
              fixed_fpr: float | None = None) -> dict[str, float]:
    """Metrics and times of one fit. The time of scoring is that of writing the predictions; the metrics then read them."""
    model, fit_time = timed(lambda: fit(train))
    kept = [F.col(label), F.col("prediction").cast("double").alias("prediction")]
    kept += [vector_to_array("probability")[1].alias("p1")] if fixed_fpr is not None else []
    scored, score_time = timed(lambda: stage_table(score(model, evaluate).select(*kept), "scored"))
    point: dict[str, float] = {}
    if fixed_fpr is not None:
        one = operating_point(roc_curve(scored, label, "p1"), fixed_fpr).first()
        # The first point of a curve has no threshold: nothing is predicted positive.
        threshold = float("inf") if one.threshold is None else one.threshold
        point = {"threshold": threshold, "fpr": one.fpr, "tpr": one.tpr}
        scored = scored.withColumn("prediction", (F.col("p1") >= threshold).cast("double"))
    if task == "classification":
        report, names = classification_metrics(scored, label, "prediction"), CLASS_METRICS
    else:
        report, names = regression_metrics(scored, label, "prediction"), REG_METRICS
    one = report.first()
    return {m: one[m] for m in names} | point | {"fit_time": float(fit_time), "score_time": float(score_time)}


def _measured_together(train: DataFrame, evaluate: DataFrame, fit: Callable, settings: Sequence[Mapping], score: Callable, label: str) -> list[dict[str, float]]:
    """:func:`_measured` of many settings whose models come from the same passes over the rows."""
    models, fit_time = timed(lambda: fit.all(train, settings))
    scored = evaluate
    for i, model in enumerate(models):
        made = score(model, scored)
        scored = made.select(*scored.columns, F.col("prediction").cast("double").alias(f"__p{i}"))
    said = F.array(*[F.col(f"__p{i}") for i in range(len(models))])
    scored, score_time = timed(lambda: stage_table(scored.select(F.col(label), said.alias("said")), "scored"))
    each = scored.select(label, F.posexplode("said").alias("setting", "prediction"))
    report = {r["setting"]: r for r in classification_metrics(each, label, "prediction", ["setting"]).collect()}  # one row a setting
    empty = None if len(report) == len(settings) else classification_metrics(each.limit(0), label, "prediction").first()
    times = {"fit_time": fit_time / len(settings), "score_time": score_time / len(settings)}
    return [{m: report.get(i, empty)[m] for m in CLASS_METRICS} | times for i in range(len(settings))]


RUN_SCHEMA = ("experiment string, run_id string, parent_run_id string, name string, start_time double, "
              "metrics map<string,double>, params map<string,string>")


def _text(params: Mapping | None) -> dict[str, str]:
    return {k: str(v) for k, v in (params or {}).items()}


def tune(plan: DataFrame, name: str, prepare: Callable, fit: Callable, score: Callable, grid: Mapping[str, Sequence],
         label: str, task: str = "classification", k: int = 5, fixed_fpr: float | None = None) -> DataFrame:
    """(setting, metric, mean, std) over the folds for every setting. ``fit`` takes (train, **setting).

    Each fold is encoded once and written; all settings are fitted on it. A fit that offers ``all(train, settings)`` gives the
    models of all settings together; their predictions are then written and counted together too, and times are shared out.
    """
    rows = []
    for j in range(1, k + 1):
        train, evaluate = (stage_table(part, "fold") for part in prepare(*named_split(plan, f"fold_{j}")))
        settings = combinations(grid)
        if hasattr(fit, "all") and task == "classification" and fixed_fpr is None:
            found = _measured_together(train, evaluate, fit, settings, score, label)
            rows += [(json.dumps(_text(s), separators=(",", ":")), m, v) for s, metrics in zip(settings, found) for m, v in metrics.items()]
            continue
        for setting in settings:
            metrics = _measured(train, evaluate, lambda t, s=setting: fit(t, **s), score, label, task, fixed_fpr)
            rows += [(json.dumps(_text(setting), separators=(",", ":")), m, v) for m, v in metrics.items()]
    found = plan.sparkSession.createDataFrame(rows, "setting string, metric string, value double")
    return found.groupBy("setting", "metric").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
