"""Analytics over a table of experiment runs: latest parents, fold means, best and worst models.

Run rows: experiment, run_id, parent_run_id (null on parents), name, start_time and one double
column per metric. Fold rows are children of a model's run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.scalars import cap_std, fmt_mean_std, scale_units
from tallyfold.operators.ordered import rank_by
from tallyfold.operators.rowsets import best_per_group, first_per_key


def wide_metrics(runs: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Metric map to one column per metric."""
    kept = [c for c in runs.columns if c not in ("metrics", "params")]
    return runs.select(*kept, *[F.col("metrics")[m].alias(m) for m in metrics])


def agg_mean_std(df: DataFrame, keys: Sequence[str], metrics: Sequence[str], extra: Sequence[Column] = ()) -> DataFrame:
    aggs = [f(m).alias(f"{m}_{k}") for m in metrics for k, f in (("mean", F.avg), ("std", F.stddev_samp))]
    return df.groupBy(*keys).agg(*extra, *aggs)


def mean_over_folds(runs: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    return runs.groupBy(*keys).agg(*[F.avg(m).alias(m) for m in metrics])


def latest_parents(runs: DataFrame) -> DataFrame:
    """The newest parent run of each (experiment, model), without encoder runs."""
    parents = runs.filter(F.col("parent_run_id").isNull() & (F.col("name") != "Encoders"))
    newest = first_per_key(parents, ["experiment", "name"], [F.col("start_time").desc(), F.col("run_id")])
    return newest.select("experiment", F.col("run_id").alias("parent_id"), F.col("name").alias("parent_name"))


def latest_run_by_name(runs: DataFrame) -> DataFrame:
    return first_per_key(runs, ["name"], [F.col("start_time").desc(), F.col("run_id")])


def child_runs(runs: DataFrame, parent: str | None = None, prefix: str | None = None) -> DataFrame:
    out = runs.filter(F.col("parent_run_id").isNotNull() if parent is None else F.col("parent_run_id") == parent)
    return out if prefix is None else out.filter(F.col("name").startswith(prefix))


def _names() -> Column:
    """Child names of one parent: a handful of folds, bounded by the split plan."""
    return F.array_sort(F.collect_list("name")).alias("nested_run_names")


def cv_metrics_by_task(runs: DataFrame, metrics: Sequence[str], task: str = "") -> DataFrame:
    """Mean and std of every metric over the folds of each latest parent."""
    mine = runs.filter(F.col("experiment").cast("string").startswith(task))
    children = mine.filter(~F.col("name").isin("validation", "testing"))
    parents = latest_parents(mine).select("parent_id", "parent_name")
    joined = children.join(parents, children.parent_run_id == parents.parent_id)
    return agg_mean_std(joined, ["experiment", "parent_id", "parent_name"], metrics, [_names()])


def cv_metrics_by_model(runs: DataFrame, metrics: Sequence[str], model: str, task: str = "") -> DataFrame:
    """The same for all parent runs of one model, in every experiment of the task."""
    mine = runs.filter(F.col("experiment").cast("string").startswith(task))
    parents = mine.filter(F.col("parent_run_id").isNull() & (F.col("name") == model)).select(
        F.col("run_id").alias("parent_id"))
    children = child_runs(mine, prefix="fold")
    joined = children.join(parents, children.parent_run_id == parents.parent_id)
    return agg_mean_std(joined, ["experiment", "parent_id"], metrics, [_names()])


def val_cv_metrics(runs: DataFrame, experiment, metrics: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(validation metrics, fold means and stds) of the latest parents of one experiment; missing ones are null."""
    mine = runs.filter(F.col("experiment") == experiment)
    parents = latest_parents(mine).drop("experiment")
    val = mine.filter(F.col("name") == "validation").select(F.col("parent_run_id").alias("parent_id"), *metrics)
    folds = agg_mean_std(child_runs(mine, prefix="fold"), ["parent_run_id"], metrics)
    folds = folds.withColumnRenamed("parent_run_id", "parent_id")
    return parents.join(val, "parent_id", "left"), parents.join(folds, "parent_id", "left")


def _picked(cv: DataFrame, metric: str, largest: bool, side: str) -> DataFrame:
    best = best_per_group(cv, "experiment", f"{metric}_mean", "parent_name", largest)
    return best.select("experiment", "parent_name", F.lit(metric).alias("metric"), F.lit(side).alias("side"),
                       F.col(f"{metric}_mean").alias("mean"), F.col(f"{metric}_std").alias("std"))


def _indexed(picks: list[DataFrame], cv: DataFrame) -> DataFrame:
    """Union with a running experiment number (1..n by id) and the formatted value."""
    out = picks[0]
    for p in picks[1:]:
        out = out.unionByName(p)
    index = rank_by(cv.select("experiment").distinct(), ["experiment"], name="experiment_idx")
    return out.join(index, "experiment").withColumn("formatted", fmt_mean_std(F.col("mean"), F.col("std")))


def summarize_classification(cv: DataFrame) -> DataFrame:
    """Best and worst model of each experiment by macro F1 and by AUC."""
    return _indexed([_picked(cv, m, big, side) for m in ("f1_macro", "roc_auc")
                     for big, side in ((True, "best"), (False, "worst"))], cv)


def summarize_regression(cv: DataFrame) -> DataFrame:
    """Best and worst by MAE, MAPE and R-squared; the worst ones with spread (and R-squared) kept plottable."""
    picks = []
    for m, low_is_best in (("mae", True), ("mape", True), ("r_squared", False)):
        best = _picked(cv, m, not low_is_best, "best").withColumns({"mean_capped": F.col("mean"), "std_capped": F.col("std")})
        worst = _picked(cv, m, low_is_best, "worst")
        mean = F.greatest(F.col("mean"), F.lit(-1.0)) if m == "r_squared" else F.col("mean")
        worst = worst.withColumn("mean_capped", mean).withColumn("std_capped", cap_std(F.col("mean_capped"), F.col("std")))
        picks += [best, worst]
    return _indexed(picks, cv)


def summarize_resource(cv: DataFrame, metrics: Sequence[str] = ("fit_time", "score_time")) -> DataFrame:
    """Cheapest and dearest model of each experiment; ns to ms, or bytes to MB."""
    picks = []
    for m in metrics:
        for big, side in ((False, "best"), (True, "worst")):
            one = _picked(cv, m, big, side)
            picks.append(one.withColumns({"mean": scale_units(F.col("mean")), "std": scale_units(F.col("std"))}))
    return _indexed(picks, cv)


def metric_by_experiment(cv: DataFrame, metrics: Sequence[str], divisor: float = 1.0) -> DataFrame:
    """(experiment, metric, mean, std) in long form. R-squared is at least -1; a spread above the mean is held below it."""
    floored = cv.withColumns({f"{m}_mean": F.greatest(F.col(f"{m}_mean"), F.lit(-1.0)) for m in metrics if m == "r_squared"})
    capped = floored.withColumns({f"{m}_std": cap_std(F.col(f"{m}_mean"), F.col(f"{m}_std"), strict=True) for m in metrics})
    cells = [F.struct(F.lit(m).alias("metric"), (F.col(f"{m}_mean") / divisor).alias("mean"),
                      (F.col(f"{m}_std") / divisor).alias("std")) for m in metrics]
    keys = [c for c in ("experiment", "parent_id", "parent_name") if c in cv.columns]
    return capped.select(*keys, F.explode(F.array(*cells)).alias("c")).select(*keys, "c.*")


def fold_stability(runs: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """(experiment, parent, fold, metric, value) of all fold runs."""
    folds = child_runs(runs, prefix="fold")
    return folds.unpivot(["experiment", "parent_run_id", "name"], list(metrics), "metric", "value")
