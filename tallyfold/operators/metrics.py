"""Scores of predictions: classification and regression reports, ROC, confusion rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.ordered import running_totals
from tallyfold.operators.stats import exact_quantiles

CLASS_METRICS = (
    "accuracy", "precision_1", "recall_1", "f1_1", "precision_0", "recall_0", "f1_0", "precision_macro",
    "recall_macro", "f1_macro", "precision_weighted", "recall_weighted", "f1_weighted", "roc_auc", "mcc")
REG_METRICS = ("mae", "mape", "mdae", "mdape", "mse", "rmse", "r_squared")


def classification_metrics(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Full two-class report from one aggregate of four counts. ``roc_auc`` is that of the hard labels."""
    y, p = F.col(label) == 1, F.col(pred) == 1
    counts = df.groupBy(*by).agg(
        F.count_if(y & p).alias("true_positive"), F.count_if(~y & ~p).alias("true_negative"),
        F.count_if(~y & p).alias("false_positive"), F.count_if(y & ~p).alias("false_negative"))
    tp, tn, fp, fn = (F.col(c).cast("double") for c in
                      ("true_positive", "true_negative", "false_positive", "false_negative"))

    def f1(prec: Column, rec: Column) -> Column:
        return F.try_divide(2 * prec * rec, prec + rec)

    out = counts.withColumns({
        "support_1": F.col("true_positive") + F.col("false_negative"),
        "support_0": F.col("true_negative") + F.col("false_positive"),
        "accuracy": F.try_divide(tp + tn, tp + tn + fp + fn),
        "precision_1": F.try_divide(tp, tp + fp), "recall_1": F.try_divide(tp, tp + fn),
        "precision_0": F.try_divide(tn, tn + fn), "recall_0": F.try_divide(tn, tn + fp),
        "mcc": F.try_divide(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)))})
    out = out.withColumns({f"f1_{c}": f1(F.col(f"precision_{c}"), F.col(f"recall_{c}")) for c in (1, 0)})
    both = {}
    for m in ("precision", "recall", "f1"):
        one, zero = F.col(f"{m}_1"), F.col(f"{m}_0")
        s1, s0 = F.col("support_1"), F.col("support_0")
        both[f"{m}_macro"] = (one + zero) / 2
        both[f"{m}_weighted"] = (one * s1 + zero * s0) / (s1 + s0)
    both["roc_auc"] = (F.col("recall_1") + F.col("recall_0")) / 2
    return out.withColumns(both)


def classification_report(metrics: DataFrame) -> DataFrame:
    """Rows class 0, class 1, macro and weighted of a one-row metrics frame."""
    n = F.col("support_0") + F.col("support_1")
    rows = [F.struct(F.lit(name).alias("row"), F.col(f"precision_{k}").alias("precision"),
                     F.col(f"recall_{k}").alias("recall"), F.col(f"f1_{k}").alias("f1"), s.alias("support"))
            for name, k, s in (("class 0", "0", F.col("support_0")), ("class 1", "1", F.col("support_1")),
                               ("macro avg", "macro", n), ("weighted avg", "weighted", n))]
    return metrics.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def confusion_matrix(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.groupBy(F.col(pred).alias("pred"), F.col(label).alias("true")).agg(F.count("*").alias("n"))


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, from the highest down.

    Rows are first reduced to counts per score; running totals over range chunks replace one big
    window. The start point (no positives predicted) has a null threshold.
    """
    y = (F.col(label) == 1).cast("long")
    counts = df.groupBy((-F.col(score).cast("double")).alias("neg")).agg(
        F.sum(y).alias("pos"), F.sum(1 - y).alias("rest"))
    runs = running_totals(counts, ["neg"], {"tp": "pos", "fp": "rest"})
    rates = runs.select((-F.col("neg")).alias("threshold"),
                        F.try_divide("fp", "total_fp").alias("fpr"), F.try_divide("tp", "total_tp").alias("tpr"))
    start = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"),
                                            F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(rates)


def operating_point(roc: DataFrame, fpr: float) -> DataFrame:
    """The last point of the curve whose false-positive rate does not exceed the target."""
    last = F.struct("fpr", "tpr", F.coalesce(-F.col("threshold"), F.lit(float("-inf"))))
    return roc.filter(F.col("fpr") <= fpr).agg(F.max_by(F.struct("threshold", "fpr", "tpr"), last).alias("p")).select("p.*")


def regression_metrics(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """MAE, MAPE, median errors, MSE, RMSE and R-squared."""
    err = F.abs(F.col(y) - F.col(yhat))
    rows = df.select(F.col(y).cast("double").alias("y"), err.alias("ae"), F.try_divide(err, F.abs(y)).alias("ape"))
    one = rows.agg(F.count("*").alias("n"), F.avg("ae").alias("mae"), F.avg("ape").alias("mape"),
                   F.avg(F.col("ae") * F.col("ae")).alias("mse"), F.var_pop("y").alias("__var"))
    med = exact_quantiles(rows, ["ae", "ape"], (0.5,)).agg(
        F.max(F.when(F.col("column") == "ae", F.col("q0"))).alias("mdae"),
        F.max(F.when(F.col("column") == "ape", F.col("q0"))).alias("mdape"))
    point = med.select(F.struct("mdae", "mdape").alias("m")).scalar()
    return one.select("n", "mae", "mape", point["mdae"].alias("mdae"), point["mdape"].alias("mdape"), "mse",
                      F.sqrt("mse").alias("rmse"), (1 - F.try_divide("mse", "__var")).alias("r_squared"))


def adjusted_r2(metrics: DataFrame, p: int, r2: str = "r_squared", n: str = "n") -> DataFrame:
    return metrics.withColumn("adjusted_r2", 1 - (1 - F.col(r2)) * (F.col(n) - 1) / (F.col(n) - F.lit(p) - 1))


def compare_models(scores: DataFrame, metric: str, largest: bool = True) -> DataFrame:
    return scores.orderBy(F.desc(metric) if largest else F.asc(metric))


def predict_at(df: DataFrame, threshold: float, prob: str = "probability", out: str = "prediction") -> DataFrame:
    """1 where the probability of the positive class reaches the threshold."""
    return df.withColumn(out, F.when(vector_to_array(prob)[1] >= threshold, 1).otherwise(0))
