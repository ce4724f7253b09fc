"""Encoders, prediction scores, run tables and baskets."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.catalog.profile import rounded
from tallyfold.catalog.registry import LINE_ID, Tables, h32, query
from tallyfold.operators import baskets as B
from tallyfold.operators import encode as E
from tallyfold.operators import metrics as K
from tallyfold.operators import runs as R
from tallyfold.operators.sampling import stratified_holdout
from tallyfold.session import shared_folder
from tallyfold.sources import io

# --- encoders: fitted on lines of even parts, applied to all lines ------------------------------


def lines(t: Tables) -> DataFrame:
    return t.lineitem.select(F.expr(LINE_ID).alias("id"), "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                             "l_linestatus", "l_linenumber", (F.col("l_returnflag") == "R").cast("int").alias("y"),
                             F.concat(F.lit("B"), (F.col("l_partkey") % 30).cast("string")).alias("brand"))


_LINES = (f"s AS (SELECT {LINE_ID} AS id, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus, l_linenumber, "
          "(l_returnflag = 'R')::INT AS y, concat('B', l_partkey % 30) AS brand FROM lineitem), tr AS (FROM s WHERE l_partkey % 30 < 25)")


def _train(df: DataFrame) -> DataFrame:
    return df.filter(F.col("l_partkey") % 30 < 25)


@query("ordinal_encode", f"WITH {_LINES}, c AS (SELECT brand, row_number() OVER (ORDER BY brand) - 1 AS code FROM (SELECT DISTINCT brand FROM tr)), "
       "n AS (SELECT l_linenumber, row_number() OVER (ORDER BY l_linenumber) - 1 AS code FROM (SELECT DISTINCT l_linenumber FROM tr)) "
       "SELECT id, coalesce(c.code, -1)::DOUBLE AS brand, coalesce(n.code, -1)::DOUBLE AS l_linenumber FROM s LEFT JOIN c USING (brand) "
       "LEFT JOIN n USING (l_linenumber)")
def ordinal_encode(t: Tables) -> DataFrame:
    df = lines(t)
    return E.OrdinalEncoder(["brand", "l_linenumber"]).fit(_train(df)).transform(df).select("id", "brand", "l_linenumber")


@query("label_encode", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END::DOUBLE AS o_orderstatus FROM orders")
def label_encode(t: Tables) -> DataFrame:
    return E.LabelEncode("o_orderstatus").fit(t.orders).transform(t.orders).select("o_orderkey", "o_orderstatus")


@query("one_hot", f"WITH {_LINES}, c AS (SELECT brand, row_number() OVER (ORDER BY brand) - 1 AS code FROM (SELECT DISTINCT brand FROM tr)) "
       "SELECT id, (c.code IS NOT NULL)::INT::DOUBLE AS filled, coalesce(c.code, -1)::INT AS slot, (SELECT count(*) FROM c)::INT AS width "
       "FROM s LEFT JOIN c USING (brand)")
def one_hot(t: Tables) -> DataFrame:
    df = lines(t)
    hot = vector_to_array("brand_hot")
    out = E.OneHot(["brand"]).fit(_train(df)).transform(df).withColumn("v", hot)
    return out.select("id", F.aggregate("v", F.lit(0.0), lambda a, b: a + b).alias("filled"),
                      (F.array_position("v", F.lit(1.0)) - 1).cast("int").alias("slot"), F.size("v").alias("width"))


def _shrink(n: str, s: str, q: str, m: str, v: str) -> str:
    var = f"greatest({q} / {n} - ({s} / {n}) * ({s} / {n}), 0)"
    w = f"({n} * {v} / ({n} * {v} + {var}))"
    return f"{w} * ({s} / {n}) + (1 - {w}) * {m}"


def _target(y: str) -> str:
    return f"""{_LINES}, p AS (SELECT avg({y}) AS m, var_pop({y}) AS v FROM tr),
c AS (SELECT brand, count(*)::DOUBLE AS n, sum({y})::DOUBLE AS s, sum({y} * {y})::DOUBLE AS q FROM tr GROUP BY 1)
SELECT id, round(coalesce({_shrink('n', 's', 'q', 'm', 'v')}, m), 8) AS brand FROM s JOIN p ON TRUE LEFT JOIN c USING (brand)"""


@query("target_encode", "WITH " + _target("y"))
def target_encode(t: Tables) -> DataFrame:
    df = lines(t)
    out = E.TargetEncode(["brand"], "y").fit(_train(df), "id").transform(df)
    return out.select("id", F.round("brand", 8).alias("brand"))


@query("target_encode_continuous", "WITH " + _target("l_extendedprice").replace(", 8) AS brand", ", 4) AS brand"))
def target_encode_continuous(t: Tables) -> DataFrame:
    df = lines(t)
    out = E.TargetEncode(["brand"], "l_extendedprice").fit(_train(df), "id").transform(df)
    return out.select("id", F.round("brand", 4).alias("brand"))


@query("target_encode_cross_fitted", f"""WITH {_LINES}, f AS (SELECT *, ({h32('id')}) % 5 AS fold FROM tr),
g AS (SELECT fold, count(*)::DOUBLE AS n, sum(y)::DOUBLE AS s FROM f GROUP BY 1),
o AS (SELECT a.fold, sum(b.s) / sum(b.n) AS m, sum(b.s) / sum(b.n) - (sum(b.s) / sum(b.n)) ** 2 AS v FROM g a JOIN g b ON a.fold <> b.fold GROUP BY 1),
c AS (SELECT brand, fold, count(*)::DOUBLE AS n, sum(y)::DOUBLE AS s FROM f GROUP BY 1, 2),
w AS (SELECT a.brand, a.fold, sum(b.n) AS n, sum(b.s) AS s FROM c a JOIN c b ON a.brand = b.brand AND a.fold <> b.fold GROUP BY 1, 2)
SELECT id, round(coalesce({_shrink('w.n', 'w.s', 'w.s', 'm', 'v')}, m), 8) AS brand FROM f JOIN o USING (fold) LEFT JOIN w USING (brand, fold)""")
def target_encode_cross_fitted(t: Tables) -> DataFrame:
    out = E.TargetEncode(["brand"], "y").fit_transform(_train(lines(t)), "id")
    return out.select("id", F.round("brand", 8).alias("brand"))


@query("standard_scale", f"WITH {_LINES}, p AS (SELECT avg(l_quantity) AS a, stddev_pop(l_quantity) AS b, avg(l_tax) AS c, stddev_pop(l_tax) AS d FROM tr) "
       "SELECT id, round((l_quantity - a) / b, 8) AS l_quantity, round((l_tax - c) / d, 8) AS l_tax FROM s, p")
def standard_scale(t: Tables) -> DataFrame:
    df = lines(t)
    out = E.StandardScale(["l_quantity", "l_tax"]).fit(_train(df)).transform(df)
    return rounded(out.select("id", "l_quantity", "l_tax"), ("l_quantity", "l_tax"), 8)


@query("minmax_scale", f"WITH {_LINES}, p AS (SELECT min(l_extendedprice) AS a, max(l_extendedprice) AS b FROM tr) "
       "SELECT id, round((l_extendedprice - a) / (b - a), 9) AS l_extendedprice FROM s, p")
def minmax_scale(t: Tables) -> DataFrame:
    df = lines(t)
    out = E.MinMaxScale(["l_extendedprice"]).fit(_train(df)).transform(df)
    return rounded(out.select("id", "l_extendedprice"), ("l_extendedprice",), 9)


@query("target_scale", "SELECT o_orderkey, round(ln(1 + o_totalprice), 9) AS logged, round((o_totalprice - (SELECT min(o_totalprice) FROM orders)) / "
       "(SELECT max(o_totalprice) - min(o_totalprice) FROM orders), 9) AS scaled, round(o_totalprice, 4) AS back FROM orders")
def target_scale(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", F.col("o_totalprice").alias("logged"), F.col("o_totalprice").alias("scaled"))
    log, mm = E.TargetScale("log1p", "logged").fit(o), E.TargetScale("minmax", "scaled").fit(o)
    out = mm.transform(log.transform(o)).withColumn("back", F.col("scaled"))
    out = mm.inverse(out, "back")
    return rounded(rounded(out, ("logged", "scaled"), 9), ("back",), 4)


_RECIPE_SQL = f"""WITH {_LINES}, c AS (SELECT brand, row_number() OVER (ORDER BY brand) - 1 AS code FROM (SELECT DISTINCT brand FROM tr)),
e AS (SELECT s.*, coalesce(code, -1)::DOUBLE AS b FROM s LEFT JOIN c USING (brand)), et AS (FROM e WHERE l_partkey % 30 < 25),
p AS (SELECT min(b) AS b0, max(b) - min(b) AS bw, min(l_quantity) AS q0, max(l_quantity) - min(l_quantity) AS qw FROM et)
SELECT id, round((b - b0) / bw, 8) AS f0, round((l_quantity - q0) / qw, 8) AS f1 FROM e, p"""


@query("recipe_features", _RECIPE_SQL)
def recipe_features(t: Tables) -> DataFrame:
    """Encoding 6: codes, standardised numbers, everything to [0, 1]; fitted on the training part only."""
    df = lines(t)
    model = E.recipe("classification", 6, ["brand"], ["l_quantity"], "y", "id")
    model.fit_transform(_train(df))
    x = vector_to_array("features")
    return model.transform(df).select("id", F.round(x[0], 8).alias("f0"), F.round(x[1], 8).alias("f1"))


@query("saved_recipe", _RECIPE_SQL)
def saved_recipe(t: Tables) -> DataFrame:
    """The same encoding fitted, saved, loaded and only then applied."""
    df, path = lines(t), f"{shared_folder(t.spark)}/tallyfold/recipe-{uuid.uuid4().hex}"
    model = E.recipe("classification", 6, ["brand"], ["l_quantity"], "y", "id")
    model.fit_transform(_train(df))
    io.save_fitted(t.spark, model, path)
    x = vector_to_array("features")
    return io.load_fitted(t.spark, path).transform(df).select("id", F.round(x[0], 8).alias("f0"), F.round(x[1], 8).alias("f1"))


@query("svd_features")
def svd_features(t: Tables) -> DataFrame:
    """Regression encoding 2: one-hot, then as many singular directions as categorical columns."""
    model = E.recipe("regression", 2, ["l_linestatus", "brand"], ["l_quantity"], "l_extendedprice", "id")
    return model.fit_transform(lines(t)).select("id", rounded_vector("features").alias("features"))


def rounded_vector(col: str):
    return F.transform(vector_to_array(col), lambda v: F.round(v, 6))


# --- prediction scores --------------------------------------------------------------------------

_SCORED = "p AS (SELECT (l_returnflag = 'R')::INT AS y, (l_quantity > 25)::INT AS pred, l_discount * 10 AS score FROM lineitem)"
_REPORT = f"""WITH {_SCORED}, c AS (SELECT count(*) FILTER (y = 1 AND pred = 1) AS tp, count(*) FILTER (y = 0 AND pred = 0) AS tn,
count(*) FILTER (y = 0 AND pred = 1) AS fp, count(*) FILTER (y = 1 AND pred = 0) AS fn FROM p),
a AS (SELECT *, tp + fn AS s1, tn + fp AS s0, tp / (tp + fp) AS p1, tp / (tp + fn) AS r1, tn / (tn + fn) AS p0, tn / (tn + fp) AS r0 FROM c),
m AS (SELECT *, 2 * p1 * r1 / (p1 + r1) AS f1, 2 * p0 * r0 / (p0 + r0) AS f0 FROM a)"""


def _scored(t: Tables) -> DataFrame:
    return t.lineitem.select((F.col("l_returnflag") == "R").cast("int").alias("y"), (F.col("l_quantity") > 25).cast("int").alias("pred"),
                             (F.col("l_discount") * 10).alias("score"))


@query("classification_metrics", _REPORT + " SELECT tp AS true_positive, tn AS true_negative, fp AS false_positive, fn AS false_negative, "
       "s1 AS support_1, s0 AS support_0, " + ", ".join(f"round({e}, 9) AS {n}" for n, e in {
           "accuracy": "(tp + tn) / (s1 + s0)", "precision_1": "p1", "recall_1": "r1", "f1_1": "f1", "precision_0": "p0", "recall_0": "r0",
           "f1_0": "f0", "precision_macro": "(p1 + p0) / 2", "recall_macro": "(r1 + r0) / 2", "f1_macro": "(f1 + f0) / 2",
           "precision_weighted": "(p1 * s1 + p0 * s0) / (s1 + s0)", "recall_weighted": "(r1 * s1 + r0 * s0) / (s1 + s0)",
           "f1_weighted": "(f1 * s1 + f0 * s0) / (s1 + s0)", "roc_auc": "(r1 + r0) / 2",
           "mcc": "(tp::DOUBLE * tn - fp::DOUBLE * fn) / sqrt((tp + fp)::DOUBLE * (tp + fn) * (tn + fp) * (tn + fn))"}.items()) + " FROM m")
def classification_metrics(t: Tables) -> DataFrame:
    return rounded(K.classification_metrics(_scored(t), "y", "pred"), K.CLASS_METRICS, 9)


@query("classification_report", _REPORT + """ SELECT "row", round(pr, 9) AS precision, round(rc, 9) AS recall, round(f, 9) AS f1, sp AS support FROM (
SELECT 'class 0' AS "row", p0 AS pr, r0 AS rc, f0 AS f, s0 AS sp FROM m UNION ALL SELECT 'class 1', p1, r1, f1, s1 FROM m
UNION ALL SELECT 'macro avg', (p1 + p0) / 2, (r1 + r0) / 2, (f1 + f0) / 2, s1 + s0 FROM m UNION ALL SELECT 'weighted avg',
(p1 * s1 + p0 * s0) / (s1 + s0), (r1 * s1 + r0 * s0) / (s1 + s0), (f1 * s1 + f0 * s0) / (s1 + s0), s1 + s0 FROM m)""")
def classification_report(t: Tables) -> DataFrame:
    return rounded(K.classification_report(K.classification_metrics(_scored(t), "y", "pred")), ("precision", "recall", "f1"), 9)


@query("confusion_matrix", f'WITH {_SCORED} SELECT pred, y AS "true", count(*) AS n FROM p GROUP BY 1, 2')
def confusion_matrix(t: Tables) -> DataFrame:
    return K.confusion_matrix(_scored(t), "y", "pred")


_ROC = f"""WITH {_SCORED}, g AS (SELECT score, sum(y) AS pos, count(*) - sum(y) AS neg FROM p GROUP BY 1),
roc AS (SELECT score AS threshold, sum(neg) OVER (ORDER BY score DESC) / (SELECT sum(neg) FROM g) AS fpr,
sum(pos) OVER (ORDER BY score DESC) / (SELECT sum(pos) FROM g) AS tpr FROM g UNION ALL SELECT NULL, 0, 0)"""


@query("roc_curve", _ROC + " SELECT round(threshold, 9) AS threshold, round(fpr, 9) AS fpr, round(tpr, 9) AS tpr FROM roc")
def roc_curve(t: Tables) -> DataFrame:
    return rounded(K.roc_curve(_scored(t), "y", "score"), ("threshold", "fpr", "tpr"), 9)


@query("operating_point", _ROC + " SELECT round(threshold, 9) AS threshold, round(fpr, 9) AS fpr, round(tpr, 9) AS tpr FROM roc "
       "WHERE fpr <= 0.3 ORDER BY roc.fpr DESC, roc.tpr DESC LIMIT 1")
def operating_point(t: Tables) -> DataFrame:
    return rounded(K.operating_point(K.roc_curve(_scored(t), "y", "score"), 0.3), ("threshold", "fpr", "tpr"), 9)


_REGRESSION = """WITH e AS (SELECT l_extendedprice AS y, abs(l_extendedprice - l_quantity * 2000) AS ae, abs(l_extendedprice - l_quantity * 2000)
/ abs(l_extendedprice) AS ape FROM lineitem), m AS (SELECT count(*) AS n, avg(ae) AS mae, avg(ape) AS mape, median(ae) AS mdae, median(ape) AS mdape,
avg(ae * ae) AS mse, sqrt(avg(ae * ae)) AS rmse, 1 - avg(ae * ae) / var_pop(y) AS r_squared FROM e)"""


@query("regression_metrics", _REGRESSION + " SELECT n, round(mae, 4) AS mae, round(mape, 8) AS mape, round(mdae, 4) AS mdae, round(mdape, 8) AS mdape, "
       "round(mse, 1) AS mse, round(rmse, 4) AS rmse, round(r_squared, 9) AS r_squared, round(1 - (1 - r_squared) * (n - 1) / (n - 3), 9) AS adjusted_r2 FROM m")
def regression_metrics(t: Tables) -> DataFrame:
    df = t.lineitem.select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 2000).alias("p"))
    out = K.adjusted_r2(K.regression_metrics(df, "y", "p"), 2)
    out = rounded(rounded(out, ("mae", "mdae", "rmse"), 4), ("mape", "mdape"), 8)
    return rounded(rounded(out, ("mse",), 1), ("r_squared", "adjusted_r2"), 9)


# --- run tables ---------------------------------------------------------------------------------

_METRICS = ("f1_macro", "roc_auc", "mae", "mape", "r_squared", "fit_time", "score_time")
# A run table from events: five experiments, one model per event type, a new parent each three days, folds by event id.
_RUN_COLS = {
    "experiment": "CAST(user_id % 5 AS INT)", "model": "event_type",
    "round": "CAST(floor((extract(DAY FROM ts) - 1) / 3.0) AS INT)",
    "child": "CASE WHEN event_id % 6 = 0 THEN 'validation' ELSE concat('fold_', event_id % 6) END",
}
# The odd divisors keep means from ending exactly on a rounding boundary.
_CHILD_AGG = {
    "f1_macro": "avg(value) / 97.3", "roc_auc": "max(value)", "mae": "min(value)", "mape": "sum(value)", "r_squared": "avg(value) / 97.3 - 1.5",
    "fit_time": "CAST(count(*) AS DOUBLE) * 1000000", "score_time": "avg(value) / 0.00973",
}
_RUN_ID = "concat(experiment, '/', model, '/', round)"
_RUNS = ("ev AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in _RUN_COLS.items()) + ", ts, value FROM events), "
         + "kids AS (SELECT experiment, concat(" + _RUN_ID[7:-1] + ", '/', child) AS run_id, " + _RUN_ID + " AS parent_run_id, child AS name, "
         + "min(ts) AS start_time, " + ", ".join(f"{e} AS {m}" for m, e in _CHILD_AGG.items())
         + " FROM ev GROUP BY experiment, model, round, child), "
         + "parents AS (SELECT experiment, " + _RUN_ID + " AS run_id, CAST(NULL AS VARCHAR(10)) AS parent_run_id, CASE WHEN model = 'error' THEN 'Encoders' "
         + "ELSE model END AS name, min(ts) AS start_time, " + ", ".join(f"CAST(NULL AS DOUBLE) AS {m}" for m in _METRICS)
         + " FROM ev GROUP BY experiment, model, round), runs AS (SELECT * FROM kids UNION ALL SELECT * FROM parents)")


def run_table(t: Tables) -> DataFrame:
    return t.spark.sql(f"WITH {_RUNS} SELECT * FROM runs".replace("FROM events", "FROM {events}"), events=t.events)


_LATEST = """latest AS (SELECT experiment, run_id AS parent_id, name AS parent_name FROM runs WHERE parent_run_id IS NULL AND name <> 'Encoders'
QUALIFY row_number() OVER (PARTITION BY experiment, name ORDER BY start_time DESC, run_id) = 1)"""
_AGG = ", ".join(f"avg(r.{m}) AS {m}_mean, stddev_samp(r.{m}) AS {m}_std" for m in _METRICS)
_CV = f"""{_LATEST}, cv AS (SELECT r.experiment, parent_id, parent_name, array_to_string(list_sort(list(r.name)), ',') AS nested_run_names, {_AGG}
FROM runs r JOIN latest ON parent_run_id = parent_id WHERE r.name NOT IN ('validation', 'testing') GROUP BY 1, 2, 3)"""
_STATS = [f"{m}_{k}" for m in _METRICS for k in ("mean", "std")]
_ROUND = ", ".join(f"round({c}, 6) AS {c}" for c in _STATS)


def _cv(t: Tables) -> DataFrame:
    return R.cv_metrics_by_task(run_table(t), _METRICS)


@query("latest_parents", f"WITH {_RUNS}, {_LATEST} SELECT * FROM latest")
def latest_parents(t: Tables) -> DataFrame:
    return R.latest_parents(run_table(t))


@query("latest_run_by_name", f"WITH {_RUNS} SELECT name, run_id FROM runs QUALIFY row_number() OVER (PARTITION BY name ORDER BY start_time DESC, run_id) = 1")
def latest_run_by_name(t: Tables) -> DataFrame:
    return R.latest_run_by_name(run_table(t)).select("name", "run_id")


@query("cv_metrics_by_task", f"WITH {_RUNS}, {_CV} SELECT experiment, parent_id, parent_name, nested_run_names, {_ROUND} FROM cv")
def cv_metrics_by_task(t: Tables) -> DataFrame:
    return rounded(_cv(t).withColumn("nested_run_names", F.array_join("nested_run_names", ",")), _STATS)


@query("cv_metrics_by_model", f"""WITH {_RUNS}, pa AS (SELECT run_id AS parent_id FROM runs WHERE parent_run_id IS NULL AND name = 'click'),
cv AS (SELECT r.experiment, parent_id, {_AGG} FROM runs r JOIN pa ON parent_run_id = parent_id WHERE r.name LIKE 'fold%' GROUP BY 1, 2)
SELECT experiment, parent_id, {_ROUND} FROM cv""")
def cv_metrics_by_model(t: Tables) -> DataFrame:
    return rounded(R.cv_metrics_by_model(run_table(t), _METRICS, "click").drop("nested_run_names"), _STATS)


@query("validation_metrics", f"""WITH {_RUNS}, {_LATEST} SELECT parent_id, parent_name, {', '.join(f'round({m}, 6) AS {m}' for m in _METRICS)}
FROM latest LEFT JOIN (SELECT * FROM runs WHERE name = 'validation') v ON v.parent_run_id = parent_id WHERE latest.experiment = 2""")
def validation_metrics(t: Tables) -> DataFrame:
    return rounded(R.val_cv_metrics(run_table(t), 2, _METRICS)[0], _METRICS)


@query("experiment_cv_metrics", f"""WITH {_RUNS}, {_LATEST}, f AS (SELECT parent_run_id AS parent_id, {_AGG} FROM runs r WHERE name LIKE 'fold%' GROUP BY 1)
SELECT parent_id, parent_name, {_ROUND} FROM latest LEFT JOIN f USING (parent_id) WHERE experiment = 2""")
def experiment_cv_metrics(t: Tables) -> DataFrame:
    return rounded(R.val_cv_metrics(run_table(t), 2, _METRICS)[1], _STATS)


@query("child_runs", f"WITH {_RUNS} SELECT run_id, parent_run_id, name FROM runs WHERE parent_run_id IS NOT NULL AND name LIKE 'fold%'")
def child_runs(t: Tables) -> DataFrame:
    return R.child_runs(run_table(t), prefix="fold").select("run_id", "parent_run_id", "name")


@query("mean_over_folds", f"WITH {_RUNS} SELECT experiment, parent_run_id, " + ", ".join(f"round(avg({m}), 6) AS {m}" for m in _METRICS)
       + " FROM runs WHERE name LIKE 'fold%' GROUP BY 1, 2")
def mean_over_folds(t: Tables) -> DataFrame:
    folds = R.child_runs(run_table(t), prefix="fold")
    return rounded(R.mean_over_folds(folds, ["experiment", "parent_run_id"], _METRICS), _METRICS)


@query("fold_stability", f"WITH {_RUNS} SELECT experiment, parent_run_id, name, metric, round(value, 6) AS value FROM "
       "(SELECT experiment, parent_run_id, name, f1_macro, roc_auc FROM runs WHERE name LIKE 'fold%') UNPIVOT (value FOR metric IN (f1_macro, roc_auc))")
def fold_stability(t: Tables) -> DataFrame:
    return rounded(R.fold_stability(run_table(t), ["f1_macro", "roc_auc"]), ("value",))


def _pick(m: str, order: str, side: str, mean: str = "", std: str = "", extra: str = "") -> str:
    return (f"(SELECT experiment, parent_name, '{m}' AS metric, '{side}' AS side, {mean or m + '_mean'} AS mean, {std or m + '_std'} AS std{extra} FROM cv "
            f"QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY {m}_mean {order} NULLS LAST, parent_name) = 1)")


_INDEX = "ix AS (SELECT experiment, row_number() OVER (ORDER BY experiment) AS experiment_idx FROM (SELECT DISTINCT experiment FROM cv))"
_FMT = "printf('%.4f', mean) || ' ± ' || printf('%.4f', std) AS formatted, experiment_idx"


@query("summarize_classification", f"WITH {_RUNS}, {_CV}, {_INDEX}, u AS (" + " UNION ALL ".join(
    _pick(m, o, s) for m in ("f1_macro", "roc_auc") for o, s in (("DESC", "best"), ("", "worst")))
    + f") SELECT experiment, parent_name, metric, side, round(mean, 6) AS mean, round(std, 6) AS std, {_FMT} FROM u JOIN ix USING (experiment)")
def summarize_classification(t: Tables) -> DataFrame:
    return rounded(R.summarize_classification(_cv(t)), ("mean", "std"))


def _capped(m: str, side: str) -> str:
    if side == "best":
        return f", {m}_mean AS mean_capped, {m}_std AS std_capped"
    mean = f"greatest({m}_mean, -1)" if m == "r_squared" else f"{m}_mean"
    return f", {mean} AS mean_capped, CASE WHEN abs({m}_std) >= abs({mean}) THEN 0.99 * abs({mean}) ELSE {m}_std END AS std_capped"


@query("summarize_regression", f"WITH {_RUNS}, {_CV}, {_INDEX}, u AS (" + " UNION ALL ".join(
    _pick(m, o, s, extra=_capped(m, s)) for m, asc in (("mae", True), ("mape", True), ("r_squared", False))
    for o, s in ((("" if asc else "DESC"), "best"), (("DESC" if asc else ""), "worst")))
    + ") SELECT experiment, parent_name, metric, side, round(mean, 6) AS mean, round(std, 6) AS std, round(mean_capped, 6) AS mean_capped, "
    f"round(std_capped, 6) AS std_capped, {_FMT} FROM u JOIN ix USING (experiment)")
def summarize_regression(t: Tables) -> DataFrame:
    return rounded(R.summarize_regression(_cv(t)), ("mean", "std", "mean_capped", "std_capped"))


@query("summarize_resource", f"WITH {_RUNS}, {_CV}, {_INDEX}, u AS (" + " UNION ALL ".join(
    _pick(m, o, s, f"{m}_mean / 1e6", f"{m}_std / 1e6") for m in ("fit_time", "score_time") for o, s in (("", "best"), ("DESC", "worst")))
    + f") SELECT experiment, parent_name, metric, side, round(mean, 9) AS mean, round(std, 9) AS std, {_FMT} FROM u JOIN ix USING (experiment)")
def summarize_resource(t: Tables) -> DataFrame:
    return rounded(R.summarize_resource(_cv(t)), ("mean", "std"), 9)


@query("metric_by_experiment", f"WITH {_RUNS}, {_CV} SELECT experiment, parent_id, parent_name, metric, round(mean, 6) AS mean, round(CASE WHEN abs(std) > "
       "abs(mean) THEN 0.99 * abs(mean) ELSE std END, 6) AS std FROM (" + " UNION ALL ".join(
           f"SELECT experiment, parent_id, parent_name, '{m}' AS metric, {'greatest(r_squared_mean, -1)' if m == 'r_squared' else m + '_mean'} AS mean, {m}_std AS std FROM cv" for m in ("f1_macro", "mape", "r_squared")) + ")")
def metric_by_experiment(t: Tables) -> DataFrame:
    return rounded(R.metric_by_experiment(_cv(t), ["f1_macro", "mape", "r_squared"]), ("mean", "std"))


@query("compare_models", f"WITH {_RUNS}, {_CV} SELECT experiment, parent_name, round(f1_macro_mean, 6) AS f1_macro_mean FROM cv ORDER BY f1_macro_mean DESC")
def compare_models(t: Tables) -> DataFrame:
    return rounded(K.compare_models(_cv(t), "f1_macro_mean").select("experiment", "parent_name", "f1_macro_mean"), ("f1_macro_mean",))


# --- baskets ------------------------------------------------------------------------------------

_BASKETS = "i AS (SELECT DISTINCT l_orderkey AS txn, p_brand AS item FROM lineitem JOIN part ON l_partkey = p_partkey)"


def _items(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return B.baskets(rows, "l_orderkey", "p_brand")


@query("baskets", f"WITH {_BASKETS} SELECT txn AS l_orderkey, string_agg(item, ',' ORDER BY item) AS items FROM i GROUP BY 1")
def baskets(t: Tables) -> DataFrame:
    return _items(t).withColumn("items", F.array_join("items", ","))


@query("clean_basket_lines", """SELECT DISTINCT o_custkey, brand FROM (SELECT o_custkey, CASE WHEN l_partkey % 11 = 0 THEN '' WHEN l_partkey % 13 = 0 THEN NULL
ELSE p_brand END AS brand, l_quantity - 3 AS q, l_extendedprice AS p FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)
WHERE brand <> '' AND q > 0 AND p > 0""")
def clean_basket_lines(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    brand = F.when(F.col("l_partkey") % 11 == 0, "").when(F.col("l_partkey") % 13 != 0, F.col("p_brand"))
    rows = rows.select("o_custkey", brand.alias("brand"), (F.col("l_quantity") - 3).alias("q"), F.col("l_extendedprice").alias("p"))
    return B.clean_lines(rows, "o_custkey", "brand", "q", "p").select("o_custkey", "brand")


_SETS = f"""{_BASKETS}, n AS (SELECT count(DISTINCT txn) AS total FROM i), one AS (SELECT item, count(*) AS freq FROM i GROUP BY 1),
two AS (SELECT a.item AS x, b.item AS y, count(*) AS freq FROM i a JOIN i b ON a.txn = b.txn AND a.item < b.item GROUP BY 1, 2),
three AS (SELECT a.item AS x, b.item AS y, c.item AS z, count(*) AS freq FROM i a JOIN i b ON a.txn = b.txn AND a.item < b.item
JOIN i c ON a.txn = c.txn AND b.item < c.item GROUP BY 1, 2, 3),
four AS (SELECT a.item AS x, b.item AS y, c.item AS z, d.item AS u, count(*) AS freq FROM i a JOIN i b ON a.txn = b.txn AND a.item < b.item
JOIN i c ON a.txn = c.txn AND b.item < c.item JOIN i d ON a.txn = d.txn AND c.item < d.item GROUP BY 1, 2, 3, 4),
sets AS (SELECT item AS items, freq, 1 AS len FROM one UNION ALL SELECT x || ',' || y, freq, 2 FROM two UNION ALL SELECT x || ',' || y || ',' || z, freq, 3 FROM three
UNION ALL SELECT x || ',' || y || ',' || z || ',' || u, freq, 4 FROM four)"""


@query("frequent_itemsets", f"WITH {_SETS} SELECT items, freq, round(freq / total, 9) AS support FROM sets, n WHERE freq >= ceil(0.01 * total)")
def frequent_itemsets(t: Tables) -> DataFrame:
    out = B.frequent_itemsets(_items(t), 0.01).withColumn("items", F.array_join("items", ","))
    return rounded(out, ("support",), 9)


@query("association_rules", f"""WITH {_SETS}, ways AS (SELECT x AS a, y AS c, freq FROM two UNION ALL SELECT y, x, freq FROM two
UNION ALL SELECT x || ',' || y, z, freq FROM three UNION ALL SELECT x || ',' || z, y, freq FROM three UNION ALL SELECT y || ',' || z, x, freq FROM three
UNION ALL SELECT x || ',' || y || ',' || z, u, freq FROM four UNION ALL SELECT x || ',' || y || ',' || u, z, freq FROM four
UNION ALL SELECT x || ',' || z || ',' || u, y, freq FROM four UNION ALL SELECT y || ',' || z || ',' || u, x, freq FROM four)
SELECT a AS antecedent, c AS consequent, round(p.freq / o.freq, 9) AS confidence, round(p.freq / o.freq / (k.freq / total), 8) AS lift,
round(p.freq / total, 9) AS support FROM ways p JOIN sets o ON o.items = a JOIN one k ON k.item = c, n
WHERE p.freq >= ceil(0.01 * total) AND p.freq / o.freq >= 0.15""")
def association_rules(t: Tables) -> DataFrame:
    out = B.association_rules(_items(t), 0.01, 0.15)
    return out.select(F.array_join("antecedent", ",").alias("antecedent"), F.array_join("consequent", ",").alias("consequent"),
                      F.round("confidence", 9).alias("confidence"), F.round("lift", 8).alias("lift"), F.round("support", 9).alias("support"))


@query("imbalanced_holdout", f"""WITH r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {h32('doc_id')}, doc_id) AS rk,
count(*) OVER (PARTITION BY quality) AS n FROM labels), z AS (SELECT *, (n * 30 + 100) // 200 AS nt FROM r)
SELECT doc_id, quality, CASE WHEN rk <= nt THEN 'test' WHEN rk <= nt + ((n - nt) * 30 + 85) // 170 THEN 'val' ELSE 'train' END AS holdout FROM z""")
def imbalanced_holdout(t: Tables) -> DataFrame:
    return stratified_holdout(t.labels, "doc_id", ["quality"]).select("doc_id", "quality", "holdout")
