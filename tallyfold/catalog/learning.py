"""Models, tuning and interpretation. Linear and naive Bayes fits have closed forms in SQL; the rest do not."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.catalog.profile import rounded
from tallyfold.catalog.registry import LINE_ID, Tables, h32, query
from tallyfold.operators import interpret, models, sampling, tuning
from tallyfold.operators import metrics as K
from tallyfold.operators.encode import assemble
from tallyfold.operators.isotonic import fit_isotonic
from tallyfold.plans import experiment as X
from tallyfold.session import stage_table

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def rows(t: Tables) -> DataFrame:
    """All lines with a two-class label (net price above 45,000) and an amount to predict."""
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return t.lineitem.select(
        F.expr(LINE_ID).alias("id"), *NUMBERS, "l_returnflag", F.concat(F.lit("B"), (F.col("l_partkey") % 30).cast("string")).alias("brand"),
        (net > 45000).cast("int").alias("y"), (net * (1 + F.col("l_tax"))).alias("amount"))


def plan(t: Tables, strata=("y",)) -> DataFrame:
    return stage_table(sampling.plan_splits(rows(t).repartition("id"), "id", list(strata)), "plan")


def _class_run(t: Tables, name: str, number: int = 4, resampler: str = "none", **params) -> DataFrame:
    """Metrics of one model on the validation split, encoded with a named recipe."""
    fit = X.classifiers("y", "id")[name]
    prepare = X.prepare_with("classification", number, ["brand", "l_returnflag"], NUMBERS, "y", "id", resampler)
    runs = X.run_model(plan(t), name, lambda df: fit(df, **params), prepare, "catalog", "y", splits=["validation"])
    return _metrics(runs)


def _amount_run(t: Tables, name: str, number: int = 8, **params) -> DataFrame:
    """The same for the amount; predictions return to the original scale before they are scored."""
    fit, fitted = X.regressors("amount")[name], {}

    def prepare(train, evaluate):
        model = X.recipe("regression", number, ["brand", "l_returnflag"], NUMBERS, "amount", "id")
        out = model.fit_transform(train).select("id", "amount", "features")
        fitted["model"] = model
        return out, model.transform(evaluate).select("id", "amount", "features")

    runs = tuning.validate(plan(t), name, prepare, lambda df: fit(df, **params),
                           lambda m, df: fitted["model"].inverse_target(m.transform(df)), "catalog", "amount", "regression", ["validation"])
    return _metrics(runs)


def _metrics(runs: DataFrame) -> DataFrame:
    """(split, metric, value); wall times stay out, they differ from run to run."""
    long = runs.filter("parent_run_id is not null").select(F.col("name").alias("split"), F.explode("metrics").alias("metric", "value"))
    return long.filter(~F.col("metric").endswith("_time"))


# --- classifiers --------------------------------------------------------------------------------

@query("logistic_regression")
def logistic_regression(t: Tables) -> DataFrame:
    return _class_run(t, "Logistic Regression", 7)


@query("calibrated_svc")
def calibrated_svc(t: Tables) -> DataFrame:
    return _class_run(t, "Linear SVC", 4)


@query("calibrated_svc_isotonic")
def calibrated_svc_isotonic(t: Tables) -> DataFrame:
    return _class_run(t, "Linear SVC", 4, method="isotonic")


@query("decision_tree")
def decision_tree(t: Tables) -> DataFrame:
    return _class_run(t, "Decision Tree", 1)


@query("random_forest")
def random_forest(t: Tables) -> DataFrame:
    return _class_run(t, "Random Forest", 3)


@query("adaboost")
def adaboost(t: Tables) -> DataFrame:
    return _class_run(t, "AdaBoost", 1)


@query("boosted_depthwise")
def boosted_depthwise(t: Tables) -> DataFrame:
    return _class_run(t, "Boosted Trees (depth-wise)", 1)


@query("boosted_leafy")
def boosted_leafy(t: Tables) -> DataFrame:
    return _class_run(t, "Boosted Trees (leafy)", 1)


@query("boosted_slow")
def boosted_slow(t: Tables) -> DataFrame:
    return _class_run(t, "Boosted Trees (slow)", 1)


@query("resampled_training")
def resampled_training(t: Tables) -> DataFrame:
    return _class_run(t, "Gaussian NB", 4, "over_under")


# The value of an isotonic fit at a point is the largest, over stretches that begin at or before it, of the smallest mean of a stretch that ends at or after it.
@query("isotonic_fit", """WITH p AS (SELECT l_quantity AS x, sum((l_extendedprice * (1 - l_discount) > 45000)::INT * (1 - (l_quantity::INT % 7 = 0)::INT)) AS a, count(*) AS b FROM lineitem GROUP BY 1),
r AS (SELECT x, sum(a) OVER (ORDER BY x) AS ca, sum(b) OVER (ORDER BY x) AS cb, sum(a) OVER (ORDER BY x) - a AS la, sum(b) OVER (ORDER BY x) - b AS lb FROM p),
m AS (SELECT i.x, j.x AS start, min((k.ca - j.la) / (k.cb - j.lb)) AS low FROM r i JOIN r j ON j.x <= i.x JOIN r k ON k.x >= i.x GROUP BY 1, 2)
SELECT x, round(max(low), 9) AS value FROM m GROUP BY 1""")
def isotonic_fit(t: Tables) -> DataFrame:
    """Share of dear lines by quantity, forced to rise; every seventh quantity breaks the order on purpose."""
    y = ((F.col("l_extendedprice") * (1 - F.col("l_discount")) > 45000) & (F.col("l_quantity").cast("int") % 7 != 0)).cast("int")
    lines = t.lineitem.select(F.col("l_quantity").alias("x"), y.alias("y"))
    fitted = fit_isotonic(lines, "x", "y").transform(lines.select("x").distinct(), "x", "value")
    return fitted.select("x", F.round("value", 9).alias("value"))


# First splits, rounds and stumps, recounted by trying every value of every column as a cut.
_CUT_COLS = ["l_quantity", "l_discount", "l_tax"]
_CUT_SRC = """src AS (SELECT l_quantity, l_discount, l_tax, (l_extendedprice * (1 - l_discount) > 45000)::INT AS y,
l_extendedprice * (1 - l_discount) * (1 + l_tax) AS amount FROM lineitem)"""
_PICK = "CASE f " + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(_CUT_COLS)) + " END"
_NAME = "CASE f " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_CUT_COLS)) + " END"


def _best_cuts(name: str, source: str, a: str, b: str, ridge: float, least: float = 0.0) -> str:
    """The best cut of each side of ``source``: sums of a and b left of it (la, lb, ln), in all (ta, tb, tn), and its gain."""
    long = " UNION ALL ".join(f"SELECT side, {i} AS f, {c} AS v, sum({a}) AS a, sum({b}) AS b, count(*) AS n FROM {source} GROUP BY side, v"
                              for i, c in enumerate(_CUT_COLS))
    worth = lambda s, t: f"({s}) ** 2 / ({t} + {ridge})"
    return f"""{name} AS (SELECT *, {worth('la', 'lb')} + {worth('ta - la', 'tb - lb')} - {worth('ta', 'tb')} AS gain FROM (
SELECT side, f, v, sum(a) OVER w AS la, sum(b) OVER w AS lb, (sum(n) OVER w)::BIGINT AS ln, sum(a) OVER k AS ta, sum(b) OVER k AS tb, (sum(n) OVER k)::BIGINT AS tn
FROM ({long}) WINDOW w AS (PARTITION BY side, f ORDER BY v ROWS UNBOUNDED PRECEDING), k AS (PARTITION BY side, f)) WHERE ln < tn AND lb >= {least} AND tb - lb >= {least}
QUALIFY row_number() OVER (PARTITION BY side ORDER BY round({worth('la', 'lb')} + {worth('ta - la', 'tb - lb')} - {worth('ta', 'tb')}, 6) DESC, f, v) = 1)"""


def _cut_frame(t: Tables, label: str) -> DataFrame:
    return assemble(rows(t).select("id", F.col(label).alias("label"), *_CUT_COLS), _CUT_COLS)


def _cut_rows(t: Tables, tree, cuts, nodes, extra) -> DataFrame:
    out = [(int(n), _CUT_COLS[tree.feature[n]], float(cuts[tree.feature[n]][tree.cut[n]]), *extra(n)) for n in nodes if tree.left[n] >= 0]
    return t.spark.createDataFrame(out, "node int, feature string, threshold double, n_left long, left_value double, right_value double")


def _sides(tree, digits: int):
    return lambda n: (int(tree.rows[tree.left[n]]), round(float(tree.value[tree.left[n]]), digits), round(float(tree.value[tree.left[n] + 1]), digits))


_SPLIT = "SELECT side AS node, {name} AS feature, v AS threshold, ln AS n_left, round({left}, {d}) AS left_value, round({right}, {d}) AS right_value FROM {cte}"


def _first_split(target: str, digits: int) -> str:
    best = _best_cuts("best", "s0", target, "1.0", 0)
    return f"WITH {_CUT_SRC}, s0 AS (SELECT 0 AS side, * FROM src), {best} " + _SPLIT.format(
        name=_NAME, left="la / lb", right="(ta - la) / (tb - lb)", d=digits, cte="best")


@query("tree_first_split", _first_split("y", 9))
def tree_first_split(t: Tables) -> DataFrame:
    """The root of a decision tree: its column, threshold, rows and shares on both sides."""
    model = models.fit_tree(_cut_frame(t, "y"), maxDepth=1)
    return _cut_rows(t, model.trees[0], model.cuts, [0], _sides(model.trees[0], 9))


@query("tree_regression_first_split", _first_split("amount", 4))
def tree_regression_first_split(t: Tables) -> DataFrame:
    model = models.fit_tree_reg(_cut_frame(t, "amount"), maxDepth=1)
    return _cut_rows(t, model.trees[0], model.cuts, [0], _sides(model.trees[0], 4))


def _round_sql(a: str, b: str, ridge: float, step: float, least: float) -> str:
    """Two levels of one boosting round from the mean of the target: the cuts, and what both sides add to the scores."""
    value = lambda s, h: f"{step} * ({s}) / ({h} + {ridge})"
    one, two = _best_cuts("one", "s0", a, b, ridge, least), _best_cuts("two", "s1", a, b, ridge, least)
    return f"""WITH {_CUT_SRC}, s0 AS (SELECT 0 AS side, *, avg(y) OVER () AS p, avg(amount) OVER () AS m FROM src), {one},
s1 AS (SELECT 1 + ({_PICK} > v)::INT AS side, s0.* EXCLUDE (side) FROM s0, (SELECT f, v FROM one)), {two} """ + " UNION ALL ".join(
        _SPLIT.format(name=_NAME, left=value("la", "lb"), right=value("ta - la", "tb - lb"), d=6, cte=cte) for cte in ("one", "two"))


@query("boosting_first_round", _round_sql("y - p", "p * (1 - p)", 1.0, 0.3, 1.0))
def boosting_first_round(t: Tables) -> DataFrame:
    """The first round of boosting on a label, grown level by level to depth two."""
    model = models.fit_gbt(_cut_frame(t, "y"), maxIter=1, maxDepth=2, firstStep=None)
    return _cut_rows(t, model.trees[0], model.cuts, range(3), _sides(model.trees[0], 6))


@query("boosting_leafy_first_round", _round_sql("y - p", "p * (1 - p)", 0.0, 0.1, 0.001))
def boosting_leafy_first_round(t: Tables) -> DataFrame:
    """The first round grown best leaf first, to the four leaves that two levels have."""
    model = models.fit_gbt(_cut_frame(t, "y"), preset="leafy", maxIter=1, maxDepth=2, maxLeaves=4, firstStep=None)
    return _cut_rows(t, model.trees[0], model.cuts, range(3), _sides(model.trees[0], 6))


@query("boosting_amount_first_round", _round_sql("amount - m", "1.0", 1.0, 0.3, 1.0))
def boosting_amount_first_round(t: Tables) -> DataFrame:
    model = models.fit_gbt_reg(_cut_frame(t, "amount"), maxIter=1, maxDepth=2, firstStep=None)
    return _cut_rows(t, model.trees[0], model.cuts, range(3), _sides(model.trees[0], 6))


def _stump_sql() -> str:
    """Two rounds of AdaBoost: a stump, its weighted error and its vote; the second on the weights that the first leaves."""
    first, second = _best_cuts("one", "s0", "y", "1.0", 0), _best_cuts("two", "s1", "y * w", "w", 0)
    hit = "(CASE WHEN {pick} <= v THEN la / lb ELSE (ta - la) / (tb - lb) END > 0.5)::INT"
    error = "(least(la, lb - la) + least(ta - la, tb - lb - ta + la)) / tb"
    row = f"SELECT {{r}} AS round, {_NAME} AS feature, v AS threshold, round({error}, 9) AS error, round(ln((1 - {error}) / ({error})), 6) AS vote FROM {{cte}}"
    return f"""WITH {_CUT_SRC}, s0 AS (SELECT 0 AS side, * FROM src), {first},
s1 AS (SELECT 0 AS side, s0.* EXCLUDE (side), CASE WHEN {hit.format(pick=_PICK)} <> y THEN (1 - {error}) / ({error}) ELSE 1.0 END AS w FROM s0, (SELECT * EXCLUDE (side) FROM one)), {second}
""" + " UNION ALL ".join(row.format(r=f"{i}::INT", cte=cte) for i, cte in ((1, "one"), (2, "two")))


@query("adaboost_stumps", _stump_sql())
def adaboost_stumps(t: Tables) -> DataFrame:
    model = models.fit_adaboost(_cut_frame(t, "y"), n=2)
    out = []
    for i, (tree, vote) in enumerate(zip(model.trees, model.weights)):
        out.append((i + 1, _CUT_COLS[tree.feature[0]], float(model.cuts[tree.feature[0]][tree.cut[0]]), round(1 / (1 + math.exp(vote)), 9), round(vote, 6)))
    return t.spark.createDataFrame(out, "round int, feature string, threshold double, error double, vote double")


_NB_COLS = ["l_quantity", "l_extendedprice"]
_NB_SRC = f"s AS (SELECT {LINE_ID} AS id, l_quantity, l_extendedprice, (l_extendedprice * (1 - l_discount) > 45000)::INT AS y FROM lineitem)"


def _nb_score(y: int) -> str:
    parts = [f"ln(n{y} / (n0 + n1))"]
    for c in _NB_COLS:
        var = f"(v{y}_{c} + 1e-9 * widest)"
        parts.append(f"- 0.5 * ln(2 * pi() * {var}) - ({c} - m{y}_{c}) ** 2 / (2 * {var})")
    return " ".join(parts)


_NB = f"""WITH {_NB_SRC}, p AS (SELECT greatest({', '.join(f'var_pop({c})' for c in _NB_COLS)}) AS widest, """ + ", ".join(
    f"count(*) FILTER (y = {y}) AS n{y}, " + ", ".join(f"avg({c}) FILTER (y = {y}) AS m{y}_{c}, var_pop({c}) FILTER (y = {y}) AS v{y}_{c}" for c in _NB_COLS)
    for y in (0, 1)) + f" FROM s), g AS (SELECT id, {_nb_score(0)} AS a, {_nb_score(1)} AS b FROM s, p)"


@query("gaussian_nb", _NB + " SELECT id, (b > a)::INT::DOUBLE AS prediction, round(1 / (1 + exp(a - b)), 6) AS p1 FROM g")
def gaussian_nb(t: Tables) -> DataFrame:
    df = rows(t)
    model = models.GaussianNB(_NB_COLS, "y").fit(df)
    return model.transform(df).select("id", "prediction", F.round(models.positive_probability(), 6).alias("p1"))


@query("threshold_predict", _NB + " SELECT (1 / (1 + exp(a - b)) >= 0.3)::INT AS prediction, count(*) AS n FROM g GROUP BY 1")
def threshold_predict(t: Tables) -> DataFrame:
    df = rows(t)
    scored = models.GaussianNB(_NB_COLS, "y").fit(df).transform(df)
    return K.predict_at(scored, 0.3).groupBy("prediction").agg(F.count("*").alias("n"))


@query("balanced_weights", "SELECT l_returnflag, round((SELECT count(*) FROM lineitem) / (3.0 * count(*)), 9) AS weight, count(*) AS n FROM lineitem GROUP BY 1")
def balanced_weights(t: Tables) -> DataFrame:
    out = models.balanced_weights(t.lineitem, "l_returnflag")
    return out.groupBy("l_returnflag", F.round("weight", 9).alias("weight")).agg(F.count("*").alias("n"))


# --- regressors ---------------------------------------------------------------------------------

_XY = "FROM (SELECT l_quantity * 1000 + l_extendedprice AS y, l_quantity AS x FROM lineitem)"


def _xy(t: Tables) -> DataFrame:
    df = t.lineitem.select((F.col("l_quantity") * 1000 + F.col("l_extendedprice")).alias("label"), F.col("l_quantity").alias("x"))
    return assemble(df, ["x"])


def _line(t: Tables, model) -> DataFrame:
    return t.lineitem.groupBy().agg(F.count("*").alias("n")).select(
        "n", F.round(F.lit(float(model.coefficients[0])), 3).alias("slope"), F.round(F.lit(float(model.intercept)), 1).alias("intercept"))


@query("linear_regression", f"SELECT count(*) AS n, round(regr_slope(y, x), 3) AS slope, round(regr_intercept(y, x), 1) AS intercept {_XY}")
def linear_regression(t: Tables) -> DataFrame:
    return _line(t, models.fit_linear(_xy(t)))


_PENALISED = "SELECT n, round(w, 3) AS slope, round(my - w * mx, 1) AS intercept FROM (SELECT n, mx, my, {w} AS w FROM (SELECT count(*) AS n, avg(x) AS mx, " \
             "avg(y) AS my, covar_pop(y, x) AS sxy, var_pop(x) AS sxx " + _XY + "))"


@query("ridge_regression", _PENALISED.format(w="n * sxy / (n * sxx + 50000)"))
def ridge_regression(t: Tables) -> DataFrame:
    return _line(t, models.fit_ridge(_xy(t), alpha=50000.0))


@query("lasso_regression", _PENALISED.format(w="greatest(sxy - 20000, 0) / sxx"))
def lasso_regression(t: Tables) -> DataFrame:
    return _line(t, models.fit_elastic(_xy(t), alpha=20000.0, l1_ratio=1.0))


@query("elastic_net_regression", _PENALISED.format(w="greatest(sxy - 100 * 0.5, 0) / (sxx + 100 * 0.5)"))
def elastic_net_regression(t: Tables) -> DataFrame:
    return _line(t, models.fit_elastic(_xy(t), alpha=100.0, l1_ratio=0.5))


@query("tree_regression")
def tree_regression(t: Tables) -> DataFrame:
    return _amount_run(t, "Decision Tree", 6)


@query("forest_regression")
def forest_regression(t: Tables) -> DataFrame:
    return _amount_run(t, "Random Forest", 7)


@query("adaboost_regression")
def adaboost_regression(t: Tables) -> DataFrame:
    return _amount_run(t, "AdaBoost", 1)


@query("boosted_regression")
def boosted_regression(t: Tables) -> DataFrame:
    return _amount_run(t, "Boosted Trees (depth-wise)", 4)


@query("linear_regression_runs")
def linear_regression_runs(t: Tables) -> DataFrame:
    return _amount_run(t, "Linear Regression", 11)


# --- tuning -------------------------------------------------------------------------------------

@query("grid_search")
def grid_search(t: Tables) -> DataFrame:
    """Mean and spread of every metric over the folds for each smoothing of naive Bayes."""
    prepare = X.prepare_with("classification", 1, ["brand"], ["l_extendedprice", "l_discount"], "y", "id")
    out = tuning.tune(plan(t), "Gaussian NB", prepare, X.classifiers("y", "id")["Gaussian NB"],
                      lambda m, df: m.transform(df), tuning.GRIDS["gaussian_nb"], "y")
    return out.filter(~F.col("metric").endswith("_time"))


# --- interpretation -----------------------------------------------------------------------------

_TWO = ["l_quantity", "l_extendedprice"]
# Least squares on two features by Cramer's rule.
_LS = f"""s AS (SELECT {LINE_ID} AS id, l_quantity AS x1, l_extendedprice AS x2, l_quantity * 900 + l_extendedprice * (1 - l_discount) AS y FROM lineitem),
q AS (SELECT var_pop(x1) AS a, covar_pop(x1, x2) AS b, var_pop(x2) AS d, covar_pop(x1, y) AS e, covar_pop(x2, y) AS f, avg(x1) AS m1, avg(x2) AS m2,
avg(y) AS my, var_pop(y) AS vy, min(x1) AS lo, max(x1) AS hi FROM s), w AS (SELECT *, (e * d - b * f) / (a * d - b * b) AS w1, (a * f - b * e) / (a * d - b * b) AS w2 FROM q)"""


def _linear(t: Tables):
    y = F.col("l_quantity") * 900 + F.col("l_extendedprice") * (1 - F.col("l_discount"))
    df = assemble(t.lineitem.select(F.expr(LINE_ID).alias("id"), *_TWO, y.alias("y")), _TWO)
    return models.fit_linear(df, "y"), df


@query("linear_importance", f"WITH {_LS}, c AS (SELECT abs(sqrt(a) * w1) AS c1, abs(sqrt(d) * w2) AS c2 FROM w) SELECT 'l_quantity' AS feature, "
       "round(c1 / (c1 + c2), 6) AS importance FROM c UNION ALL SELECT 'l_extendedprice', round(c2 / (c1 + c2), 6) FROM c")
def linear_importance(t: Tables) -> DataFrame:
    model, df = _linear(t)
    return rounded(interpret.linear_importance(model, df, _TWO), ("importance",))


@query("partial_dependence", f"WITH {_LS} SELECT i::INT AS grid, round(lo + i * (hi - lo) / 99, 6) AS value, round(my + w1 * (lo + i * (hi - lo) / 99 - m1), 3) "
       "AS mean_prediction FROM w, range(100) r(i)")
def partial_dependence(t: Tables) -> DataFrame:
    model, df = _linear(t)
    out = interpret.partial_dependence(model, df, 0)
    return rounded(rounded(out, ("value",)), ("mean_prediction",), 3)


@query("partial_dependence_all", f"WITH {_LS}, e AS (SELECT *, (SELECT min(x2) FROM s) AS lo2, (SELECT max(x2) FROM s) AS hi2 FROM w) "
       "SELECT 'l_quantity' AS feature, i::INT AS grid, round(lo + i * (hi - lo) / 99, 6) AS value, round(my + w1 * (lo + i * (hi - lo) / 99 - m1), 3) AS mean_prediction "
       "FROM e, range(100) r(i) UNION ALL SELECT 'l_extendedprice', i::INT, round(lo2 + i * (hi2 - lo2) / 99, 6), round(my + w2 * (lo2 + i * (hi2 - lo2) / 99 - m2), 3) FROM e, range(100) r(i)")
def partial_dependence_all(t: Tables) -> DataFrame:
    model, df = _linear(t)
    out = interpret.partial_dependence_all(model, df, _TWO)
    return rounded(rounded(out, ("value",)), ("mean_prediction",), 3)


@query("tree_partial_dependence", f"""WITH {_CUT_SRC}, s0 AS (SELECT 0 AS side, * FROM src), {_best_cuts("best", "s0", "y", "1.0", 0)},
p AS (SELECT f, v, la / lb AS low, (ta - la) / (tb - lb) AS high, ta / tb AS mean FROM best),
g AS (""" + " UNION ALL ".join(f"SELECT {i} AS j, '{c}' AS feature, min({c}) AS lo, max({c}) AS hi FROM src" for i, c in enumerate(_CUT_COLS)) + """)
SELECT feature, i::INT AS grid, round(lo + i * (hi - lo) / 99, 6) AS value,
round(CASE WHEN j <> f THEN mean WHEN lo + i * ((hi - lo) / 99) <= v THEN low ELSE high END, 6) AS mean_prediction FROM g, p, range(100) r(i)""")
def tree_partial_dependence(t: Tables) -> DataFrame:
    """All features of a tree with one split, whose dependence is a step of its column and flat in the others."""
    df = _cut_frame(t, "y")
    out = interpret.partial_dependence_all(models.fit_tree(df, maxDepth=1), df, _CUT_COLS)
    return rounded(rounded(out, ("value",)), ("mean_prediction",))


@query("permutation_importance", f"""WITH {_LS}, r AS (SELECT s.*, rep, {h32("concat(id, '-', rep)")} AS h FROM s, range(1, 11) g(rep)),
d AS (SELECT *, coalesce(lead(x1) OVER k, first_value(x1) OVER k) AS p1, coalesce(lead(x2) OVER k, first_value(x2) OVER k) AS p2 FROM r
WINDOW k AS (PARTITION BY rep ORDER BY h, id)),
b AS (SELECT avg((y - my - w1 * (x1 - m1) - w2 * (x2 - m2)) ** 2) AS base, any_value(vy) AS vy FROM s, w),
z AS (SELECT rep, avg((y - my - w1 * (p1 - m1) - w2 * (x2 - m2)) ** 2) AS z1, avg((y - my - w1 * (x1 - m1) - w2 * (p2 - m2)) ** 2) AS z2 FROM d, w GROUP BY 1)
SELECT 'l_quantity' AS feature, rep::INT AS repeat, round((z1 - base) / vy, 6) AS importance FROM z, b UNION ALL
SELECT 'l_extendedprice', rep::INT, round((z2 - base) / vy, 6) FROM z, b""")
def permutation_importance(t: Tables) -> DataFrame:
    model, df = _linear(t)
    return rounded(interpret.permutation_importance(model, df, "id", "y", _TWO, "r2"), ("importance",))


@query("tree_importance")
def tree_importance(t: Tables) -> DataFrame:
    df = assemble(rows(t), NUMBERS)
    return interpret.tree_importance(models.fit_forest(df, "y"), t.spark, NUMBERS)


@query("calibrated_importance")
def calibrated_importance(t: Tables) -> DataFrame:
    df = assemble(rows(t), NUMBERS)
    return interpret.calibrated_importance(models.fit_calibrated_svc(df, "id", "y"), df, NUMBERS)
