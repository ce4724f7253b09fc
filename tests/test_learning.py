import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyfold.operators import encode as E
from tallyfold.operators import interpret, metrics, models, sampling, tuning
from tallyfold.plans import experiment as X


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(11)
    n = 600
    a, b = rng.normal(size=n), rng.normal(size=n)
    pdf = pd.DataFrame({"id": np.arange(n), "a": a, "b": b, "c": rng.choice(["x", "y", "z"], n), "k": rng.choice([2, 10, 1], n),
                        "label": (a + 0.5 * b + rng.normal(0, 0.5, n) > 0).astype(float), "target": 3 * a - b + 5})
    return pdf, E.assemble(spark.createDataFrame(pdf), ["a", "b"]).cache()


def test_ordinal_uses_native_order(spark, data):
    pdf, df = data
    enc = E.OrdinalEncoder(["k", "c"]).fit(df.filter("c <> 'z'"))
    got = enc.transform(spark.createDataFrame([(10, "x"), (2, "z"), (1, None), (7, "y")], "k long, c string"))
    assert sorted((r.k, r.c) for r in got.collect()) == sorted([(2.0, 0.0), (1.0, -1.0), (0.0, -1.0), (-1.0, 1.0)])


def test_one_hot_unknown_is_zero(spark, data):
    _, df = data
    hot = E.OneHot(["c"]).fit(df.filter("c <> 'z'"))
    got = {r.c: r.v for r in hot.transform(spark.createDataFrame([("x",), ("y",), ("z",)], "c string")).select(
        "c", vector_to_array("c_hot").alias("v")).collect()}
    assert got == {"x": [1.0, 0.0], "y": [0.0, 1.0], "z": [0.0, 0.0]}


def test_scalers_on_constant_column(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert {r.x for r in E.MinMaxScale(["x"]).fit(df).transform(df).collect()} == {0.0}
    assert {r.x for r in E.StandardScale(["x"]).fit(df).transform(df).collect()} == {0.0}


def test_target_encoding_leaves_own_fold_out(data):
    pdf, df = data
    enc = E.TargetEncode(["c"], "label")
    got = enc.fit_transform(df, "id").select("id", "c").toPandas().set_index("id")["c"]
    fold = df.select("id", enc._fold("id").alias("f")).toPandas().set_index("id")["f"]
    i = 17
    rest = pdf[pdf["id"].map(fold) != fold[i]]
    mean, var = rest["label"].mean(), rest["label"].var(ddof=0)
    own = rest[rest["c"] == pdf["c"][i]]["label"]
    w = len(own) * var / (len(own) * var + own.var(ddof=0))
    assert np.isclose(got[i], w * own.mean() + (1 - w) * mean)


def test_svd_matches_numpy(data):
    pdf, df = data
    svd = E.TruncatedSVD("features", 1).fit(df)
    v = np.linalg.svd(pdf[["a", "b"]].to_numpy(), full_matrices=False)[2][0]
    assert np.allclose(np.abs(svd.v.toArray()[:, 0]), np.abs(v))
    assert "svd_0" in svd.transform(df).columns


@pytest.mark.parametrize("kind,number", [("classification", 2), ("classification", 7), ("regression", 2), ("regression", 5), ("regression", 10)])
def test_recipes_run(data, kind, number):
    _, df = data
    df = df.drop("features").withColumn("target", F.abs("target"))
    model = E.recipe(kind, number, ["c", "k"], ["a", "b"], "label" if kind == "classification" else "target", "id")
    out = model.fit_transform(df.filter("id % 5 <> 0"))
    assert out.select("features").first()[0].size == model.transform(df.filter("id % 5 = 0")).select("features").first()[0].size


def test_logistic_is_at_the_optimum(data):
    pdf, df = data
    m = models.fit_logistic(df, "label", C=0.5)
    x, w = pdf[["a", "b"]].to_numpy(), m.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ w + m.intercept)))
    assert np.allclose(0.5 * x.T @ (p - pdf["label"]) + w, 0, atol=0.05)


def test_penalised_regression(data):
    pdf, df = data
    x, y = pdf[["a", "b"]].to_numpy(), pdf["target"].to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 50 * np.eye(2), xc.T @ yc)
    assert np.allclose(models.fit_ridge(df, "target", 50.0).coefficients.toArray(), want, atol=1e-4)
    w = models.fit_elastic(df, "target", 0.4, 0.5).coefficients.toArray()
    grad = -xc.T @ (yc - xc @ w) / len(y) + 0.2 * np.sign(w) + 0.2 * w
    assert np.allclose(grad, 0, atol=1e-3)


def _accuracy(model, df):
    return model.transform(df).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]


def test_classifiers(data):
    _, df = data
    for name, fit in X.classifiers("label", "id").items():
        small = {"AdaBoost": {"n": 4}, "Linear SVC": {"max_iter": 8}, "Random Forest": {"numTrees": 5, "maxDepth": 5}}.get(name, {"maxIter": 2, "maxDepth": 3} if "Boosted" in name else {})
        assert _accuracy(fit(df, **small), df) > 0.75, name


def test_calibrated_probabilities(data):
    _, df = data
    for method in ("sigmoid", "isotonic"):
        model = models.fit_calibrated_svc(df, "id", "label", method, max_iter=10)
        p = [r.p for r in model.transform(df).select(models.positive_probability().alias("p")).collect()]
        assert 0 <= min(p) <= max(p) <= 1 and abs(np.mean(p) - 0.5) < 0.1
    imp = interpret.calibrated_importance(model, df, ["a", "b"]).toPandas()
    assert np.isclose(imp["importance"].sum(), 1)


def test_regressors(data):
    _, df = data
    for name, fit in X.regressors("target").items():
        small = {"AdaBoost": {"n": 4}, "Random Forest": {"numTrees": 5, "maxDepth": 5}, "Lasso": {"alpha": 0.1}, "Elastic Net": {"alpha": 0.1}}.get(
            name, {"maxIter": 3} if "Boosted" in name else {})
        r2 = metrics.regression_metrics(fit(df, **small).transform(df), "target", "prediction").first().r_squared
        assert r2 > 0.5, name


def test_hard_auc_is_mean_recall(data):
    _, df = data
    r = metrics.classification_metrics(df.withColumn("p", (F.col("a") > 0.1).cast("int")), "label", "p").first()
    assert np.isclose(r.roc_auc, (r.recall_0 + r.recall_1) / 2)
    assert metrics.classification_metrics(df.withColumn("p", F.lit(0)), "label", "p").first().precision_1 is None


def test_interpretation(spark, data):
    pdf, df = data
    model = models.fit_linear(df, "target")
    assert np.isclose(interpret.linear_importance(model, df, ["a", "b"]).agg(F.sum("importance")).first()[0], 1)
    perm = interpret.mean_importance(interpret.permutation_importance(model, df, "id", "target", ["a", "b"], "r2", 3)).toPandas()
    assert perm.set_index("feature")["importance_mean"]["a"] > perm.set_index("feature")["importance_mean"]["b"] > 0
    pdp = interpret.partial_dependence(model, df, 1, 5).orderBy("grid").collect()
    assert np.isclose(pdp[-1].mean_prediction - pdp[0].mean_prediction, -(pdf["b"].max() - pdf["b"].min()))
    tree = models.fit_tree(df, "label", maxDepth=3)
    assert np.isclose(interpret.tree_importance(tree, spark, ["a", "b"]).agg(F.sum("importance")).first()[0], 1)


def test_run_rows_and_grid(data):
    _, df = data
    plan = sampling.plan_splits(df.drop("features"), "id", ["label"]).cache()
    prepare = X.prepare_with("classification", 4, ["c"], ["a", "b"], "label", "id", "smote")
    runs = X.run_model(plan, "Gaussian NB", X.classifiers("label", "id")["Gaussian NB"], prepare, "trial", "label",
                       splits=["testing", "validation", "fold_1"])
    assert sorted(r.name for r in runs.collect()) == ["Gaussian NB", "fold_1", "validation"]
    assert len(tuning.combinations(tuning.GRIDS["logistic"])) == 60
    grid = tuning.tune(plan, "nb", prepare, X.classifiers("label", "id")["Gaussian NB"], lambda m, d: m.transform(d),
                       {"var_smoothing": [1e-9, 1.0]}, "label", k=2)
    assert grid.filter("metric = 'accuracy'").count() == 2


def test_fitted_objects_survive_saving(spark, tmp_path):
    from tallyfold.operators import encode, models
    from tallyfold.sources import io

    df = spark.range(200).selectExpr("id", "concat('c', id % 5) AS c", "double(id % 17) AS x", "int(id % 17 > 8) AS y")
    recipe = encode.recipe("classification", 4, ["c"], ["x"], "y", "id")
    train = recipe.fit_transform(df)
    tree = models.fit_tree(train, "y")
    io.save_fitted(spark, {"recipe": recipe, "tree": tree}, str(tmp_path / "both"))
    back = io.load_fitted(spark, str(tmp_path / "both"))
    want = tree.transform(recipe.transform(df)).select("id", "features", "prediction").orderBy("id").collect()
    got = back["tree"].transform(back["recipe"].transform(df)).select("id", "features", "prediction").orderBy("id").collect()
    assert got == want


def test_balanced_weights_reach_the_fits(spark):
    from tallyfold.operators import sampling
    from tallyfold.plans import experiment as X

    df = spark.range(400).selectExpr("id", "concat('c', id % 5) AS c", "double(id % 19) AS x", "int(id % 19 > 15) AS y")
    plan = sampling.plan_splits(df, "id", ["y"])
    prepare = X.prepare_with("classification", 4, ["c"], ["x"], "y", "id", weight="weight")
    fit = X.classifiers("y", "id")["Logistic Regression"]
    runs = X.run_model(plan, "weighted", lambda t: fit(t, weight="weight"), prepare, "e", "y", splits=["validation"])
    assert runs.filter("parent_run_id IS NOT NULL").count() == 1


def test_registered_models_run_their_defaults(monkeypatch):
    from tallyfold.catalog import learning
    seen = {}
    for fn in ("_class_run", "_amount_run"):
        monkeypatch.setattr(learning, fn, lambda t, name, number=0, resampler="none", **params: seen.update({t: params}))
    monkeypatch.setattr(learning, "rows", lambda t: t)
    monkeypatch.setattr(learning, "assemble", lambda df, cols: df)
    for fn in ("fit_forest", "fit_calibrated_svc"):
        monkeypatch.setattr(learning.models, fn, lambda df, *columns, **params: seen.update({df: params}))
    for fn in ("tree_importance", "calibrated_importance"):
        monkeypatch.setattr(learning.interpret, fn, lambda *a: None)

    class Named(str):
        spark = None

    names = ["random_forest", "adaboost", "boosted_depthwise", "boosted_leafy", "boosted_slow", "calibrated_svc", "calibrated_svc_isotonic",
             "calibrated_importance", "tree_regression", "forest_regression", "tree_importance", "adaboost_regression", "boosted_regression"]
    for name in names:
        getattr(learning, name)(Named(name))
    assert seen == {n: {"method": "isotonic"} if n == "calibrated_svc_isotonic" else {} for n in names}


def test_permutation_moves_a_row_as_plain_columns(spark):
    """The rows travel once a repeat by the leading bits of one long, without arrays or separate columns for repeat and chunk."""
    import re

    from pyspark.ml.functions import array_to_vector

    from tallyfold.operators import interpret, models

    rows = [(i, float(i % 7), float(i % 5), float(3 * (i % 7) + i % 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y double").withColumn("features", array_to_vector(F.array("a", "b")))
    found = interpret.permutation_importance(models.fit_linear(df, "y"), df, "id", "y", ["a", "b"], "r2", repeats=3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Exchange hashpartitioning\(shiftright\(slot#\d+L, 20\)", plan) and not re.search(r"Exchange hashpartitioning\(repeat#\d+, b#", plan)
    assert found.count() == 6 and found.filter("importance > 0").count() == 6


def test_smoothings_share_their_passes(data, monkeypatch):
    """All settings of a fold come from one fit and one pass of scores, and give what each gives alone."""
    _, df = data
    plan = sampling.plan_splits(df.drop("features"), "id", ["label"]).cache()
    prepare = X.prepare_with("classification", 4, ["c"], ["a", "b"], "label", "id")
    fit, grid = X.classifiers("label", "id")["Gaussian NB"], {"var_smoothing": [1e-9, 0.3, 2.0]}
    score = lambda m, d: m.transform(d)
    alone = tuning.tune(plan, "nb", prepare, lambda d, **p: fit(d, **p), score, grid, "label", k=2)
    fits = []
    whole = models.GaussianNB.fit
    monkeypatch.setattr(models.GaussianNB, "fit", lambda self, d: fits.append(1) or whole(self, d))
    got = tuning.tune(plan, "nb", prepare, fit, score, grid, "label", k=2)
    rows = lambda f: {(r.setting, r.metric): (r.mean, r.std) for r in f.collect() if not r.metric.endswith("_time")}
    assert len(fits) == 2 and rows(got) == rows(alone) and len(rows(got)) == 3 * len(metrics.CLASS_METRICS)


def test_folds_of_a_calibration_are_fitted_at_once(data, monkeypatch):
    import threading

    _, df = data
    fit, meet = models.fit_linear_svc, threading.Barrier(5, timeout=120)

    def waiting(*args):
        meet.wait()  # broken unless all five folds are under way
        return fit(*args)

    one = models.fit_calibrated_svc(df, "id", "label", max_iter=3)
    monkeypatch.setattr(models, "fit_linear_svc", waiting)
    both = [one, models.fit_calibrated_svc(df, "id", "label", max_iter=3)]
    assert np.allclose(*[[m.coefficients.toArray() for m in x.models] for x in both])
    assert np.allclose(*[[c.intercept for c in x.calibrators] for x in both])
    monkeypatch.setattr(models, "FITTED_CELLS", 1)
    monkeypatch.setattr(models, "fit_linear_svc", fit)
    assert len(models.fit_calibrated_svc(df, "id", "label", max_iter=3).models) == 5


def test_rings_of_permutations_take_turns(spark, monkeypatch):
    """Large rings are shuffled a few at a time; the turns show neither in the scores nor in how many rows lie on disk at once."""
    df = E.assemble(spark.createDataFrame([(i, float(i % 7), float(i % 5), float(3 * (i % 7) + i % 5)) for i in range(300)], "id long, a double, b double, y double"), ["a", "b"])
    model, turns = models.fit_linear(df, "y"), []
    found = lambda: sorted(map(tuple, interpret.permutation_importance(model, df, "id", "y", ["a", "b"], "r2", repeats=5).collect()))
    whole, inner = found(), interpret._ring_scores
    monkeypatch.setattr(interpret, "RING_ROWS", 700)
    monkeypatch.setattr(interpret, "_ring_scores", lambda *args: turns.append(args[4:6]) or inner(*args))
    got = found()
    assert turns == [(1, 2), (3, 4), (5, 5)]
    assert [r[:2] for r in got] == [r[:2] for r in whole] and np.allclose([r[2] for r in got], [r[2] for r in whole])
