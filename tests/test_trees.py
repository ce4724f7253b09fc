import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tallyfold.operators import models
from tallyfold.operators import trees as T
from tallyfold.session import stage_table


def table(n=900, seed=3):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 12, n), rng.integers(0, 40, n), rng.integers(0, 3, n), rng.integers(0, 25, n)]).astype(float)
    y = ((x[:, 0] > 5) ^ (x[:, 1] > 17) | (x[:, 3] > 20)).astype(int)
    y = np.where(rng.random(n) < 0.1, 1 - y, y)
    return x, y, np.round(x[:, 0] * 10 - x[:, 1] + x[:, 2] * 25 + rng.integers(0, 7, n))


@pytest.fixture(scope="module")
def data(spark):
    x, y, z = table()
    df = spark.createDataFrame([(i, *map(float, r), int(a), float(b)) for i, (r, a, b) in enumerate(zip(x, y, z))],
                               "id long, a double, b double, c double, d double, y int, z double").repartition(3)
    return x, y, z, df.select("id", "y", "z", array_to_vector(F.array("a", "b", "c", "d")).alias("features")).cache()


def naive(x, a, b, rules, depth=0):
    """The best cut of these rows by trying all, and the tree below it as nested tuples."""
    worth = lambda s, t: s * s / (t + rules.ridge) if t + rules.ridge > 0 else 0.0
    best = None
    if depth < rules.depth and len(a) >= max(rules.min_split, 2 * rules.min_rows):
        for j in range(x.shape[1]):
            for v in np.unique(x[:, j])[:-1]:
                on = x[:, j] <= v
                if min(on.sum(), (~on).sum()) < rules.min_rows or min(b[on].sum(), b[~on].sum()) < rules.min_weight:
                    continue
                gain = worth(a[on].sum(), b[on].sum()) + worth(a[~on].sum(), b[~on].sum()) - worth(a.sum(), b.sum())
                if gain > 1e-9 and (best is None or gain > best[0] * (1 + 1e-9)):
                    best = (gain, j, v)
    if best is None:
        return a.sum() / (b.sum() + rules.ridge)
    gain, j, v = best
    on = x[:, j] <= v
    return j, v, naive(x[on], a[on], b[on], rules, depth + 1), naive(x[~on], a[~on], b[~on], rules, depth + 1)


def answers(tree, x):
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    j, v, low, high = tree
    out, on = np.empty(len(x)), x[:, j] <= v
    out[on], out[~on] = answers(low, x[on]), answers(high, x[~on])
    return out


def same_trees(one, two):
    assert len(one.trees) == len(two.trees)
    for a, b in zip(one.trees, two.trees):
        bins = np.random.default_rng(1).integers(0, 40, (len(one.cuts), 4000)).astype(np.uint8)
        assert len(a.left) == len(b.left) and np.allclose(a.value[a.leaf_of(bins)], b.value[b.leaf_of(bins)])


@pytest.mark.parametrize("local", [10, 300, 10**6])
def test_single_tree_equals_trying_all_cuts(data, local):
    x, y, z, df = data
    for label, target, rules in (("y", y, {"depth": 4}), ("y", y, {"depth": 30, "min_rows": 5, "min_split": 30}), ("z", z, {"depth": 6})):
        model = T.fit_trees(df, label, "mean" if label == "z" else "proportion", local=local, **rules)
        want = answers(naive(x, target.astype(float), np.ones(len(x)), T.Rules(**rules)), x)
        assert np.allclose(model.scores(x), want)


def test_nodes_grown_in_a_task_or_by_histograms_are_the_same(data):
    *_, df = data
    for options in ({"share": "sqrt"}, {"share": "all", "min_rows": 3}):
        made = [T.fit_trees(df, "y", "proportion", 5, True, local=local, **options) for local in (20, 150, 10**6)]
        same_trees(made[0], made[2])
        same_trees(made[1], made[2])
    entropy = [T.fit_trees(df, "y", "proportion", local=local, entropy=True, depth=5) for local in (20, 10**6)]
    same_trees(*entropy)


def test_layout_of_rows_does_not_matter(data):
    *_, df = data
    fits = [lambda d: models.fit_forest(d, "y", numTrees=4, maxDepth=6), lambda d: models.fit_gbt(d, "y", "leafy", maxIter=3, subsamplingRate=0.5, columnRate=0.5)]
    for fit in fits:
        same_trees(fit(df), fit(df.repartition(7)))


def test_blocks_of_many_partitions(data, monkeypatch):
    *_, df = data
    whole = models.fit_gbt(df, "y", "depthwise", maxIter=4)
    monkeypatch.setattr(T, "TASK_CELLS", 500)
    monkeypatch.setattr(T, "PASS_CELLS", 3000)  # a node or two in each pass
    same_trees(whole, models.fit_gbt(df.repartition(6), "y", "depthwise", maxIter=4))


def test_boosting_rounds_equal_the_definition(data):
    x, y, z, df = data
    for kind, label, target in (("logit", "y", y), ("sum", "z", z)):
        model = T.fit_boosted(df, label, kind, rounds=4, step=0.3, depth=3)
        rules = T.Rules(3, 1, 2, 1.0, 1.0)
        score = np.full(len(x), math.log(y.mean() / (1 - y.mean())) if kind == "logit" else z.mean())
        for _ in range(4):
            p = 1 / (1 + np.exp(-score))
            a, b = (target - p, p * (1 - p)) if kind == "logit" else (target - score, np.ones(len(x)))
            score = score + 0.3 * answers(naive(x, a, b, rules), x)
        assert np.allclose(model.scores(x), score)


def test_best_leaf_first(data):
    x, y, _, df = data
    grown = T.fit_boosted(df, "y", "logit", rounds=1, step=1.0, depth=20, leaves=9)
    full = T.fit_boosted(df, "y", "logit", rounds=1, step=1.0, depth=20)
    assert (grown.trees[0].left < 0).sum() == 9
    bins = np.random.default_rng(1).integers(0, 40, (4, 3000)).astype(np.uint8)
    cut = full.trees[0].pruned(9)
    assert np.allclose(cut.value[cut.leaf_of(bins)], grown.trees[0].value[grown.trees[0].leaf_of(bins)])
    assert (models.fit_tree(df, "y", maxLeaves=7).trees[0].left < 0).sum() == 7


def test_symmetric_levels_share_a_cut(data):
    x, y, _, df = data
    model = T.fit_boosted(df, "y", "logit", rounds=2, step=0.5, depth=3, ridge=3.0, symmetric=True, min_weight=0.0)
    tree, level = model.trees[0], [0]
    for _ in range(3):
        assert len({(int(tree.feature[n]), int(tree.cut[n])) for n in level}) == 1
        level = [c for n in level for c in (int(tree.left[n]), int(tree.left[n]) + 1)]
    assert len(tree.left) == 15


def test_adaboost_equals_the_definition(data):
    x, y, z, df = data
    model = models.fit_adaboost(df, "y", n=5)
    w = np.ones(len(x))
    for tree, alpha in zip(model.trees, model.weights):
        p = answers(naive(x, w * y, w, T.Rules(1)), x) > 0.5
        miss = p != (y > 0.5)
        error = w[miss].sum() / w.sum()
        assert alpha == pytest.approx(math.log((1 - error) / error))
        w = w * np.exp(alpha * miss)
        w *= len(x) / w.sum()
    out = models.fit_adaboost_r2(df, "z", n=3).transform(df)
    assert out.agg(F.corr("prediction", "z")).first()[0] > 0.8


def test_weights_and_empty_leaves(data):
    x, y, _, df = data
    doubled = df.withColumn("w", F.lit(2.0))
    same_trees(models.fit_tree(df, "y", maxDepth=4), models.fit_tree(doubled, "y", maxDepth=4, weight="w"))
    balanced = models.fit_tree(df, "y", maxDepth=1, classWeight="balanced")
    assert balanced.trees[0].value[0] == pytest.approx(0.5)
    one = models.fit_gbt(df.filter("y = 1"), "y", "depthwise", maxIter=3)
    assert one.trees == [] and one.transform(df).filter("prediction <> 1").count() == 0


def test_draws():
    key = np.arange(1, 200_001, dtype=np.uint64)
    u = T._mixed(key, 7, 1)
    assert abs(u.mean() - 0.5) < 0.005 and abs(np.corrcoef(u, T._mixed(key, 7, 2))[0, 1]) < 0.01
    n = T._drawn(u)
    assert abs(n.mean() - 1) < 0.01 and abs((n == 0).mean() - math.exp(-1)) < 0.01
    picked = np.mean([T._chosen(9, 3, 1, t, 1) for t in range(3000)], axis=0)
    assert np.allclose(picked, 1 / 3, atol=0.04)


def test_dependence_of_all_features(data):
    from tallyfold.operators import interpret

    x, _, _, df = data
    for model in (models.fit_gbt(df, "y", "depthwise", maxIter=5), models.fit_tree_reg(df, "z", maxDepth=4), models.fit_adaboost(df, "y", n=2)):
        got = {(r.feature, r.grid): r for r in interpret.partial_dependence_all(model, df, list("abcd"), 7).collect()}
        assert len(got) == 28
        for j, name in enumerate("abcd"):
            for g, v in enumerate(np.linspace(x[:, j].min(), x[:, j].max(), 7)):
                moved = x.copy()
                moved[:, j] = got[name, g].value
                score = model.scores(moved)
                want = 1 / (1 + np.exp(-score / sum(model.weights))) if model.kind == "vote" else model.output(score)
                assert got[name, g].value == pytest.approx(v) and got[name, g].mean_prediction == pytest.approx(want.mean())


def test_scores_at_a_fixed_false_positive_rate(data):
    from tallyfold.operators import sampling, tuning

    *_, df = data
    plan = sampling.plan_splits(df.select("id", "y", "features"), "id", ["y"])
    runs = tuning.validate(plan, "tree", lambda a, b: (a, b), lambda d: models.fit_tree(d, "y", maxDepth=5), lambda m, d: m.transform(d), "e", "y",
                           splits=["validation"], fixed_fpr=0.1)
    found = runs.filter("parent_run_id IS NOT NULL").first().metrics
    assert found["fpr"] <= 0.1 < found["tpr"] and 0 < found["threshold"] <= 1


def test_blocks_are_dealt_out_to_idle_cores(spark):
    """Many blocks in one small file keep one core busy; the sums over them do not depend on how they lie."""
    rows = [(i, float(i % 11), float(i % 3 == 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, x double, label double").withColumn("features", array_to_vector(F.array("x")))
    cuts = T.find_cuts(df, 1)
    frame = T.binned_blocks(df, "label", None, "id", cuts)
    many = stage_table(frame.unionAll(frame).unionAll(frame).unionAll(frame).coalesce(1), "blocks")
    state = T._state(many, 1, 0.0)
    assert many.rdd.getNumPartitions() == 1 and state.getNumPartitions() == min(many.count(), 8)
    one = T._Growing(1, T.Rules(1))
    T.grow(state, [one], [lambda block: (block.w * block.y, block.w, np.ones(len(block.y)))])
    assert one.total[0].tolist() == [4.0 * 134, 1600.0, 1600.0]
    state.unpersist()


def test_rounds_in_one_task_are_the_same(spark, data, monkeypatch):
    """All rounds run in one job, whatever their number, and give the trees that a job for each level gives."""
    *_, df = data
    fits = [lambda: models.fit_gbt(df, "y", "slow", maxIter=12, maxDepth=4),
            lambda: models.fit_gbt(df, "y", "leafy", maxIter=3, maxLeaves=6, subsamplingRate=0.5, columnRate=0.5)]
    held = []
    for i, fit in enumerate(fits):
        spark.sparkContext.setJobGroup(f"rounds-{i}", "rounds")
        held.append(fit())
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"rounds-{i}")) < 40
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    monkeypatch.setattr(T, "ROUND_CELLS", 0)
    for fit, one in zip(fits, held):
        same_trees(one, fit())


def test_joint_bins_are_told_apart():
    rng = np.random.default_rng(5)
    sizes = [7, 200, 3, 40, 256]
    bins = np.stack([rng.integers(0, k, 3000) for k in sizes]).astype(np.uint8)
    a, at = rng.normal(size=3000), rng.integers(0, 2, 3000)
    routes = T.Tree(np.array([0, -1, -1]), np.array([2, 0, 0], np.uint8), np.array([1, -1, -1], np.int32), *[np.zeros(3)] * 3)
    block = T.Block(bins, a, np.ones(3000), np.zeros(3000, np.uint64), a)
    at = bins[0] > 2
    for layout in (T.Layout(sizes), T.Layout(sizes, 1)):
        found = T._spread(T._histograms(block, routes, [1, 2], lambda b: (a, None, None), layout, 0), layout)
        for node in (0, 1):
            for j in range(5):
                assert np.allclose(found[node, j, :, 0], np.bincount(bins[j][at == node], a[at == node], 256))
                assert np.array_equal(found[node, j, :, 2], np.bincount(bins[j][at == node], minlength=256))
    assert len(T.Layout(sizes).groups) == 3


def test_draws_are_the_places_among_the_steps():
    u = np.concatenate([np.random.default_rng(2).random(20_000), [0.0, 1 - 2.0 ** -53]])
    steps = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)])
    assert np.array_equal(T._drawn(u), np.searchsorted(steps, u, "right"))
