import numpy as np
import pandas as pd
import pytest

from tallyfold.operators import density, neighbours, shapes


def brute_dbscan(x, eps, m):
    near = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) <= eps
    core, lab, c = near.sum(1) >= m, np.full(len(x), -1), 0
    for i in range(len(x)):
        if core[i] and lab[i] < 0:
            stack, lab[i] = [i], c
            while stack:
                for v in np.nonzero(near[stack.pop()])[0]:
                    if core[v] and lab[v] < 0:
                        lab[v] = c
                        stack.append(v)
            c += 1
    for i in np.nonzero(~core)[0]:
        hits = [lab[v] for v in np.nonzero(near[i])[0] if core[v]]
        lab[i] = min(hits) if hits else -1
    return lab


@pytest.fixture(scope="module")
def cloud(spark):
    """Grid-like points, so ties are common; a third of all rows are one point."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 40, (400, 2)).astype(float)
    x[rng.random(400) < 0.33] = [20.0, 20.0]
    pdf = pd.DataFrame({"id": np.arange(400), "x": x[:, 0], "y": x[:, 1], "v": [r.tolist() for r in x]})
    return x, spark.createDataFrame(pdf)


@pytest.mark.parametrize("metric", neighbours.METRICS)
def test_knn_join(cloud, metric):
    x, df = cloud
    got = neighbours.knn_join(df, df, 4, "id", "id", "v", metric=metric, exclude_self=True).toPandas().sort_values(["left_id", "rank"])
    gap = x[:, None] - x[None]
    d = np.sqrt((gap ** 2).sum(-1)) if metric == "euclidean" else np.abs(gap).sum(-1)
    np.fill_diagonal(d, np.inf)
    want = np.argsort(d, axis=1, kind="stable")[:, :4]
    assert (got["right_id"].to_numpy().reshape(-1, 4) == want).all()


def test_radius_counts(cloud):
    x, df = cloud
    got = neighbours.radius_counts(df, "id", "v", 3.0).toPandas().sort_values("id")["n_within"].to_numpy()
    assert (got == (np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) <= 3.0).sum(1)).all()


@pytest.mark.parametrize("eps,m", [(1.0, 3), (2.0, 6)])
def test_dbscan_plane(cloud, eps, m):
    x, df = cloud
    got = density.dbscan(df, "id", ["x", "y"], eps, m).toPandas().sort_values("id")["cluster"].to_numpy()
    assert (got == brute_dbscan(x, eps, m)).all()


def test_dbscan_undecided_boxes(spark):
    """Points laid out so that sub-cell boxes alone cannot decide the link."""
    rng = np.random.default_rng(8)
    x = np.vstack([rng.random((150, 2)) * 0.2, rng.random((150, 2)) * 0.2 + [1.1, 0.0], rng.random((60, 2)) * 4])
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(len(x)), "x": x[:, 0], "y": x[:, 1]}))
    for eps in (0.8, 0.92, 1.0):
        got = density.dbscan(df, "id", ["x", "y"], eps, 40).toPandas().sort_values("id")["cluster"].to_numpy()
        assert (got == brute_dbscan(x, eps, 40)).all()


def test_dbscan_vectors(cloud):
    x, df = cloud
    got = density.dbscan_vectors(df, "id", "v", 2.0, 6).toPandas().sort_values("id")["cluster"].to_numpy()
    assert (got == brute_dbscan(x, 2.0, 6)).all()


def test_dbscan_line(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(0, 30, 500).round(0), rng.normal(200, 5, 100).round(0)])
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(600), "x": x}))
    for eps, m in ((1.0, 20), (3.0, 60)):
        got = density.dbscan_1d(df, "id", "x", eps, m).toPandas().sort_values("id")["cluster"].to_numpy()
        assert (got == brute_dbscan(x[:, None], eps, m)).all()


def dtw(a, b):
    acc = np.full((len(a) + 1, len(b) + 1), np.inf)
    acc[0, 0] = 0
    for i in range(len(a)):
        for j in range(len(b)):
            acc[i + 1, j + 1] = (a[i] - b[j]) ** 2 + min(acc[i, j + 1], acc[i + 1, j], acc[i, j])
    return acc[-1, -1]


def test_warped_kmeans(spark):
    rng = np.random.default_rng(4)
    base = [np.sin(np.linspace(0, 6, 12)), np.linspace(0, 3, 12), np.r_[np.zeros(6), np.ones(6) * 4]]
    series = [(f"d{i:02d}", (base[i % 3] + rng.normal(0, 0.05, 12)).tolist()) for i in range(30)]
    df = spark.createDataFrame(series, "date string, profile array<double>")
    got = {r.date: r.cluster for r in shapes.dtw_kmeans(df, "date", "profile", 3).collect()}
    groups = [{got[f"d{i:02d}"] for i in range(s, 30, 3)} for s in range(3)]
    assert all(len(g) == 1 for g in groups) and len(set.union(*groups)) == 3
    curve = [r.inertia for r in shapes.elbow(df, "date", "profile", ks=range(1, 5), iters=8).orderBy("k").collect()]
    assert curve[0] > curve[1] > curve[2] and curve[2] < 0.2
    x = np.array([s for _, s in series])
    assert np.isclose(shapes._warp(x[:1], x[1])[0, -1, -1], dtw(x[0], x[1]))


@pytest.mark.parametrize("fan,leaf", [(3, 10), (6, 40)])
def test_deep_trees_of_pivots(cloud, spark, monkeypatch, fan, leaf):
    """Crowded cells are cut again and again; answers stay those of all pairs, and no cell holds more than a leaf."""
    monkeypatch.setattr(neighbours, "FAN", fan)
    monkeypatch.setattr(neighbours, "LEAF", leaf)
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    test_knn_join(cloud, "euclidean")
    test_radius_counts(cloud)
    x, df = cloud
    refs = neighbours._distinct(neighbours._as_vectors(df, "id", "v"), "rid").select("rid", "vec")
    tree = neighbours.PivotTree(refs, 2, "manhattan")
    sizes = [r["count"] for r in tree.cells.groupBy("cell").count().collect()]
    assert len(tree.levels) >= 1 and max(sizes) <= leaf and sum(sizes) == refs.count()


def test_candidates_do_not_grow_with_the_rows(spark, monkeypatch):
    """With ten times the rows a query meets about as many vectors."""
    monkeypatch.setattr(neighbours, "FAN", 8)
    monkeypatch.setattr(neighbours, "LEAF", 32)
    met = []
    for n in (400, 4000):
        x = np.random.default_rng(1).random((n, 2)) * [[1, 1]]
        refs = spark.createDataFrame(pd.DataFrame({"rid": np.arange(n), "vec": [r.tolist() for r in x]}))
        tree = neighbours.PivotTree(refs, 3, "euclidean")
        cells = tree.cells.groupBy("cell").count()
        reached = tree.reached(refs.limit(200).withColumnRenamed("rid", "qid"))
        met.append(reached.join(cells, "cell").agg({"count": "sum"}).first()[0] / 200)
    assert met[1] < 2.5 * met[0]


@pytest.mark.parametrize("share", [0.0, 2.0])
def test_packed_blocks_and_cells_agree(cloud, spark, monkeypatch, share):
    """All pairs in packed blocks (share 0) and the cells under the tree (share 2) give what brute force gives."""
    monkeypatch.setattr(neighbours, "SHARE", share)
    monkeypatch.setattr(neighbours, "FAN", 4)
    monkeypatch.setattr(neighbours, "LEAF", 30)
    monkeypatch.setattr(neighbours, "PACK", 1024)
    monkeypatch.setattr(neighbours, "ROWS", 16)
    monkeypatch.setattr(neighbours, "COLS", 32)
    for metric in neighbours.METRICS:
        test_knn_join(cloud, metric)
    test_radius_counts(cloud)
    test_dbscan_vectors(cloud)


def test_crowded_vectors_meet_in_packed_blocks(spark):
    """Where no cell can be left out, rows grow with vectors and blocks, not with queries times cells."""
    x = np.random.default_rng(3).normal(size=(3000, 32))
    refs = spark.createDataFrame(pd.DataFrame({"rid": np.arange(len(x)), "vec": [r.tolist() for r in x]}))
    tree = neighbours.PivotTree(refs, 3, "euclidean")
    queries = refs.withColumnRenamed("rid", "qid")
    assert tree.crowded(queries)
    sizes = tree.over(queries, lambda qid, q, rid, r, _: pd.DataFrame({"n": [len(q) * len(r)]}), "n long").collect()
    assert sum(s.n for s in sizes) == len(x) ** 2 and len(sizes) <= neighbours.SPREAD ** 2


@pytest.mark.parametrize("metric", neighbours.METRICS)
@pytest.mark.parametrize("scale,shift", [(1.0, 0.0), (1e-25, 0.0), (1e20, 0.0), (1.0, 1e6), (1.0, 1e12)])
def test_rough_distances_decide_as_exact_ones(metric, scale, shift):
    rng = np.random.default_rng(6)
    x = np.vstack([rng.normal(size=(700, 5)), rng.integers(0, 3, (700, 5))]) * scale + shift
    a, b, ids = x[::2], x[1::2], rng.permutation(len(x) // 2)
    d = neighbours._distances(a, b, metric)
    row, col, dist = neighbours._nearest_in(a, b, ids, 4, metric)
    by_id = np.argsort(ids)
    want = by_id[np.argsort(d[:, by_id], axis=1, kind="stable")[:, :4]]
    assert (row == np.repeat(np.arange(len(a)), 4)).all() and (col.reshape(-1, 4) == want).all()
    assert (dist == d[row, col]).all()
    for eps in (0.0, np.sqrt(2) * scale, float(np.median(d))):
        hit = np.zeros(d.shape, bool)
        for i, j, part in neighbours._within(a, b, eps, metric):
            hit[i: i + part.shape[0], j: j + part.shape[1]] = part
        assert (hit == (d <= eps)).all()


def test_components_that_are_no_numbers():
    x = np.random.default_rng(7).normal(size=(40, 3))
    x[3, 1], x[5] = np.nan, np.inf
    row, col, dist = neighbours._nearest_in(x[:20], x[20:], np.arange(20), 2, "euclidean")
    assert len(row) == 40 and np.isnan(dist[row == 3]).all()
