import hashlib
import math
import random

import numpy as np

from tallyfold.llm.simplex_kmeans import Simplex, cluster_vectors, integer_vectors, nearest

SCHEMA = "vec_id long, embedding array<float>, cluster string, q int"


def ok(v, size):
    return v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)


def brute(rows, k, rounds, size, scale=64):
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows if ok(v, size)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centre = [v for _, v in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centre)) for _, v in kept]

    for _ in range(rounds):
        got = assign()
        for j in range(len(centre)):
            mine = [v for (_, v), (_, g) in zip(kept, got) if g == j]
            if mine:
                centre[j] = [sum(c) // len(mine) for c in zip(*mine)]
    got = assign()
    total = {j: sum(d for d, g in got if g == j) for j in range(len(centre))}
    return [(i, j, d, total[j], sum(total.values()), hashlib.sha256(",".join(map(str, centre[j])).encode()).hexdigest())
            for (i, _), (d, j) in zip(kept, got)]


def check(spark, rows, **settings):
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA).repartition(3)
    got = cluster_vectors(frame, **settings).collect()
    want = brute(rows, settings.get("k", 16), settings.get("rounds", 3), settings.get("size", 64))
    assert sorted(str(tuple(r)[:6]) for r in got) == sorted(map(str, want))
    return got


def made(seed, n, size, spread=0.3):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(size)] for _ in range(6)]
    return [(i, [c + rng.gauss(0, spread) for c in rng.choice(centres)]) for i in range(n)]


def test_equals_brute_force(spark):
    rows = made(1, 400, 64) + [(3, [0.5] * 64)] * 40 + [(None, [0.25] * 64)] * 2
    rows += [(900, [0.1] * 63), (901, [0.1] * 65), (902, None), (903, []), (904, [0.1] * 63 + [None]), (905, [float("nan")] * 64),
             (906, [0.1] * 63 + [float("inf")])]
    check(spark, rows)


def test_bounds_spare_comparisons(spark):
    got = check(spark, made(2, 600, 64, 0.02))
    assert max(r.compared for r in got) < 6


def test_ties_few_and_flat_vectors(spark):
    line = [(i, [float(i % 5), 0.0]) for i in range(50)]
    check(spark, line, size=2, k=4)
    check(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [-1.0, 0.5])], size=2)
    check(spark, [(7, [0.0] * 64)])
    check(spark, [(i, [1.0, 1.0]) for i in range(30)], size=2, k=3)
    assert cluster_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_beyond_the_limit(spark):
    frame = spark.createDataFrame([(1, [3e38, -3e38])], "vec_id long, embedding array<float>")
    assert integer_vectors(frame, size=2).first().q == [1 << 26, -(1 << 26)]


def test_bounds_hold():
    rng = np.random.default_rng(5)
    points, pivots = rng.integers(-60, 60, (200, 8)), rng.integers(-60, 60, (5, 8))
    simplex = Simplex(np.vstack([pivots, pivots[:2]]))
    assert len(simplex.pivots) == 5
    apex = simplex.place(points)
    true = np.sqrt(((points[:, None] - points[None]) ** 2).sum(2))
    low = np.sqrt(((apex[:, None] - apex[None]) ** 2).sum(2))
    turned = apex * np.array([1] * 4 + [-1])
    high = np.sqrt(((apex[:, None] - turned[None]) ** 2).sum(2))
    assert (low <= true + 1e-6).all() and (true <= high + 1e-6).all()
    cluster, square, tested = nearest(points, apex, points[:9], apex[:9])
    exact = ((points[:, None] - points[None, :9]) ** 2).sum(2)
    assert (cluster == exact.argmin(1)).all() and (square == exact.min(1)).all() and tested < exact.size
