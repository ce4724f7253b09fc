"""Clustering of equally long series under dynamic time warping, and polygon centroids."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.hashing import SEED, hash32
from tallyfold.session import stage_table


# --- warping -----------------------------------------------------------------------------------

def _warp(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Accumulated squared cost of aligning every row of ``x`` with ``c``: (rows, T, T)."""
    n, t = x.shape
    acc = np.empty((n, t, len(c)))
    for i in range(t):
        for j in range(len(c)):
            step = (x[:, i] - c[j]) ** 2
            if i and j:
                step = step + np.minimum(np.minimum(acc[:, i - 1, j], acc[:, i, j - 1]), acc[:, i - 1, j - 1])
            elif i or j:
                step = step + (acc[:, i - 1, j] if i else acc[:, i, j - 1])
            acc[:, i, j] = step
    return acc


def _path(acc: np.ndarray) -> list[tuple[int, int]]:
    i, j = acc.shape[0] - 1, acc.shape[1] - 1
    out = [(i, j)]
    while i or j:
        if i and j:
            moves = ((acc[i - 1, j - 1], i - 1, j - 1), (acc[i - 1, j], i - 1, j), (acc[i, j - 1], i, j - 1))
            _, i, j = min(moves, key=lambda m: m[0])
        else:
            i, j = max(i - 1, 0), max(j - 1, 0)
        out.append((i, j))
    return out


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    costs = np.stack([_warp(x, c)[:, -1, -1] for c in centres], axis=1)
    return costs.argmin(axis=1), costs.min(axis=1)


def dtw_seeds(series: DataFrame, key: str, vec: str, k: int, seed: int = SEED) -> np.ndarray:
    """k starting series, each drawn with weight on its squared distance to the ones before (by hash)."""
    u = (hash32(F.col(key), seed) + 1) / F.lit(float(1 << 32))
    rows = series.select(F.col(key).alias("key"), F.col(vec).alias("vec"), u.alias("u"))
    centres = [rows.orderBy("u", "key").first().vec]
    while len(centres) < k:
        near = np.array(centres, dtype=float)

        def gap(batches: Iterator[pd.DataFrame], near: np.ndarray = near) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if len(pdf):
                    yield pdf.assign(d=_nearest(np.stack(pdf["vec"].to_numpy()).astype(float), near)[1])

        far = rows.mapInPandas(gap, "key string, vec array<double>, u double, d double")
        pick = far.filter("d > 0").orderBy(-F.ln("u") / F.col("d"), "key").first()
        if pick is None:
            break
        centres.append(pick.vec)
    return np.array(centres, dtype=float)


def _fit(series: DataFrame, vec: str, starts: dict[int, np.ndarray], iters: int, tol: float):
    """Barycentre updates for several cluster counts at once; one pass over the series per round.

    Tasks send sums per (k, cluster, position); only those few numbers reach the driver.
    """
    centres = dict(starts)
    inertia: dict[int, float] = {}
    for _ in range(iters):
        now = dict(centres)

        def align(batches: Iterator[pd.DataFrame], now: dict = now) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if not len(pdf):
                    continue
                x = np.stack(pdf[vec].to_numpy()).astype(float)
                for k, cs in now.items():
                    accs = np.stack([_warp(x, c) for c in cs], axis=1)
                    who = accs[:, :, -1, -1].argmin(axis=1)
                    sums, counts = np.zeros(cs.shape), np.zeros(cs.shape)
                    for r, g in enumerate(who):
                        for i, j in _path(accs[r, g]):
                            sums[g, j] += x[r, i]
                            counts[g, j] += 1
                    cost = accs[np.arange(len(x)), who, -1, -1]
                    size = np.bincount(who, minlength=len(cs))
                    total = np.bincount(who, weights=cost, minlength=len(cs))
                    g, j = np.indices(cs.shape)
                    yield pd.DataFrame({"k": k, "g": g.ravel(), "j": j.ravel(), "s": sums.ravel(), "n": counts.ravel(),
                                        "rows": np.where(j == 0, size[:, None], 0).ravel().astype("int64"),
                                        "cost": np.where(j == 0, total[:, None], 0.0).ravel()})

        parts = series.select(vec).mapInPandas(
            align, "k int, g int, j int, s double, n double, rows long, cost double")
        sums = parts.groupBy("k", "g", "j").agg(*[F.sum(c).alias(c) for c in ("s", "n", "rows", "cost")]).toPandas()
        settled = True
        for k, part in sums.groupby("k"):
            k = int(k)
            spread = part["cost"].sum() / max(part["rows"].sum(), 1)
            if k in inertia and abs(inertia[k] - spread) < tol:
                continue
            settled = False
            inertia[k] = float(spread)
            fresh = centres[k].copy()
            hit = part["n"].to_numpy() > 0
            fresh[part["g"].to_numpy()[hit], part["j"].to_numpy()[hit]] = (
                part["s"].to_numpy()[hit] / part["n"].to_numpy()[hit])
            centres[k] = fresh
        if settled:
            break
    return centres, inertia


def dtw_kmeans(series: DataFrame, key: str, vec: str, k: int = 3, iters: int = 50, tol: float = 1e-6) -> DataFrame:
    """(key, cluster, distance) of every series; centres are moved by barycentre averaging."""
    rows = stage_table(series.select(key, vec), "series")
    start = dtw_seeds(rows, key, vec, k)
    centres, _ = _fit(rows, vec, {k: start}, iters, tol)
    final = centres[k]

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                who, cost = _nearest(np.stack(pdf[vec].to_numpy()).astype(float), final)
                yield pd.DataFrame({key: pdf[key], "cluster": who.astype("int32"), "distance": np.sqrt(cost)})

    return rows.mapInPandas(label, f"{key} string, cluster int, distance double")


def elbow(series: DataFrame, key: str, vec: str, ks: Sequence[int] = range(1, 11), iters: int = 50,
          tol: float = 1e-6) -> DataFrame:
    """(k, inertia): mean squared warping distance for each cluster count, all fitted in the same passes."""
    rows = stage_table(series.select(key, vec), "series")
    seeds = dtw_seeds(rows, key, vec, max(ks))
    _, inertia = _fit(rows, vec, {k: seeds[:k] for k in ks}, iters, tol)
    return series.sparkSession.createDataFrame(sorted(inertia.items()), "k int, inertia double")


# --- polygons ----------------------------------------------------------------------------------

def _cross_sum(ring: Column, value) -> Column:
    """Sum of value(a, b) * cross(a, b) over the closed ring's edges."""
    following = F.concat(F.slice(ring, 2, F.size(ring) - 1), F.slice(ring, 1, 1))
    cells = F.zip_with(ring, following, lambda a, b: value(a, b) * (a["x"] * b["y"] - b["x"] * a["y"]))
    return F.aggregate(cells, F.lit(0.0), lambda s, v: s + v)


def polygon_centroid(df: DataFrame, ring_col: str, x: str = "geometry_x", y: str = "geometry_y") -> DataFrame:
    """Area centroid of a ring given as array<struct<x, y>> (shoelace formula, measured from the first corner)."""
    base = F.element_at(ring_col, 1)
    ring = F.transform(ring_col, lambda p: F.struct((p["x"] - base["x"]).alias("x"), (p["y"] - base["y"]).alias("y")))
    area6 = 3 * _cross_sum(ring, lambda a, b: F.lit(1.0))
    return df.withColumns({x: base["x"] + _cross_sum(ring, lambda a, b: a["x"] + b["x"]) / area6,
                           y: base["y"] + _cross_sum(ring, lambda a, b: a["y"] + b["y"]) / area6})


def mean_centroid(df: DataFrame, group: str, x: str = "geometry_x", y: str = "geometry_y") -> DataFrame:
    return df.groupBy(group).agg(F.avg(x).alias(x), F.avg(y).alias(y))
