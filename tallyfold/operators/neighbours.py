"""Exact nearest-neighbour and radius joins over vectors, cut into cells under a tree of pivots.

Every reference vector belongs to the cell of its nearest pivot, and crowded cells are cut again. From
each node's radius and its closest members the triangle inequality gives, per query, a bound on the
k-th distance and thereby the few cells that can hold an answer. A query meets only those cells, block
against block, and only its k best per block leave the task. Equal vectors are handled once, so copies
cost nothing.

Where the bounds spare little, as with many dimensions, a row per query and cell would be far more than
the pairs are worth: then all pairs are worked through in large packed blocks, a few hundred bytes of
shuffle a vector and block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.functions.hashing import SEED, hash32
from tallyfold.operators.rowsets import first_per_key
from tallyfold.session import stage_table

BLOCK = 2048
METRICS = ("euclidean", "manhattan")


def _distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """All distances between two small blocks, one dimension at a time (no cancellation)."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        gap = a[:, j:j + 1] - b[None, :, j]
        out += gap * gap if metric == "euclidean" else np.abs(gap)
    return np.sqrt(out) if metric == "euclidean" else out


ROWS, COLS, STRIP = 512, 4096, 32  # a tile of rough distances; rows of it that stay in the processor's cache
EXACT = 1 << 16  # pairs whose exact distances are worked out at a time


class _Tiles:
    """Distances between two blocks, tile by tile: rough ones in single precision with a bound on their error, exact ones where those decide nothing.

    Rough distances are in units of the largest component around the mean, and squared for the Euclidean metric.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray, metric: str) -> None:
        self.a, self.b, self.metric = a, b, metric
        fine = np.isfinite(b).all(axis=1)
        centre = b[fine].mean(axis=0) if fine.any() else 0.0
        x, y = a - centre, b - centre
        far = max((float(np.abs(z[np.isfinite(z)]).max(initial=0.0)) for z in (x, y)))
        self.unit = far if 1e-290 < far < 1e290 else 1.0
        slip = 1e-15 * (far + float(np.abs(centre).max(initial=0.0))) / self.unit
        with np.errstate(over="ignore", invalid="ignore"):
            x, y = (x / self.unit).astype(np.float32), (y / self.unit).astype(np.float32)
            if metric == "euclidean":
                self.size_a, self.size_b = ((z.astype(float) ** 2).sum(axis=1) for z in (x, y))
                one = np.ones((len(x), 1), np.float32), np.ones((len(y), 1), np.float32)
                x = np.hstack([-2 * x, self.size_a[:, None].astype(np.float32), one[0]])
                y = np.hstack([y, one[1], self.size_b[:, None].astype(np.float32)])
            else:
                self.size_a, self.size_b = (np.abs(z.astype(float)).sum(axis=1) for z in (x, y))
        self.x, self.y = np.ascontiguousarray(x), np.ascontiguousarray(y.T)
        self.share = (a.shape[1] + 16) * 2.0 ** -22
        self.slip = 4 * a.shape[1] * slip

    def rough(self, i: int, j: int) -> tuple[np.ndarray, float]:
        """Of the tile that begins at row i and column j, and how far each may be from the exact one."""
        x, y = self.x[i: i + ROWS], self.y[:, j: j + COLS]
        size = float(self.size_a[i: i + ROWS].max() + self.size_b[j: j + COLS].max())
        if not size < 1e30:  # also where a component is not a number
            return np.zeros((len(x), y.shape[1]), np.float32), np.inf
        if self.metric == "euclidean":
            return x @ y, self.share * size + self.slip * (size ** 0.5 + self.slip) + 1e-36
        out = np.zeros((len(x), y.shape[1]), np.float32)
        for r in range(0, len(x), STRIP):
            strip = out[r: r + STRIP]
            gap = np.empty_like(strip)
            for d in range(len(y)):
                np.subtract(x[r: r + STRIP, d, None], y[d], out=gap)
                np.abs(gap, out=gap)
                strip += gap
        return out, self.share * size + self.slip + 1e-36

    def scaled(self, d):
        """An exact distance as a rough one."""
        return (d / self.unit) ** 2 if self.metric == "euclidean" else d / self.unit

    def exact(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i))
        for at in range(0, len(i), EXACT):
            x, y, part = self.a[i[at: at + EXACT]], self.b[j[at: at + EXACT]], out[at: at + EXACT]
            for d in range(x.shape[1]):
                gap = x[:, d] - y[:, d]
                part += gap * gap if self.metric == "euclidean" else np.abs(gap)
        return np.sqrt(out) if self.metric == "euclidean" else out


def _up(x) -> np.ndarray:
    return np.nextafter(np.asarray(x).astype(np.float32), np.float32(np.inf))


def _within(a: np.ndarray, b: np.ndarray, eps: float, metric: str) -> Iterator[tuple[int, int, np.ndarray]]:
    """(row, column, hit): of each tile, which pairs lie within ``eps``; the columns of a row follow each other."""
    tiles = _Tiles(a, b, metric)
    limit = tiles.scaled(eps) * (1 + 1e-12) if eps >= 0 else -np.inf
    for i in range(0, len(a), ROWS):
        for j in range(0, len(b), COLS):
            rough, err = tiles.rough(i, j)
            hit = rough <= -_up(-(limit * (1 - 4e-12) - err))
            unsure = rough <= _up(limit + err)
            unsure ^= hit
            p, q = np.nonzero(unsure)
            hit[p, q] = tiles.exact(p + i, q + j) <= eps
            yield i, j, hit


def _nearest_in(a: np.ndarray, b: np.ndarray, ids: np.ndarray, k: int, metric: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, distance) of the k nearest of b to each of a, ties by ``ids``."""
    tiles, found = _Tiles(a, b, metric), []
    for i in range(0, len(a), ROWS):
        n = len(a[i: i + ROWS])
        row, col, dist, bound = np.array([], int), np.array([], int), np.array([], float), np.full(n, np.inf)
        for j in range(0, len(b), COLS):
            rough, err = tiles.rough(i, j)
            limit = bound + err
            if rough.shape[1] > k and not np.isfinite(bound).all():
                limit = np.minimum(limit, np.partition(rough, k - 1, axis=1)[:, k - 1].astype(float) + 2 * err)
            p, q = np.nonzero(rough <= _up(limit)[:, None])
            row, col, dist = np.concatenate([row, p]), np.concatenate([col, q + j]), np.concatenate([dist, tiles.exact(p + i, q + j)])
            order = np.lexsort((ids[col], dist, row))
            nth = np.arange(len(order)) - np.searchsorted(row[order], row[order])
            order, nth = order[nth < k], nth[nth < k]
            row, col, dist = row[order], col[order], dist[order]
            last = nth == k - 1
            bound[row[last]] = np.nan_to_num(tiles.scaled(dist[last]) * (1 + 1e-12), nan=np.inf)
        found.append((row + i, col, dist))
    return tuple(np.concatenate(x) for x in zip(*found))


def _pivots(df: DataFrame, n: int) -> np.ndarray:
    """A fixed number of vectors picked by hash; at most ``n`` rows reach the driver."""
    picked = df.select("vec", F.xxhash64("vec", F.lit(SEED)).alias("h")).orderBy("h").limit(n)
    return np.array([r.vec for r in picked.collect()], dtype=float)


FAN = 512  # pivots on the first level, and at most below one node
LEAF = 4096  # vectors of a cell that is not cut again
SLICE = 512  # queries whose bounds are worked out at a time
SHARE = 0.125  # of the references that a query meets on average, above which all pairs are worked through in packed blocks
PACK = 1 << 24  # bytes of vectors in a packed block
SPREAD = 6  # packed blocks of at least 4,096 vectors that a smaller table is cut into


def _stacked(vec: pd.Series) -> np.ndarray:
    return np.stack(vec.to_numpy()).astype(float)


def _packed(df: DataFrame, key: str, tag: str | None, parts: int) -> DataFrame:
    """(part, key, vec, tag, kind): blocks of vectors as bytes, one row each."""
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        tags = pdf[tag].to_numpy() if tag else np.array([])
        return pd.DataFrame([{"part": pdf["part"].iloc[0], "key": pdf[key].to_numpy().astype("int64").tobytes(),
                              "vec": _stacked(pdf["vec"]).tobytes(), "tag": tags.tobytes(), "kind": tags.dtype.str}])

    rows = df.select(key, "vec", *([tag] if tag else []), F.pmod(F.xxhash64(key, F.lit(SEED)), F.lit(parts)).cast("int").alias("part"))
    return rows.groupBy("part").applyInPandas(pack, "part int, key binary, vec binary, tag binary, kind string")


def _unpacked(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    row = pdf.iloc[0]
    keys = np.frombuffer(row["key"], "int64")
    return keys, np.frombuffer(row["vec"], float).reshape(len(keys), -1), np.frombuffer(row["tag"], row["kind"])


def _bounds(d: np.ndarray, close: np.ndarray, k: int) -> np.ndarray:
    """A bound on the k-th distance of each query: to a member of a node it is at most that to its pivot and on from there."""
    out = np.empty(len(d))
    for i in range(0, len(d), SLICE):
        reachable = (d[i: i + SLICE, :, None] + close[None]).reshape(len(d[i: i + SLICE]), -1)
        kth = min(k, reachable.shape[1]) - 1
        out[i: i + SLICE] = np.partition(reachable, kth, axis=1)[:, kth]
    return out


def _padded(lists, k: int) -> np.ndarray:
    out = np.full((len(lists), k), np.inf)
    for i, d in enumerate(lists):
        out[i, :len(d)] = d
    return out


class PivotTree:
    """Distinct reference vectors (rid, vec, ...) in cells of at most ``LEAF`` of them, under a tree of pivots.

    The first level has up to ``FAN`` pivots, held by the driver. A cell of more than ``LEAF`` vectors gets pivots of its
    own, picked by hash among its members, and so on down; these lie in written tables with the radius of each node and
    the distances of its closest members. So the cells a query meets, and their size, do not grow with the data.
    """

    def __init__(self, vectors: DataFrame, k: int, metric: str):
        if metric not in METRICS:
            raise ValueError(f"metric must be one of {METRICS}")
        self.metric, self.k, self.extra = metric, max(k, 1), vectors.columns
        self.n = vectors.count()
        self.pivots = _pivots(vectors, int(min(FAN, max(1, round(self.n ** 0.5 / 2)))))
        self._level, self._grown = None, None
        if not self.n:
            return
        self._level = stage_table(self._nearest(vectors), "cells")
        top = {r.cell: r for r in self._summary(self._level).collect()}  # at most FAN rows
        self.radius = np.array([top[c].radius if c in top else -1.0 for c in range(len(self.pivots))])
        self.close = _padded([top[c].close if c in top else [] for c in range(len(self.pivots))], self.k)
        self.sizes = np.array([top[c].n if c in top else 0 for c in range(len(self.pivots))])

    @property
    def cells(self) -> DataFrame:
        return self._grow()[0]

    @property
    def levels(self) -> list[DataFrame]:
        return self._grow()[1]

    def _grow(self) -> tuple[DataFrame, list[DataFrame]]:
        """The cells and the levels of nodes below the first, made when they are first asked for."""
        if self._grown is not None:
            return self._grown
        level, ready, levels = self._level, [], []
        while True:
            sizes = stage_table(level.groupBy("cell").agg(F.count("*").alias("n")), "sizes")
            big = sizes.filter(F.col("n") > LEAF)
            if big.isEmpty():
                break
            ready.append(level.join(sizes.filter(F.col("n") <= LEAF), "cell", "left_semi"))
            level = self._cut(level.join(big, "cell"), levels)
        self._grown = reduce(DataFrame.unionByName, [*ready, level]), levels
        return self._grown

    def _nearest(self, vectors: DataFrame) -> DataFrame:
        pivots, metric = self.pivots, self.metric

        def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for at in range(0, len(pdf), SLICE):
                    part = pdf.iloc[at: at + SLICE]
                    d = _distances(_stacked(part["vec"]), pivots, metric)
                    yield part.assign(cell=d.argmin(axis=1).astype("int64"), dist=d.min(axis=1))

        schema = T.StructType([*vectors.schema.fields, T.StructField("cell", T.LongType()), T.StructField("dist", T.DoubleType())])
        return vectors.mapInPandas(assign, schema)

    def _summary(self, level: DataFrame) -> DataFrame:
        """(cell, radius, n, close): the farthest member of each node, its members, and the distances of its k closest."""
        close = first_per_key(level.select("cell", "dist"), ["cell"], ["dist"], n=self.k).groupBy("cell").agg(
            F.sort_array(F.collect_list("dist")).alias("close"))
        return level.groupBy("cell").agg(F.max("dist").alias("radius"), F.count("*").alias("n")).join(close, "cell")

    def _cut(self, members: DataFrame, levels: list[DataFrame]) -> DataFrame:
        """The members (with n, the size of their cell) in the cells of new pivots; the nodes are added to ``levels``, for descents."""
        metric, columns = self.metric, [*self.extra, "cell", "dist"]
        ranked = first_per_key(members.select("cell", "n", "vec", F.xxhash64("vec", F.lit(SEED + 1)).alias("h")), ["cell"], ["h"], FAN, "nth")
        picks = stage_table(ranked.filter(F.col("nth") <= F.greatest(F.lit(2), F.ceil(2 * F.col("n") / LEAF))).select(
            "cell", "n", ((F.col("cell") + 1) * FAN + F.col("nth") - 1).alias("child"), F.col("vec").alias("pivot")), "pivots")
        parts = F.ceil(F.col("n") / BLOCK).cast("int")
        left = members.withColumn("part", F.pmod(F.xxhash64("rid"), parts).cast("int"))
        right = picks.select("cell", "child", "pivot", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))

        def assign(pdf: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
            if not len(pdf):
                return pdf[columns]
            d = _distances(np.stack(pdf["vec"].to_numpy()).astype(float), np.stack(pivots["pivot"].to_numpy()), metric)
            return pdf.assign(cell=pivots["child"].to_numpy()[d.argmin(axis=1)], dist=d.min(axis=1))[columns]

        level = left.groupBy("cell", "part").cogroup(right.groupBy("cell", "part")).applyInPandas(assign, members.select(*columns).schema)
        level = stage_table(level, "cells")
        nodes = self._summary(level).drop("n").join(picks.select(F.col("cell").alias("parent"), F.col("child").alias("cell"), "pivot"), "cell")
        levels.append(stage_table(nodes, "nodes"))
        return level

    def crowded(self, queries: DataFrame, eps: float | None = None) -> bool:
        """Whether the bounds of the first level leave a query, on average, more than ``SHARE`` of all references."""
        pivots, metric, radius, close, sizes, k = self.pivots, self.metric, self.radius, self.close, self.sizes, self.k

        def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for at in range(0, len(pdf), SLICE):
                    d = _distances(_stacked(pdf["vec"].iloc[at: at + SLICE]), pivots, metric)
                    bound = _bounds(d, close, k)[:, None] if eps is None else eps
                    met = (radius >= 0) & (d - radius <= bound + 1e-9 * (1.0 + d))
                    yield pd.DataFrame({"n": [len(d)], "met": [float((met @ sizes).sum())]})

        seen = queries.select("vec").mapInPandas(meet, "n long, met double").agg(F.sum("n").alias("n"), F.sum("met").alias("met")).first()
        return bool(seen.n) and seen.met > SHARE * seen.n * self.n

    def reached(self, queries: DataFrame, eps: float | None = None) -> DataFrame:
        """Each query (qid, vec) once per cell that may hold one of its k nearest, or a vector within ``eps``."""
        pivots, metric, radius, close, k = self.pivots, self.metric, self.radius, self.close, self.k

        def meet(pdf: pd.DataFrame, d: np.ndarray, bound: np.ndarray, radius: np.ndarray, cells: np.ndarray) -> pd.DataFrame:
            low = d - radius
            q, c = np.nonzero((radius >= 0) & (low <= bound[:, None] + 1e-9 * (1.0 + d)))
            return pd.DataFrame({"qid": pdf["qid"].to_numpy()[q], "vec": pdf["vec"].to_numpy()[q], "cell": cells[c],
                                 "bound": bound[q], "low": low[q, c] - 1e-9 * (1.0 + d[q, c])})

        def start(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for at in range(0, len(pdf), SLICE // 8):  # a query may meet every cell: few of them at a time
                    part = pdf.iloc[at: at + SLICE // 8]
                    d = _distances(_stacked(part["vec"]), pivots, metric)
                    yield meet(part, d, _bounds(d, close, k) if eps is None else np.full(len(d), eps), radius, np.arange(len(pivots)))

        def descend(pdf: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
            if not len(pdf) or not len(nodes):
                return pdf[["qid", "vec", "cell", "bound", "low"]].iloc[:0]
            d = _distances(np.stack(pdf["vec"].to_numpy()).astype(float), np.stack(nodes["pivot"].to_numpy()), metric)
            bound = pdf["bound"].to_numpy()
            if eps is None:
                bound = np.minimum(bound, _bounds(d, _padded(nodes["close"].to_numpy(), k), k))
            return meet(pdf, d, bound, nodes["radius"].to_numpy(), nodes["cell"].to_numpy())

        schema = "qid long, vec array<double>, cell long, bound double, low double"
        rows = queries.select("qid", "vec").mapInPandas(start, schema)
        for nodes in self.levels:
            rows = stage_table(rows, "reach")
            inner = nodes.select(F.col("parent").alias("cell")).distinct()
            met = stage_table(rows.groupBy("cell").agg(F.ceil(F.count("*") / min(BLOCK, SLICE)).cast("int").alias("parts")).join(inner, "cell"), "met")
            left = rows.join(met, "cell").withColumn("part", F.pmod(F.xxhash64("qid"), F.col("parts")).cast("int")).drop("parts")
            right = nodes.join(met.select(F.col("cell").alias("parent"), F.col("parts").alias("spread")), "parent").withColumn(
                "part", F.explode(F.sequence(F.lit(0), F.col("spread") - 1))).drop("spread")
            down = left.groupBy("cell", "part").cogroup(right.groupBy("parent", "part")).applyInPandas(descend, schema)
            rows = stage_table(rows.join(met, "cell", "left_anti").unionByName(down), "reach")
            if eps is None:  # what one node has shown holds for the query everywhere
                least = stage_table(rows.groupBy("qid").agg(F.min("bound").alias("least")), "bounds")
                rows = rows.join(least, "qid").filter(F.col("low") <= F.col("least")).withColumn("bound", F.col("least")).drop("least")
        return rows.select("qid", "vec", "cell")

    def blocks(self, queries: DataFrame, eps: float | None = None):
        """Queries and references cogrouped by (cell, query block, reference block), each of bounded size."""
        q = stage_table(self.reached(queries, eps), "reach")
        sizes = q.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts_q"))
        sizes = stage_table(sizes.join(self.cells.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts_r")), "cell"), "sizes")

        def pick(key: str, parts: str):
            return F.pmod(F.xxhash64(key, F.lit(SEED)), F.col(parts)).cast("int")

        def spread(parts: str):
            return F.explode(F.sequence(F.lit(0), F.col(parts) - 1))

        left = q.join(sizes, "cell").withColumn("qb", pick("qid", "parts_q")).withColumn("rb", spread("parts_r")).drop("parts_q", "parts_r")
        right = self.cells.drop("dist").join(sizes, "cell").withColumn("rb", pick("rid", "parts_r")).withColumn("qb", spread("parts_q")).drop("parts_q", "parts_r")
        return left.groupBy("cell", "qb", "rb").cogroup(right.groupBy("cell", "qb", "rb"))

    def _parts(self, n: int) -> int:
        most = max(1, PACK // (8 * self.pivots.shape[1]))
        return max(1, -(-n // most), min(SPREAD, -(-n // 4096)))

    def over(self, queries: DataFrame, work: Callable, schema: str, eps: float | None = None) -> DataFrame:
        """What ``work`` makes of every block of queries and references that must meet: of their ids, vectors, and the references' tags."""
        if not self.n:
            return queries.sparkSession.createDataFrame([], schema)
        tag = next((c for c in self.extra if c not in ("rid", "vec")), None)
        none = T.StructType.fromDDL(schema).fieldNames()
        if not self.crowded(queries, eps):
            def block(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
                if not len(q) or not len(r):
                    return pd.DataFrame({c: [] for c in none})
                return work(q["qid"].to_numpy(), _stacked(q["vec"]), r["rid"].to_numpy(), _stacked(r["vec"]), r[tag].to_numpy() if tag else None)

            return self.blocks(queries, eps).applyInPandas(block, schema)

        def pair(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
            if not len(q) or not len(r):
                return pd.DataFrame({c: [] for c in none})
            (qid, q, _), (rid, r, tags) = _unpacked(q), _unpacked(r)
            return work(qid, q, rid, r, tags)

        n_left, n_right = self._parts(queries.count()), self._parts(self.n)
        left = stage_table(_packed(queries, "qid", None, n_left), "packs").withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(n_right - 1))))
        right = stage_table(_packed(self._level, "rid", tag, n_right), "packs").withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(n_left - 1))))
        return left.groupBy("part", "other").cogroup(right.groupBy("other", "part")).applyInPandas(pair, schema)


def _as_vectors(df: DataFrame, id_col: str, vec: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("vec"))


def _distinct(vectors: DataFrame, name: str) -> DataFrame:
    """One row per distinct vector with the smallest id as its representative."""
    return vectors.groupBy("vec").agg(F.min("id").alias(name))


def knn_join(left: DataFrame, right: DataFrame, k: int, left_id: str, right_id: str, left_vec: str,
             right_vec: str | None = None, metric: str = "euclidean", exclude_self: bool = False) -> DataFrame:
    """(left_id, right_id, distance, rank): the k nearest right rows of every left row, ties by right id.

    ``exclude_self`` drops the pair with equal ids, for a join of a table with itself.
    """
    lv, rv = _as_vectors(left, left_id, left_vec), _as_vectors(right, right_id, right_vec or left_vec)
    need = k + 1 if exclude_self else k
    queries = stage_table(_distinct(lv, "qid"), "queries")
    # A vector shared by many rows can give at most `need` of them; the group limit keeps only those.
    copies = stage_table(first_per_key(rv, ["vec"], ["id"], n=need), "copies")
    refs = stage_table(_distinct(copies, "rid").select("rid", "vec"), "refs")
    cells = PivotTree(refs, need, metric)

    def best(qid, q, rid, r, _) -> pd.DataFrame:
        row, col, dist = _nearest_in(q, r, rid, need, metric)
        return pd.DataFrame({"qid": qid[row], "rid": rid[col], "dist": dist})

    pairs = cells.over(queries, best, "qid long, rid long, dist double")
    near = first_per_key(pairs, ["qid"], ["dist", "rid"], n=need)
    members = copies.join(refs.select("rid", F.col("vec").alias("__v")), F.col("vec") == F.col("__v")).select("rid", "id")
    full = near.join(members, "rid").select("qid", F.col("id").alias("nbr"), "dist")
    full = stage_table(first_per_key(full, ["qid"], ["dist", "nbr"], n=need, rank_name="rank"), "near")
    ids = lv.join(queries, "vec").select("id", "qid")
    out = ids.join(full, "qid").drop("qid")
    if exclude_self:
        out = out.filter(F.col("id") != F.col("nbr"))
        out = first_per_key(out.drop("rank"), ["id"], ["dist", "nbr"], n=k, rank_name="rank")
    names = ("left_id", "right_id") if left_id == right_id else (left_id, right_id)
    return out.select(F.col("id").alias(names[0]), F.col("nbr").alias(names[1]),
                      F.col("dist").alias("distance"), F.col("rank").cast("int").alias("rank"))


def radius_counts(df: DataFrame, id_col: str, vec: str, eps: float, metric: str = "euclidean",
                  weight: str | None = None) -> DataFrame:
    """(id, n_within): weight of all rows within ``eps`` of each row, itself included. No pair is emitted."""
    w = F.col(weight) if weight else F.lit(1.0)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("vec"),
                     w.cast("double").alias("w"))
    points = stage_table(rows.groupBy("vec").agg(F.min("id").alias("rid"), F.sum("w").alias("w")), "points")
    cells = PivotTree(points, 1, metric)

    def within(qid, q, rid, r, w) -> pd.DataFrame:
        n, same = np.zeros(len(q)), bool((w == w[0]).all())
        for i, j, hit in _within(q, r, eps, metric):
            n[i: i + len(hit)] += np.count_nonzero(hit, axis=1) * w[0] if same else hit @ w[j: j + hit.shape[1]]
        return pd.DataFrame({"qid": qid, "n": n})

    queries = points.select(F.col("rid").alias("qid"), "vec")
    sums = cells.over(queries, within, "qid long, n double", eps).groupBy("qid").agg(F.sum("n").alias("n_within"))
    per_vec = sums.join(points.select("rid", "vec"), F.col("qid") == F.col("rid")).select("vec", "n_within")
    return rows.join(per_vec, "vec").select(F.col("id").alias(id_col), "n_within")


def radius_links(points: DataFrame, eps: float, metric: str = "euclidean") -> DataFrame:
    """(a, b) links that connect points (rid, vec) exactly as all pairs within ``eps`` would.

    Each block gives a spanning forest of its own pairs, so at most one link per point and block.
    """
    cells = PivotTree(points, 1, metric)

    def forest(qid, q, rid, r, _) -> pd.DataFrame:
        links, root = [], np.arange(len(r))
        for i, rows in groupby(_within(q, r, eps, metric), key=lambda tile: tile[0]):
            close = np.concatenate([hit for _, _, hit in rows], axis=1)
            for a, line in zip(qid[i: i + len(close)], close):
                hits = np.flatnonzero(line)
                if len(hits):
                    groups, first = np.unique(root[hits], return_index=True)
                    links += [(a, rid[hits[f]]) for f in first]
                    if len(groups) > 1:
                        root[np.isin(root, groups)] = groups[0]
        links = np.array(links, dtype="int64").reshape(-1, 2)
        return pd.DataFrame({"a": links[:, 0], "b": links[:, 1]})

    queries = points.select(F.col("rid").alias("qid"), "vec")
    return cells.over(queries, forest, "a long, b long", eps).filter("a <> b")


def radius_best(queries: DataFrame, refs: DataFrame, eps: float, tag: str, metric: str = "euclidean") -> DataFrame:
    """(rid, tag): the lowest tag among references (rid, vec, tag) within ``eps`` of each query (rid, vec)."""
    cells = PivotTree(refs.select("rid", "vec", tag), 1, metric)

    def lowest(qid, q, rid, r, tags) -> pd.DataFrame:
        best = np.full(len(q), np.iinfo("int64").max)
        for i, j, hit in _within(q, r, eps, metric):
            p, c = np.nonzero(hit)
            np.minimum.at(best, p + i, tags[c + j])
        found = best < np.iinfo("int64").max
        return pd.DataFrame({"rid": qid[found], tag: best[found]})

    asked = queries.select(F.col("rid").alias("qid"), "vec")
    found = cells.over(asked, lowest, f"rid long, {tag} long", eps)
    return found.groupBy("rid").agg(F.min(tag).alias(tag))


def knn_classify(train: DataFrame, evaluate: DataFrame, id_col: str, vec: str, label: str, k: int = 5,
                 weights: str = "uniform", p: int = 2) -> DataFrame:
    """(id, prediction, score): weighted vote of the k nearest training rows; ties go to the lower class.

    With ``weights='distance'`` a neighbour at distance 0 outvotes all others.
    """
    near = knn_join(evaluate, train.withColumnRenamed(id_col, "__tid"), k, id_col, "__tid", vec,
                    metric="euclidean" if p == 2 else "manhattan")
    tagged = near.join(train.select(F.col(id_col).alias("__tid"), F.col(label).alias("__y")), "__tid")
    if weights == "distance":
        exact = F.max(F.col("distance") == 0)
        tagged = tagged.join(tagged.groupBy(id_col).agg(exact.alias("__exact")), id_col)
        w = F.when(F.col("__exact"), (F.col("distance") == 0).cast("double")).otherwise(1 / F.col("distance"))
    else:
        w = F.lit(1.0)
    votes = tagged.groupBy(id_col, "__y").agg(F.sum(w).alias("vote"))
    return votes.groupBy(id_col).agg(F.max_by("__y", F.struct("vote", -F.col("__y"))).alias("prediction"),
                                     (F.max("vote") / F.sum("vote")).alias("score"))
