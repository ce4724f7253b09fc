"""Centroid clustering on integers, with n-simplex bounds in front of the exact comparison."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.session import stage_table

LIMIT = 1 << 26  # largest component, so that squared distances of 64 components stay below 2^60
FLAT = 0.05  # a pivot this near to the span of the others, in parts of the longest edge, is left out
SLACK = 1e-7  # relative; rounding of the bounds is about 1e-12


def integer_vectors(vectors: DataFrame, size: int = 64, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and q, the components as integers floor(scale * x), of vectors with ``size`` finite components."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vector_col, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("int"))
    return vectors.filter((F.size(vector_col) == size) & finite).select(F.col(id_col).alias("vec_id"), whole.alias("q"))


def start_key(vec_id: Column, seed: int = 1) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(vec_id.cast("string"), F.lit(""))), 256)


class Simplex:
    """Apex coordinates over a base of pivots: a point's distances to m pivots place it in m dimensions.

    The base is built from distances alone: pivot 0 is the origin, each further pivot has coordinates along the ones
    before and a height of its own. A point is solved for in the same way; its last coordinate is its height above the
    base. For two points, the distance of their apexes is a lower bound of theirs; with one of the heights turned over
    it is an upper bound.
    """

    def __init__(self, pivots: np.ndarray) -> None:
        apart = _squares(pivots, pivots).astype(float)
        longest = float(apart.max(initial=0))
        kept, base = ([0] if len(pivots) else []), np.zeros((1, 0))
        for i in range(1, len(pivots)):
            x, height = _apex(base, apart[i: i + 1, kept])
            if height[0] <= FLAT * longest ** 0.5:
                continue
            base = np.vstack([np.hstack([base, np.zeros((len(base), 1))]), np.append(x[0], height[0])])
            kept.append(i)
        self.pivots, self.base = pivots[kept], base

    def place(self, points: np.ndarray) -> np.ndarray:
        """(rows, pivots): coordinates along the base, then the height."""
        if not len(self.pivots):
            return np.zeros((len(points), 1))
        x, height = _apex(self.base, _squares(points, self.pivots).astype(float))
        return np.column_stack([x, height])


def _apex(base: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates and height of points from their squared distances to the base points, one base edge after another."""
    x = np.zeros((len(squares), len(base) - 1))
    for i in range(1, len(base)):
        edge = base[i]
        right = (squares[:, 0] + edge @ edge - squares[:, i]) / 2 - x[:, : i - 1] @ edge[: i - 1]
        x[:, i - 1] = right / edge[i - 1]
    return x, np.sqrt(np.maximum(squares[:, 0] - (x * x).sum(1), 0))


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of a to the few rows of b."""
    out = np.empty((len(a), len(b)), np.int64)
    for j in range(len(b)):
        step = a - b[j]
        out[:, j] = np.einsum("ij,ij->i", step, step)
    return out


def nearest(points: np.ndarray, apex: np.ndarray, centroids: np.ndarray, centre_apex: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each point (the smaller number of equals), its squared distance, and how many were compared.

    A centroid whose lower bound is above the least upper bound cannot be nearest; the others are compared on integers.
    """
    low = np.empty((len(points), len(centroids)))
    for j in range(len(centroids)):
        step = apex - centre_apex[j]
        low[:, j] = np.einsum("ij,ij->i", step, step)
    high = low + 4 * np.outer(apex[:, -1], centre_apex[:, -1])
    room = SLACK * (np.einsum("ij,ij->i", apex, apex) + np.einsum("ij,ij->i", centre_apex, centre_apex).max())
    open_ = low <= (high.min(1) + room)[:, None]
    best, cluster = np.full(len(points), np.iinfo(np.int64).max), np.zeros(len(points), np.int32)
    for j in range(len(centroids)):
        rows = np.flatnonzero(open_[:, j])
        step = points[rows] - centroids[j]
        square = np.einsum("ij,ij->i", step, step)
        closer = square < best[rows]
        best[rows[closer]], cluster[rows[closer]] = square[closer], j
    return cluster, best, int(open_.sum())


def _matrix(column: pa.Array, kind) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(kind) if len(column) else np.zeros((0, 0), kind)


def _apex_rows(simplex: Simplex):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                apex = simplex.place(_matrix(batch.column(1), np.int64))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(apex) + 1, dtype=np.int32) * apex.shape[1]), pa.array(apex.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["vec_id", "q", "apex"])
    return task


def _sum_rows(centroids: np.ndarray, centre_apex: np.ndarray):
    """Task: one row for each cluster and component met, with the count and the sum over the whole task."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            if batch.num_rows:
                points = _matrix(batch.column(0), np.int64)
                cluster, _, _ = nearest(points, _matrix(batch.column(1), float), centroids, centre_apex)
                count += np.bincount(cluster, minlength=len(centroids))
                for j in np.unique(cluster):
                    total[j] += points[cluster == j].sum(0)
        met = np.flatnonzero(count)
        width = centroids.shape[1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(met, width).astype(np.int32)), pa.array(np.tile(np.arange(width, dtype=np.int32), len(met))),
             pa.array(np.repeat(count[met], width)), pa.array(total[met].ravel())], names=["cluster", "component", "n", "total"])
    return task


def _assigned_rows(centroids: np.ndarray, centre_apex: np.ndarray):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cluster, square, tested = nearest(_matrix(batch.column(1), np.int64), _matrix(batch.column(2), float), centroids, centre_apex)
                share = np.full(len(cluster), tested / len(cluster))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster), pa.array(square), pa.array(share)],
                                                 names=["vec_id", "cluster", "distance", "compared"])
    return task


def cluster_vectors(vectors: DataFrame, k: int = 16, rounds: int = 3, size: int = 64, scale: int = 64, seed: int = 1,
                    id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, compared for every vector that is kept.

    Kept are vectors of exactly ``size`` components, none null, NaN or infinite; their components become integers.
    Centroids start as the ``k`` vectors whose ids have the smallest hashes. Each round assigns every vector to the
    nearest centroid by squared distance and moves a centroid to the floor of its vectors' mean; one without vectors
    stays. After the last round vectors are assigned once more.

    * The starting centroids are the pivots. Distances to them are taken once, turned into apex coordinates and written
      with the vectors; later rounds place only the moved centroids, and compare vectors with those whose bounds allow
      it. ``compared`` is the mean number of exact comparisons a vector in the row's batch.
    * A round is one pass without moving vectors: a task returns sums, at most k * size numbers, which are added up in a
      shuffle of these; the driver holds k centroids of ``size`` integers and no more.

    Ties go to the smaller centroid number; equal hashes are in order of the components, so repeated rows may start two
    equal centroids, the second of which stays empty. A null id hashes as empty text. Components beyond 2^26 after
    scaling are set to that limit, as distances would not fit a long. With fewer than ``k`` vectors each starts a
    centroid; an empty table gives no rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    kept = integer_vectors(vectors, size, scale, id_col, vector_col)
    start = kept.select("q", start_key(F.col("vec_id"), seed).alias("key")).orderBy("key", "q").limit(k).collect()
    centroids = np.array([r["q"] for r in start], np.int64).reshape(len(start), size)
    simplex = Simplex(centroids)
    id_type = kept.schema["vec_id"].dataType.simpleString()
    placed = stage_table(kept.mapInArrow(_apex_rows(simplex), f"vec_id {id_type}, q array<int>, apex array<double>"), "apexes")
    for _ in range(rounds):
        if not len(centroids):
            break
        parts = placed.select("q", "apex").mapInArrow(_sum_rows(centroids, simplex.place(centroids)), "cluster int, component int, n long, total long")
        moved = parts.groupBy("cluster", "component").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        centroids = centroids.copy()
        for r in moved.collect():  # at most k * size rows
            centroids[r["cluster"], r["component"]] = r["total"] // r["n"]
    assigned = placed.mapInArrow(_assigned_rows(centroids, simplex.place(centroids)), f"vec_id {id_type}, cluster int, distance long, compared double")
    assigned = stage_table(assigned, "assigned")
    digests = [(j, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(centroids.tolist())]
    named = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")
    inertia = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = int(assigned.agg(F.sum("distance")).first()[0] or 0)
    # At most k rows, whatever the input.
    each = F.broadcast(stage_table(inertia.join(F.broadcast(named), "cluster"), "inertia"))
    return assigned.join(each, "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(whole).cast("long").alias("inertia"), "centroid_sha256", "compared")
