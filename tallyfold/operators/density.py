"""Density clustering (DBSCAN): one dimension, low-dimensional points, and general vectors.

All forms work on distinct points with weights, so copies collapse before any join, and number the
clusters from 0 by their smallest core row; noise is -1 and a border point takes its lowest cluster.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.components import connected_components
from tallyfold.operators.neighbours import radius_best, radius_counts, radius_links
from tallyfold.operators.ordered import rank_by, running_totals, with_previous
from tallyfold.session import stage_table


# --- one dimension -----------------------------------------------------------------------------

def window_weights(values: DataFrame, eps: float, blocks: int = 1024) -> DataFrame:
    """Add ``near``: total weight ``w`` of values within ``eps`` of each distinct value ``v``.

    The axis is cut into blocks at least ``eps`` wide; a value is copied to the blocks next to it and
    every block slides its own window.
    """
    ends = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    width = max(eps, ((ends.hi or 0.0) - (ends.lo or 0.0)) / blocks) or 1.0
    home = F.floor(F.col("v") / width)
    halo = values.withColumn("home", home).withColumn("block", F.explode(F.sequence(home - 1, home + 1)))
    slide = f"partition by block order by v range between {float(eps)!r}D preceding and {float(eps)!r}D following"
    return halo.withColumn("near", F.expr(f"sum(w) over ({slide})")).filter("block = home").drop("home", "block")


def dbscan_1d(df: DataFrame, row_key: str, col: str, eps: float, min_pts: int) -> DataFrame:
    """``df`` plus ``cluster``. Cores in one cell of width ``eps`` belong together, so cells are linked, not points."""
    values = df.groupBy(F.col(col).cast("double").alias("v")).agg(
        F.count("*").cast("double").alias("w"), F.min(row_key).alias("first"))
    points = stage_table(window_weights(values, eps).withColumns({
        "core": F.col("near") >= min_pts, "cell": F.floor(F.col("v") / eps)}), "points")
    cells = points.filter("core").groupBy("cell").agg(
        F.min("v").alias("lo"), F.max("v").alias("hi"), F.min("first").alias("first"))
    linked = with_previous(cells, "cell", "hi", "prev")
    starts = linked.withColumn("start", F.when(F.col("prev").isNull() | (F.col("lo") - F.col("prev") > eps), 1).otherwise(0))
    runs = stage_table(running_totals(starts, ["cell"], {"run": "start"}).select("cell", "lo", "hi", "first", "run"), "runs")
    ids = rank_by(runs.groupBy("run").agg(F.min("first").alias("first")), ["first"]).select(
        "run", (F.col("rank") - 1).alias("cluster"))
    near = stage_table(runs.join(ids, "run").select(F.col("cell").alias("c"), "lo", "hi", "cluster"), "cells")
    asked = points.select("v", "core", "cell", F.explode(
        F.when(F.col("core"), F.array("cell")).otherwise(F.sequence(F.col("cell") - 1, F.col("cell") + 1))).alias("c"))
    reach = (F.col("c") == F.col("cell")) | ((F.col("c") < F.col("cell")) & (F.col("v") - F.col("hi") <= eps)) | (
        (F.col("c") > F.col("cell")) & (F.col("lo") - F.col("v") <= eps))
    labels = asked.join(near, "c").filter(reach).groupBy("v").agg(F.min("cluster").alias("cluster"))
    tagged = df.join(labels, F.col(col).cast("double") == F.col("v"), "left").drop("v")
    return tagged.withColumn("cluster", F.coalesce("cluster", F.lit(-1)).cast("int"))


def anomalies(clustered: DataFrame) -> DataFrame:
    return clustered.filter("cluster = -1")


# --- one to three dimensions -------------------------------------------------------------------

def _gap2(cols: Sequence[str], a: str, b: str) -> Column:
    total = F.lit(0.0)
    for c in cols:
        gap = F.col(f"{a}.{c}") - F.col(f"{b}.{c}")
        total = total + gap * gap
    return total


def _offsets(dims: int) -> list[tuple[int, ...]]:
    """Cells whose nearest corners lie within eps when the cell diagonal is eps."""
    reach = range(-2, 3)
    return [o for o in product(reach, repeat=dims) if sum(max(abs(x) - 1, 0) ** 2 for x in o) <= dims]


def _shift(cell: str, offsets: list[tuple[int, ...]]) -> Column:
    moved = [F.array(*[F.element_at(cell, i + 1) + F.lit(x).cast("long") for i, x in enumerate(o)]) for o in offsets]
    return F.explode(F.array(*moved))


def dbscan(df: DataFrame, row_key: str, cols: Sequence[str], eps: float, min_pts: int,
           weight: str | None = None) -> DataFrame:
    """``df`` plus ``cluster`` for points in one to three dimensions.

    Cells have diagonal ``eps``: a cell holding ``min_pts`` weight makes all its points cores without
    a single distance, so only cells poorer than ``min_pts`` look around. Cells, not points, are
    linked: sub-cell bounding boxes settle nearly all links and only undecided boxes compare points.
    """
    cols, dims = list(cols), len(cols)
    if not 1 <= dims <= 3:
        raise ValueError("dbscan takes one to three columns; use dbscan_vectors")
    side, fine = eps / dims ** 0.5, 4
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    xs = [F.col(c).cast("double").alias(c) for c in cols]
    points = df.select(*xs, w.alias("w"), F.col(row_key).alias("__k")).groupBy(*cols).agg(
        F.sum("w").alias("w"), F.min("__k").alias("pid"))
    points = points.withColumns({
        "cell": F.array(*[F.floor(F.col(c) / side) for c in cols]),
        "sub": F.array(*[F.floor(F.col(c) / (side / fine)) for c in cols])})
    points = stage_table(points, "points")
    rich = points.groupBy("cell").agg((F.sum("w") >= min_pts).alias("rich"))
    points = stage_table(points.join(rich, "cell"), "points")

    around = _offsets(dims)
    poor = points.filter("not rich").withColumn("at", _shift("cell", around)).alias("p")
    others = points.alias("q")
    seen = poor.join(others, F.col("p.at") == F.col("q.cell")).filter(_gap2(cols, "p", "q") <= eps * eps)
    poor_cores = seen.groupBy(F.col("p.pid").alias("pid")).agg(F.sum("q.w").alias("near")).filter(F.col("near") >= min_pts)
    flagged = points.join(poor_cores.select("pid", F.lit(True).alias("__c")), "pid", "left").withColumn(
        "core", F.col("rich") | F.coalesce("__c", F.lit(False))).drop("__c", "rich")
    points = stage_table(flagged, "points")
    cores = points.filter("core")

    heads = stage_table(cores.groupBy("cell").agg(F.min("pid").alias("node")), "heads")
    boxes = cores.groupBy("cell", "sub").agg(*[f(c).alias(f"{k}_{c}") for c in cols
                                               for k, f in (("lo", F.min), ("hi", F.max))])
    boxes = stage_table(boxes.join(heads, "cell"), "boxes")
    half = [o for o in around if o > tuple([0] * dims)]
    pairs = boxes.withColumn("at", _shift("cell", half)).alias("a").join(boxes.alias("b"), F.col("a.at") == F.col("b.cell"))
    near2, far2 = F.lit(0.0), F.lit(0.0)
    for c in cols:
        apart = F.greatest(F.col(f"a.lo_{c}") - F.col(f"b.hi_{c}"), F.col(f"b.lo_{c}") - F.col(f"a.hi_{c}"), F.lit(0.0))
        reach = F.greatest(F.col(f"a.hi_{c}") - F.col(f"b.lo_{c}"), F.col(f"b.hi_{c}") - F.col(f"a.lo_{c}"))
        near2, far2 = near2 + apart * apart, far2 + reach * reach
    links = pairs.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"), F.col("a.sub").alias("sa"),
                         F.col("b.sub").alias("sb"), (far2 <= eps * eps).alias("sure"), near2.alias("near2"))
    links = stage_table(links.filter(F.col("near2") <= eps * eps), "links")
    sure = links.filter("sure").select("a", "b").distinct()
    open_ = links.filter("not sure").join(sure, ["a", "b"], "left_anti")
    left = cores.select(F.col("sub").alias("sa"), F.struct(*cols).alias("p"))
    right = cores.select(F.col("sub").alias("sb"), F.struct(*cols).alias("q"))
    found = open_.join(left, "sa").join(right, "sb").filter(_gap2(cols, "p", "q") <= eps * eps).select("a", "b").distinct()

    parts = stage_table(connected_components(heads, sure.unionAll(found)), "parts")
    ids = rank_by(parts.select("component").distinct(), ["component"]).select(
        "component", (F.col("rank") - 1).alias("cluster"))
    cell_ids = stage_table(heads.join(parts, "node").join(ids, "component").select("cell", "cluster"), "cells")
    core_ids = cores.join(cell_ids, "cell")
    edge = points.filter("not core").withColumn("at", _shift("cell", around)).alias("p")
    border = edge.join(core_ids.alias("q"), F.col("p.at") == F.col("q.cell")).filter(
        _gap2(cols, "p", "q") <= eps * eps).groupBy(F.col("p.pid").alias("pid")).agg(F.min("q.cluster").alias("cluster"))
    named = core_ids.select("pid", "cluster").unionAll(border)
    labels = stage_table(points.select("pid", *cols).join(named, "pid").select(
        *[F.col(c).alias(f"__{c}") for c in cols], F.col("cluster").alias("__cluster")), "labels")
    cond = F.lit(True)
    for c in cols:
        cond = cond & (F.col(c).cast("double") == F.col(f"__{c}"))
    out = df.join(labels, cond, "left").withColumn("cluster", F.coalesce("__cluster", F.lit(-1)).cast("int"))
    return out.drop("__cluster", *[f"__{c}" for c in cols])


def hotspots(df: DataFrame, row_key: str, x: str, y: str, eps: float, min_pts: int) -> DataFrame:
    """Dense areas of a map: DBSCAN on coordinates, copies of a place counted by weight."""
    return dbscan(df, row_key, [x, y], eps, min_pts)


# --- vectors -----------------------------------------------------------------------------------

def dbscan_vectors(df: DataFrame, row_key: str, vec: str, eps: float, min_pts: int) -> DataFrame:
    """``df`` plus ``cluster`` for vectors of any length (``row_key`` is a long)."""
    rows = df.select(F.col(row_key).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("vec"))
    points = stage_table(rows.groupBy("vec").agg(F.min("id").alias("rid"), F.count("*").cast("double").alias("w")), "points")
    near = radius_counts(points, "rid", "vec", eps, weight="w")
    points = stage_table(points.join(near, "rid").withColumn("core", F.col("n_within") >= min_pts), "points")
    cores = points.filter("core").select("rid", "vec")
    if not cores.take(1):
        return df.withColumn("cluster", F.lit(-1))
    nodes = cores.select(F.col("rid").alias("node"))
    parts = stage_table(connected_components(nodes, radius_links(cores, eps)), "parts")
    ids = rank_by(parts.select("component").distinct(), ["component"]).select(
        "component", (F.col("rank") - 1).alias("cluster"))
    named = stage_table(parts.join(ids, "component").select(F.col("node").alias("rid"), "cluster"), "named")
    tagged = cores.join(named, "rid")
    border = radius_best(points.filter("not core").select("rid", "vec"), tagged, eps, "cluster")
    labels = named.unionAll(border).join(points.select("rid", "vec"), "rid").select(
        F.col("vec").alias("__vec"), F.col("cluster").alias("__cluster"))
    out = df.join(labels, F.col(vec).cast("array<double>") == F.col("__vec"), "left").drop("__vec")
    return out.withColumn("cluster", F.coalesce("__cluster", F.lit(-1)).cast("int")).drop("__cluster")


# --- results -----------------------------------------------------------------------------------

def cluster_members(df: DataFrame, date_col: str, day_col: str) -> DataFrame:
    """Members of each cluster as (cluster, dates, weekdays): one entry per calendar day, so lists stay short."""
    return df.groupBy("cluster").agg(F.array_sort(F.collect_set(date_col)).alias("dates"),
                                     F.array_sort(F.collect_set(day_col)).alias("day_names"))


def cluster_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("cluster").count().orderBy("cluster")
