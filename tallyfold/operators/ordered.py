"""Ranks, running totals and carried-forward values over huge or badly skewed groups.

A plain window sends each group to one task. Here a group is cut into order-preserving chunks, each
chunk is worked on by its own task, and the chunks are linked by a small per-chunk summary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyfold.functions.hashing import bucket_of
from tallyfold.operators.rowsets import null_safe_on
from tallyfold.session import stage_table

CHUNK = "__chunk"


def range_chunks(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add a chunk number that grows with ``order`` and holds about equally many rows.

    Range partitioning samples the data for its bounds; writing the result fixes them, so every
    later use sees the same chunks. Put a unique column last in ``order`` and no value is hot.
    """
    ranged = df.repartitionByRange(*order).withColumn(CHUNK, F.spark_partition_id())
    return stage_table(ranged, "chunks")


def _chunk_window(group: Sequence[str]):
    return W.partitionBy(*group) if group else W.partitionBy(F.lit(0))


def _attach(df: DataFrame, side: DataFrame, group: Sequence[str], chunk: str = CHUNK) -> DataFrame:
    """A chunk is never null: equality on it finds rows that a window has already brought together by chunk alone."""
    on = df[chunk] == side[chunk]
    return df.join(side, null_safe_on(df, side, group) & on if group else on, "left").drop(*[side[k] for k in (*group, chunk)])


def rank_in_chunks(df: DataFrame, order: Sequence[str | Column], group: Sequence[str] = (), name: str = "rank",
                   chunk: str = CHUNK) -> DataFrame:
    """Exact 1-based row number within ``group`` from rows that carry an order-preserving chunk."""
    keys = [*group, chunk]
    before = _chunk_window(group).orderBy(chunk).rowsBetween(W.unboundedPreceding, -1)
    sizes = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    offsets = sizes.select(*keys, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    local = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    ranked = df.withColumn("__local", local)
    return (_attach(ranked, offsets, group, chunk)
            .withColumn(name, (F.col("__before") + F.col("__local")).cast("long"))
            .drop("__before", "__local"))


def rank_by(df: DataFrame, order: Sequence[str], group: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """Exact 1-based ascending row number in any order, without a one-task window."""
    return rank_in_chunks(range_chunks(df, [*group, *order]), order, group, name).drop(CHUNK)


def rank_by_hash(df: DataFrame, h: str, tie: str, group: Sequence[str] = (), name: str = "rank",
                 bits: int = 14) -> DataFrame:
    """Row number in the order of a uniform 32-bit hash column, null first; its leading bits are the chunks."""
    chunked = df.withColumn(CHUNK, F.coalesce(bucket_of(F.col(h), bits), F.lit(-1)))
    return rank_in_chunks(chunked, [h, tie], group, name).drop(CHUNK)


def running_totals(df: DataFrame, order: Sequence[str], sums: dict[str, str], group: Sequence[str] = ()) -> DataFrame:
    """Inclusive running sums in ``order``; ``sums`` maps output name to input column.

    ``df`` holds one row per order value, so aggregate to distinct values first. The grand total of
    the group comes along as ``total_<name>``.
    """
    chunked = range_chunks(df, [*group, *order])
    keys = [*group, CHUNK]
    before = _chunk_window(group).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
    totals = chunked.groupBy(*keys).agg(*[F.sum(c).alias(f"__t_{o}") for o, c in sums.items()])
    offsets = totals.select(
        *keys,
        *[F.coalesce(F.sum(f"__t_{o}").over(before), F.lit(0)).alias(f"__b_{o}") for o in sums],
        *[F.sum(f"__t_{o}").over(_chunk_window(group)).alias(f"total_{o}") for o in sums])
    inside = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    local = chunked.withColumns({f"__l_{o}": F.sum(c).over(inside) for o, c in sums.items()})
    linked = _attach(local, offsets, group).withColumns({o: F.col(f"__b_{o}") + F.col(f"__l_{o}") for o in sums})
    return linked.drop(CHUNK, *[f"__{p}_{o}" for o in sums for p in ("b", "l")])


def forward_fill(df: DataFrame, group: str, col: str, order: str, source: DataFrame | None = None) -> DataFrame:
    """Carry the last known value of ``col`` forward inside ``group``; leading nulls stay null.

    ``order`` is a unique row id. Only groups with a gap take part, with three columns; the filled
    cells are then joined back by id, so complete rows never move for it. ``source`` may give the
    three columns from a table that is cheaper to read than ``df``.
    """
    base = df if source is None else source
    gaps = base.filter(F.col(col).isNull()).select(group).distinct()
    narrow = base.select(group, order, col).join(gaps, group, "left_semi")
    chunked = range_chunks(narrow, [group, order])
    keys = [group, CHUNK]
    last_known = F.max_by(col, F.when(F.col(col).isNotNull(), F.col(order)))
    ends = chunked.groupBy(*keys).agg(last_known.alias("__last"))
    before = W.partitionBy(group).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select(*keys, F.last("__last", ignorenulls=True).over(before).alias("__carry"))
    inside = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    local = chunked.withColumn("__here", F.last(col, ignorenulls=True).over(inside)).filter(F.col(col).isNull())
    linked = _attach(local, carried, [group]).select(order, F.coalesce("__here", "__carry").alias("__filled"))
    filled = stage_table(linked.filter(F.col("__filled").isNotNull()), "filled")
    out = df.join(filled, order, "left").withColumn(col, F.coalesce(F.col(col), F.col("__filled")))
    return out.select(*df.columns)


def with_previous(df: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """Add ``value`` of the row before in ``order`` (null on the first row)."""
    chunked = range_chunks(df, [order])
    ends = chunked.groupBy(CHUNK).agg(F.max_by(value, order).alias("__end"))
    before = W.partitionBy(F.lit(0)).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select(CHUNK, F.last("__end", ignorenulls=True).over(before).alias("__carry"))
    here = F.lag(value).over(W.partitionBy(CHUNK).orderBy(order))
    linked = _attach(chunked.withColumn("__here", here), carried, [])
    return linked.withColumn(name, F.coalesce("__here", "__carry")).drop(CHUNK, "__here", "__carry")
