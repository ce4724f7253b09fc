"""Exact order statistics by radix selection: only counts of digits are shuffled, never values."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.session import stage_table

SHIFTS = (42, 21, 0)  # digits of 22, 21 and 21 bits


def _ordered_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: adds the last column, doubles, as 64-bit integers in the same order; NaN last, both zeros alike."""
    for batch in batches:
        bits = _bits(batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bits)], names=[*batch.schema.names, "bits"])


def _bits(values: np.ndarray) -> np.ndarray:
    values = values + 0.0
    bits = np.where(np.isnan(values), np.nan, values).view(np.int64)
    return np.where(bits < 0, bits ^ np.int64((1 << 63) - 1), bits)


COUNTED = 1 << 20  # digits that a task may hold before it sends them on


def _digit_counts(width: int, shift: int, prefix: int | None, wanted: list[np.ndarray] | None):
    """Task: (column, prefix, digit, n, value) of the entries of arrays; ``wanted`` are the prefixes of each column that count."""
    def merged(parts: list[tuple]) -> tuple[np.ndarray, ...]:
        digit, n, value = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(digit, kind="stable")
        digit, starts = np.unique(digit[order], return_index=True)
        n, value = np.add.reduceat(n[order], starts), np.minimum.reduceat(value[order], starts)
        return digit, n, value

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in range(width)]
        size = 0

        def flushed() -> Iterator[pa.RecordBatch]:
            for column, parts in enumerate(held):
                if parts:
                    digit, n, value = merged(parts)
                    before = digit >> (prefix - shift) if prefix is not None else np.zeros(len(digit), np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(digit), column, np.int32)), pa.array(before), pa.array(digit), pa.array(n), pa.array(value)],
                                                     names=["column", "prefix", "digit", "n", "value"])
                parts.clear()

        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            for column in range(width):
                value = np.sort(x[:, column] + 0.0)  # NaN last, as in the order of the bits
                bits = _bits(value)
                if wanted is not None:
                    on = np.isin(bits >> prefix, wanted[column])
                    value, bits = value[on], bits[on]
                if len(bits):
                    digit, starts = np.unique(bits >> shift, return_index=True)
                    held[column].append((digit, np.diff(starts, append=len(bits)), value[starts]))
                    size += len(digit)
            if size > COUNTED:
                yield from flushed()
                size = 0
        yield from flushed()
    return task


def column_statistics(arrays: DataFrame, width: int, probs: Sequence[float]) -> DataFrame:
    """:func:`order_statistics` of the entries of one array column, (column, i, low, high, part): entries are numbered, not exploded.
    A task counts the digits of its own rows, so that a pass sends counts out of Python and no value."""
    def counted(shift: int, prefix: int | None, found: DataFrame | None) -> DataFrame:
        wanted = None
        if found is not None:
            seen = found.select("column", "digit").distinct().collect()  # at most two a rank and column
            wanted = [np.array(sorted(r["digit"] for r in seen if r["column"] == c), np.int64) for c in range(width)]
        counts = arrays.mapInArrow(_digit_counts(width, shift, prefix, wanted), "column int, prefix long, digit long, n long, value double")
        keys = ["column"] if prefix is None else ["column", "prefix"]
        # Bounded by the digits, not by the rows; both uses of a pass read what it wrote.
        return stage_table(counts.groupBy(*keys, "digit").agg(F.sum("n").alias("n"), F.min("value").alias("value")), "digits")

    return _selected(arrays.sparkSession, counted, ["column"], probs, True)


def _meet(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])


def order_statistics(long: DataFrame, group: Sequence[str], probs: Sequence[float], few_groups: bool) -> DataFrame:
    """(group..., i, low, high, part): the values at ranks floor(p (n - 1)) and ceil(p (n - 1)) of each group for the i-th
    of ``probs``, and the fraction between the ranks.

    long: group..., value (double, without nulls). A value is read as three digits of its order-preserving bits. One pass
    counts the first digits of all values and finds the digit that each wanted rank falls into; the next pass counts the
    second digits of the values behind these alone, and so on. A pass shuffles counts that were added up on the map
    side, at most 2^22 a group, however many rows it holds. What a pass has found is two digits a rank and group: with
    ``few_groups`` (a bounded number, as of columns) these few rows go through the driver; else they are written.
    """
    long = long.select(*group, F.col("value").cast("double"))
    keyed = long.mapInArrow(_ordered_bits, T.StructType([*long.schema.fields, T.StructField("bits", T.LongType())]))

    def counted(shift: int, prefix: int | None, found: DataFrame | None) -> DataFrame:
        rows, keys = keyed.withColumn("digit", F.shiftright("bits", shift)), [*group]
        if found is not None:
            wanted = found.select(*[F.col(k).alias(f"__{k}") for k in group], F.col("digit").alias("__digit")).distinct()
            rows = rows.withColumn("prefix", F.shiftright("bits", prefix))
            rows = rows.join(wanted, _meet(rows, wanted, [*[(k, f"__{k}") for k in group], ("prefix", "__digit")]), "left_semi")
            keys.append("prefix")
        return rows.groupBy(*keys, "digit").agg(F.count("*").alias("n"), F.min("value").alias("value"))

    return _selected(long.sparkSession, counted, group, probs, few_groups)


def _selected(spark: SparkSession, counted: Callable, group: Sequence[str], probs: Sequence[float], few_groups: bool) -> DataFrame:
    """The passes of the selection; ``counted`` gives the counts of one, behind the digits found so far."""
    found, prefix = None, None
    for shift in SHIFTS:
        counts, keys = counted(shift, prefix, found), [*group] if found is None else [*group, "prefix"]
        before = F.sum("n").over(W.partitionBy(*keys).orderBy("digit").rowsBetween(W.unboundedPreceding, -1))
        counts = counts.withColumn("place", F.coalesce(before, F.lit(0)))
        if found is None:
            places = F.array(*[F.struct(F.lit(i).alias("i"), (F.lit(float(p)) * (F.col("size") - 1)).alias("at")) for i, p in enumerate(probs)])
            sized = counts.groupBy(*group).agg(F.sum("n").alias("size")).select(*group, F.explode(places).alias("p"))
            sought = sized.select(*group, "p.i", (F.col("p.at") - F.floor("p.at")).alias("part"),
                                  F.posexplode(F.array(F.floor("p.at"), F.ceil("p.at"))).alias("end", "place"))
        else:
            sought = found.select(*group, "i", "part", "end", F.col("rank").alias("place"), F.col("digit").alias("prefix"))
        # A rank falls into the last digit that begins at or before it.
        line = counts.select(*keys, "place", F.struct("digit", "place", "value").alias("here")).unionByName(sought, allowMissingColumns=True)
        last = F.last("here", ignorenulls=True).over(W.partitionBy(*keys).orderBy("place", F.col("i").isNotNull()).rowsBetween(W.unboundedPreceding, 0))
        found = line.withColumn("in", last).filter(F.col("i").isNotNull()).select(
            *group, "i", "part", "end", (F.col("place") - F.col("in.place")).alias("rank"), "in.digit", "in.value")
        # Used twice by the next pass, and worth a pass over all values. A table made from Arrow has a known size: joins broadcast it.
        found = spark.createDataFrame(found.toArrow(), found.schema) if few_groups else stage_table(found, "digits")
        prefix = shift
    low, high = (F.max(F.when(F.col("end") == e, F.col("value"))).alias(name) for e, name in ((0, "low"), (1, "high")))
    return found.groupBy(*group, "i").agg(low, high, F.first("part").alias("part"))


def interpolated(stats: DataFrame, group: Sequence[str], n: int) -> DataFrame:
    """One row a group with columns q0, q1, ...: linear between the two values."""
    value = F.col("low") + (F.col("high") - F.col("low")) * F.col("part")
    return stats.groupBy(*group).agg(*[F.max(F.when(F.col("i") == i, value)).alias(f"q{i}") for i in range(n)])
