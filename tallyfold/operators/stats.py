"""Profile statistics: counts, describe, quantiles, skew, correlation, outliers, histograms, density."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.quantiles import interpolated, order_statistics

QUARTILES = (0.25, 0.5, 0.75)


# --- counts ------------------------------------------------------------------------------------

def row_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts around a step and how many rows it removed."""
    b = before.select(F.lit(1).alias("b"), F.lit(0).alias("a"))
    a = after.select(F.lit(0).alias("b"), F.lit(1).alias("a"))
    total = b.unionAll(a).agg(F.coalesce(F.sum("b"), F.lit(0)).alias("n_before"),
                              F.coalesce(F.sum("a"), F.lit(0)).alias("n_after"))
    return total.withColumn("n_removed", F.col("n_before") - F.col("n_after"))


def value_counts(df: DataFrame, col: str, dropna: bool = True, sort: bool = True) -> DataFrame:
    rows = df.filter(F.col(col).isNotNull()) if dropna else df
    counts = rows.groupBy(col).count()
    return counts.orderBy(F.desc("count"), F.asc_nulls_first(col)) if sort else counts


def count_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).count()


def mean_by(df: DataFrame, key: str, val: str, name: str = "mean") -> DataFrame:
    return df.groupBy(key).agg(F.avg(val).alias(name))


def unique_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct values per column as rows (column, value), so a wide domain never sits in one array."""
    return long_values(df, cols, "string").distinct()


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, n_null) for every column from one aggregate row."""
    cols = list(cols or df.columns)
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return one.unpivot([], cols, "column", "n_null")


def crosstab(df: DataFrame, row: str, col: str, values: Sequence) -> DataFrame:
    return df.groupBy(row).pivot(col, list(values)).count().na.fill(0)


def rate_by(df: DataFrame, group: str, predicate: Column, name: str = "rate") -> DataFrame:
    """Share of rows meeting the predicate; null for a group in which none does."""
    hits = F.count_if(predicate)
    return df.groupBy(group).agg((F.nullif(hits, F.lit(0).cast("long")) / F.count("*")).alias(name))


def top_bottom_groups(df: DataFrame, col: str, n: int, lookup: DataFrame, lookup_key: str, label: str) -> DataFrame:
    """The n most and n least frequent groups with their label; ties by key."""
    counts = df.groupBy(col).count()
    top = counts.orderBy(F.desc("count"), F.asc(col)).limit(n).withColumn("side", F.lit("top"))
    low = counts.orderBy(F.asc("count"), F.asc(col)).limit(n).withColumn("side", F.lit("bottom"))
    names = lookup.select(F.col(lookup_key).alias("__k"), F.col(label).alias("label"))
    both = top.unionByName(low)
    return both.join(names, both[col] == names["__k"], "left").drop("__k")


def top_words(df: DataFrame, col: str, n: int = 60) -> DataFrame:
    """Most frequent tokens: runs of characters that are neither blank nor punctuation."""
    words = df.select(F.explode(F.split(F.col(col), r"[\s\p{Punct}]+")).alias("word")).filter("word <> ''")
    return words.groupBy("word").count().orderBy(F.desc("count"), F.asc("word")).limit(n)


# --- long form and exact quantiles -------------------------------------------------------------

def long_values(df: DataFrame, cols: Sequence[str], kind: str = "double", by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, value) without nulls; one pass over the selected columns."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("value")) for c in cols]
    return (df.select(*by, F.explode(F.array(*cells)).alias("__c"))
            .select(*by, "__c.column", "__c.value").filter(F.col("value").isNotNull()))


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float] = QUARTILES,
                    by: Sequence[str] = ()) -> DataFrame:
    """Linearly interpolated quantiles per (by..., column) as columns q0, q1, ...

    By radix selection (:mod:`quantiles`): three passes over the values, of which none is shuffled.
    """
    group = [*by, "column"]
    return interpolated(order_statistics(long_values(df, cols, by=by), group, probs, not by), group, len(probs))


# --- describe ----------------------------------------------------------------------------------

def describe_numeric(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """count, mean, sample std, min, quartiles, max per column (and group)."""
    group = [*by, "column"]
    moments = long_values(df, cols, by=by).groupBy(*group).agg(
        F.count("*").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    quart = exact_quantiles(df, cols, QUARTILES, by)
    quart = quart.withColumnsRenamed({"q0": "q25", "q1": "q50", "q2": "q75"})
    return moments.join(quart, group)


def describe_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, number of distinct values, most frequent value (lowest on ties) and its frequency."""
    counts = long_values(df, cols, "string").groupBy("column", "value").agg(F.count("*").alias("n"))
    best = F.max(F.struct(F.col("n"), F.lit(0))).alias("__m")
    sized = counts.groupBy("column").agg(F.sum("n").alias("n"), F.count("*").alias("n_unique"), best)
    tops = (counts.withColumnRenamed("n", "freq").join(sized, "column").filter(F.col("freq") == F.col("__m.n"))
            .groupBy("column").agg(F.min("value").alias("top")))
    return sized.join(tops, "column").select("column", "n", "n_unique", "top", F.col("__m.n").alias("freq"))


def center_stats(df: DataFrame, col: str) -> DataFrame:
    """Mean, median and mode (lowest value on ties). Only the mode needs the distinct values with their counts."""
    counts = long_values(df, [col]).groupBy("column", "value").agg(F.count("*").alias("n"))
    most = counts.groupBy("column").agg(
        F.max_by("value", F.struct("n", -F.col("value"))).alias("mode"),
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"))
    median = exact_quantiles(df, [col], (0.5,)).withColumnRenamed("q0", "median")
    return most.join(median, "column").select("column", "mean", "median", "mode")


def skewness(df: DataFrame, cols: Sequence[str], bias: bool = True) -> DataFrame:
    """Population skewness per column, or the bias-corrected one."""
    factor = F.sqrt(F.col("n") * (F.col("n") - 1)) / (F.col("n") - 2)
    out = long_values(df, cols).groupBy("column").agg(F.count("*").alias("n"), F.skewness("value").alias("skewness"))
    return out if bias else out.withColumn("skewness", F.col("skewness") * factor)


def skew_direction_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """How many columns lean right and how many lean left."""
    return skewness(df, cols).agg(F.count_if(F.col("skewness") > 0).alias("n_right"),
                                  F.count_if(F.col("skewness") < 0).alias("n_left"))


# --- outliers ----------------------------------------------------------------------------------

def iqr_limits(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Quartiles, inter-quartile range and the fences at 1.5 and 3 ranges, per column."""
    q = exact_quantiles(df, cols, (0.25, 0.75)).select("column", F.col("q0").alias("q1"), F.col("q1").alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    return q.withColumns({
        "lower": F.col("q1") - 1.5 * F.col("iqr"), "upper": F.col("q3") + 1.5 * F.col("iqr"),
        "lower_extreme": F.col("q1") - 3 * F.col("iqr"), "upper_extreme": F.col("q3") + 3 * F.col("iqr")})


def outlier_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Columns with a value outside the 1.5-range fences. Needs only the extremes, not a second scan of rows."""
    ends = long_values(df, cols).groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    flagged = ends.join(iqr_limits(df, cols), "column")
    return flagged.filter((F.col("lo") < F.col("lower")) | (F.col("hi") > F.col("upper"))).select("column")


def fence_percentages(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Percent of rows at or above each fence."""
    limits = iqr_limits(df, cols)
    rows = long_values(df, cols).join(limits, "column")
    fences = ("lower", "lower_extreme", "upper", "upper_extreme")
    return rows.groupBy("column").agg(*[
        (F.count_if(F.col("value") >= F.col(f)) * 100.0 / F.count("*")).alias(f"pct_{f}") for f in fences])


# --- correlation -------------------------------------------------------------------------------

def correlation_pairs(df: DataFrame, cols: Sequence[str], min_abs: float = 0.0) -> DataFrame:
    """Pearson r of every ordered pair of different columns with |r| >= ``min_abs`` and r <> 1."""
    pairs = list(combinations(cols, 2))
    one = df.agg(*[F.corr(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    cells = [F.struct(F.lit(x).alias("col_a"), F.lit(y).alias("col_b"), F.col(f"{i}").alias("r"))
             for i, (a, b) in enumerate(pairs) for x, y in ((a, b), (b, a))]
    out = one.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    return out.filter((F.abs("r") >= min_abs) & (F.col("r") != 1.0))


def max_abs_correlation(df: DataFrame, cols: Sequence[str], above: float = 0.0) -> DataFrame:
    out = correlation_pairs(df, cols).groupBy(F.col("col_a").alias("column")).agg(F.max(F.abs("r")).alias("max_abs_r"))
    return out.filter(F.col("max_abs_r") > above)


# --- distributions -----------------------------------------------------------------------------

def histogram(df: DataFrame, col: str, bins: int = 30, by: Sequence[str] = (), density: bool = False) -> DataFrame:
    """Counts (or densities) in equal-width bins between min and max; the last bin is closed."""
    ends = df.agg(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi"), F.count(col).alias("n")).first()
    lo, width = F.lit(ends.lo).cast("double"), F.lit(((ends.hi or 0.0) - (ends.lo or 0.0)) / bins)
    raw = F.coalesce(F.floor(F.try_divide(F.col(col) - lo, width)), F.lit(0))
    counts = (df.filter(F.col(col).isNotNull()).withColumn("bin", F.least(raw, F.lit(bins - 1)).cast("int"))
              .groupBy(*by, "bin").agg(F.count("*").alias("n")))
    out = counts.withColumns({"bin_lo": lo + F.col("bin") * width, "bin_hi": lo + (F.col("bin") + 1) * width})
    return out.withColumn("density", F.try_divide(F.col("n"), ends.n * width)) if density else out


def kde(df: DataFrame, col: str, grid: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density on an even grid that reaches ``cut`` bandwidths past the data (Scott's rule).

    Each distinct value is weighted by its count and meets the grid through an exploded sequence, so
    sums form on the map side and only ``grid`` rows are exchanged.
    """
    one = df.agg(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi"), F.count(col).alias("n"),
                 F.stddev_samp(col).alias("sd")).first()
    bw = one.sd * one.n ** -0.2
    start, step = one.lo - cut * bw, (one.hi - one.lo + 2 * cut * bw) / (grid - 1)
    points = (df.filter(F.col(col).isNotNull()).groupBy(F.col(col).cast("double").alias("v"))
              .agg(F.count("*").alias("w"))
              .withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(grid - 1)))))
    at = F.lit(start) + F.col("i") * F.lit(step)
    z = (at - F.col("v")) / F.lit(bw)
    kernel = F.col("w") * F.exp(-0.5 * z * z)
    sums = points.groupBy("i").agg(F.sum(kernel).alias("k"))
    return sums.select("i", at.alias("x"), (F.col("k") / F.lit(one.n * bw * math.sqrt(2 * math.pi))).alias("density"))
