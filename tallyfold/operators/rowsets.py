"""Filters, joins to lookups, duplicates, reshapes and best-row picks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


# --- filters -----------------------------------------------------------------------------------

def keep_in(df: DataFrame, col: str, values: Sequence, keep_null: bool = False) -> DataFrame:
    cond = F.col(col).isin(list(values))
    return df.filter(cond | F.col(col).isNull() if keep_null else cond)


def drop_if_greater(df: DataFrame, a: str, b: str) -> DataFrame:
    """Drop rows with a > b; a comparison with null keeps the row."""
    return df.filter(~F.coalesce(F.col(a) > F.col(b), F.lit(False)))


def between_half_open(df: DataFrame, col: str, lo, hi) -> DataFrame:
    return df.filter((F.col(col) >= lo) & (F.col(col) < hi))


def non_numeric_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values that are not numbers."""
    return df.filter(F.col(col).try_cast("double").isNull()).select(col).distinct()


def fill_by_keyword(df: DataFrame, text: str, target: str, missing: str, rules: Mapping[str, str]) -> DataFrame:
    """Where ``target`` equals ``missing``, set it by the first pattern found in ``text`` (any case)."""
    value = F.col(target)
    chosen = F.when(value != missing, value)
    for pattern, code in rules.items():
        chosen = chosen.when(F.col(text).rlike(f"(?i){pattern}"), F.lit(code))
    return df.withColumn(target, chosen.otherwise(value))


def fill_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.na.fill(dict(values))


# --- joins -------------------------------------------------------------------------------------

def null_safe_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equality on all keys where null equals null."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def lookup_key(df: DataFrame, dim: DataFrame, on: Mapping[str, str], key: str, as_name: str | None = None,
               how: str = "inner") -> DataFrame:
    """Add ``dim``'s key by its natural columns; ``on`` maps fact column to dim column.

    The size of the dim decides the join: no hint is given, so a small one (by statistics or after
    its stage has run) is broadcast and a large one is shuffled, with skewed keys split.
    """
    renamed = dim.select(*[F.col(d).alias(f"__{d}") for d in on.values()], F.col(key).alias(as_name or key))
    cond = reduce(lambda a, b: a & b, [F.col(f) == F.col(f"__{d}") for f, d in on.items()])
    return df.join(renamed, cond, how).drop(*[f"__{d}" for d in on.values()])


def join_roles(df: DataFrame, dim: DataFrame, dim_key: str, roles: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Inner join of the same small dim once per role; each role maps dim columns to output names."""
    for fact_key, names in roles.items():
        side = dim.select(F.col(dim_key).alias("__k"), *[F.col(c).alias(n) for c, n in names.items()])
        df = df.join(side, F.col(fact_key) == F.col("__k"), "inner").drop("__k")
    return df


# --- duplicates --------------------------------------------------------------------------------

def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int = 1,
                  rank_name: str | None = None) -> DataFrame:
    """The first ``n`` rows of each key in a fixed order.

    Spark keeps only ``n`` rows per key on the map side (group limit), so a hot key stays small.
    """
    name = rank_name or "__rn"
    out = df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col(name) <= n)
    return out if rank_name else out.drop(name)


def dedup(df: DataFrame, keys: Sequence[str] | None = None, order: Sequence[str | Column] | None = None) -> DataFrame:
    """Whole-row or key duplicates removed; with ``order`` the first row of each key stays."""
    if order:
        return first_per_key(df, keys or df.columns, order)
    return df.dropDuplicates(list(keys)) if keys else df.dropDuplicates()


def duplicate_rows(df: DataFrame, cols: Sequence[str], row_id: str) -> DataFrame:
    """Rows that repeat an earlier row over ``cols``, as many as there are beyond the first.

    Rows are ordered by ``row_id``, and by all columns where that repeats. Of rows equal in every column, all but one are
    given. Only the first row of each group travels, never a whole group. The key travels as one value, in which null equals
    null, so a join finds the first rows where they were picked; every column travels once.
    """
    rest = [c for c in df.columns if c not in cols]
    rows = df.select(F.struct(*cols).alias("__key"), *rest)
    at = F.struct(*sorted(rest, key=lambda c: c != row_id)) if rest else F.lit(0)  # within a group its key does not tell rows apart
    first = rows.groupBy("__key").agg(F.min(at).alias("__first"), F.count("*").alias("__m"))
    rows = rows.join(first, "__key").select(*[F.col(f"__key.{c}") if c in cols else F.col(c) for c in df.columns], "__m", (at == F.col("__first")).alias("__is_first"))
    later = rows.filter("NOT __is_first").select(*df.columns)
    copies = rows.filter("__is_first AND __m > 1").groupBy(*df.columns).agg(F.count("*").alias("__n")).filter("__n > 1")
    return later.unionAll(copies.withColumn("__i", F.explode(F.expr("sequence(2, __n)"))).select(*df.columns))


def upsert_first_wins(existing: DataFrame | None, new: DataFrame, keys: Sequence[str], attrs: Sequence[str],
                      order: Column) -> DataFrame:
    """Rows to append: the earliest row of each new natural key that ``existing`` does not hold yet."""
    rows = first_per_key(new, list(keys), [order.asc_nulls_last(), *attrs]).select(*keys, *attrs)
    return rows if existing is None else rows.join(existing.select(*keys), list(keys), "left_anti")


def best_per_group(df: DataFrame, group: str, metric: str, tie: str, largest: bool = True) -> DataFrame:
    """The row with the largest (smallest) metric in each group, first by ``tie`` on equal values."""
    order = F.col(metric).desc_nulls_last() if largest else F.col(metric).asc_nulls_last()
    return first_per_key(df, [group], [order, F.col(tie)])


# --- reshapes ----------------------------------------------------------------------------------

def pivot(df: DataFrame, index: Sequence[str], col: str, val: str, values: Sequence) -> DataFrame:
    return df.groupBy(*index).pivot(col, list(values)).agg(F.first(val, ignorenulls=True))


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], var: str = "variable",
         val: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(values), var, val)


def unnest_parallel(df: DataFrame, ids: Sequence[str], arrays: Mapping[str, str]) -> DataFrame:
    """Parallel array columns to rows; ``arrays`` maps array column to output name."""
    zipped = df.select(*ids, F.explode(F.arrays_zip(*arrays)).alias("__z"))
    return zipped.select(*ids, *[F.col(f"__z.{a}").alias(n) for a, n in arrays.items()])
