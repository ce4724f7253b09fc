"""Reproducible splits: stratified holdout, folds, balanced plans, per-group samples.

Rows are ordered by a seeded hash of their id. A cut of exact size needs only the id of the row at
the cut: a histogram of the hash finds the bucket it lies in, and only that bucket is ranked. Every
row then compares itself with the cut, so the data itself is neither shuffled nor sorted.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyfold.functions.hashing import SEED, bucket_of, hash32
from tallyfold.operators.rowsets import null_safe_on
from tallyfold.session import stage_table

BITS = 14


def share(n: Column, part: int, whole: int) -> Column:
    """round(n * part / whole) in whole numbers, halves up."""
    return F.floor((n * (2 * part) + whole) / F.lit(2 * whole)).cast("long")


def hash_cuts(df: DataFrame, id_col: str, strata: Sequence[str], targets: dict[str, Column],
              seed: int | str = SEED, drawn: str | None = None) -> DataFrame:
    """(strata..., one struct(h, id) column per target): the last row, in hash order, of each target size.

    A target is an expression over ``total``, the number of rows in the stratum. Size 0 gives null, a size above the
    total the last row of all. ``drawn`` names a column that already holds the hash.
    """
    strata = list(strata)
    rows = df.select(*strata, _hash(id_col, seed, drawn).alias("h"), F.col(id_col).alias("id"))
    rows = rows.withColumn("b", bucket_of(F.col("h"), BITS))
    over = W.partitionBy(*strata) if strata else W.partitionBy(F.lit(0))
    hist = rows.groupBy(*strata, "b").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(over.orderBy("b").rowsBetween(W.unboundedPreceding, 0))
    hist = hist.withColumns({"upto": upto, "total": F.sum("n").over(over)})
    wanted = F.array(*[F.struct(F.lit(k).alias("cut"), F.least(t.cast("long"), F.col("total")).alias("size")) for k, t in targets.items()])
    marks = (hist.withColumn("w", F.explode(wanted)).select("*", "w.*")
             .filter((F.col("size") > F.col("upto") - F.col("n")) & (F.col("size") <= F.col("upto")))
             .select(*strata, "b", "cut", (F.col("size") - F.col("upto") + F.col("n")).alias("need")))
    keys = [*strata, "b"]
    near = rows.join(marks.select(*keys).distinct().withColumnsRenamed({k: f"m_{k}" for k in keys}),
                     _pairs(keys), "left_semi")
    ranked = near.withColumn("rn", F.row_number().over(W.partitionBy(*keys).orderBy("h", "id")))
    hit = ranked.join(marks, null_safe_on(ranked, marks, keys) & (ranked["rn"] == marks["need"]))
    picks = hit.select(*[ranked[s] for s in strata], "cut", F.struct("h", "id").alias("at"))
    cuts = [F.max(F.when(F.col("cut") == k, F.col("at"))).alias(k) for k in targets]
    return picks.groupBy(*strata).agg(*cuts)


def _hash(id_col: str, seed: int | str, drawn: str | None) -> Column:
    return F.col(drawn) if drawn else hash32(F.col(id_col), seed)


def _pairs(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"m_{k}")) for k in keys])


def with_cuts(df: DataFrame, id_col: str, strata: Sequence[str], targets: dict[str, Column],
              seed: int | str = SEED, drawn: str | None = None, among: Column | None = None) -> DataFrame:
    """``df`` plus a boolean column per target: the row is among the first ``size`` of its stratum.

    Sizes are those of the rows that meet ``among``, if it is given; all rows are compared with the cuts.
    """
    cuts = hash_cuts(df if among is None else df.filter(among), id_col, strata, targets, seed, drawn)
    here = F.struct(_hash(id_col, seed, drawn).alias("h"), F.col(id_col).alias("id"))
    if not strata:
        row, kind = cuts.first(), df.schema[id_col].dataType
        ends = {t: row and row[t] for t in targets}
        return df.withColumns({t: F.lit(False) if at is None else here <= F.struct(
            F.lit(at.h).cast("long").alias("h"), F.lit(at.id).cast(kind).alias("id")) for t, at in ends.items()})
    cuts = stage_table(cuts, "cuts")
    cuts = cuts.withColumnsRenamed({s: f"m_{s}" for s in strata} | {t: f"__{t}" for t in targets})
    joined = df.join(cuts, _pairs(strata), "left")
    flags = {t: F.coalesce(here <= F.col(f"__{t}"), F.lit(False)) for t in targets}
    return joined.withColumns(flags).drop(*[f"m_{s}" for s in strata], *[f"__{t}" for t in targets])


def stratified_holdout(df: DataFrame, id_col: str, strata: Sequence[str] = (), test: int = 15, val: int = 15,
                       whole: int = 100, seed: int = SEED, drawn: str | None = None) -> DataFrame:
    """Column ``holdout``: test, val or train. Sizes are exact in every stratum."""
    total = F.col("total")
    n_test = share(total, test, whole)
    n_val = share(total - n_test, val, whole - test)
    flagged = with_cuts(df, id_col, strata, {"__test": n_test, "__val": n_test + n_val}, seed, drawn)
    name = F.when(F.col("__test"), "test").when(F.col("__val"), "val").otherwise("train")
    return flagged.withColumn("holdout", name).drop("__test", "__val")


def kfold(df: DataFrame, id_col: str, strata: Sequence[str] = (), k: int = 5, seed: int = SEED + 1,
          drawn: str | None = None, among: Column | None = None) -> DataFrame:
    """Column ``fold`` in 1..k; fold sizes differ by at most one row in every stratum. Rows that do not meet ``among`` get null."""
    targets = {f"__f{j}": F.floor((F.col("total") * j + (k - 1)) / F.lit(k)).cast("long") for j in range(1, k)}
    flagged = with_cuts(df, id_col, strata, targets, seed, drawn, among)
    fold = F.lit(k)
    for j in range(k - 1, 0, -1):
        fold = F.when(F.col(f"__f{j}"), F.lit(j)).otherwise(fold)
    fold = fold.cast("int")
    return flagged.withColumn("fold", fold if among is None else F.when(among, fold)).drop(*targets)


def plan_splits(df: DataFrame, id_col: str, strata: Sequence[str] = (), k: int = 5, seed: int = SEED) -> DataFrame:
    """``holdout`` for all rows and ``fold`` for the rows outside the test set (null inside it).

    The md5 of a row costs more than all else here, and every cut is looked for in several passes: both hashes are drawn once
    and written with the rows.
    """
    hashes = {"__holdout": hash32(F.col(id_col), seed), "__fold": hash32(F.col(id_col), seed + 1)}
    held = stratified_holdout(stage_table(df.withColumns(hashes), "hashed"), id_col, strata, seed=seed, drawn="__holdout")
    return kfold(held, id_col, strata, k, seed + 1, "__fold", F.col("holdout") != "test").drop(*hashes)


def named_split(plan: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(train, eval) of ``testing``, ``validation`` or ``fold_i`` as filters of one plan."""
    extra = F.col("extra") if "extra" in plan.columns else F.lit(None).cast("string")
    own = extra.isNull()
    if name == "testing":
        return plan.filter(own & (F.col("holdout") != "test")), plan.filter(F.col("holdout") == "test")
    if name == "validation":
        return plan.filter(own & (F.col("holdout") == "train")), plan.filter(F.col("holdout") == "val")
    i = int(name.removeprefix("fold_"))
    inside = F.col("fold").isNotNull() & own
    return (plan.filter(inside & (F.col("fold") != i)),
            plan.filter((inside & (F.col("fold") == i)) | F.coalesce(extra == "val", F.lit(False))))


def split_names(k: int = 5) -> list[str]:
    return ["testing", "validation", *[f"fold_{i}" for i in range(1, k + 1)]]


def class_sizes(df: DataFrame, label: str) -> tuple[object, int, object, int]:
    """(majority class, its size, minority class, its size) of a label."""
    one = df.groupBy(label).count().agg(
        F.max(F.struct("count", label)).alias("hi"), F.min(F.struct("count", label)).alias("lo")).first()
    return one.hi[label], one.hi["count"], one.lo[label], one.lo["count"]


def balanced_plan(df: DataFrame, id_col: str, target: str, factor: int = 1, k: int = 5, seed: int = SEED) -> DataFrame:
    """Down-sample the majority class before splitting.

    ``minority * factor`` majority rows are split as usual with the minority. The rest gets
    ``extra`` = val or test (half each) and only ever joins evaluation sets.
    """
    major, n_major, _, n_minor = class_sizes(df, target)
    keep = n_minor * factor
    if keep > n_major:
        raise ValueError(f"factor {factor} asks for {keep} rows of the majority class, which has {n_major}")
    spare_test = -(-(n_major - keep) // 2)
    is_major = F.col(target) == F.lit(major)
    flagged = with_cuts(df.filter(is_major), id_col, [], {"__keep": F.lit(keep),
                                                          "__val": F.lit(n_major - spare_test)}, seed + 2)
    spare = flagged.filter(~F.col("__keep")).withColumn("extra", F.when(F.col("__val"), "val").otherwise("test"))
    spare = spare.drop("__keep", "__val").withColumn("holdout", F.col("extra"))
    used = flagged.filter("__keep").drop("__keep", "__val").unionByName(df.filter(~is_major))
    plan = plan_splits(used, id_col, [target], k, seed)
    return plan.unionByName(spare, allowMissingColumns=True)


def sample_per_group(df: DataFrame, id_col: str, group: Sequence[str], per_mille: int = 200,
                     seed: int = SEED) -> DataFrame:
    """max(1, floor(n * fraction)) rows of every group; the fraction is given in thousandths."""
    size = F.greatest(F.lit(1).cast("long"), F.floor(F.col("total") * per_mille / F.lit(1000)).cast("long"))
    return with_cuts(df, id_col, group, {"__pick": size}, seed).filter("__pick").drop("__pick")


def split_class_counts(plan: DataFrame, label: str, split: str = "holdout",
                       values: Sequence = ("train", "val", "test")) -> DataFrame:
    """Rows of every class per split, side by side."""
    return plan.groupBy(label).pivot(split, list(values)).count().na.fill(0)
