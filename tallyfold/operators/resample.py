"""Class resampling of training rows: random over/under-sampling, SMOTE family, NearMiss.

Two classes are assumed, as in the experiments. Sizes are exact; which rows are drawn follows the
seeded hash of the row id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyfold.functions.hashing import HASH_SPACE, SEED, hash32, hash60
from tallyfold.operators.neighbours import knn_join
from tallyfold.operators.ordered import rank_by, rank_by_hash
from tallyfold.operators.sampling import class_sizes, with_cuts
from tallyfold.session import stage_table


def random_undersample(df: DataFrame, id_col: str, label: str, ratio: float = 1.0, seed: int = SEED) -> DataFrame:
    """Keep n_minority / ratio rows of the majority class, without replacement."""
    major, n_major, _, n_minor = class_sizes(df, label)
    keep = min(n_major, int(n_minor / ratio))
    is_major = F.col(label) == F.lit(major)
    kept = with_cuts(df.filter(is_major), id_col, [], {"__keep": F.lit(keep)}, seed).filter("__keep").drop("__keep")
    return kept.unionByName(df.filter(~is_major))


def random_oversample(df: DataFrame, id_col: str, label: str, ratio: float = 1.0, seed: int = SEED) -> DataFrame:
    """Add minority rows drawn with replacement until minority = ratio * majority. ``draw`` is null on originals."""
    _, n_major, minor, n_minor = class_sizes(df, label)
    need = max(0, int(n_major * ratio) - n_minor)
    pool = rank_by_hash(df.filter(F.col(label) == F.lit(minor)).withColumn("__h", hash32(F.col(id_col), seed)),
                        "__h", id_col, name="__rank").drop("__h")
    draws = df.sparkSession.range(need).select(
        F.col("id").alias("draw"), (F.pmod(hash60(F.col("id"), f"{seed}:draw"), F.lit(n_minor)) + 1).alias("__rank"))
    extra = draws.join(pool, "__rank").drop("__rank")
    return df.unionByName(extra, allowMissingColumns=True)


def _seeds(minority: DataFrame, total: int, n_rows: int, seed: int) -> DataFrame:
    """Spread ``total`` synthetic rows over the seed rows in hash order: (id, j), j counts within a row."""
    ranked = rank_by_hash(minority.select("id").withColumn("h", hash32(F.col("id"), seed)), "h", "id")
    each, rest = divmod(total, max(n_rows, 1))
    quota = F.lit(each) + F.when(F.col("rank") <= rest, 1).otherwise(0)
    return ranked.select("id", quota.cast("int").alias("quota"))


def _interpolate(seeds: DataFrame, near: DataFrame, vectors: DataFrame, k: int, seed: int) -> DataFrame:
    """Synthetic points x + t * (x_nn - x): one of the k neighbours and t in [0, 1) by hash of (id, j)."""
    draws = seeds.filter("quota > 0").select("id", F.explode(F.sequence(F.lit(0), F.col("quota") - 1)).alias("j"))
    key = F.concat_ws("-", F.col("id").cast("string"), F.col("j").cast("string"))
    sized = near.groupBy("left_id").agg(F.max("rank").alias("n_near"))
    draws = draws.join(sized, F.col("id") == F.col("left_id")).drop("left_id").withColumns({
        "pick": (F.pmod(hash32(key, f"{seed}:nn"), F.least(F.lit(k), F.col("n_near"))) + 1).cast("int"),
        "t": hash32(key, f"{seed}:gap") / F.lit(float(HASH_SPACE))})
    chosen = draws.join(near, (F.col("id") == F.col("left_id")) & (F.col("pick") == F.col("rank")))
    a = vectors.select(F.col("id").alias("__a"), F.col("vec").alias("x"))
    b = vectors.select(F.col("id").alias("__b"), F.col("vec").alias("y"))
    pairs = chosen.join(a, F.col("id") == F.col("__a")).join(b, F.col("right_id") == F.col("__b"))
    moved = F.zip_with("x", "y", lambda x, y: (y - x))
    return (pairs.withColumn("__d", moved)
            .withColumn("__g", F.transform("__d", lambda d: d * F.col("t")))
            .select(F.col("id").alias("seed_id"), F.col("right_id").alias("neighbour_id"), "j", "t",
                    F.zip_with("x", "__g", lambda x, g: x + g).alias("vec")))


def _vectors(df: DataFrame, id_col: str, vec: str, cond: Column | None = None) -> DataFrame:
    rows = df if cond is None else df.filter(cond)
    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("vec"))


def smote(df: DataFrame, id_col: str, vec: str, label: str, k: int = 5, ratio: float = 1.0,
          seed: int = SEED) -> DataFrame:
    """Synthetic minority rows (seed_id, neighbour_id, j, t, vec) up to ratio * majority."""
    _, n_major, minor, n_minor = class_sizes(df, label)
    need = max(0, int(n_major * ratio) - n_minor)
    minority = stage_table(_vectors(df, id_col, vec, F.col(label) == F.lit(minor)), "minority")
    near = knn_join(minority, minority, k, "id", "id", "vec", exclude_self=True)
    return _interpolate(_seeds(minority, need, n_minor, seed), near, minority, k, seed)


def _majority_share(df: DataFrame, id_col: str, vec: str, label: str, minor, m: int) -> DataFrame:
    """(id, n_major): how many of the m nearest rows of each minority row belong to the other class."""
    every = stage_table(_vectors(df, id_col, vec), "every")
    minority = _vectors(df, id_col, vec, F.col(label) == F.lit(minor))
    near = knn_join(minority, every, m, "id", "id", "vec", exclude_self=True)
    tags = df.select(F.col(id_col).cast("long").alias("right_id"), (F.col(label) != F.lit(minor)).alias("other"))
    return near.join(tags, "right_id").groupBy(F.col("left_id").alias("id")).agg(
        F.count_if("other").alias("n_major"), F.count("*").alias("m"))


def borderline_smote(df: DataFrame, id_col: str, vec: str, label: str, k: int = 5, m: int = 10, ratio: float = 1.0,
                     seed: int = SEED) -> DataFrame:
    """SMOTE that grows only from minority rows in danger: m/2 <= majority neighbours < m."""
    _, n_major, minor, n_minor = class_sizes(df, label)
    need = max(0, int(n_major * ratio) - n_minor)
    minority = stage_table(_vectors(df, id_col, vec, F.col(label) == F.lit(minor)), "minority")
    shares = _majority_share(df, id_col, vec, label, minor, m)
    danger = stage_table(shares.filter((F.col("n_major") * 2 >= m) & (F.col("n_major") < m)).select("id"), "danger")
    near = knn_join(danger.join(minority, "id"), minority, k, "id", "id", "vec", exclude_self=True)
    return _interpolate(_seeds(danger, need, danger.count(), seed), near, minority, k, seed)


def adasyn(df: DataFrame, id_col: str, vec: str, label: str, k: int = 5, ratio: float = 1.0,
           seed: int = SEED) -> DataFrame:
    """Synthetic minority rows in proportion to the majority share around each minority row."""
    _, n_major, minor, n_minor = class_sizes(df, label)
    need = max(0, int(n_major * ratio) - n_minor)
    minority = stage_table(_vectors(df, id_col, vec, F.col(label) == F.lit(minor)), "minority")
    shares = stage_table(_majority_share(df, id_col, vec, label, minor, k)
                         .select("id", (F.col("n_major") / F.col("m")).alias("r")), "shares")
    total = shares.agg(F.sum("r")).scalar()
    quota = F.round(F.coalesce(F.try_divide(F.col("r") * need, total), F.lit(0.0))).cast("int")
    near = knn_join(minority, minority, k, "id", "id", "vec", exclude_self=True)
    return _interpolate(shares.select("id", quota.alias("quota")), near, minority, k, seed)


def near_miss(df: DataFrame, id_col: str, vec: str, label: str, k: int = 3) -> DataFrame:
    """Keep the majority rows whose k nearest minority rows are closest on average, as many as the minority."""
    major, _, minor, n_minor = class_sizes(df, label)
    majority = _vectors(df, id_col, vec, F.col(label) == F.lit(major))
    minority = _vectors(df, id_col, vec, F.col(label) == F.lit(minor)).withColumnRenamed("id", "mid")
    near = knn_join(majority, minority, k, "id", "mid", "vec")
    mean = near.groupBy("id").agg(F.avg("distance").alias("mean_distance"))
    return rank_by(mean, ["mean_distance", "id"]).filter(F.col("rank") <= n_minor)


def with_synthetic(df: DataFrame, synthetic: DataFrame, vec: str, label: str, minority) -> DataFrame:
    """Training rows followed by synthetic ones: same vector and label columns, other columns null."""
    extra = synthetic.select(F.col("vec").alias(vec), F.lit(minority).alias(label))
    return df.unionByName(extra, allowMissingColumns=True)


def over_then_under(df: DataFrame, id_col: str, label: str, seed: int = SEED) -> DataFrame:
    """Random over-sampling to half the majority, then random under-sampling to parity."""
    over = random_oversample(df, id_col, label, 0.5, seed)
    return _under(over, id_col, label, seed)


def smote_then_under(df: DataFrame, id_col: str, vec: str, label: str, k: int = 5, seed: int = SEED) -> DataFrame:
    """SMOTE to half the majority, then random under-sampling to parity."""
    _, _, minor, _ = class_sizes(df, label)
    over = with_synthetic(df, smote(df, id_col, vec, label, k, 0.5, seed), vec, label, minor)
    return _under(over, id_col, label, seed)


def _under(df: DataFrame, id_col: str, label: str, seed: int) -> DataFrame:
    staged = stage_table(df, "over")
    return random_undersample(staged, id_col, label, 1.0, seed)
