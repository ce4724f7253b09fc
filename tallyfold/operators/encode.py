"""Feature encoders: fitted on training rows, kept as small tables, applied by joins and expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.hashing import SEED, hash32
from tallyfold.operators.ordered import rank_by
from tallyfold.session import stage_table


def _distinct_cells(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull()).select(F.col(col).alias("value")).distinct()


@dataclass
class OrdinalEncoder:
    """Category codes 0..n-1 in the native order of the values; unknown and null become -1."""

    cols: Sequence[str]
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> OrdinalEncoder:
        for c in self.cols:
            codes = rank_by(_distinct_cells(df, c), ["value"], name="code")
            self.tables[c] = stage_table(codes.select("value", (F.col("code") - 1).cast("double").alias("code")),
                                         f"ordinal-{c}")
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        for c in self.cols:
            side = self.tables[c].select(F.col("value").alias("__v"), F.col("code").alias("__code"))
            df = (df.join(side, F.col(c) == F.col("__v"), "left")
                  .withColumn(c, F.coalesce("__code", F.lit(-1.0))).drop("__v", "__code"))
        return df


class LabelEncode(OrdinalEncoder):
    """Sorted classes to 0..K-1 for one label column."""

    def __init__(self, col: str):
        super().__init__([col])


@dataclass
class OneHot:
    """Sparse one-hot vectors; a value unseen in training becomes the zero vector."""

    cols: Sequence[str]
    suffix: str = "_hot"
    ordinal: OrdinalEncoder | None = None
    encoder: object = None

    def fit(self, df: DataFrame) -> OneHot:
        self.ordinal = OrdinalEncoder(self.cols).fit(df)
        coded = self._shifted(df)
        outs = [c + self.suffix for c in self.cols]
        self.encoder = OneHotEncoder(inputCols=[f"__{c}" for c in self.cols], outputCols=outs,
                                     dropLast=True, handleInvalid="keep").fit(coded)
        return self

    def _shifted(self, df: DataFrame) -> DataFrame:
        codes = self.ordinal.transform(df.withColumns({f"__raw_{c}": F.col(c) for c in self.cols}))
        # An unknown value takes an index past the fitted ones, which the dropped last slot turns into zeros.
        past = {f"__{c}": F.when(F.col(c) < 0, F.lit(float(2 ** 30))).otherwise(F.col(c)) for c in self.cols}
        restored = {c: F.col(f"__raw_{c}") for c in self.cols}
        return codes.withColumns(past).withColumns(restored).drop(*[f"__raw_{c}" for c in self.cols])

    def transform(self, df: DataFrame) -> DataFrame:
        return self.encoder.transform(self._shifted(df)).drop(*[f"__{c}" for c in self.cols])


def _shrunk_mean(n: Column, s: Column, q: Column, mean: Column, var: Column) -> Column:
    """Category mean pulled to the global mean: weight n*tau2 / (n*tau2 + sigma2)."""
    cat_mean = s / n
    cat_var = F.greatest(q / n - cat_mean * cat_mean, F.lit(0.0))
    weight = F.coalesce(F.try_divide(n * var, n * var + cat_var), F.lit(1.0))
    return weight * cat_mean + (1 - weight) * mean


@dataclass
class TargetEncode:
    """Mean-target encoding with empirical-Bayes shrinkage (binary 0/1 or continuous target).

    ``transform`` uses all training rows. ``fit_transform`` cross-fits: a row is encoded from the
    folds it is not in. One pass sums n, y and y*y per (category, fold); out-of-fold numbers are
    totals minus the fold's own.
    """

    cols: Sequence[str]
    label: str
    folds: int = 5
    seed: int = SEED
    tables: dict[str, DataFrame] = field(default_factory=dict)
    fold_tables: dict[str, DataFrame] = field(default_factory=dict)
    mean: float = 0.0
    fold_means: dict[int, float] = field(default_factory=dict)

    def _fold(self, id_col: str) -> Column:
        return (F.pmod(hash32(F.col(id_col), self.seed), F.lit(self.folds)) + 1).cast("int")

    def fit(self, df: DataFrame, id_col: str) -> TargetEncode:
        y = F.col(self.label).cast("double")
        rows = df.withColumns({"__fold": self._fold(id_col), "__y": y})
        sums = [F.count("__y").alias("n"), F.sum("__y").alias("s"), F.sum(F.col("__y") * F.col("__y")).alias("q")]
        per_fold = {r["__fold"]: (r.n, r.s, r.q) for r in rows.groupBy("__fold").agg(*sums).collect()}
        total = tuple(sum(v[i] for v in per_fold.values()) for i in range(3))
        self.mean, var = _mean_var(total)
        rest = {f: _mean_var(tuple(t - v for t, v in zip(total, own))) for f, own in per_fold.items()}
        self.fold_means = {f: m for f, (m, _) in rest.items()}
        for c in self.cols:
            cells = stage_table(rows.groupBy(F.col(c).alias("value"), "__fold").agg(*sums), f"target-{c}")
            whole = cells.groupBy("value").agg(F.sum("n").alias("n_all"), F.sum("s").alias("s_all"), F.sum("q").alias("q_all"))
            self.tables[c] = stage_table(whole.select("value", _shrunk_mean(
                F.col("n_all"), F.col("s_all"), F.col("q_all"), F.lit(self.mean), F.lit(var)).alias("enc")), f"target-{c}")
            out = cells.join(whole.withColumnRenamed("value", "__v"), F.col("value").eqNullSafe(F.col("__v")))
            left = out.filter(F.col("n_all") > F.col("n"))
            mean_f = _by_fold({f: m for f, (m, _) in rest.items()})
            var_f = _by_fold({f: v for f, (_, v) in rest.items()})
            self.fold_tables[c] = stage_table(left.select("value", "__fold", _shrunk_mean(
                F.col("n_all") - F.col("n"), F.col("s_all") - F.col("s"), F.col("q_all") - F.col("q"), mean_f, var_f).alias("enc")),
                f"target-{c}")
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        for c in self.cols:
            side = self.tables[c].select(F.col("value").alias("__v"), F.col("enc").alias("__e"))
            df = (df.join(side, F.col(c).eqNullSafe(F.col("__v")), "left")
                  .withColumn(c, F.coalesce("__e", F.lit(self.mean))).drop("__v", "__e"))
        return df

    def transform_train(self, df: DataFrame, id_col: str) -> DataFrame:
        df = df.withColumn("__fold", self._fold(id_col))
        for c in self.cols:
            side = self.fold_tables[c].select(F.col("value").alias("__v"), F.col("__fold").alias("__g"),
                                              F.col("enc").alias("__e"))
            cond = F.col(c).eqNullSafe(F.col("__v")) & (F.col("__fold") == F.col("__g"))
            df = (df.join(side, cond, "left")
                  .withColumn(c, F.coalesce("__e", _by_fold(self.fold_means))).drop("__v", "__g", "__e"))
        return df.drop("__fold")

    def fit_transform(self, df: DataFrame, id_col: str) -> DataFrame:
        return self.fit(df, id_col).transform_train(df, id_col)


def _mean_var(sums: tuple) -> tuple[float, float]:
    n, s, q = sums
    if not n:
        return 0.0, 0.0
    return s / n, max(q / n - (s / n) ** 2, 0.0)


def _by_fold(values: dict[int, float]) -> Column:
    out = F.lit(0.0)
    for f, v in values.items():
        out = F.when(F.col("__fold") == f, F.lit(v)).otherwise(out)
    return out


@dataclass
class StandardScale:
    """(x - mean) / population std; a constant column is only centred."""

    cols: Sequence[str]
    stats: dict[str, tuple[float, float]] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> StandardScale:
        one = df.agg(*[f(c).alias(f"{k}{i}") for i, c in enumerate(self.cols)
                       for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
        self.stats = {c: (one[f"m{i}"], one[f"s{i}"] or 1.0) for i, c in enumerate(self.cols)}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - m) / F.lit(s) for c, (m, s) in self.stats.items()})


@dataclass
class MinMaxScale:
    """(x - min) / (max - min), not clipped; a constant column becomes 0."""

    cols: Sequence[str]
    stats: dict[str, tuple[float, float]] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> MinMaxScale:
        one = df.agg(*[f(c).cast("double").alias(f"{k}{i}") for i, c in enumerate(self.cols)
                       for k, f in (("a", F.min), ("b", F.max))]).first()
        self.stats = {c: (one[f"a{i}"], (one[f"b{i}"] - one[f"a{i}"]) or 1.0) for i, c in enumerate(self.cols)}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - a) / F.lit(w) for c, (a, w) in self.stats.items()})

    def inverse(self, df: DataFrame, cols: Sequence[str], source: str) -> DataFrame:
        a, w = self.stats[source]
        return df.withColumns({c: F.col(c) * w + a for c in cols})


@dataclass
class TargetScale:
    """Scaling of a regression target (``minmax`` or ``log1p``) and its inverse for predictions."""

    kind: str
    label: str
    scaler: MinMaxScale | None = None

    def fit(self, df: DataFrame) -> TargetScale:
        if self.kind == "minmax":
            self.scaler = MinMaxScale([self.label]).fit(df)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if self.kind == "minmax":
            return self.scaler.transform(df)
        return df.withColumn(self.label, F.log1p(self.label))

    def inverse(self, df: DataFrame, col: str) -> DataFrame:
        if self.kind == "minmax":
            return self.scaler.inverse(df, [col], self.label)
        return df.withColumn(col, F.expm1(col))


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out).transform(df)


@dataclass
class TruncatedSVD:
    """Projection on the first ``k`` right singular vectors of the uncentred feature matrix.

    The sign of each component is fixed so that its largest loading is positive.
    """

    col: str
    k: int
    out: str = "svd"
    v: DenseMatrix | None = None

    def fit(self, df: DataFrame) -> TruncatedSVD:
        rows = MLUtils.convertVectorColumnsFromML(df.select(self.col), self.col)
        v = RowMatrix(rows).computeSVD(self.k).V.toArray()
        top = abs(v).argmax(axis=0)
        v = v * [1.0 if v[i, j] >= 0 else -1.0 for j, i in enumerate(top)]
        self.v = DenseMatrix(v.shape[0], v.shape[1], v.T.flatten().tolist())
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        loadings = self.v.toArray().tolist()
        x = vector_to_array(self.col)
        comps = [F.aggregate(F.zip_with(x, F.lit([row[j] for row in loadings]), lambda a, b: a * b),
                             F.lit(0.0), lambda s, t: s + t).alias(f"{self.out}_{j}") for j in range(len(loadings[0]))]
        return df.select("*", *comps)


# --- recipes -----------------------------------------------------------------------------------

@dataclass(frozen=True)
class Recipe:
    """Which steps a named encoding uses."""

    category: str
    standard: bool = False
    minmax: bool = False
    target: str | None = None


CLASSIFICATION_RECIPES = {
    1: Recipe("ordinal"), 2: Recipe("onehot"), 3: Recipe("target"),
    4: Recipe("ordinal", standard=True), 5: Recipe("target", standard=True),
    6: Recipe("ordinal", standard=True, minmax=True), 7: Recipe("target", standard=True, minmax=True),
}
REGRESSION_RECIPES = {
    1: Recipe("ordinal"), 2: Recipe("svd"), 3: Recipe("target"),
    4: Recipe("ordinal", target="minmax"), 5: Recipe("target", target="minmax"),
    6: Recipe("ordinal", target="log1p"), 7: Recipe("target", target="log1p"),
    8: Recipe("ordinal", standard=True, target="log1p"), 9: Recipe("target", standard=True, target="log1p"),
    10: Recipe("ordinal", standard=True, minmax=True, target="log1p"),
    11: Recipe("target", standard=True, minmax=True, target="log1p"),
}


@dataclass
class RecipeModel:
    """A recipe fitted on one split's training rows. ``features`` is the assembled vector."""

    recipe: Recipe
    categorical: Sequence[str]
    numerical: Sequence[str]
    label: str
    id_col: str
    steps: dict[str, object] = field(default_factory=dict)
    inputs: list[str] = field(default_factory=list)

    def fit_transform(self, train: DataFrame) -> DataFrame:
        cats, nums = list(self.categorical), list(self.numerical)
        df = train
        if self.recipe.target:
            self.steps["y"] = TargetScale(self.recipe.target, self.label).fit(df)
            df = self.steps["y"].transform(df)
        kind = self.recipe.category
        if kind == "ordinal":
            self.steps["cat"] = OrdinalEncoder(cats).fit(df)
            df = self.steps["cat"].transform(df)
            self.inputs = cats + nums
        elif kind == "target":
            enc = TargetEncode(cats, self.label)
            df = enc.fit_transform(df, self.id_col)
            self.steps["cat"] = enc
            self.inputs = cats + nums
        else:
            hot = OneHot(cats).fit(df)
            df = hot.transform(df)
            self.steps["cat"] = hot
            hots = [c + hot.suffix for c in cats]
            self.inputs = hots + nums
            if kind == "svd":
                df = assemble(df, hots, "__hot")
                self.steps["svd"] = TruncatedSVD("__hot", len(cats)).fit(df)
                df = self.steps["svd"].transform(df)
                self.inputs = [f"svd_{j}" for j in range(len(cats))] + nums
        if self.recipe.standard:
            self.steps["std"] = StandardScale(nums).fit(df)
            df = self.steps["std"].transform(df)
        if self.recipe.minmax:
            self.steps["mm"] = MinMaxScale(self.inputs).fit(df)
            df = self.steps["mm"].transform(df)
        return assemble(df, self.inputs)

    def transform(self, df: DataFrame) -> DataFrame:
        df = self.steps["cat"].transform(df)
        if "svd" in self.steps:
            df = assemble(df, [c + "_hot" for c in self.categorical], "__hot")
            df = self.steps["svd"].transform(df)
        for step in ("std", "mm"):
            if step in self.steps:
                df = self.steps[step].transform(df)
        return assemble(df, self.inputs)

    def inverse_target(self, df: DataFrame, col: str = "prediction") -> DataFrame:
        return self.steps["y"].inverse(df, col) if "y" in self.steps else df


def recipe(kind: str, number: int, categorical: Sequence[str], numerical: Sequence[str], label: str,
           id_col: str) -> RecipeModel:
    """A named encoding; ``kind`` is classification or regression."""
    table = CLASSIFICATION_RECIPES if kind == "classification" else REGRESSION_RECIPES
    return RecipeModel(table[number], categorical, numerical, label, id_col)
