import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyfold.operators import resample, sampling


@pytest.fixture(scope="module")
def people(spark):
    return spark.range(1000).select("id", F.when(F.col("id") % 7 == 0, 1).otherwise(0).alias("y"), (F.col("id") % 3).alias("g")).cache()


def test_holdout_sizes(people):
    got = sampling.stratified_holdout(people, "id", ["y"]).groupBy("y", "holdout").count().toPandas()
    n = {r.y: r["count"] for r in people.groupBy("y").count().collect()}
    for y, size in n.items():
        part = got[got.y == y].set_index("holdout")["count"]
        test = int(np.floor(size * 0.15 + 0.5))
        assert part["test"] == test and part.sum() == size
        assert part["val"] == int(np.floor((size - test) * 15 / 85 + 0.5))


def test_folds_are_even_and_disjoint(people):
    plan = sampling.plan_splits(people, "id", ["y"]).cache()
    assert plan.count() == 1000 and plan.select("id").distinct().count() == 1000
    sizes = plan.filter("fold is not null").groupBy("y", "fold").count().toPandas()
    assert sizes.groupby("y")["count"].agg(lambda c: c.max() - c.min()).max() <= 1
    for name in sampling.split_names():
        train, evaluate = sampling.named_split(plan, name)
        assert train.join(evaluate, "id").count() == 0


def test_splits_repeat(people):
    a = sampling.plan_splits(people, "id", ["y"]).toPandas().sort_values("id").reset_index(drop=True)
    b = sampling.plan_splits(people.repartition(5), "id", ["y"]).toPandas().sort_values("id").reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b)


def test_balanced_training(people):
    plan = sampling.balanced_plan(people, "id", "y").cache()
    assert plan.count() == 1000
    train, evaluate = sampling.named_split(plan, "validation")
    sizes = {r.y: r["count"] for r in train.groupBy("y").count().collect()}
    assert abs(sizes[0] - sizes[1]) <= 1
    assert evaluate.filter("extra = 'val'").count() == (1000 - 2 * 143) // 2


def test_group_sample_has_at_least_one(people):
    got = sampling.sample_per_group(people, "id", ["g"], 1).groupBy("g").count().collect()
    assert {r["count"] for r in got} == {1} and len(got) == 3


def test_random_resampling(people):
    under = resample.random_undersample(people, "id", "y").groupBy("y").count().collect()
    assert {r["count"] for r in under} == {143}
    over = resample.random_oversample(people, "id", "y").groupBy("y").count().collect()
    assert {r["count"] for r in over} == {857}


def test_smote_points_lie_between_parents(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"id": np.arange(120), "y": (np.arange(120) < 25).astype(int), "vec": [v.tolist() for v in rng.normal(size=(120, 3))]})
    df = spark.createDataFrame(pdf)
    at = {r.id: np.array(r.vec) for r in pdf.itertuples()}
    for made in (resample.smote(df, "id", "vec", "y"), resample.borderline_smote(df, "id", "vec", "y"), resample.adasyn(df, "id", "vec", "y")):
        rows = made.collect()
        assert abs(len(rows) - 70) <= 13
        for r in rows:
            a, b = at[r.seed_id], at[r.neighbour_id]
            assert np.allclose(np.array(r.vec), a + r.t * (b - a)) and 0 <= r.t < 1
    assert len(resample.smote(df, "id", "vec", "y").collect()) == 70


def test_sizes_above_the_stratum_take_all_rows_and_too_large_a_factor_is_refused(spark):
    rows = spark.createDataFrame([(i, int(i >= 70)) for i in range(100)], "id long, y int")
    assert sampling.with_cuts(rows, "id", ["y"], {"pick": F.lit(1000)}).filter("pick").count() == 100
    assert sampling.with_cuts(rows, "id", [], {"pick": F.lit(1000)}).filter("pick").count() == 100
    with pytest.raises(ValueError):
        sampling.balanced_plan(rows, "id", "y", factor=5)
    assert sampling.balanced_plan(rows, "id", "y", factor=2).filter("y = 0 AND holdout = 'train'").count() > 0


def test_a_plan_draws_the_hashes_of_a_row_once(people):
    """Cuts and folds read the written hashes; the rows that come out are compared with cuts and hashed no more."""
    plan = sampling.plan_splits(people, "id", ["y"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "md5" not in text and "Union" not in text and plan.columns == ["id", "y", "g", "holdout", "fold"]
    assert plan.filter("(holdout = 'test') <> (fold IS NULL)").count() == 0
