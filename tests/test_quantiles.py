import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyfold.operators import quantiles as Q
from tallyfold.operators import stats


def values(seed):
    rng = random.Random(seed)
    wide = [rng.uniform(-1, 1) * 10 ** rng.randint(-300, 300) for _ in range(500)]
    return wide + [0.0, -0.0, 1e-320, -1e-320, 5e-324, float("inf"), float("-inf")] + [3.25] * 400 + [float(i) for i in range(-100, 100)]


def test_equals_sorting(spark):
    rows = [(i, "a" if i % 3 else None, v, None if i % 7 else v * 0.5) for i, v in enumerate(values(1))]
    df = spark.createDataFrame(rows, "id long, g string, x double, y double").repartition(5)
    probs = (0.0, 0.1, 0.25, 0.5, 0.77, 1.0)

    def want(xs, p):
        xs, at = sorted(xs), p * (len(xs) - 1)
        lo, hi = xs[math.floor(at)], xs[math.ceil(at)]
        return lo + (hi - lo) * (at - math.floor(at))

    def close(a, b):
        return (math.isnan(a) and math.isnan(b)) or a == b

    got = {r["column"]: [r[f"q{i}"] for i in range(len(probs))] for r in stats.exact_quantiles(df, ["x", "y"], probs).collect()}
    for name, at in (("x", 2), ("y", 3)):
        assert all(close(a, want([r[at] for r in rows if r[at] is not None], p)) for a, p in zip(got[name], probs))
    got = {r["g"]: [r[f"q{i}"] for i in range(len(probs))] for r in stats.exact_quantiles(df, ["x"], probs, ["g"]).collect()}
    assert set(got) == {"a", None}
    for g, found in got.items():
        assert all(close(a, want([r[2] for r in rows if r[1] == g], p)) for a, p in zip(found, probs))


def test_nan_is_last_and_empty_columns_are_left_out(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (2.0, None)], "x double, y double")
    out = stats.exact_quantiles(df, ["x", "y"], (0.5, 1.0)).collect()
    assert len(out) == 1 and out[0].q0 == 2.0 and math.isnan(out[0].q1)


@pytest.mark.parametrize("n", [1, 2, 5])
def test_center_of_few_rows(spark, n):
    xs = [float(i * i) for i in range(n)]
    r = stats.center_stats(spark.createDataFrame([(x,) for x in xs], "x double"), "x").first()
    assert r.median == float(np.median(xs)) and r.mode == 0.0 and r["mean"] == pytest.approx(np.mean(xs))


def test_found_digits_are_broadcast_to_the_values(spark, tmp_path):
    """What a pass has found is small and known to be so: no join moves the values to one task per column."""
    x = np.random.default_rng(9).normal(size=3000)
    spark.createDataFrame(pd.DataFrame({"a": x, "b": x * 2})).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2000b")
    try:
        plan = stats.fence_percentages(df, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in plan and "BuildRight" in plan and "SortMergeJoin" not in plan


def test_columns_without_values(spark):
    df = spark.createDataFrame([(None, None), (None, None)], "a double, b double")
    assert stats.exact_quantiles(df, ["a", "b"]).count() == 0


def test_columns_of_arrays_are_counted_in_tasks(spark, monkeypatch):
    """The same ranks as from exploded values, without a row for each value between the engine and Python."""
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.normal(size=700), np.round(rng.normal(size=700), 1), np.full(700, -0.0)])
    x[5, 0], x[6, 1] = np.nan, -1e300
    df = spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>").repartition(3)
    probs = [0, 0.013, 0.5, 0.77, 1]
    long = df.select(F.posexplode("x").alias("column", "value"))
    key = lambda r: (r["column"], r.i)
    want = [tuple(r) for r in sorted(Q.order_statistics(long, ["column"], probs, True).collect(), key=key)]  # both zeros are alike
    for held in (1, 1 << 20):
        monkeypatch.setattr(Q, "COUNTED", held)
        got = [tuple(r) for r in sorted(Q.column_statistics(df, 3, probs).collect(), key=key)]
        assert np.array_equal(np.array(got, float), np.array(want, float), equal_nan=True)
