import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyfold.operators import ordered, stats
from tallyfold.operators.components import connected_components


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows and a third of all values are equal."""
    rng = np.random.default_rng(3)
    n = 3000
    pdf = pd.DataFrame({"id": np.arange(n), "g": np.where(rng.random(n) < 0.7, "hot", rng.choice(list("abc"), n)),
                        "x": np.where(rng.random(n) < 0.33, 7.0, rng.normal(0, 50, n).round(1))})
    pdf["gap"] = np.where(rng.random(n) < 0.4, None, rng.integers(0, 9, n).astype(str))
    return pdf, spark.createDataFrame(pdf).repartition(8)


def test_rank(skewed):
    pdf, df = skewed
    got = ordered.rank_by(df, ["x", "id"], ["g"]).toPandas().set_index("id")["rank"].sort_index()
    want = pdf.sort_values(["x", "id"]).groupby("g").cumcount() + 1
    assert (got.to_numpy() == want.sort_index().to_numpy()).all()


def test_running_totals(skewed):
    pdf, df = skewed
    counts = df.groupBy("g", "x").agg(F.count("*").alias("n"))
    got = ordered.running_totals(counts, ["x"], {"upto": "n"}, ["g"]).toPandas().sort_values(["g", "x"])
    want = pdf.groupby(["g", "x"]).size().groupby("g").cumsum().reset_index(name="upto")
    assert (got["upto"].to_numpy() == want["upto"].to_numpy()).all()


def test_forward_fill(skewed):
    pdf, df = skewed
    got = ordered.forward_fill(df, "g", "gap", "id").toPandas().sort_values("id")["gap"]
    want = pdf.sort_values("id").groupby("g")["gap"].ffill()
    assert got.where(got.notna(), None).tolist() == want.where(want.notna(), None).tolist()


def test_previous(skewed):
    pdf, df = skewed
    got = ordered.with_previous(df, "id", "x", "p").toPandas().sort_values("id")["p"].to_numpy()
    assert np.isnan(got[0]) and (got[1:] == pdf["x"].to_numpy()[:-1]).all()


def test_exact_quantiles(skewed):
    pdf, df = skewed
    got = stats.exact_quantiles(df, ["x"], (0.1, 0.5, 0.99), ["g"]).toPandas().set_index("g")
    for g, part in pdf.groupby("g"):
        assert np.allclose(got.loc[g, ["q0", "q1", "q2"]].astype(float), part["x"].quantile([0.1, 0.5, 0.99]))


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (230, 2))] + [(i, i + 1) for i in range(400, 480)]
    parent = {n: n for n in range(500)}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    nodes = spark.range(500).withColumnRenamed("id", "node")
    got = {r.node: r.component for r in connected_components(nodes, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in range(500)}


def test_median_mode(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (3.0,), (1.0,), (10.0,)], "x double")
    r = stats.center_stats(df, "x").first()
    assert (r["mean"], r["median"], r["mode"]) == (3.6, 3.0, 1.0)


def test_rank_by_hash_links_chunks_without_moving_the_rows_again(spark):
    """Offsets meet the ranked rows by the chunk they are already arranged by; a null hash comes first."""
    rows = [(None, "x"), (None, "y"), (5, "b"), (5, "a"), (1 << 31, "c"), ((1 << 32) - 1, "d")]
    ranked = ordered.rank_by_hash(spark.createDataFrame(rows, "h long, t string"), "h", "t")
    assert [r.t for r in ranked.orderBy("rank").collect()] == ["x", "y", "a", "b", "c", "d"]
    assert [r["rank"] for r in ranked.orderBy("rank").collect()] == [1, 2, 3, 4, 5, 6]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = spark.range(5000).select((F.col("id") * 800_000).alias("h"), F.col("id").cast("string").alias("t"))
        plan = ordered.rank_by_hash(wide, "h", "t")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "coalesce(__chunk" not in plan.split("Window", 1)[0]  # no second exchange by a null-safe key
