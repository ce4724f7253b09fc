"""The two trained scores: gradients, held-out accuracy on the small tables, edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfold.llm import quality_pu, toxic_gru
from tallyfold.llm.catalog import QUERIES

FOLDER = "/root/testdata/sf0.1"
EDGE = [(1, None, "x"), (2, "", "x"), (None, "plain words", "y"), (2, "", "x"), (5, "w " * 60_000, "z"), (6, "x" * 50_000, "z")]


def edge(spark):
    return spark.createDataFrame(EDGE, "doc_id long, text string, score string")


def test_gradients_of_the_network():
    rng = np.random.default_rng(0)
    net = toxic_gru.Network(np.arange(20, dtype=np.uint64))
    net.p = {k: v.astype(float) for k, v in net.p.items()}
    word, head, tail = rng.integers(0, 21, (6, 5)), rng.integers(0, 50, (6, 5)), rng.integers(0, 50, (6, 5))
    alive, target = np.arange(6)[:, None] < np.array([1, 6, 3, 4, 6]), np.array([0.0, 1, 1, 0, 1])

    def loss():
        z = net.forward(word, head, tail, alive)
        return np.mean(np.logaddexp(0, -z) * target + np.logaddexp(0, z) * (1 - target))

    for name, grad in net.gradients(word, head, tail, alive, target).items():
        flat, at = net.p[name].reshape(-1), int(np.argmax(np.abs(np.asarray(grad).reshape(-1))))
        keep, step = flat[at], 1e-3
        flat[at] = keep + step
        up = loss()
        flat[at] = keep - step
        down = loss()
        flat[at] = keep
        assert abs((up - down) / 2 / step - np.asarray(grad).reshape(-1)[at]) < 1e-4, name


def test_windows_overlap_and_cover():
    first = np.array([0, 0, 10, 10 + 64, 74 + 65, 139 + 500])
    doc, start, size = toxic_gru.windows(first)
    for d in range(5):
        seen = set()
        for s, n in zip(start[doc == d], size[doc == d]):
            seen |= set(range(s, s + n))
        assert seen == set(range(first[d], first[d + 1])) and (doc == d).any()


def test_half_a_window_is_seen_whole():
    doc, start, size = toxic_gru.windows(np.array([0, 500, 563, 1200]))
    for d, (a, b) in enumerate([(0, 500), (500, 563), (563, 1200)]):
        for at in range(a, b - 32 + 1):
            assert ((start <= at) & (start + size >= at + 32) & (doc == d)).any(), (d, at)


@pytest.mark.parametrize("query,label,least", [("op3_pu_quality", "quality", 0.95), ("op5_bigru_toxicity", "toxic", 0.93)])
def test_held_out_accuracy(spark, query, label, least):
    rows = QUERIES[query](spark, FOLDER).filter("held_out").join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id")
    good, n, low, high = rows.agg(F.avg((F.col("predicted") == F.col(label)).cast("int")), F.count("*"), F.min("score"), F.max("score")).first()
    assert n > 500 and good >= least and 0 <= low and high <= 1


def test_held_out_recall_in_every_language(spark):
    rows = QUERIES["op5_bigru_toxicity"](spark, FOLDER).filter("held_out").join(spark.read.parquet(f"{FOLDER}/labels.parquet").filter("toxic = 1"), "doc_id") \
        .join(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang"), "doc_id")
    recall = {r.lang: r.found for r in rows.groupBy("lang").agg(F.avg("predicted").alias("found")).collect()}
    assert len(recall) == 4 and min(recall.values()) >= 0.75, recall


def test_edge_cases(spark):
    labels = spark.createDataFrame([(5, 1), (6, 0), (6, 1), (None, 1), (7, None)], "doc_id long, label int")
    net = toxic_gru.train(edge(spark), labels, rounds=3)
    got = toxic_gru.score(edge(spark), net).collect()
    assert [r.doc_id for r in got] == [r[0] for r in EDGE] and all(0 <= r.score <= 1 for r in got)
    whole = toxic_gru.score(edge(spark), net, name="p", whole_rows=True)
    assert whole.columns == ["doc_id", "text", "score", "p"] and whole.count() == len(EDGE)
    assert toxic_gru.score(edge(spark).limit(0), toxic_gru.train(edge(spark).limit(0), labels.limit(0))).count() == 0
    ids = labels.select("doc_id")
    model, prior = quality_pu.train(edge(spark), ids, ids)
    assert 0 < prior < 1
    got = quality_pu.score(edge(spark), model).collect()
    assert [r.doc_id for r in got] == [r[0] for r in EDGE] and all(0 <= r.score <= 1 for r in got)
    assert quality_pu.score(edge(spark), quality_pu.train(edge(spark), ids.limit(0), ids)[0]).first().score == 0.5


def test_prior_of_a_known_mixture():
    rng = np.random.default_rng(1)
    positive = rng.normal(2, 1, 4000)
    mixed = np.concatenate([rng.normal(2, 1, 6000), rng.normal(-2, 1, 2000)])
    assert abs(quality_pu.estimate_prior(positive, mixed) - 0.75) < 0.06
