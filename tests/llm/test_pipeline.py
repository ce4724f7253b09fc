import re

from pyspark.sql import functions as F

import corpus_pipeline as pipeline

SF = "/root/testdata/sf0.001"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_stages_one_by_one(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    states, names = [docs], [n for n, _ in pipeline.STAGES]
    for name, stage in pipeline.STAGES:
        stage(spark, states[-1], SF).write.parquet(str(tmp_path / name))
        states.append(spark.read.parquet(str(tmp_path / name)))
    assert names == ["toxicity", "exact_dedup", "ngram_jaccard_join", "benchmark_decontamination", "bpe"]
    assert all(s.columns == docs.columns for s in states[1:5])
    rows = [{r.doc_id: r.text for r in s.collect()} for s in states[:5]]
    assert 0.8 < len(rows[1]) / len(rows[0]) < 1
    best = {}
    for d, t in rows[1].items():
        key = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        best[key] = min(best.get(key, (1, 0)), (-len(t or ""), d))
    assert set(rows[2]) == {d for _, d in best.values()}
    sets, root = {d: shingles(t) for d, t in rows[2].items()}, {d: d for d in rows[2]}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert set(rows[3]) == {d for d in ids if find(d) == d}
    tests = [shingles(t) for t in items]
    clean = {d for d in rows[3] if not any(len(sets[d] & t) * 100 >= 80 * len(t) for t in tests)}
    assert set(rows[4]) == clean
    last = states[5]
    assert {r.doc_id for r in last.collect()} == clean and last.filter("n_tokens > 0").count() > 0


def test_run_equals_the_stages_and_survives_odd_rows(spark, tmp_path):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    got = pipeline.run(spark, SF)
    assert got.count() == got.select("doc_id").distinct().count() > 0
    odd = source.limit(20).unionAll(source.limit(3)).unionAll(source.limit(2).withColumn("doc_id", F.lit(None).cast("long"))) \
        .unionAll(source.limit(2).withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.col("doc_id") + 10**6)).withColumn("score", F.lit("x"))
    for _, stage in pipeline.STAGES:
        odd = _again(spark, stage(spark, odd, SF), tmp_path)
    assert odd.count() == odd.distinct().count()
    empty = source.limit(0)
    for _, stage in pipeline.STAGES[:4]:
        assert stage(spark, empty, SF).count() == 0


def _again(spark, df, tmp_path):
    path = str(tmp_path / str(len(list(tmp_path.iterdir()))))
    df.write.parquet(path)
    return spark.read.parquet(path)
