import hashlib
import random
import re

from tallyfold.llm.exact_radix import exact_groups

SCHEMA = "doc_id long, text string, size int, rest string"


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    groups = {}
    for (d, t), x in zip(rows, norm):
        groups.setdefault(x, []).append((-len(t or ""), d is None, d or 0, d))
    out = []
    for (d, t), x in zip(rows, norm):
        best = min(groups[x])
        out.append((d, best[3], len(groups[x]), d == best[3] and len(t or "") == -best[0], hashlib.sha256(x.encode()).hexdigest(), len(t or "")))
    return sorted(out, key=str)


def test_equals_brute_force(spark):
    rng = random.Random(2)
    long = "".join(rng.choice("abc é") for _ in range(40_000))
    texts = [long, long + " ", long[:-1] + "x", long[:20_000] + "y" + long[20_001:], "", None, " \n", "a", "a ", "b"]
    texts += ["same  text"] * 30 + ["same text"] * 30 + ["".join(rng.choice("ab ") for _ in range(rng.randint(0, 6))) for _ in range(200)]
    rows = list(enumerate(texts)) + [(None, "a"), (None, "only null id"), (3, "other"), (12, "same  text"), (12, "same  text")]
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], SCHEMA).repartition(4)
    assert sorted((tuple(r) for r in exact_groups(docs, first=4, growth=4).collect()), key=str) == brute(rows)
    assert sorted((tuple(r) for r in exact_groups(docs).collect()), key=str) == brute(rows)
    assert exact_groups(docs.limit(0)).count() == 0
