import hashlib
import random
import re
from collections import Counter

import pytest

from tallyfold.llm.debruijn import remove_repeats

SCHEMA = "doc_id long, text string, start int, spans string"


def brute(rows, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    count = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcé") + str(rng.randint(0, 9))
    passages = [[word() for _ in range(n)] for n in (10, 34, 35, 36, 60, 200)]
    out = []
    for _ in range(60):
        t = []
        for _ in range(rng.randint(0, 4)):
            t += [word() for _ in range(rng.randint(0, 50))]
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            t += p if rng.random() < 0.6 else p[a:]
        out.append(t)
    out += [["x"] * 34, ["y"] * 35, ["z"] * 36, ["a", "b"] * 200, [], list(out[0]), list(out[0])]
    texts = [rng.choice([" ", "\n", " \t "]).join(t) for t in out] + [None, "\x0b \x0c", "one word here"]
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, 1, "clash") for i, t in rows], SCHEMA).repartition(4)
    got = sorted((tuple(r) for r in remove_repeats(docs).collect()), key=str)
    assert got == brute(rows, 35)


def test_nulls_repeats_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text), (3, text), (3, text), (3, "other words"), (4, None)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)
    assert sorted((tuple(r) for r in remove_repeats(docs).collect()), key=str) == brute(rows, 35)
    kept = {r.kept_text for r in remove_repeats(docs, with_text=True).collect()}
    assert kept == {"", "other words"}
    assert remove_repeats(docs.limit(0)).count() == 0


def long_words(n):
    """Two different words of n letters on which polynomial hashes modulo 2^64 agree."""
    a = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return a, a.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [1024, 4096])
def test_long_words_are_told_apart(spark, n):
    a, b = long_words(n)
    rows = [(1, " ".join([a] + [f"w{i}" for i in range(34)])), (2, " ".join([b] + [f"w{i}" for i in range(34)])),
            (3, " ".join([a, b] * 40)), (4, " ".join([a] * 20 + [b] + [a] * 14)), (5, " ".join([a] * 20 + [b] + [a] * 14 + ["end"]))]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)
    assert sorted((tuple(r) for r in remove_repeats(docs).collect()), key=str) == brute(rows, 35)


def test_very_long_text(spark):
    rng = random.Random(9)
    body = [f"v{rng.randint(0, 10**6)}" for _ in range(300_000)]
    rows = [(1, " ".join(body)), (2, " ".join(body[1000:1100])), (3, "x" * 3_000_000)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)
    got = {r.doc_id: r.n_removed for r in remove_repeats(docs).collect()}
    assert got == {1: 100, 2: 100, 3: 0}
