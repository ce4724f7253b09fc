import random
import re
from collections import defaultdict

import pytest

from tallyfold.llm import shingle_join
from tallyfold.llm.shingle_join import jaccard_components, prefix_length

SCHEMA = "doc_id long, text string, n long, token string"


def brute(rows, k=4, percent=85):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = []
    for doc_id, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets.append((doc_id, {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()))
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (doc_id, _) in enumerate(sets):
        groups[find(i)].append(doc_id)
    return sorted(((d, len(s), min((x for x in groups[find(i)] if x is not None), default=None)) for i, (d, s) in enumerate(sets)), key=str)


def corpus(seed=3):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randint(0, 60))
    base = [[word() for _ in range(rng.randint(5, 120))] for _ in range(25)]
    passage = [word() for _ in range(30)]
    out = []
    for b in base:
        out.append(b)
        for _ in range(rng.randint(0, 4)):
            c = list(b)
            for _ in range(rng.randint(0, 3)):
                c[rng.randrange(len(c))] = word()
            out.append(c)
        if rng.random() < 0.6:
            out.append(b[:10] + passage + b[10:14])
    hot = [word() for _ in range(150)]
    for _ in range(60):
        c = list(hot)
        for _ in range(rng.randint(0, 4)):
            c[rng.randrange(len(c))] = word()
        out.append(c)
    texts = [rng.choice([" ", "  ", "\n"]).join(w.upper() if rng.random() < 0.1 else w for w in t) for t in out]
    texts += ["", None, "one", "ONE", "a b", "a b c d", " a b\tc d ", "x" * 5000, *["same text of five words here"] * 40]
    return list(enumerate(texts))


@pytest.mark.parametrize("crowd", [32, 3])
def test_equals_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(shingle_join, "CROWD", crowd)
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 1, "clash") for i, t in rows], SCHEMA).repartition(5)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(docs).collect()), key=str)
    assert got == brute(rows)


def test_nulls_repeats_and_empty_table(spark):
    rows = [(None, "p q r s t u v w"), (None, "p q r s t u v w"), (7, "p q r s t u v w"), (7, "p q r s t u v w"), (9, None), (None, "")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(docs).collect()), key=str)
    assert got == sorted([(None, 5, 7), (None, 5, 7), (7, 5, 7), (7, 5, 7), (9, 0, 9), (None, 0, None)], key=str)
    assert jaccard_components(docs.limit(0)).count() == 0


def test_prefix_length():
    assert [prefix_length(n, 85) for n in (1, 6, 20, 100)] == [1, 1, 4, 16]


@pytest.mark.parametrize("n", [1024, 4096])
def test_long_words_are_told_apart(spark, n):
    a = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    b = a.translate(str.maketrans("ab", "ba"))
    rows = [(1, a), (2, b), (3, f"{a} x y z"), (4, f"{b} x y z"), (5, f"x {a} {b} {a}"), (6, f"x {a} {a} {b}"), (7, a.upper())]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(docs).collect()), key=str)
    assert got == brute(rows)
