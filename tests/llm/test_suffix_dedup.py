import hashlib
import random

import numpy as np
import pytest

from tallyfold.llm.suffix_dedup import remove_repeated_bytes
from tallyfold.llm.suffix_sort import permuted_common_prefixes, suffix_array

SCHEMA = "doc_id long, text string, start int, bytes string"


def brute(rows, window):
    texts = [(doc_id, (t or "").encode()) for doc_id, t in rows]
    first = {}
    for d, t in texts:
        for i in range(len(t) - window + 1):
            w, at = t[i:i + window], (d is not None, d or 0, i)
            first[w] = min(first.get(w, at), at)
    out = []
    for d, t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - window + 1):
            if first[t[i:i + window]] < (d is not None, d or 0, i):
                gone[i:i + window] = True
        spans = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((d, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("ab é中d.") for _ in range(n))
    passages = [text(n) for n in (50, 70, 99, 100, 101, 130, 400)]
    out = []
    for _ in range(70):
        t = ""
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            t += text(rng.randint(0, 120)) + (p if rng.random() < 0.6 else p[rng.randrange(len(p)):])
        out.append(t)
    out += ["x" * 99, "y" * 100, "z" * 300, "ab" * 200, "", out[3], out[3], None, " "]
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("seed,crowd", [(1, 4000), (2, 4000), (3, 3)])
def test_equals_brute_force(spark, seed, crowd):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, 1, "clash") for i, t in rows], SCHEMA).repartition(4)
    got = sorted((tuple(r) for r in remove_repeated_bytes(docs, crowd=crowd, shard_bytes=20_000).collect()), key=str)
    assert got == brute(rows, 100)


def test_nulls_repeats_and_empty_table(spark):
    text = "".join(chr(97 + i * 7 % 26) + str(i) for i in range(60))
    rows = [(None, text), (3, text), (3, text), (3, "pad" + text), (4, None)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)
    assert sorted((tuple(r) for r in remove_repeated_bytes(docs).collect()), key=str) == brute(rows, 100)
    assert remove_repeated_bytes(docs.limit(0)).count() == 0


def test_suffix_array_and_common_prefixes():
    rng = random.Random(4)
    for _ in range(100):
        b = bytes(rng.randrange(97, 97 + rng.choice([1, 2, 3, 26])) for _ in range(rng.randint(1, 200)))
        text = np.frombuffer(b, np.uint8)
        order = suffix_array(text, len(b))
        assert order.tolist() == sorted(range(len(b)), key=lambda i: b[i:])
        at = np.sort(order[order + 12 <= len(b)])
        if len(at) > 1:
            got = permuted_common_prefixes(text, at[1:], at[:-1], 12)
            want = [next((k for k in range(12) if b[i + k] != b[j + k]), 12) for i, j in zip(at[1:], at[:-1])]
            assert got.tolist() == want


@pytest.mark.parametrize("n", [1024, 4096])
def test_long_words_are_told_apart(spark, n):
    a = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    b = a.translate(str.maketrans("ab", "ba"))
    rows = [(1, a), (2, b), (3, f"{a} {b}"), (4, f"{b} {a}"), (5, b[::-1] + a)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)
    assert sorted((tuple(r) for r in remove_repeated_bytes(docs).collect()), key=str) == brute(rows, 100)


def test_slices_tell_contents_apart():
    from tallyfold.llm.common import Slices

    rng = np.random.default_rng(3)
    for units in (rng.integers(97, 99, 600).astype(np.uint8), rng.integers(0, 2, 600).astype(np.uint64)):
        starts = np.repeat(np.arange(500), 12)
        ends = starts + np.tile([0, 1, 2, 3, 5, 8, 9, 16, 24, 35, 64, 100], 500)
        found = {}
        for h, a, b in zip(Slices(units).hash(starts, ends).tolist(), starts, ends):
            assert found.setdefault(h, units[a:b].tobytes()) == units[a:b].tobytes()
        assert len(found) == len({units[a:b].tobytes() for a, b in zip(starts, ends)})
        assert (Slices(units).every(24)[:500] == Slices(units).every(24)[:500]).all()
