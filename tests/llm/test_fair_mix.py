import hashlib
import random
import re

from tallyfold.llm.fair_mix import fair_queue, mixed_documents

SCHEMA = "doc_id long, text string, source string, size int, mark string"


def targets(sizes, weights, repeats, budget):
    """Shares of the budget, with the excess of full sources dealt out again round by round."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full = set()
    while True:
        free = sum(weight[s] for s in order if s not in full)
        level = (budget - sum(repeats * sizes[s] for s in full)) / free if free else 0
        more = {s for s in order if s not in full and weight[s] * level > repeats * sizes[s]}
        if not more:
            return {s: float(repeats * sizes[s]) if s in full else weight[s] * level for s in order}, order
        full |= more


def brute(rows, weights=(1, 2, 3), repeats=3):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    sizes = {}
    for (_, _, s), n in zip(rows, size):
        sizes[s] = sizes.get(s, 0) + n
    target, order = targets(sizes, weights, repeats, sum(size))
    queue = []
    for s in order:
        mine = sorted((hashlib.md5(f"mix:{'' if d is None else d}".encode()).hexdigest(), d or 0, n, i)
                      for i, ((d, _, of), n) in enumerate(zip(rows, size)) if of == s)
        at = 0
        for _ in range(repeats):
            for _, _, n, i in mine:
                at += n
                if n and target[s] > 0:
                    queue.append((at / target[s], order.index(s), at, n, i))
    taken, spent = [0] * len(rows), 0
    for *_, n, i in sorted(queue):
        spent += n
        if spent > sum(size):
            break
        taken[i] += n
    return [(d, n, sizes[s], target[s], t) for (d, _, s), n, t in zip(rows, size, taken)]


def made(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["hot"] * 6 + ["b", "a", "\U0001F600", "�", None, "tiny"])
        words = rng.choice([0, 1, 5, 40, 200]) if source != "tiny" else 1
        rows.append((i, rng.choice([" ", "\n\t"]).join(["wörd"] * words) if words or rng.random() < 0.5 else None, source))
    return rows


def test_equals_brute_force(spark):
    long = "w " * 30_000
    for rows in (made(1, 300), made(2, 40) + [(None, "no id here", "a"), (7, "x y", None), (7, "x y", None), (500, long, "b")],
                 [(1, "a b c", "only")], [(1, None, "x"), (2, "", None)]):
        docs = spark.createDataFrame([(d, t, s, 1, "m") for d, t, s in rows], SCHEMA).repartition(5)
        got = [tuple(r) for r in fair_queue(docs).select("doc_id", "size", "source_size", "target", "taken").collect()]
        assert sorted(map(str, got)) == sorted(map(str, brute(rows)))
    assert fair_queue(spark.createDataFrame([], SCHEMA)).count() == 0


def test_targets_and_reruns(spark):
    rows = made(3, 2000)
    docs = spark.createDataFrame([(d, t, s, 1, "m") for d, t, s in rows], SCHEMA)
    first = fair_queue(docs.repartition(3)).collect()
    assert sorted(map(str, first)) == sorted(map(str, fair_queue(docs.repartition(11)).collect()))
    by_source = {}
    for r in first:
        assert r.taken <= 3 * r.size
        entry = by_source.setdefault(r.source, [r.target, 0, 0])
        entry[1] += r.taken
        entry[2] = max(entry[2], r.size)
    for target, taken, largest in by_source.values():
        assert abs(target - taken) <= largest * len(by_source)
    total = sum(r.size for r in first)
    assert total - 200 < sum(r.taken for r in first) <= total
    assert abs(sum(v[0] for v in by_source.values()) - total) < 1e-6


def test_mix_repeats_rows(spark):
    rows = made(4, 120) + [(3, "twice twice", "a")] * 2
    docs = spark.createDataFrame([(d, t, s, 1, "m") for d, t, s in rows], SCHEMA)
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert sum(len((r.text or "").split()) for r in mixed.collect()) == sum(r.taken for r in fair_queue(docs).collect())
