import random

from tallyfold.llm.decontaminate import contaminated

SCHEMA = "doc_id long, text string, item_id long, words string"


def grams(text, k):
    words = (text or "").lower().split()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


def brute(docs, items):
    out = set()
    for i, t in items:
        n = len((t or "").split())
        own = grams(t, min(5, n)) if n else set()
        for d, x in docs:
            shared = len(own & grams(x, min(5, n))) if n else 0
            if own and 100 * shared >= 80 * len(own):
                out.add((d, i, len(own), shared))
    return sorted(out, key=str)


def test_equals_brute_force(spark):
    rng = random.Random(6)
    word = lambda: rng.choice("ABcd") + str(rng.randint(0, 30))
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 4, 5, 6, 20, 40])))) for i in range(30)] + [(90, ""), (91, None)]
    docs = []
    for d in range(60):
        words = [word() for _ in range(rng.choice([0, 3, 50, 400]))]
        for _ in range(rng.randint(0, 3)):
            own = rng.choice(items)[1] or ""
            own = own.split()
            if rng.random() < 0.5 and own:
                own[rng.randrange(len(own))] = word()
            at = rng.randint(0, len(words))
            words[at:at] = own
        docs.append((d, rng.choice([" ", "\n\t"]).join(words)))
    docs += [(None, items[5][1]), (7, docs[7][1]), (99, None)]
    frame = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], SCHEMA).repartition(3)
    tests = spark.createDataFrame([(i, t, "c") for i, t in items], "item_id long, text string, doc_id string")
    assert sorted((tuple(r) for r in contaminated(frame, tests).collect()), key=str) == brute(docs, items)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert contaminated(docs, items.limit(0)).count() == 0
    assert contaminated(docs.limit(0), items).count() == 0
    assert contaminated(docs, items).count() == 1
