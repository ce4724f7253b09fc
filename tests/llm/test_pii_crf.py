import random
import re

from tallyfold.llm.pii_crf import KINDS, Crf, added_spans, base_spans, detect, luhn, sequences, tags_of, train


def plain(text):
    """The patterns as the contract writes them, run one by one."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    tests = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    }
    out = [(m.start(), m.end(), k) for k, (p, ok) in tests.items() for m in re.finditer(p, text) if ok(m[0])]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(8)
    for _ in range(4000):
        text = "".join(rng.choice(["@", ".", "-", "+", "1", "22", "255", "a", "é", " ", "b.c", "(", ")", "4111 1111 1111 1111", "1.2.3.4", "%"])
                       for _ in range(rng.randint(0, 30)))
        assert base_spans(text) == plain(text), text


def test_viterbi_is_the_best_path():
    import itertools

    import numpy as np
    rng = np.random.default_rng(2)
    model = Crf()
    model.emit, model.move = rng.normal(size=model.emit.shape), rng.normal(size=model.move.shape)
    runs = [[list(map(int, rng.integers(0, 4096, 8))) for _ in range(n)] for n in (1, 3, 2, 4)]
    move = model.move + model.ban
    for run, got in zip(runs, model.viterbi(runs)):
        score = [model.emit[ids].sum(axis=0) for ids in run]
        best = max(itertools.product(range(9), repeat=len(run)), key=lambda p: sum(s[t] for s, t in zip(score, p)) +
                   move[0, p[0]] + sum(move[a, b] for a, b in zip(p, p[1:])) + move[p[-1], 0])
        assert got == list(best)


def test_model_learns_the_labels_and_keeps_base_spans(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        words = ["".join(rng.choice("abcdef") for _ in range(5)) for _ in range(12)]
        words[rng.randrange(12)] = f"u{i}@mail{i % 7}.example.com"
        words[rng.randrange(12)] = f"+1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}"
        words[rng.randrange(12)] = str(rng.randint(1, 999))
        rows.append((i, " ".join(words), "x"))
    rows += [(900, None, "x"), (901, "", "x"), (None, "call +1 (222) 555-1234 now", "x"), (5, rows[5][1], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    model = train(docs)
    for _, text, _ in rows[:50]:
        for words, ids in sequences(text):
            assert model.viterbi([ids])[0] == tags_of(words, base_spans(text))
    got = detect(docs, model).collect()
    assert len(got) == len(rows)
    for r, (doc_id, text, _) in zip(got, rows):
        base = [f"{k}:{a}:{b}" for a, b, k in base_spans(text or "")]
        assert r.doc_id == doc_id and set(base) <= set(r.spans.split(",")) | {""}
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b.startswith(k) for b in base) for k in KINDS]
    assert detect(docs.limit(0), train(docs.limit(0))).count() == 0


def test_added_spans_leave_base_spans_alone():
    text = "x 12345, y"
    assert added_spans([(2, 8)], [5], text, []) == [(2, 7, "card")]
    assert added_spans([(2, 8)], [5], text, [(3, 5, "ip")]) == []
