import hashlib
import random
import zlib

from pyspark.sql import functions as F

from tallyfold.llm.merkle import Parent, lowered, merkle_manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, path int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes, fan):
    levels = [nodes]
    while len(levels[-1]) > 1:
        level = levels[-1]
        levels.append([sha("".join(level[i: i + fan])) for i in range(0, len(level), fan)])
    return levels


def climb(levels, at, value, fan):
    """Siblings of a node on its way up, and what its tree's root becomes with another value there."""
    seen = []
    for level in levels[:-1]:
        run, start = level[at // fan * fan: (at // fan + 1) * fan], at // fan * fan
        seen += run[: at - start] + run[at - start + 1:]
        value = sha("".join([*run[: at - start], value, *run[at - start + 1:]]))
        at //= fan
    return seen, value


def brute(rows, fan=16, tampers=True):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    trees = {}
    for s, mine in groups.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[s] = tree([leaf_of(r) for r in mine], fan)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    top = tree([trees[s][-1][0] for s in order], fan)
    out = []
    for i, s in enumerate(order):
        for at, row in enumerate(groups[s]):
            changed = tampers and zlib.crc32(b"" if row[0] is None else str(row[0]).encode()) % 5 == 0 and row[4] is not None
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[4]) if changed else row[4]
            seen, value = climb(trees[s], at, leaf_of((*row[:4], low)), fan)
            more, folded = climb(top, i, value, fan)
            out.append((row[0], leaf_of(row), trees[s][-1][0], top[-1][0], sha("".join(seen + more)), folded, folded == top[-1][0]))
    return out


def check(spark, rows, **settings):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(4)
    altered = F.when(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0, lowered(F.col("text")))
    got = [tuple(r) for r in merkle_manifest(docs, altered, **settings).collect()]
    want = brute(rows, settings.get("fan", 16))
    assert sorted(map(str, got)) == sorted(map(str, want))
    return got


def made(seed, n, sources):
    rng = random.Random(seed)
    return [(i, rng.choice(sources), rng.choice(["en", None, ""]), rng.choice([None, 3, -7]),
             rng.choice([None, "", "Mixed Case É", "plain", "ALL CAPS \U0001F600"])) for i in range(n)]


def test_equals_brute_force(spark):
    rows = made(1, 900, ["hot"] * 8 + ["b", None, "", "z\U0001F600", "z�"]) + [(5, "b", "en", 1, "Twice")] * 3 + [(None, "b", None, None, "No Id")] * 2
    rows += [(1000 + i, f"one{i}", "en", 1, "Alone") for i in range(20)]
    got = check(spark, rows)
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)


def test_deep_trees_over_many_blocks(spark):
    rows = made(2, 700, ["hot"] * 5 + [f"s{i}" for i in range(9)])
    check(spark, rows, fan=2, depth=2)
    check(spark, rows, fan=3, depth=1)


def test_small_tables(spark):
    for rows in ([], [(7, "a", None, None, "T" * 100_000)], [(1, "a", "x", 1, "A"), (2, "b", "x", 1, "B")], made(3, 17, ["a"]), made(4, 16, ["a"])):
        check(spark, rows)
    docs = spark.createDataFrame([(*r, "x", 1) for r in made(5, 40, ["a", "b"])], SCHEMA)
    assert all(r.verified for r in merkle_manifest(docs).collect())


def test_resumed_state_equals_the_whole_hash():
    children = [sha(str(i)).encode() for i in range(16)]
    parent = Parent(children)
    for i in range(16):
        new = sha("new").encode()
        assert parent.resume(i, new) == Parent([*children[:i], new, *children[i + 1:]]).digest
        assert parent.resume(i, children[i]) == parent.digest
