import hashlib
import random

import pytest
from tokenizers import Tokenizer

from tallyfold.llm.bpe_prefix import Codec, encode_digests, encode_documents, load_vocabulary
from tallyfold.llm.catalog import tokenizer_path


@pytest.fixture(scope="module")
def both():
    return Codec(load_vocabulary(tokenizer_path())), Tokenizer.from_file(tokenizer_path())


def same(both, texts):
    codec, library = both
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = codec.encode(texts)
    assert got == want
    assert [codec.decode(ids) for ids in got] == [library.decode(ids, skip_special_tokens=False) for ids in want] == texts


def test_every_code_point(both):
    points = [chr(x) for x in range(0x110000) if not 0xD800 <= x < 0xE000]
    same(both, ["".join(f"a1{c} b {c}{c}  {c}!9{c}" for c in points[k:k + 60]) for k in range(0, len(points), 60)])


def test_random_and_very_long_texts(both):
    rng = random.Random(1)
    parts = [*"ab '  \n\t!<|>sdt9é中🙂\x85\xa0\x1c\u200b\u3000", "<|endoftext|>", "'ll", "'re", "tion", " the"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 80))) for _ in range(5000)]
    same(both, texts + ["", "a" * 5000, "ab" * 3000, " " * 999, "\n" * 500, "word " * 50_000])


def test_documents(spark, both):
    rows = [(1, "Hello world"), (2, None), (3, ""), (None, "<|endoftext|>x"), (1, "Hello world")]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, ids int")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [both[1].encode(t or "", add_special_tokens=False).ids for _, t in rows]
    assert [(r.doc_id, r.ids, r.decoded) for r in encode_documents(docs, tokenizer_path()).collect()] == \
        [(d, ids, t or "") for (d, t), ids in zip(rows, want)]
    assert [tuple(r) for r in encode_digests(docs, tokenizer_path()).collect()] == \
        [(d, len(ids), sha(",".join(map(str, ids))), sha(t or "")) for (d, t), ids in zip(rows, want)]
    assert encode_digests(docs.limit(0), tokenizer_path()).count() == 0
