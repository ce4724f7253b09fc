"""Byte-level BPE by dynamic programming over prefixes, and decoding of its ids."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import per_worker

# Fixed value: how byte-level BPE cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# The same cut in the faster standard module, and the characters for which its classes may differ from the above.
PLAIN_PATTERN = r" ?[^\W\d_]+|'s|'t|'re|'ve|'m|'ll|'d| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
NOT_PLAIN = r"[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f]"


def byte_letters() -> dict[str, int]:
    """The printable letters that vocabulary files write for the 256 bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_vocabulary(path: str) -> dict:
    """Merges as id pairs in rank order, token bytes by id and special tokens, from a tokenizer file of the byte-level kind."""
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    letters, vocab = byte_letters(), whole["model"]["vocab"]
    size = 1 + max([*vocab.values(), *(t["id"] for t in whole["added_tokens"])])
    tokens: list[bytes] = [b""] * size
    for word, i in vocab.items():
        tokens[i] = bytes(letters[c] for c in word)
    merges = []
    for merge in whole["model"]["merges"]:
        left, right = merge if isinstance(merge, list) else merge.split(" ")
        merges.append((vocab[left], vocab[right], vocab[left + right]))
    special = {t["content"]: t["id"] for t in whole["added_tokens"]}
    for text, i in special.items():
        tokens[i] = text.encode()
    return {"merges": merges, "tokens": tokens, "special": special}


class PrefixEncoder:
    """Encodes many words at once: for every prefix of every word it finds the one token that BPE's encoding ends with.

    An automaton reads a word byte by byte; its state is the longest suffix read so far that begins some token, and its
    suffix links list all tokens that end there. A token can be last if what precedes it is empty or if the last token of
    the shorter prefix and it stay apart when BPE runs over both: the pair test undoes merges from the highest rank down
    and fails where an earlier merge would have crossed the border. Exactly one token passes for each prefix, so one
    number per prefix is the whole table, and the ids follow from the back-pointers.
    """

    def __init__(self, vocabulary: dict):
        tokens, merges = vocabulary["tokens"], vocabulary["merges"]
        specials = set(vocabulary["special"].values())
        n = len(tokens)
        self.tokens, self.length = tokens, np.array([len(t) for t in tokens], np.int32)
        self.texts = [str(i) for i in range(n)]
        # Merge rank of a token (-1 for a single byte) and the pair it is made of.
        self.rank = np.full(n, -1, np.int64)
        self.left, self.right = np.arange(n, dtype=np.int32), np.arange(n, dtype=np.int32)
        for r, (a, b, c) in enumerate(merges):
            if self.rank[c] < 0:
                self.rank[c], self.left[c], self.right[c] = r, a, b
        self._pairs(np.array(merges, np.int64).reshape(-1, 3))
        self._automaton([i for i in range(n) if i not in specials and tokens[i]])

    def _pairs(self, merges: np.ndarray) -> None:
        bits = max(10, int(np.ceil(np.log2(len(merges) + 1))) + 4)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.pair_key, self.pair_rank = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
        keys = (merges[:, 0] << 32) | merges[:, 1]
        slots = self._slot(keys).tolist()
        for r, (key, slot) in enumerate(zip(keys.tolist(), slots)):
            while self.pair_key[slot] >= 0 and self.pair_key[slot] != key:
                slot = (slot + 1) & self.mask
            if self.pair_key[slot] < 0:
                self.pair_key[slot], self.pair_rank[slot] = key, r

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def merge_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of merging each pair; a number above all ranks where the pair does not merge."""
        keys = (left.astype(np.int64) << 32) | right
        slots = self._slot(keys)
        out = np.full(len(keys), np.iinfo(np.int64).max)
        todo = np.arange(len(keys))
        while len(todo):
            found = self.pair_key[slots[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = self.pair_rank[slots[todo[hit]]]
            todo = todo[~hit & (found >= 0)]
            slots[todo] = (slots[todo] + 1) & self.mask
        return out

    def apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether BPE over the bytes of both tokens gives just these two tokens.

        Working backwards in rank, the later of the two last merges is undone, which shows the tokens on either side of
        the border before it. A merge across the border wins if its rank is below that of the merge undone last; on equal
        rank the left one goes first.
        """
        ok = np.ones(len(left), bool)
        at = np.arange(len(left))
        left, right = left.copy(), right.copy()
        limit = np.full(len(left), np.iinfo(np.int64).max - 1)
        while len(at):
            crossing = self.merge_rank(left, right) < limit
            ok[at[crossing]] = False
            rank_l, rank_r = self.rank[left], self.rank[right]
            go = ~crossing & ((rank_l >= 0) | (rank_r >= 0))
            at, left, right, rank_l, rank_r = at[go], left[go], right[go], rank_l[go], rank_r[go]
            undo_left = rank_l > rank_r
            limit = np.where(undo_left, rank_l, rank_r + 1)
            left, right = np.where(undo_left, self.right[left], left), np.where(undo_left, right, self.left[right])
        return ok

    def _automaton(self, ids: Sequence[int]) -> None:
        child: list[dict[int, int]] = [{}]
        ends, depth_of = [-1], [0]
        for i in ids:
            node = 0
            for byte in self.tokens[i]:
                nxt = child[node].get(byte)
                if nxt is None:
                    nxt = child[node][byte] = len(child)
                    child.append({})
                    ends.append(-1)
                    depth_of.append(depth_of[node] + 1)
                node = nxt
            ends[node] = i
        step = np.zeros((len(child), 256), np.int32)
        longest = np.full(len(child), -1, np.int32)  # longest token that is a suffix of the state
        shorter = np.full(len(self.tokens), -1, np.int32)  # longest token that is a proper suffix of a token
        fail = [0] * len(child)
        queue = []
        for byte, nxt in child[0].items():
            step[0, byte] = nxt
            queue.append(nxt)
        for node in queue:
            link = fail[node]
            longest[node] = ends[node] if ends[node] >= 0 else longest[link]
            if ends[node] >= 0:
                shorter[ends[node]] = longest[link]
            step[node] = step[link]
            for byte, nxt in child[node].items():
                fail[nxt] = int(step[link, byte])
                step[node, byte] = nxt
                queue.append(nxt)
        self.step, self.longest, self.shorter = step, longest, shorter

    def encode(self, words: Sequence[bytes], cells: int = 1 << 21) -> list[tuple[int, ...]]:
        """Ids of each word, a block of words of like length at a time."""
        sizes = np.array([len(w) for w in words], np.int64)
        order = np.argsort(sizes, kind="stable")
        out: list[tuple[int, ...]] = [()] * len(words)
        start = 0
        while start < len(order):
            end = start + 1
            # As many words as keep the table of the longest one in bounds; a very long word stands alone.
            while end < len(order) and (end - start + 1) * (sizes[order[min(len(order), 2 * end - start) - 1]] + 1) <= cells:
                end = min(len(order), 2 * end - start)
            block = order[start:end]
            for i, ids in zip(block.tolist(), self._block([words[i] for i in block.tolist()], sizes[block])):
                out[i] = ids
            start = end
        return out

    def _block(self, words: list[bytes], sizes: np.ndarray) -> list[tuple[int, ...]]:
        n, most = len(words), int(sizes[-1])
        flat = np.frombuffer(b"".join(words), np.uint8)
        begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        last = np.full((most + 1, n), -1, np.int32)  # last token of each prefix: the whole table
        state = np.zeros(n, np.int32)
        for i in range(1, most + 1):
            first = int(np.searchsorted(sizes, i))  # words are sorted by length: those from here on reach position i
            state[first:] = self.step[state[first:], flat[begin[first:] + i - 1]]
            todo = np.arange(first, n)
            token = self.longest[state[first:]]
            while len(todo):
                before = i - self.length[token]
                ok = before == 0
                pairs = np.flatnonzero(~ok)
                ok[pairs] = self.apart(last[before[pairs], todo[pairs]], token[pairs])
                last[i, todo[ok]] = token[ok]
                todo, token = todo[~ok], self.shorter[token[~ok]]
        counts, at, found = np.zeros(n, np.int64), sizes.copy(), []
        alive = np.flatnonzero(at > 0)
        while len(alive):
            token = last[at[alive], alive]
            found.append((alive, token))
            counts[alive] += 1
            at[alive] -= self.length[token]
            alive = alive[at[alive] > 0]
        stop = np.cumsum(counts)
        ids = np.empty(int(stop[-1]) if n else 0, np.int32)
        for k, (who, token) in enumerate(found):
            ids[stop[who] - 1 - k] = token
        listed, stops = ids.tolist(), stop.tolist()
        return [tuple(listed[a:b]) for a, b in zip([0, *stops[:-1]], stops)]


class Codec:
    """Whole texts to ids and back, with a bounded memory of words seen."""

    def __init__(self, vocabulary: dict, remember: int = 200_000):
        self.encoder, self.special = PrefixEncoder(vocabulary), vocabulary["special"]
        self.pattern, self.remember = regex.compile(PATTERN), remember
        self.plain, self.odd = re.compile(PLAIN_PATTERN), re.compile(NOT_PLAIN)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        self.known: dict[str, tuple[int, ...]] = {}

    def words(self, text: str) -> list[str]:
        if not self.cut or not any(s in text for s in self.special):
            return (self.pattern if self.odd.search(text) else self.plain).findall(text)
        out: list[str] = []
        for part in self.cut.split(text):
            out += [part] if part in self.special else self.pattern.findall(part)
        return out

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        cut = [self.words(t) for t in texts]
        new = list(set(chain.from_iterable(cut)).difference(self.known))
        if len(self.known) + len(new) > self.remember:
            self.known = {}
            new = list(set(chain.from_iterable(cut)))
        known = self.known
        known.update(zip(new, self.encoder.encode([w.encode() for w in new])))
        known.update({s: (i,) for s, i in self.special.items() if s in known})
        return [list(chain.from_iterable(map(known.__getitem__, words))) for words in cut]

    def decode(self, ids: Sequence[int]) -> str:
        return b"".join(map(self.encoder.tokens.__getitem__, ids)).decode("utf-8", "replace")


def codec(vocabulary: dict, name: str) -> Codec:
    return per_worker(("bpe", name, len(vocabulary["tokens"])), lambda: Codec(vocabulary))


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                     batch_chars: int = 1 << 20) -> DataFrame:
    """doc_id, ids (array of int) and decoded text of each document, in one pass without a shuffle.

    ``path`` is a byte-level tokenizer file on the driver; its tables are as large as the vocabulary and are sent once.
    Special tokens written out in a text become their id, as the tokenizers library does. Null text counts as empty and
    gives no ids; repeated rows are each encoded; a null id is passed on. A text of any length is encoded whole.
    """
    return _over(docs, path, id_col, text_col, batch_chars, "doc_id long, ids array<int>, decoded string",
                 [("ids", pa.list_(pa.int32()), lambda c, ids: ids), ("decoded", pa.string(), lambda c, ids: c.decode(ids))])


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                   batch_chars: int = 1 << 20) -> DataFrame:
    """:func:`encode_documents` with counts and digests in place of ids and text: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    def digest(c: Codec, ids: list[int]) -> str:
        return hashlib.sha256(",".join(map(c.encoder.texts.__getitem__, ids)).encode()).hexdigest()

    return _over(docs, path, id_col, text_col, batch_chars,
                 "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
                 [("n_tokens", pa.int64(), lambda c, ids: len(ids)), ("ids_sha256", pa.string(), digest),
                  ("decoded_sha256", pa.string(), lambda c, ids: hashlib.sha256(c.decode(ids).encode()).hexdigest())])


def _over(docs: DataFrame, path: str, id_col: str, text_col: str, batch_chars: int, schema: str, columns) -> DataFrame:
    vocabulary = load_vocabulary(path)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(shared.value, path)
        for batch in batches:
            texts, ids = batch.column(1), batch.column(0)
            start = 0
            while start < len(texts):
                block, size, end = [], 0, start
                while end < len(texts) and (not block or size < batch_chars):
                    text = texts[end].as_py() or ""
                    block.append(text)
                    size += len(text)
                    end += 1
                encoded = c.encode(block)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, end - start), *(pa.array([of(c, e) for e in encoded], kind) for _, kind, of in columns)],
                    names=["doc_id", *(name for name, _, _ in columns)])
                start = end
        c.known = {}  # the worker lives on; the words of this task need not

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(task, schema)
