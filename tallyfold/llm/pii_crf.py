"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes that adds to them."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("email", "ip", "card", "phone")
TAGS = ("O", *(f"{b}-{k}" for k in KINDS for b in "BI"))
BUCKETS = 1 << 12

# The patterns of the contract. Look-behinds only keep a search from starting again inside one run.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# A word that may be part of an entity holds a digit or an at sign; all others are outside for certain.
CANDIDATE = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*")
NOT_DIGIT = re.compile(r"[^0-9]")

Span = tuple[int, int, str]  # start, end, kind


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, leftmost and non-overlapping within a kind; matches that fail their test are dropped."""
    out: list[Span] = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end(), "email"))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    if any(c in text for c in "0123456789"):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                out.append((*m.span(), "ip"))
        for m in CARD.finditer(text):
            digits = NOT_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((*m.span(), "card"))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                    out.append((*m.span(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def shape(word: str) -> str:
    """Letters as a or A, digits as 9, runs of letters shortened to one and of digits to their length; the rest as it is."""
    out, k, n = [], 0, len(word)
    while k < min(n, 200):  # the shape of a longer word is that of its beginning and its length class
        c, j = word[k], k + 1
        if c.isdigit():
            while j < n and word[j].isdigit():
                j += 1
            out.append(f"9{min(j - k, 20)}")
        elif c.isalpha():
            while j < n and word[j].isalpha():
                j += 1
            out.append("A" if c.isupper() else "a")
        else:
            out.append(c)
        k = j
    return "".join(out)


def sequences(text: str) -> list[tuple[list[tuple[int, int]], list[list[int]]]]:
    """Runs of neighbouring candidate words with one blank between them: their spans and the feature numbers of each."""
    out: list[tuple[list[tuple[int, int]], list[list[int]]]] = []
    run: list[tuple[int, int]] = []

    def close() -> None:
        if run:
            shapes = [shape(text[a:b]) for a, b in run]
            before = shape(text[max(0, run[0][0] - 40): run[0][0]].split(" ")[-2][-12:]) if " " in text[max(0, run[0][0] - 40): run[0][0]] else "^"
            after = shape((text[run[-1][1]: run[-1][1] + 40].split(" ") + ["$", "$"])[1][:12])
            around = [before, *shapes, after]
            ids = []
            for i, (a, b) in enumerate(run):
                word = text[a:b]
                digits = sum(c.isdigit() for c in word[:200])
                tokens = (f"s{shapes[i]}", f"p{around[i]}|{shapes[i][:4]}", f"n{around[i + 2]}|{shapes[i][:4]}", f"d{min(digits, 24)}",
                          f"l{min(b - a, 30)}", f"@{'@' in word}{word.count('.')}", f"c{shape(word[0])}{shape(word[-1])}", "bias")
                ids.append([zlib.crc32(t.encode()) % BUCKETS for t in tokens])
            out.append((list(run), ids))
            run.clear()

    for m in CANDIDATE.finditer(text):
        if run and (m.start() - run[-1][1] != 1 or text[m.start() - 1] != " " or len(run) >= 64):
            close()
        run.append(m.span())
    close()
    return out


def tags_of(words: Sequence[tuple[int, int]], spans: Sequence[Span]) -> list[int]:
    """Tag of each word from the spans that cover it."""
    tags = []
    for a, b in words:
        tag = 0
        for s, e, kind in spans:
            if s < b and a < e:
                tag = TAGS.index(f"{'B' if s >= a else 'I'}-{kind}")
                break
        tags.append(tag)
    return tags


class Crf:
    """Scores of tags by features and of neighbouring tags; a run begins after and ends before an outside word."""

    def __init__(self) -> None:
        n = len(TAGS)
        self.emit, self.move = np.zeros((BUCKETS, n)), np.zeros((n, n))
        self.ban = np.zeros((n, n))  # from, to: an inside tag follows only its own kind
        for j, tag in enumerate(TAGS):
            if tag[0] == "I":
                self.ban[:, j] = [0 if t[2:] == tag[2:] and t != "O" else -1e9 for t in TAGS]

    def _lattice(self, runs: Sequence[Sequence[Sequence[int]]]):
        """Tag scores (step x run x tag) and the run lengths, for runs of at most 64 words."""
        size = np.array([len(r) for r in runs])
        steps = int(size.max())
        ids = np.zeros((steps, len(runs), 8), np.int64)
        for i, r in enumerate(runs):
            ids[: len(r), i] = r
        return ids, self.emit[ids].sum(axis=2), size

    def viterbi(self, runs: Sequence[Sequence[Sequence[int]]]) -> list[list[int]]:
        """The best tags of each run, all runs of a block at once."""
        out: list[list[int]] = [[]] * len(runs)
        order = np.argsort([len(r) for r in runs], kind="stable")
        move = self.move + self.ban
        for k in range(0, len(order), 4096):
            own = order[k: k + 4096]
            _, score, size = self._lattice([runs[i] for i in own])
            best, back = score[0] + move[0], np.zeros(score.shape, np.int16)
            for t in range(1, len(score)):
                ways = best[:, :, None] + move
                back[t] = ways.argmax(axis=1)
                best = np.where((t < size)[:, None], ways.max(axis=1) + score[t], best)
            tag = (best + move[:, 0]).argmax(axis=1)
            path = np.zeros((len(score), len(own)), np.int64)
            for t in range(len(score) - 1, -1, -1):
                path[t] = tag
                tag = np.where((t < size) & (t > 0), back[t, np.arange(len(own)), tag], tag)
            for i, row in enumerate(own.tolist()):
                out[row] = path[: size[i], i].tolist()
        return out

    def fit(self, runs, tags, rounds: int = 120, rate: float = 0.1, decay: float = 0.02) -> None:
        """Maximum likelihood with forward-backward over all runs at once, and Adam."""
        n, count = len(TAGS), len(runs)
        ids, _, size = self._lattice(runs)
        steps = len(ids)
        gold = np.zeros((steps, count), np.int64)
        for i, t in enumerate(tags):
            gold[: len(t), i] = t
        live = np.arange(steps)[:, None] < size
        used = np.unique(ids)
        short = np.searchsorted(used, ids)
        one = np.eye(n)

        def spread(weight: np.ndarray) -> np.ndarray:
            flat = np.zeros((len(used), n))
            for f in range(ids.shape[2]):
                np.add.at(flat, short[:, :, f][live], weight[live])
            return flat

        seen_emit = spread(one[gold])
        seen_move = np.zeros((n, n))
        ends = gold[size - 1, np.arange(count)]
        np.add.at(seen_move, (0, gold[0]), 1)
        np.add.at(seen_move, (ends, 0), 1)
        for t in range(1, steps):
            np.add.at(seen_move, (gold[t - 1][live[t]], gold[t][live[t]]), 1)
        params = [np.zeros((len(used), n)), np.zeros((n, n))]
        m, v = [np.zeros_like(w) for w in params], [np.zeros_like(w) for w in params]
        for step in range(1, rounds + 1):
            score, move = params[0][short].sum(axis=2), params[1] + self.ban
            alpha, beta = np.zeros((steps, count, n)), np.zeros((steps, count, n))
            alpha[0] = score[0] + move[0]
            for t in range(1, steps):
                alpha[t] = np.where(live[t][:, None], np.logaddexp.reduce(alpha[t - 1][:, :, None] + move, axis=1) + score[t], alpha[t - 1])
            beta[:] = move[:, 0]
            for t in range(steps - 2, -1, -1):
                beta[t] = np.where(live[t + 1][:, None], np.logaddexp.reduce(move[None] + (score[t + 1] + beta[t + 1])[:, None, :], axis=2), beta[t])
            whole = np.logaddexp.reduce(alpha[-1] + move[:, 0], axis=1)
            marginal = np.exp(alpha + beta - whole[None, :, None]) * live[:, :, None]
            hope = np.zeros((n, n))
            hope[0] += marginal[0].sum(axis=0)
            hope[:, 0] += marginal[size - 1, np.arange(count)].sum(axis=0)
            for t in range(1, steps):
                on = live[t]
                hope += np.exp(alpha[t - 1][on][:, :, None] + move + (score[t] + beta[t])[on][:, None, :] - whole[on][:, None, None]).sum(axis=0)
            grads = [spread(marginal) - seen_emit, hope - seen_move]
            for k, g in enumerate(grads):
                g = g / count + decay * params[k] / 10
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.01 * (g * g - v[k])
                params[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)
        self.emit[used], self.move = params


def added_spans(words: Sequence[tuple[int, int]], tags: Sequence[int], text: str, base: Sequence[Span]) -> list[Span]:
    """Spans of the tags, without punctuation at their ends, where no fixed pattern matched."""
    out, i = [], 0
    while i < len(tags):
        if TAGS[tags[i]][0] != "B":
            i += 1
            continue
        j, kind = i + 1, TAGS[tags[i]][2:]
        while j < len(tags) and TAGS[tags[j]] == f"I-{kind}":
            j += 1
        start, end = words[i][0], words[j - 1][1]
        while start < end and not (text[start].isalnum() or text[start] in "+("):
            start += 1
        while start < end and not text[end - 1].isalnum():
            end -= 1
        if start < end and not any(s < end and start < e for s, e, _ in base):
            out.append((start, end, kind))
        i = j
    return out


def find(texts: Sequence[str], model: Crf) -> list[tuple[list[Span], list[Span]]]:
    """Of each text the spans of the fixed patterns, and these together with those that the model adds."""
    base = [base_spans(t) if t else [] for t in texts]
    runs = [sequences(t) for t in texts]
    flat = [ids for own in runs for _, ids in own]
    tags = iter(model.viterbi(flat) if flat else [])
    out = []
    for text, own, spans in zip(texts, runs, base):
        more = [s for words, _ in own for s in added_spans(words, next(tags), text, spans)]
        out.append((spans, sorted([*spans, *more], key=lambda s: (s[0], KINDS.index(s[2])))))
    return out


def labelled_runs(docs: DataFrame, max_docs: int = 2000, max_runs: int = 4000, seed: int = 17) -> tuple[list, list]:
    """A small labelled table: runs of candidate words with tags from the fixed patterns.

    Of the documents that hold a digit or an at sign, the ``max_docs`` with the smallest hash of their text are read
    (copies once), and of their runs the ``max_runs`` with the smallest hash, those with an entity before the others up to one half each.
    """
    source = docs.select("text").filter(F.col("text").rlike("[0-9@]")).withColumn("h", F.xxhash64("text", F.lit(seed)))
    low = source.select("h").distinct().orderBy("h").limit(max_docs)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                spans = base_spans(text)
                for words, ids in sequences(text):
                    rows.append((ids, tags_of(words, spans)))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.list_(pa.list_(pa.int32()))), pa.array([r[1] for r in rows], pa.list_(pa.int32()))],
                                             names=["ids", "tags"])

    runs = source.join(F.broadcast(low), "h").groupBy("h").agg(F.first("text").alias("text")).select("text").mapInArrow(task, "ids array<array<int>>, tags array<int>")
    rank = F.xxhash64("ids", "tags", F.lit(seed))
    some = F.exists("tags", lambda t: t > 0)
    rows = [r for part in (runs.filter(some), runs.filter(~some)) for r in
            part.orderBy(rank, "ids").limit(max_runs // 2).collect()]
    return [r["ids"] for r in rows], [r["tags"] for r in rows]


def train(docs: DataFrame, **bounds) -> Crf:
    """The field fitted on :func:`labelled_runs`; without any labelled run it tags everything as outside."""
    model = Crf()
    runs, tags = labelled_runs(docs, **bounds)
    if runs:
        model.fit(runs, tags)
    else:
        model.move[:, 1:] = -1.0
    return model


def _joined(spans: Sequence[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def detect(docs: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts of the fixed patterns' spans by kind, base_sha256, spans (all of them, as kind:start:end).

    Offsets are code points of the whole text, end exclusive. Null and empty texts have none; repeated rows are each read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([source.schema[0], *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS),
                           T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                found = find([t or "" for t in part.column(1).to_pylist()], shared.value)
                counts = [pa.array([sum(s[2] == k for s in base) for base, _ in found], pa.int64()) for k in KINDS]
                digest = pa.array([hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in found], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), *counts, digest, pa.array([_joined(s) for _, s in found], pa.string())],
                                                 names=schema.names)

    return source.mapInArrow(task, schema)
