"""Text quality by positive-unlabelled learning: non-negative risk with an estimated class prior, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.llm.common import LOWER, Powers, byte_table, prefix_hash, slice_hash, text_chunks, word_spans

LETTERS = byte_table(3)
NAMES = ("lower", "upper", "digit", "space", "newline", "stop", "bar", "mark", "symbol", "high", "log_words", "word_length",
         "long_words", "short_words", "caps_words", "odd_words", "distinct_words", "top_word", "same_as_last", "bigram_repeat",
         "log_lines", "line_words", "repeated_lines", "stopped_words")


def _classes() -> np.ndarray:
    kind = np.full(256, 8, np.uint8)
    for k, members in enumerate((range(97, 123), range(65, 91), range(48, 58), b" \t", b"\n\x0b\x0c\r", b".!?,;:", b"|", b"'\"()-", (), range(128, 256))):
        kind[list(members)] = k
    return kind


CLASS = _classes()


def _per_doc(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the values of each document; documents may be empty."""
    sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _repeats(keys: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each document: distinct keys, and how often the most frequent one occurs."""
    n = len(bounds) - 1
    distinct, top = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        if b > a:
            ordered = np.sort(keys[a:b])
            edge = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]]))
            distinct[i], top[i] = len(edge) - 1, int(np.diff(edge).max())
    return distinct, top


def features(data: np.ndarray, off: np.ndarray, powers: Powers) -> np.ndarray:
    """documents x features: shares of character classes, shapes of words, repetition of words and lines."""
    n, size = len(off) - 1, np.maximum(1, np.diff(off))
    kind = CLASS[data] if len(data) else np.zeros(0, np.uint8)
    out = [_per_doc(kind == k, off) / size for k in range(10)]
    starts, ends, first = word_spans(data, off)
    n_words, length = np.diff(first), ends - starts
    words = np.maximum(1, n_words)
    if len(starts):
        hashes = slice_hash(prefix_hash(LETTERS[LOWER[data]], powers), starts, ends, powers)
        bad = np.concatenate([[0], np.cumsum((kind >= 6) & (kind <= 8))])
        capital = np.concatenate([[0], np.cumsum(kind == 1)])
        odd, caps = bad[ends] > bad[starts], (capital[ends] - capital[starts] > 1)
        closed = kind[ends - 1] == 5
    else:
        hashes, odd, caps, closed = np.zeros(0, np.uint64), *(np.zeros(0, bool) for _ in range(3))
    distinct, top = _repeats(hashes, first)
    pairs = hashes[:-1] * np.uint64(3) + hashes[1:] if len(hashes) else hashes
    pair_bounds = np.minimum(np.stack([first[:-1], np.maximum(first[:-1], first[1:] - 1)]), len(pairs))
    pair_kinds = np.array([len(np.unique(pairs[a:b])) for a, b in pair_bounds.T.tolist()], np.int64)
    same = np.zeros(len(hashes), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    out += [np.log1p(n_words), _per_doc(length, first) / words, _per_doc(length >= 12, first) / words, _per_doc(length <= 3, first) / words,
            _per_doc(caps, first) / words, _per_doc(odd, first) / words, distinct / words, top / words, _per_doc(same, first) / words,
            1 - pair_kinds / np.maximum(1, n_words - 1)]
    new = np.flatnonzero(data == 10) + 1 if len(data) else np.zeros(0, np.int64)
    begin = np.unique(np.concatenate([off[:-1][np.diff(off) > 0], new[new < len(data)]])) if len(data) else np.zeros(0, np.int64)
    stop = np.concatenate([begin[1:], [len(data)]]) if len(begin) else begin
    lines = slice_hash(prefix_hash(LETTERS[data], powers), begin, stop, powers) if len(begin) else np.zeros(0, np.uint64)
    line_bounds = np.searchsorted(begin, off)
    line_kinds, _ = _repeats(lines, line_bounds)
    n_lines = np.maximum(1, np.diff(line_bounds))
    out += [np.log1p(n_lines), np.log1p(words / n_lines), 1 - line_kinds / n_lines, _per_doc(closed, first) / words]
    return np.stack(out, axis=1).astype(np.float32).reshape(n, len(NAMES))


class Classifier:
    """One hidden layer on standardised features."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, hidden: int = 16, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.p = [rng.normal(0, 0.3, (len(mean), hidden)), np.zeros(hidden), rng.normal(0, 0.3, hidden), np.zeros(1)]

    def _hidden(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return z, np.tanh(z @ self.p[0] + self.p[1])

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self._hidden(x)[1] @ self.p[2] + self.p[3][0]

    def _back(self, x: np.ndarray, d_logit: np.ndarray) -> list[np.ndarray]:
        z, h = self._hidden(x)
        d_h = d_logit[:, None] * self.p[2] * (1 - h * h)
        return [z.T @ d_h, d_h.sum(axis=0), h.T @ d_logit, d_logit.sum(keepdims=True)]

    def fit(self, positive: np.ndarray, unlabelled: np.ndarray, prior: float, rounds: int = 1500, rate: float = 0.01,
            decay: float = 1e-4, batch: int = 512, seed: int = 9) -> None:
        """Minimise prior * R(P, +1) + max(0, R(U, -1) - prior * R(P, -1)) of the logistic loss with Adam.

        When the second part, the risk of the unseen negatives, falls below zero, the step goes up along it instead.
        """
        rng = np.random.default_rng(seed)
        m, v = [np.zeros_like(w) for w in self.p], [np.zeros_like(w) for w in self.p]
        for i in range(rounds):
            p, u = positive[rng.integers(0, len(positive), batch)], unlabelled[rng.integers(0, len(unlabelled), batch)]
            gp, gu = self.logit(p), self.logit(u)
            up, uu = 1 / (1 + np.exp(-gp)), 1 / (1 + np.exp(-gu))
            negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
            if negative >= 0:
                grad = [a + b for a, b in zip(self._back(p, prior * (up - 1) / batch - prior * up / batch), self._back(u, uu / batch))]
            else:
                grad = [a + b for a, b in zip(self._back(p, prior * up / batch), self._back(u, -uu / batch))]
            for k, g in enumerate(grad):
                g = g + decay * self.p[k]
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.01 * (g * g - v[k])
                self.p[k] = self.p[k] - rate * (1 - i / rounds) * (m[k] / (1 - 0.9 ** (i + 1))) / (np.sqrt(v[k] / (1 - 0.99 ** (i + 1))) + 1e-8)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.logit(x)))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled, from the scores of both.

    Below a threshold that hardly any positive reaches lie only negatives: for every threshold, the share of unlabelled
    scores below it in excess of the positives' bounds the share of negatives. The largest such bound is taken, each less
    one standard error so that chance in a thin tail does not count.
    """
    cuts = np.unique(np.quantile(np.concatenate([positive, unlabelled]), np.linspace(0.005, 0.9, 180)))
    below_p = np.searchsorted(np.sort(positive), cuts) / len(positive)
    below_u = np.searchsorted(np.sort(unlabelled), cuts) / len(unlabelled)
    error = np.sqrt(below_p * (1 - below_p) / len(positive) + below_u * (1 - below_u) / len(unlabelled))
    negative = ((below_u - below_p - error) / np.maximum(1 - below_p, 0.05)).max()
    return float(np.clip(1 - negative, 0.05, 0.99))


def _feature_rows(at: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for a, b, data, off in text_chunks(batch.column(at)):
                x = features(data, off, powers)
                values = pa.array(x.ravel())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.FixedSizeListArray.from_arrays(values, x.shape[1]).cast(pa.list_(pa.float32()))],
                    names=["side", "x"])
    return task


def train(docs: DataFrame, trusted: DataFrame, unlabelled: DataFrame, max_trusted: int = 4000, max_unlabelled: int = 8000,
          seed: int = 13) -> tuple[Classifier, float]:
    """The classifier and the class prior it was fitted with.

    docs: doc_id, text. trusted, unlabelled: doc_id of documents known to be good, and of any documents. Of either, those
    with the smallest hash of their id are taken, up to the given numbers; only these ids and feature vectors meet the
    driver. The prior is estimated from the scores of a first classifier on the half of the sample it was not fitted on.
    Without trusted documents the score is one half everywhere.
    """
    rank = F.xxhash64("doc_id", F.lit(seed))
    picked = None
    for side, ids, most in ((1, trusted, max_trusted), (0, unlabelled, max_unlabelled)):
        part = ids.select(F.col("doc_id").cast("long").alias("doc_id")).dropna().distinct().orderBy(rank, "doc_id").limit(most) \
            .select("doc_id", F.lit(side).alias("side"))
        picked = part if picked is None else picked.unionAll(part)
    # A bounded number of pairs of numbers: they go to the documents, and no text is shuffled.
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(picked), "doc_id")
    rows = source.select("side", "text").mapInArrow(_feature_rows(1), "side int, x array<float>").toPandas()
    rows = rows.assign(key=[tuple(x) for x in rows["x"]]).sort_values(["side", "key"]).reset_index(drop=True)
    x = np.stack(rows["x"]) if len(rows) else np.zeros((0, len(NAMES)), np.float32)
    positive, anything = x[rows["side"] == 1], x[rows["side"] == 0]
    if not len(positive) or not len(anything):
        model = Classifier(np.zeros(len(NAMES)), np.ones(len(NAMES)))
        model.p[2] = model.p[2] * 0
        return model, 0.5
    mean, scale = x.mean(axis=0).astype(float), np.maximum(x.std(axis=0), 1e-3).astype(float)
    rng = np.random.default_rng(seed)
    half_p, half_u = rng.random(len(positive)) < 0.5, rng.random(len(anything)) < 0.5
    if half_p.all() or not half_p.any() or half_u.all() or not half_u.any():
        half_p[:], half_u[:] = True, True
    first = Classifier(mean, scale)
    first.fit(positive[half_p], anything[half_u], 0.5, rounds=500)
    unseen_p, unseen_u = positive[~half_p], anything[~half_u]
    prior = estimate_prior(first.logit(unseen_p), first.logit(unseen_u)) if len(unseen_p) and len(unseen_u) else 0.5
    model = Classifier(mean, scale)
    model.fit(positive, anything, prior)
    return model, prior


def score(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row, in one pass without a shuffle.

    Null and empty texts have the score of a text without any character; repeated rows are each scored; a text of any
    length is read whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([source.schema[0], T.StructField("score", T.DoubleType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            parts = [shared.value.score(features(data, off, powers)) for _, _, data, off in text_chunks(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([*parts, np.zeros(0)]))], names=["doc_id", "score"])

    return source.mapInArrow(task, schema)
