"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained and run in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.llm.common import LOWER, Powers, byte_table, prefix_hash, slice_hash, text_chunks

WIDTH, STRIDE = 64, 32  # words of a window, and words between the starts of neighbouring windows (at most half a window)
UNITS, DIM, CHARS = 8, 8, 256  # units a direction, size of an input vector, buckets of word beginnings and of endings
LETTERS = byte_table(5)
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def words(data: np.ndarray, off: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, beginning and ending bucket of every word (letters and digits, A-Z lower-cased); first word of each document."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, np.zeros(len(off), np.int64)
    inside = WORD_BYTE[data]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    before = np.concatenate([[False], inside[:-1]])
    after = np.concatenate([inside[1:], [False]])
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    low = LOWER[data]
    hashes = slice_hash(prefix_hash(LETTERS[low], powers), starts, ends, powers)
    low = np.concatenate([low, np.zeros(3, np.uint8)]).astype(np.int64)
    head, tail = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    for k in range(3):
        head = head * 131 + np.where(starts + k < ends, low[starts + k], 0)
        tail = tail * 131 + np.where(ends - 1 - k >= starts, low[ends - 1 - k], 0)
    return hashes, head * 40503 % 65521 % CHARS, tail * 40503 % 65521 % CHARS, np.searchsorted(starts, off)


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word, number of words) of all overlapping windows; a document without words has one empty window."""
    n_words = np.diff(first)
    count = np.maximum(1, -(-(n_words - WIDTH) // STRIDE) + 1)
    doc = np.repeat(np.arange(len(n_words)), count)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    return doc, first[doc] + nth * STRIDE, np.minimum(WIDTH, n_words[doc] - nth * STRIDE)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Network:
    """Inputs of a word: its own vector, if it is in the vocabulary, and vectors of its first and last three characters."""

    def __init__(self, vocabulary: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.vocabulary = np.sort(vocabulary)  # hashes of the known words
        v = len(vocabulary) + 1

        def normal(*shape, scale):
            return rng.normal(0, scale, shape).astype(np.float32)

        self.p = {"word": normal(v, DIM, scale=0.1), "head": normal(CHARS, DIM, scale=0.1), "tail": normal(CHARS, DIM, scale=0.1)}
        for d in "fb":
            self.p |= {"W" + d: normal(DIM, 3 * UNITS, scale=0.4), "U" + d: normal(UNITS, 3 * UNITS, scale=0.3),
                       "c" + d: np.zeros(3 * UNITS, np.float32)}
        self.p |= {"att": normal(2 * UNITS, scale=0.3), "out": normal(2 * UNITS, scale=0.3), "bias": np.zeros(1, np.float32)}

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        """Place in the vocabulary; its size stands for all other words."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, len(self.vocabulary))

    def _direction(self, inputs: np.ndarray, alive: np.ndarray, d: str, keep: bool):
        """inputs: step x window x 3 gates. Hidden states of every step; with ``keep`` also what the way back needs."""
        steps, n = alive.shape
        u, h, u_n = self.p["U" + d][:, : 2 * UNITS], np.zeros((n, UNITS), np.float32), self.p["U" + d][:, 2 * UNITS:]
        out, saved = np.zeros((steps, n, UNITS), np.float32), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            gates = _sigmoid(inputs[t, :, : 2 * UNITS] + h @ u)
            z, r = gates[:, :UNITS], gates[:, UNITS:]
            hu = h @ u_n
            new = np.tanh(inputs[t, :, 2 * UNITS:] + r * hu)
            nxt = new + z * (h - new)
            nxt = np.where(alive[t][:, None], nxt, h)
            if keep:
                saved.append((t, h, z, r, hu, new))
            out[t] = h = nxt
        return out, saved

    def forward(self, word, head, tail, alive, keep=False, shown=None):
        """Logit of each window. word, head, tail, alive: step x window."""
        vectors = [self.p[k][ids] for k, ids in (("word", word), ("head", head), ("tail", tail))]
        x = sum(vectors if shown is None else (v * s[..., None] for v, s in zip(vectors, shown)))
        states, saved = [], {}
        for d in "fb":
            out, saved[d] = self._direction(x @ self.p["W" + d] + self.p["c" + d], alive, d, keep)
            states.append(out)
        return self._pool(np.concatenate(states, axis=2), alive, keep, x, saved)

    def _pool(self, h, alive, keep, x=None, saved=None):
        e = np.where(alive, h @ self.p["att"], -1e30)
        a = np.exp(e - e.max(axis=0)) * alive
        a /= np.maximum(a.sum(axis=0), 1e-30)
        pooled = np.einsum("tn,tnk->nk", a, h)
        logit = pooled @ self.p["out"] + self.p["bias"][0]
        return (logit, (x, saved, h, a, pooled)) if keep else logit

    def gradients(self, word, head, tail, alive, target, shown=None):
        """Gradients of the mean logistic loss over the windows by back-propagation through time.

        ``shown`` marks the input vectors that are used; the rest count as zero.
        """
        logit, (x, saved, h, a, pooled) = self.forward(word, head, tail, alive, keep=True, shown=shown)
        d_logit = ((_sigmoid(logit) - target) / len(target)).astype(np.float32)
        g = {"out": pooled.T @ d_logit, "bias": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * self.p["out"]
        d_a = np.einsum("tnk,nk->tn", h, d_pooled)
        d_e = a * (d_a - (a * d_a).sum(axis=0))
        g["att"] = np.einsum("tn,tnk->k", d_e, h)
        d_h_all = a[..., None] * d_pooled + d_e[..., None] * self.p["att"]
        d_x = np.zeros_like(x)
        for k, d in enumerate("fb"):
            u, u_n = self.p["U" + d][:, : 2 * UNITS], self.p["U" + d][:, 2 * UNITS:]
            g_u, d_in = np.zeros_like(self.p["U" + d]), np.zeros((*alive.shape, 3 * UNITS), np.float32)
            carry = np.zeros_like(pooled[:, :UNITS])
            for t, before, z, r, hu, new in reversed(saved[d]):
                total = carry + d_h_all[t, :, k * UNITS: (k + 1) * UNITS]
                live = alive[t][:, None]
                d_next = np.where(live, total, 0)
                d_new = d_next * (1 - z) * (1 - new * new)
                d_z = d_next * (before - new) * z * (1 - z)
                d_r = d_new * hu * r * (1 - r)
                d_zr = np.concatenate([d_z, d_r], axis=1)
                d_in[t] = np.concatenate([d_zr, d_new], axis=1)
                g_u[:, : 2 * UNITS] += before.T @ d_zr
                g_u[:, 2 * UNITS:] += before.T @ (d_new * r)
                carry = np.where(live, d_next * z + d_zr @ u.T + (d_new * r) @ u_n.T, total)
            g["U" + d] = g_u
            flat = d_in.reshape(-1, 3 * UNITS)
            g["W" + d], g["c" + d] = x.reshape(-1, DIM).T @ flat, flat.sum(axis=0)
            d_x += d_in @ self.p["W" + d].T
        for k, (name, ids) in enumerate((("word", word), ("head", head), ("tail", tail))):
            g[name] = np.zeros_like(self.p[name])
            np.add.at(g[name], ids.ravel(), (d_x if shown is None else d_x * shown[k][..., None]).reshape(-1, DIM))
        return g

    def fit(self, inputs, target: np.ndarray, rounds: int, batch: int = 256, rate: float = 0.01, decay: float = 1e-3,
            hide: float = 0.25, soft: float = 0.03, seed: int = 11) -> None:
        """Adam over drawn batches in which both classes weigh the same.

        Against learning single documents by heart, input vectors are hidden at random, targets are softened and the
        vectors shrink.
        """
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        sides = [side for side in (np.flatnonzero(target > 0.5), np.flatnonzero(target <= 0.5)) if len(side)]
        target = soft + (1 - 2 * soft) * target
        for i in range(rounds):
            pick = np.concatenate([rng.choice(side, batch // len(sides)) for side in sides])
            own = [x[:, pick] for x in inputs]
            shown = (rng.random((3, *own[0].shape), np.float32) >= hide).astype(np.float32)
            g = self.gradients(*own, target[pick], shown)
            speed = rate * (1 - i / rounds)
            for k, d in g.items():
                d = d + decay * self.p[k]
                first[k] += 0.1 * (d - first[k])
                second[k] += 0.01 * (d * d - second[k])
                self.p[k] -= speed * (first[k] / (1 - 0.9 ** (i + 1))) / (np.sqrt(second[k] / (1 - 0.99 ** (i + 1))) + 1e-6)

    def tables(self) -> dict[str, list[np.ndarray]]:
        """Input vectors of words, beginnings and endings already multiplied by the gate weights."""
        return {d: [self.p["word"] @ self.p["W" + d] + self.p["c" + d], self.p["head"] @ self.p["W" + d],
                    self.p["tail"] @ self.p["W" + d]] for d in "fb"}

    def score_windows(self, word, head, tail, start, size, tables, block: int = 1024) -> np.ndarray:
        """Logits of windows given as first word and number of words into the arrays of a chunk."""
        out = np.empty(len(start), np.float32)
        order = np.argsort(size, kind="stable")
        if not len(word):
            word = head = tail = np.zeros(1, np.int64)
        for i in range(0, len(order), block):
            own = order[i: i + block]
            steps = max(1, int(size[own[-1]]))
            nth = np.arange(steps)[:, None]
            alive = nth < size[own]
            at = np.minimum(start[own] + nth, len(word) - 1)
            states = []
            for d in "fb":
                a, b, c = tables[d]
                states.append(self._direction(a[word[at]] + b[head[at]] + c[tail[at]], alive, d, False)[0])
            out[own] = self._pool(np.concatenate(states, axis=2), alive, False)
        return out


def _window_rows(per_doc: int, seed: int):
    """Task: at most ``per_doc`` windows of each document, drawn over its whole length, as arrays of inputs."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            label = batch.column(2).to_numpy(zero_copy_only=False)
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for a, b, data, off in text_chunks(batch.column(1)):
                hashes, head, tail, first = words(data, off, powers)
                doc, start, size = windows(first)
                rng = np.random.default_rng(seed)
                draw = rng.random(len(doc))
                order = np.lexsort((draw, doc))
                rank = np.arange(len(doc)) - np.searchsorted(doc, doc)
                own = order[rank < per_doc]
                rows = [(int(ids[a + doc[w]]), int(label[a + doc[w]]), hashes[start[w]: start[w] + size[w]].view(np.int64),
                         head[start[w]: start[w] + size[w]], tail[start[w]: start[w] + size[w]]) for w in own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                     pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                     *(pa.array([r[k].astype(np.int16) for r in rows], pa.list_(pa.int16())) for k in (3, 4))],
                    names=["doc_id", "label", "hash", "head", "tail"])
    return task


def _telling_words(rows: pd.DataFrame, most: int, least_z: float = 4.0) -> np.ndarray:
    """Hashes of the words whose share of windows differs most between the classes, beyond what chance explains."""
    sides = [np.unique(np.concatenate([np.unique(h) for h in part["hash"]] or [np.zeros(0, np.int64)]), return_counts=True)
             for part in (rows[rows["label"] == 0], rows[rows["label"] == 1])]
    seen = np.union1d(sides[0][0], sides[1][0])
    total = np.array([max(1, int((rows["label"] == k).sum())) for k in (0, 1)])
    count = np.zeros((2, len(seen)))
    for k, (word, times) in enumerate(sides):
        count[k, np.searchsorted(seen, word)] = times
    both = count.sum(axis=0) / total.sum()
    z = np.abs(count[1] / total[1] - count[0] / total[0]) / np.sqrt(both * (1 - both) * (1 / total).sum() + 1e-12)
    top = np.argsort(-z, kind="stable")[:most]
    return seen[top[z[top] >= least_z]].view(np.uint64)


def train(docs: DataFrame, labels: DataFrame, max_docs: int = 3000, per_doc: int = 3, max_words: int = 4000, rounds: int = 100,
          seed: int = 7) -> Network:
    """Fit the network on at most ``max_docs`` labelled documents of each class.

    docs: doc_id, text. labels: doc_id, label (only rows that may be learnt from; of several for an id the largest
    counts). The documents are those with the smallest hash of their id, from both classes as far as they go. Of each, ``per_doc``
    windows are drawn over its whole length. A toxic document has harmless windows too, and some labels are wrong, so a
    second training keeps only its window that the first network finds worst, if that one looks toxic at all; a bar that rises
    with the other documents would leave out languages whose signals are weaker. Words that tell the classes apart beyond chance have a
    vector of their own, at most ``max_words``; all words have those of their characters. Memory of the driver: the windows, at most
    2 * max_docs * per_doc * 64 words.
    """
    rank = F.xxhash64(F.col("doc_id"), F.lit(seed))
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label")).dropna() \
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = None
    for value in (0, 1):
        part = own.filter(F.col("label") == value).orderBy(rank, "doc_id").limit(max_docs)
        chosen = part if chosen is None else chosen.unionAll(part)
    # At most 2 * max_docs pairs of numbers, so they go to the documents and no text is shuffled.
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    rows: pd.DataFrame = chosen.mapInArrow(_window_rows(per_doc, seed), "doc_id long, label int, hash array<long>, head array<short>, tail array<short>").toPandas()
    # Copies of a window count once for each label, or their words would seem to tell the classes apart.
    rows = rows.assign(copy=[np.asarray(h).tobytes() for h in rows["hash"]]).sort_values(["doc_id", "label", "copy"], kind="stable") \
        .drop_duplicates(["label", "copy"]).drop(columns="copy").reset_index(drop=True)
    if not len(rows):
        return Network(np.zeros(0, np.uint64), seed)
    vocabulary = _telling_words(rows, max_words)

    def inputs(network: Network, frame: pd.DataFrame):
        size = frame["hash"].map(len).to_numpy()
        shape = (WIDTH, len(frame))
        word, head, tail, alive = (np.zeros(shape, np.int16) for _ in range(4))
        for i, (h, a, b) in enumerate(zip(frame["hash"], frame["head"], frame["tail"])):
            word[: size[i], i], head[: size[i], i], tail[: size[i], i] = network.word_ids(np.asarray(h).view(np.uint64)), a, b
            alive[: size[i], i] = 1
        return word, head, tail, alive.astype(bool)

    network, target = Network(vocabulary, seed), rows["label"].to_numpy().astype(np.float32)
    x = inputs(network, rows)
    network.fit(x, target, rounds)
    logit = np.concatenate([network.forward(*(v[:, i: i + 512] for v in x)) for i in range(0, len(rows), 512)])
    best = np.isin(np.arange(len(rows)), rows.assign(logit=logit).sort_values("logit", ascending=False).drop_duplicates("doc_id").index)
    keep = (target < 0.5) | (best & (logit > 0))
    network.fit([v[:, keep] for v in x], target[keep], rounds)
    return network


def score(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text", name: str = "score",
          whole_rows: bool = False) -> DataFrame:
    """doc_id and score: the highest window probability of each whole text, in one pass without a shuffle.

    With ``whole_rows`` all columns of the input stay, and the probability is added as column ``name``. Null and empty
    texts get the probability of a window without words; repeated rows are each scored. A very long text is many windows,
    of which a bounded block is worked on at a time.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)
    source = docs if whole_rows else docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    at = source.columns.index(text_col if whole_rows else "text")
    keep = [i for i in range(len(source.columns)) if whole_rows or i != at]
    schema = T.StructType([*(source.schema[i] for i in keep), T.StructField(name, T.DoubleType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, powers = shared.value, Powers()
        tables = net.tables()
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for a, b, data, off in text_chunks(batch.column(at)):
                hashes, head, tail, first = words(data, off, powers)
                doc, start, size = windows(first)
                logits = net.score_windows(net.word_ids(hashes), head, tail, start, size, tables)
                scores[a:b] = 1 / (1 + np.exp(-np.maximum.reduceat(logits, np.searchsorted(doc, np.arange(b - a))).astype(float)))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(scores)], names=schema.names)

    return source.mapInArrow(task, schema)
