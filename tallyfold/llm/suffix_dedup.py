"""Removal of repeated byte strings with suffix arrays of shards."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.anchors import window_runs
from tallyfold.llm.common import Slices, digests, text_chunks
from tallyfold.llm.debruijn import NO_ID, keyed
from tallyfold.llm.suffix_sort import permuted_common_prefixes, suffix_array
from tallyfold.session import stage_table

RUNS = "anchor long, bytes1 long, bytes2 long, doc_id long, mark long, start int, windows int"


def _run_rows(window: int, k: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, off in text_chunks(batch.column(2)):
                anchor, first, doc, count = window_runs(Slices(data), off, window, k)
                content = digests(data.tobytes(), first, first + count + window - 1)
                own = pa.array(doc + a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), *map(pa.array, content), batch.column(0).take(own), batch.column(1).take(own),
                     pa.array((first - off[doc]).astype(np.int32)), pa.array(count.astype(np.int32))],
                    names=["anchor", "bytes1", "bytes2", "doc_id", "mark", "start", "windows"])
    return task


def _anchor_rows(window: int, k: int):
    """Task: the minimizers of all runs and nothing else, for the first count."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, off in text_chunks(batch.column(0)):
                anchor = window_runs(Slices(data), off, window, k)[0]
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64))], names=["anchor"])
    return task


PIECES = "key long, doc_id long, mark long, start int, bytes binary"


def _piece_rows(window: int, k: int):
    """Task: the bytes of the wanted runs, each in at most two pieces: windows that hold at least half of what surrounds
    the anchor to its right, and the others. The key is a hash of what all windows of a piece hold for certain, so equal
    windows meet under one key and windows of a frequent anchor are told apart by their surroundings."""
    right = (window - k) // 2  # bytes beyond the anchor that windows of the right piece hold
    left = window - k - right + 1  # bytes before it that windows of the left piece hold

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(3)
            for a, b, data, off in text_chunks(batch.column(2)):
                slices, own = Slices(data), wanted.slice(a, b - a)
                pieces = slices.every(k).view(np.int64)
                flat, sizes = own.flatten(), np.diff(own.offsets.to_numpy())
                start, count = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
                doc = np.repeat(np.arange(b - a), sizes)
                begin = off[doc] + start
                anchor = flat.field(2).to_numpy(zero_copy_only=False)
                rows = []  # key from, key to, document, first byte, end byte
                for p, n, h, d in zip(begin.tolist(), count.tolist(), anchor.tolist(), doc.tolist()):
                    # The anchor lies in every window of the run: it is the smallest piece hash there.
                    at = p + n - 1 + int(np.argmax(pieces[p + n - 1: p + window - k + 1] == h))
                    split = min(n, max(0, at - left - p + 1))  # windows before this one hold ``left`` bytes before the anchor
                    if split:
                        rows.append((at - left, at + k, d, p, p + split - 1 + window))
                    if split < n:
                        rows.append((at, at + k + right, d, p + split, p + n - 1 + window))
                key_from, key_to, of, lo, hi = np.array(rows, np.int64).reshape(-1, 5).T
                take = pa.array(a + of)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slices.hash(key_from, key_to).view(np.int64)), batch.column(0).take(take), batch.column(1).take(take),
                     pa.array((lo - off[of]).astype(np.int32)), pa.array([data[x:y].tobytes() for x, y in zip(lo.tolist(), hi.tolist())], pa.binary())],
                    names=["key", "doc_id", "mark", "start", "bytes"])
    return task


SPANS = "doc_id long, mark long, start int, stop int"


def _later_windows(pieces: list[tuple], window: int) -> list[tuple[int, int, int, int]]:
    """Spans of the windows of these pieces that also start earlier in another piece, from one suffix array.

    pieces: (doc_id, mark, start, bytes).
    """
    text = np.frombuffer(b"".join(p[3] for p in pieces), np.uint8)
    size = np.array([len(p[3]) for p in pieces], np.int64)
    begin = np.cumsum(size) - size
    count = size - window + 1
    piece = np.repeat(np.arange(len(pieces)), count)
    place = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count)
    at = begin[piece] + place  # every window, in text order
    order = suffix_array(text, window)
    is_window = np.zeros(len(text), np.int64)
    is_window[at] = np.arange(1, len(at) + 1)
    nth = is_window[order]
    nth = nth[nth > 0] - 1  # windows in sorted order
    before = np.full(len(at), -1, np.int64)
    before[nth[1:]] = nth[:-1]
    has = np.flatnonzero(before >= 0)
    common = np.zeros(len(at), np.int32)
    common[has] = permuted_common_prefixes(text, at[has], at[before[has]], window)
    group = np.empty(len(at), np.int64)
    group[nth] = np.cumsum(common[nth] < window) - 1
    doc = np.array([p[0] for p in pieces], np.int64)[piece]
    where = np.array([p[2] for p in pieces], np.int64)[piece] + place
    ranked = np.lexsort((where, doc, group))
    lead = np.ones(len(at), bool)
    lead[1:] = group[ranked][1:] != group[ranked][:-1]
    first = ranked[lead][group]  # the earliest window of each group
    later = (doc > doc[first]) | ((doc == doc[first]) & (where > where[first]))
    return _runs(pieces, piece, place, later, window)


def _runs(pieces, piece, place, later, window):
    hit = np.flatnonzero(later)
    if not len(hit):
        return []
    new = np.ones(len(hit), bool)
    new[1:] = (np.diff(hit) != 1) | (np.diff(piece[hit]) != 0)
    head, tail = hit[new], hit[np.append(new[1:], True)]
    return [(pieces[p][0], pieces[p][1], pieces[p][2] + int(a), pieces[p][2] + int(b) + window)
            for p, a, b in zip(piece[head].tolist(), place[head], place[tail])]


def _shard_rows(window: int, shard_bytes: int):
    """Task: a suffix array over as many whole keys as fill a shard. Pieces come sorted by key."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple] = []
        size, last = 0, None

        def out() -> pa.RecordBatch:
            rows = _later_windows(shard, window) if shard else []
            cols = list(zip(*rows)) or [(), (), (), ()]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["doc_id", "mark", "start", "stop"])

        for batch in batches:
            for key, doc_id, mark, start, data in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if size >= shard_bytes and key != last:
                    yield out()
                    shard, size = [], 0
                shard.append((doc_id, mark, start, data))
                size, last = size + len(data), key
        yield out()
    return task


def _window_rows(window: int):
    """Task: each window of a piece by itself, under the digest of its bytes."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = batch.column(4)[i].as_py()
                begin = np.arange(len(data) - window + 1)
                own = pa.array(np.full(len(begin), i))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(own), *map(pa.array, digests(data, begin, begin + window)), batch.column(1).take(own),
                     batch.column(2).take(own), pa.array((batch.column(3)[i].as_py() + begin).astype(np.int32))],
                    names=["key", "bytes1", "bytes2", "doc_id", "mark", "start"])
    return task


def repeated_byte_spans(docs: DataFrame, window: int = 100, k: int = 24, shard_bytes: int = 2 << 20, crowd: int = 4000,
                        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, mark, start, stop): byte stretches covered by ``window``-byte strings that also start earlier.

    1. Windows are packed into runs that share a minimizer (:mod:`anchors`). A minimizer seen once cannot repeat.
    2. Runs with the same bytes (by a cryptographic digest of 128 bits): all but the earliest are repeats as a whole. This settles copies, however many.
    3. Of minimizers with several contents, the earliest run of each content goes to a shard by its surroundings, where a
       suffix array by induced sorting and common prefixes in text order show which windows are equal.
    A key with more than ``crowd`` pieces, each different, does not go to one shard: its windows are counted one by one,
    with combining before the shuffle, and the earliest of each is found that way. The result is the same.
    """
    source = keyed(docs, id_col, text_col)
    runs = source.mapInArrow(_run_rows(window, k), RUNS)
    seen = source.select("text").mapInArrow(_anchor_rows(window, k), "anchor long").groupBy("anchor").agg(F.count("*").alias("n")) \
        .filter("n > 1").select("anchor")
    # Written first: a join on a plain table, not on an aggregate, is one whose hot minimizers can be split.
    runs = stage_table(runs.join(stage_table(seen, "seen").hint("merge"), "anchor"), "runs")
    same = ["anchor", "bytes1", "bytes2"]
    kinds = stage_table(runs.groupBy(*same).agg(
        F.count("*").alias("times"), F.min(F.struct("doc_id", "start", "mark", "windows")).alias("r")), "kinds")
    copied = kinds.filter("times > 1").select(*same, F.struct("r.doc_id", "r.start").alias("first"))
    copies = runs.join(copied.hint("merge"), same).filter(F.struct("doc_id", "start") > F.col("first")) \
        .select("doc_id", "mark", "start", (F.col("start") + F.col("windows") + (window - 1)).alias("stop"))
    many = kinds.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    wanted = kinds.join(stage_table(many, "many").hint("merge"), "anchor").select("r.doc_id", "r.mark", F.struct("r.start", "r.windows", "anchor").alias("w")) \
        .groupBy("doc_id", "mark").agg(F.collect_list("w").alias("wanted"))
    pieces = source.join(wanted.hint("merge"), ["doc_id", "mark"]).select("doc_id", "mark", "text", "wanted") \
        .mapInArrow(_piece_rows(window, k), PIECES)
    pieces = stage_table(pieces, "pieces")
    crowds = pieces.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    pieces = stage_table(pieces.join(stage_table(crowds, "keys").hint("merge"), "key"), "crowds")
    sharded = pieces.filter(F.col("n") <= crowd).select("key", "doc_id", "mark", "start", "bytes") \
        .repartition("key").sortWithinPartitions("key").mapInArrow(_shard_rows(window, shard_bytes), SPANS)
    single = stage_table(pieces.filter(F.col("n") > crowd).select("key", "doc_id", "mark", "start", "bytes").mapInArrow(
        _window_rows(window), "key long, bytes1 long, bytes2 long, doc_id long, mark long, start int"), "windows")
    same = ["key", "bytes1", "bytes2"]
    first = stage_table(single.groupBy(*same).agg(F.min(F.struct("doc_id", "start")).alias("first"), F.count("*").alias("n")).filter("n > 1"), "first")
    crowded = single.join(first.hint("merge"), same).filter(F.struct("doc_id", "start") > F.col("first")) \
        .select("doc_id", "mark", "start", (F.col("start") + window).alias("stop"))
    return copies.unionAll(sharded).unionAll(crowded)


def remove_repeated_bytes(docs: DataFrame, window: int = 100, k: int = 24, id_col: str = "doc_id", text_col: str = "text",
                          with_bytes: bool = False, **settings) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept_bytes) of every row.

    Null counts as empty. A null id comes before all others. Neither of two rows with one id is earlier by its id, only
    by where the string starts. An empty table gives no rows; other columns are not read.
    """
    spans = repeated_byte_spans(docs, window, k, id_col=id_col, text_col=text_col, **settings).groupBy("doc_id", "mark") \
        .agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    rows = keyed(docs, id_col, text_col).join(spans.hint("merge"), ["doc_id", "mark"], "left") \
        .select("doc_id", F.col("text").cast("binary").alias("text"), "spans")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept_bytes"] if with_bytes else [])]
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept_bytes binary" if with_bytes else "")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1), batch.column(2)):
                data = text.as_py()
                size, gone, parts = len(data), 0, 0
                if spans.is_valid:
                    flat = spans.values
                    step = np.zeros(size + 1, np.int32)
                    np.add.at(step, flat.field(0).to_numpy(), 1)
                    np.add.at(step, flat.field(1).to_numpy(), -1)
                    out_of = np.cumsum(step[:-1]) > 0
                    gone, parts = int(out_of.sum()), int(out_of[0]) + int((out_of[1:] & ~out_of[:-1]).sum())
                    data = np.frombuffer(data, np.uint8)[~out_of].tobytes()
                out.append((size, gone, parts, hashlib.sha256(data).hexdigest(), *([data] if with_bytes else [])))
            cols = list(zip(*out)) or [()] * (len(names) - 1)
            kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds))], names=names)

    return rows.mapInArrow(task, schema).withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))
