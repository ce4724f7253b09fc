"""Substring dedup on a compacted de Bruijn graph of word windows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.anchors import window_runs
from tallyfold.llm.common import Slices, digests, joined_words, text_chunks, word_spans
from tallyfold.session import stage_table

NO_ID = -(1 << 63)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id (null: the smallest number), mark and text. Id and mark name a row; rows equal in both are alike."""
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.xxhash64(text_col).alias("mark"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def _word_rows(data: np.ndarray, off: np.ndarray):
    """Hashes of all words, the first word of each document, and the words themselves as :func:`common.joined_words`."""
    starts, ends, first = word_spans(data, off)
    return Slices(Slices(data).hash(starts, ends)), first, *joined_words(data, starts, ends)


def _path_rows(window: int, k: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, off in text_chunks(batch.column(2)):
                words, word_off, joined, begin = _word_rows(data, off)
                anchor, first, doc, count = window_runs(words, word_off, window, k)
                content = digests(joined, begin[first], begin[first + count + window - 1] - 1)
                own = pa.array(doc + a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), *map(pa.array, content), batch.column(0).take(own), batch.column(1).take(own),
                     pa.array((first - word_off[doc]).astype(np.int32)), pa.array(count.astype(np.int32))],
                    names=["anchor", "words1", "words2", "doc_id", "mark", "start", "edges"])
    return task


PATHS = "anchor long, words1 long, words2 long, doc_id long, mark long, start int, edges int"


def _edge_rows(window: int):
    """Task: every single edge (window) of the wanted paths: path and place in it, and the digest of its words."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(3)
            for a, b, data, off in text_chunks(batch.column(2)):
                starts, ends, word_off = word_spans(data, off)
                joined, begin = joined_words(data, starts, ends)
                own = wanted.slice(a, b - a)
                flat, sizes = own.flatten(), np.diff(own.offsets.to_numpy())
                start, edges, times = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (3, 4, 5))
                doc = np.repeat(np.arange(b - a), sizes)
                path = np.repeat(np.arange(len(start)), edges)
                place = np.arange(len(path)) - np.repeat(np.cumsum(edges) - edges, edges)
                at = word_off[doc[path]] + start[path] + place
                edge = digests(joined, begin[at], begin[at + window] - 1)
                take = pa.array(path)
                yield pa.RecordBatch.from_arrays(
                    [*(flat.field(i).take(take) for i in range(3)), pa.array(place.astype(np.int32)), pa.array(times[path]), *map(pa.array, edge)],
                    names=["anchor", "words1", "words2", "place", "times", "edge1", "edge2"])
    return task


def repeated_spans(docs: DataFrame, window: int = 35, k: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, mark, start, stop): stretches of words that lie in windows whose word sequence also starts elsewhere.

    The graph has the ``window``-word sequences as edges and the sequences one word shorter as nodes. A text is a path.

    * Neighbouring edges that share a minimizer are packed into one path row at the source, with its coordinates. Equal
      edges always lie at the same minimizer, so paths of different minimizers have no edge in common.
    * A minimizer that occurs once has only edges of multiplicity one; all such rows, most of a text, go at once.
    * If all paths at a minimizer have one content, the path does not branch: joined on the minimizer they are one compact
      path of multiplicity two or more, and all their coordinates are repeats.
    * If contents differ, the graph branches there. Each distinct content stands for all its copies, is unpacked into its
      edges, and edges are counted with the copies as weights. Coordinates of the copies then take over the verdict.

    Paths and edges are told apart by a cryptographic digest of 128 bits over their words, taken at the source
    coordinates; the hashes behind the minimizers only decide which of them meet. Counts are combined before each shuffle;
    no group of rows is gathered in one task, and the joins back are on written tables, so that they can be split.
    """
    source = keyed(docs, id_col, text_col)
    paths = source.mapInArrow(_path_rows(window, k), PATHS)
    seen = paths.groupBy("anchor").agg(F.count("*").alias("n"), *[f(c).alias(f"{c}_{f.__name__}") for c in ("words1", "words2") for f in (F.min, F.max)]) \
        .filter("n > 1").select("anchor", F.expr("words1_min != words1_max OR words2_min != words2_max").alias("branches"))
    # Written first: a join on a plain table, not on an aggregate, is one whose hot minimizers can be split.
    paths = stage_table(paths.join(stage_table(seen, "seen").hint("merge"), "anchor"), "paths")
    plain = paths.filter("NOT branches").select("doc_id", "mark", "start", (F.col("start") + F.col("edges") + (window - 1)).alias("stop"))
    forked = paths.filter("branches")
    same = ["anchor", "words1", "words2"]
    kinds = forked.groupBy(*same).agg(F.count("*").alias("times"), F.min(F.struct("doc_id", "mark", "start", "edges")).alias("r"))
    wanted = kinds.select("r.doc_id", "r.mark", F.struct(*same, "r.start", "r.edges", "times").alias("w")) \
        .groupBy("doc_id", "mark").agg(F.collect_list("w").alias("wanted"))
    single = source.join(wanted.hint("merge"), ["doc_id", "mark"]).select("doc_id", "mark", "text", "wanted")
    single = stage_table(single.mapInArrow(_edge_rows(window), "anchor long, words1 long, words2 long, place int, times long, edge1 long, edge2 long"), "edges")
    edge = ["anchor", "edge1", "edge2"]
    often = stage_table(single.groupBy(*edge).agg(F.sum("times").alias("n")).filter("n > 1").select(*edge), "often")
    hit = stage_table(single.join(often.hint("merge"), edge).groupBy(*same).agg(F.collect_set("place").alias("places")), "hit")
    forks = forked.join(hit.hint("merge"), same).select("doc_id", "mark", "start", F.explode("places").alias("place"))
    forks = forks.select("doc_id", "mark", (F.col("start") + F.col("place")).alias("start"), (F.col("start") + F.col("place") + window).alias("stop"))
    return plain.unionAll(forks)


def _kept_words(text: str, spans) -> tuple[int, int, bytes]:
    """Words, removed words, and the kept ones joined by one space."""
    words = text.encode().split()  # bytes split at exactly the six white space characters
    if spans is None:
        return len(words), 0, b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int32)
    np.add.at(gone, [s["start"] for s in spans], 1)
    np.add.at(gone, [s["stop"] for s in spans], -1)
    keep = np.cumsum(gone[:-1]) == 0
    return len(words), int(len(words) - keep.sum()), b" ".join([words[i] for i in np.flatnonzero(keep)])


def remove_repeats(docs: DataFrame, window: int = 35, k: int = 8, id_col: str = "doc_id", text_col: str = "text",
                   with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and kept_text) of every row after removal of all repeated windows.

    Every copy goes, the first one too. Null counts as a text without words. Rows with one id and different texts are
    different documents; equal rows are copies of one another. An empty table gives no rows; other columns are not read.
    """
    spans = repeated_spans(docs, window, k, id_col, text_col).groupBy("doc_id", "mark") \
        .agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    rows = keyed(docs, id_col, text_col).join(spans.hint("merge"), ["doc_id", "mark"], "left").select("doc_id", "text", "spans")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if with_text else "")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1), batch.column(2)):
                n, gone, kept = _kept_words(text.as_py(), spans.as_py())
                out.append((n, gone, hashlib.sha256(kept).hexdigest(), *([kept.decode()] if with_text else [])))
            cols = list(zip(*out)) or [()] * (4 if with_text else 3)
            ids = batch.column(0)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), *(pa.array(c, pa.string()) for c in cols[2:])],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", *(["kept_text"] if with_text else [])])

    return rows.mapInArrow(task, schema).withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))
