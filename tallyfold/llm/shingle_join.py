"""N-gram Jaccard self-join by grouped prefixes, down to connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import LOWER, Slices, mix, text_chunks, word_spans
from tallyfold.operators.components import connected_components
from tallyfold.session import release_shuffles, stage_table

ZONE = 4 / 3  # the share of the hash space whose shingles are counted over all documents, in prefix lengths
CROWD = 32  # classes in a bucket beyond which they are filed again by the counts of all their shingles
SIGN = -(1 << 63)


def prefix_length(n, percent: int):
    """Shingles of which two sets of this size or more must share one, if 100 * intersection >= percent * union."""
    return n - -(-n * percent // 100) + 1


def document_shingles(data: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all word k-grams (A-Z lower-cased) and the document of each; shorter documents give one whole sequence."""
    starts, ends, first = word_spans(data, off)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    words = Slices(Slices(LOWER[data]).hash(starts, ends))
    n_words = np.diff(first)
    doc = np.repeat(np.arange(len(n_words)), n_words)
    left = first[1:][doc] - np.arange(len(words))  # words from here to the end of the document
    at = np.flatnonzero((left >= k) | ((n_words[doc] < k) & (left == n_words[doc])))
    return words.hash(at, at + np.minimum(left[at], k)), doc[at]


def _sets(k: int, percent: int, whole: bool):
    """Task: distinct shingles of each document, sorted; without ``whole`` only those a prefix may need."""
    cut = np.uint64(min((1 << 64) - 1, int(ZONE * (100 - percent) / 100 * (1 << 64))))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, off in text_chunks(batch.column(1)):
                hashes, doc = document_shingles(data, off, k)
                bounds = np.searchsorted(doc, np.arange(b - a + 1))
                sets = [np.unique(hashes[bounds[i]: bounds[i + 1]]) for i in range(b - a)]
                size = np.array([len(s) for s in sets], np.int64)
                flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
                edge = np.concatenate([[0], np.cumsum(size)])
                sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(flat ^ np.uint64(s)))]) for s in (0x51, 0xA7C3)]
                signs = [(s[edge[1:]] - s[edge[:-1]]).view(np.int64) for s in sums]
                zone = np.array([int(np.searchsorted(s, cut)) for s in sets], np.int64)
                keep = size if whole else np.minimum(size, np.maximum(zone, prefix_length(size, percent)))
                if not whole:
                    flat = np.concatenate([*(s[:n] for s, n in zip(sets, keep)), np.zeros(0, np.uint64)])
                # Flipping the top bit keeps the order of unsigned numbers in signed ones.
                values = pa.array((flat ^ np.uint64(1 << 63)).view(np.int64))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(keep)]).astype(np.int32)), values)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(size), *map(pa.array, signs), pa.array(zone), lists],
                    names=["doc_id", "n", "s1", "s2", "zone", "head"])
    return task


def _class_sets(k: int):
    """Task: the whole set of each class from the text of one of its documents; rows that only share the id are left out."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = _sets(k, 0, True)
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([batch.column(0), batch.column(3)], names=["cid", "text"])
            at = 0
            for out in make(iter([texts])):
                want = batch.slice(at, out.num_rows)
                at += out.num_rows
                same = pc.and_(pc.equal(out.column(2), want.column(1)), pc.equal(out.column(3), want.column(2)))
                yield pa.RecordBatch.from_arrays([out.column(0), out.column(5)], names=["cid", "head"]).filter(same)
    return task


SCHEMA = "doc_id long, n long, s1 long, s2 long, zone long, head array<long>"


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose whole shingle sets are similar enough."""
    left, right = sets.select(F.col("cid").alias("a"), F.col("head").alias("set_a")), \
        sets.select(F.col("cid").alias("b"), F.col("head").alias("set_b"))
    shared = F.size(F.array_intersect("set_a", "set_b"))
    return (pairs.join(left, "a").join(right, "b")
            .filter(100 * shared >= percent * (F.size("set_a") + F.size("set_b") - shared)).select("a", "b"))


def _sizes_fit(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _filed(classes: DataFrame, percent: int) -> DataFrame:
    """(cid, n, alone, token, pos, held): each class under the shingles of its prefix that another class is filed under too.

    classes: cid, n, zone, head. The order of shingles is that of the first ``zone`` ones by the number of classes that
    hold them, then the rest of ``head`` as it is. ``alone`` counts those that one class holds; they come first and find
    nobody. ``held`` is the number of classes under the shingle.
    """
    inside = classes.select("cid", F.explode(F.slice("head", F.lit(1), F.col("zone").cast("int"))).alias("token"))
    common = inside.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    common = stage_table(common, "common")  # a join on a plain table, not on an aggregate, can be split where it is hot
    shared = inside.join(common.hint("merge"), "token").groupBy("cid").agg(
        F.sort_array(F.collect_list(F.struct("df", "token"))).alias("known"))
    need = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    late = F.transform(F.slice("head", F.col("zone").cast("int") + 1, F.greatest(F.size("head") - F.col("zone"), F.lit(0)).cast("int")),
                       lambda t: F.struct(F.lit(1 << 62).alias("df"), t.alias("token")))
    known = F.coalesce("known", F.array().cast("array<struct<df:bigint,token:bigint>>"))
    rows = classes.select("cid", "n", "zone", late.alias("late")).join(shared.hint("merge"), "cid", "left") \
        .select("cid", "n", need.alias("need"), (F.col("zone") - F.size(known)).alias("alone"), F.concat(known, "late").alias("order"))
    prefix = F.slice("order", F.lit(1), F.greatest(F.col("need") - F.col("alone"), F.lit(0)).cast("int"))
    entries = stage_table(rows.select("cid", "n", "alone", F.posexplode(F.transform(prefix, lambda x: x["token"])).alias("pos", "token"))
                          .withColumn("pos", F.col("pos") + F.col("alone")), "prefixes")
    held = stage_table(entries.groupBy("token").agg(F.count("*").alias("held")).filter("held > 1"), "held")
    return entries.join(held.hint("merge"), "token")


def jaccard_components(docs: DataFrame, k: int = 4, percent: int = 85, rounds: int = 2, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id linked to, directly or through others) for every row.

    1. Documents with the same shingle set are one class from here on, however many there are.
    2. Shingles are put in one global order: those in a fixed zone of the hash space first, by the number of classes that
       hold them, then the rest by hash. Two similar sets share a shingle among the first ``prefix_length`` of each. A
       shingle of one class alone fills its place but finds nobody, so most documents are done here.
    3. Classes in a bucket (shared prefix shingle) of more than ``CROWD`` are taken as a collection of their own and filed
       again, now by the counts of all their shingles within it: a passage that many documents share no longer brings
       together documents that are otherwise different. A pair that only meets in such buckets has both members there.
       What is crowded now is mostly groups of near copies: its classes are first compared with a leader each, one with
       few shingles of its own. That is linear in the bucket, whatever its size.
    4. Classes of the same component, size and shared prefix are one group. Pairs of groups that share a bucket but not
       a component pass the size and position filters, and only then are expanded to members and verified on whole sets.
    Pairs inside a component are never made: they cannot change the result. No pair across components is left out.

    A shingle is compared by a 64-bit hash. Null and empty texts have no shingles and are linked with nothing; a null id
    never names a component. Repeated rows each get the same answer. An empty table gives no rows.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = stage_table(source.mapInArrow(_sets(k, percent, False), SCHEMA), "shingles")
    grouped = (rows.filter("n > 0").groupBy("s1", "s2", "n")
               .agg(F.min("doc_id").alias("doc_id"), F.first("zone").alias("zone"), F.first("head").alias("head")))
    classes = stage_table(grouped.select(F.monotonically_increasing_id().alias("cid"), "*"), "classes")
    # A set below this size is linked only with equal ones.
    filed = stage_table(_filed(classes.filter(f"{percent} * (n + 1) <= 100 * n").select("cid", "n", "zone", "head"), percent), "filed")
    release_shuffles(docs.sparkSession)  # each step stands on written tables: what the one before it shuffled may go
    # Whole sets of the classes that share a bucket with another one.
    some_id = F.coalesce("doc_id", F.lit(SIGN)).alias("doc_id")
    wanted = filed.select("cid").distinct().join(classes.select("cid", some_id, "s1", "s2"), "cid")
    texts = source.select(some_id, "text").join(wanted.hint("merge"), "doc_id").select("cid", "s1", "s2", "text")
    sets = stage_table(texts.mapInArrow(_class_sets(k), "cid long, head array<long>"), "sets")
    del texts
    release_shuffles(docs.sparkSession)

    crowd = filed.filter(F.col("held") > CROWD).select("cid").distinct()
    again = sets.join(stage_table(crowd, "crowd").hint("merge"), "cid")
    again = again.dropDuplicates(["cid"]).select("cid", F.size("head").cast("long").alias("n"), F.size("head").cast("long").alias("zone"), "head")
    again = stage_table(again, "crowded-sets")
    crowded = stage_table(_filed(again, percent), "crowded")
    release_shuffles(docs.sparkSession)
    entries = filed.filter(F.col("held") <= CROWD).unionByName(crowded.withColumn("token", F.xxhash64("token", F.lit(2)))).drop("held")

    nodes = filed.select(F.col("cid").alias("node")).distinct()
    links, label = None, nodes.select("node", F.col("node").alias("component"))
    for turn in range(rounds):
        member = crowded.join(label.select(F.col("node").alias("cid"), "component"), "cid")
        rank = ["alone", "cid"] if turn == 0 else [F.xxhash64("component", F.lit(turn)).alias("h"), "alone", "cid"]
        lead = stage_table(member.groupBy("token").agg(F.min(F.struct(*rank, "component", "n")).alias("l")), "leaders")
        found = (member.join(lead, "token").filter("component <> l.component").filter(_sizes_fit("n", "l.n", percent))
                 .select(F.col("cid").alias("a"), F.col("l.cid").alias("b")).distinct())
        got = stage_table(_verified(found, again, percent), "links")
        links = got if links is None else links.unionAll(got)
        label = stage_table(connected_components(nodes, links), "labels")

    groups = (entries.groupBy("cid", "n").agg(F.sort_array(F.collect_list(F.struct("pos", "token"))).alias("entry"))
              .join(label.select(F.col("node").alias("cid"), "component"), "cid"))
    groups = stage_table(groups.select("cid", "n", "component", "entry", F.xxhash64("component", "n", "entry").alias("gid")), "groups")
    buckets = groups.groupBy("gid", "n", "component").agg(F.first("entry").alias("entry")) \
        .select("gid", "n", "component", F.inline("entry"))
    buckets = stage_table(buckets, "buckets")
    there = buckets.select("token", "component").distinct()
    across = there.select("token", F.col("component").alias("c1")).join(there.select("token", F.col("component").alias("c2")), "token").filter("c1 < c2")
    one, two = (buckets.select("token", *(F.col(c).alias(f"{c}{i}") for c in ("n", "pos", "gid")), F.col("component").alias(f"c{i}")) for i in (1, 2))
    # With this shingle shared, at most the rest of either set can be shared as well.
    most = F.least(F.col("n1") - F.col("pos1"), F.col("n2") - F.col("pos2"))
    pairs = (across.join(one, ["token", "c1"]).join(two, ["token", "c2"]).filter(_sizes_fit("n1", "n2", percent))
             .filter((100 + percent) * most >= percent * (F.col("n1") + F.col("n2")))
             .select("gid1", "gid2").distinct())
    expanded = (pairs.join(groups.select(F.col("gid").alias("gid1"), F.col("cid").alias("a")), "gid1")
                .join(groups.select(F.col("gid").alias("gid2"), F.col("cid").alias("b")), "gid2").select("a", "b").distinct())
    got = stage_table(_verified(expanded, sets, percent), "links")
    label = connected_components(nodes, got if links is None else links.unionAll(got))
    named = stage_table(classes.select("cid", "s1", "s2", "n", "doc_id").join(label.select(F.col("node").alias("cid"), "component"), "cid", "left")
                        .withColumn("component", F.coalesce("component", "cid")), "named")
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    answer = named.join(smallest, "component").select("s1", "s2", "n", "component_id")
    return (rows.select("doc_id", "n", "s1", "s2").join(answer, ["s1", "s2", "n"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))
