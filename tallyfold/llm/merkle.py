"""Merkle manifest of a table: SHA-256 trees whose parents keep the hash state before each child."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.ordered import rank_by
from tallyfold.session import stage_table

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 in hex of the values as text: ``-`` for null, else UTF-8 byte count, colon, value."""
    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*map(part, values)), 256)


class Parent:
    """A node over a run of children. ``states[i]`` is the hash state before child i, a copy taken while hashing."""

    __slots__ = ("children", "states", "digest")

    def __init__(self, children: list[bytes]) -> None:
        self.children, self.states = b"".join(children), []
        state = hashlib.sha256()
        for child in children:
            self.states.append(state.copy())
            state.update(child)
        self.digest = state.hexdigest().encode()

    def resume(self, slot: int, child: bytes) -> bytes:
        """The digest with another child in a slot: the state before it, the child, and what is right of it."""
        state = self.states[slot].copy()
        state.update(child + self.children[64 * slot + 64:])
        return state.hexdigest().encode()

    def siblings(self, slot: int) -> bytes:
        return self.children[: 64 * slot] + self.children[64 * slot + 64:]


def parents_of(level: list[bytes], fan: int) -> list[Parent]:
    return [Parent(level[i: i + fan]) for i in range(0, len(level), fan)]


def tree_levels(leaves: DataFrame, group: str, fan: int = 16) -> tuple[list[DataFrame], DataFrame]:
    """Runs of children by level, and the root of each group.

    leaves: group, pos (from 0, in order), digest, n (leaves of the group). A level is a written table (group, run,
    children, digest, n): ``fan`` consecutive nodes, hashed to one, for groups of more than one node. A group of any size
    is spread over all tasks by its runs; the number of levels is the logarithm of the largest group.
    """
    spark = leaves.sparkSession
    current, levels = leaves.select(group, "pos", "digest", "n"), []
    roots = current.filter("n = 1").select(group, "digest")
    most = current.agg(F.max("n")).first()[0] or 0
    while most > 1:
        runs = current.filter("n > 1").groupBy(group, F.expr(f"pos div {fan}").alias("run")).agg(
            F.transform(F.sort_array(F.collect_list(F.struct("pos", "digest"))), lambda x: x["digest"]).alias("children"), F.first("n").alias("n"))
        runs = stage_table(runs.select(group, "run", "children", F.sha2(F.concat_ws("", "children"), 256).alias("digest"),
                                       F.expr(f"(n + {fan - 1}) div {fan}").alias("n")), "runs")
        levels.append(runs)
        current = runs.select(group, F.col("run").alias("pos"), "digest", "n")
        roots = roots.unionAll(current.filter("n = 1").select(group, "digest"))
        most = -(-most // fan)
    return levels, stage_table(roots, "roots")


def _path_up(rows: DataFrame, levels: Sequence[DataFrame], group: str, at: str, path: str, fan: int) -> DataFrame:
    """Adds to ``path`` the run above ``at`` on each level, as (slot, children); where a tree has ended nothing is added."""
    for runs in levels:
        side = runs.select(F.col(group).alias("__group"), F.col("run").alias("__run"), "children")
        on = rows[group].eqNullSafe(side["__group"]) & (F.expr(f"{at} div {fan}") == F.col("__run"))
        step = F.when(F.col("children").isNotNull(), F.array(F.struct(F.expr(f"cast({at} % {fan} as int)").alias("slot"), "children")))
        rows = rows.join(side, on, "left").withColumn(path, F.concat(path, F.coalesce(step, F.array()))) \
            .withColumn(at, F.expr(f"{at} div {fan}")).drop("__group", "__run", "children")
    return rows


NO_PATH = "cast(array() as array<struct<slot:int,children:array<string>>>)"
PROOFS = "doc_id {id}, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


def _fold_rows(fan: int, depth: int):
    """Task: rows sorted by block, each block a path row and then its leaves; one proof and one folded root a leaf."""
    def block(path: dict, leaves: list[tuple], put) -> None:
        level, size = [leaf for _, leaf, _ in leaves], path["n"]
        local: list[list[Parent]] = []
        while len(local) < depth and size > 1:
            local.append(parents_of(level, fan))
            level, size = [p.digest for p in local[-1]], -(-size // fan)
        above = [(Parent([c.encode() for c in step["children"]]), step["slot"]) for step in path["own"]]
        subroot = above[-1][0].digest if above else level[0]
        n_own = len(above)
        above += [(Parent([c.encode() for c in step["children"]]), step["slot"]) for step in path["top"]]
        root = above[-1][0].digest if len(above) > n_own else subroot
        rest = b"".join(parent.siblings(slot) for parent, slot in above)
        folded: dict[tuple[int, bytes], bytes] = {}  # nodes that many leaves fold to are carried up once
        for at, (doc_id, leaf, altered) in enumerate(leaves):
            value, seen = altered or leaf, []
            for parents in local:
                at, slot = divmod(at, fan)
                seen.append(parents[at].siblings(slot))
                value = parents[at].resume(slot, value)
            if value not in folded:
                top = value
                for parent, slot in above:
                    top = parent.resume(slot, top)
                folded[value] = top
            seen.append(rest)
            put(doc_id, leaf.decode(), subroot.decode(), root.decode(), hashlib.sha256(b"".join(seen)).hexdigest(), folded[value].decode())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, leaves, kind = None, [], pa.int64()
        cols: list[list] = [[] for _ in range(6)]

        def put(*row) -> None:
            for col, value in zip(cols, row):
                col.append(value)

        def out() -> pa.RecordBatch:
            types = [kind, *[pa.string()] * 5]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                               names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"])
            for col in cols:
                col.clear()
            return batch

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for row in batch.select(["doc_id", "leaf", "altered", "path"]).to_pylist():
                if row["path"] is None:
                    leaves.append((row["doc_id"], row["leaf"].encode(), row["altered"] and row["altered"].encode()))
                    continue
                if leaves:
                    block(path, leaves, put)
                    if len(cols[0]) >= fan ** depth:
                        yield out()
                path, leaves = row["path"], []
        if leaves:
            block(path, leaves, put)
        if cols[0]:
            yield out()
    return task


def merkle_manifest(docs: DataFrame, altered: Column | None = None, fan: int = 16, depth: int = 3, id_col: str = "doc_id",
                    source_col: str = "source", columns: Sequence[str] = COLUMNS, text_col: str = "text") -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row.

    Rows are leaves, in order of id within their source; every ``fan`` consecutive nodes become their parent until one is
    left, the subroot of the source. Subroots in order of source make a tree of the same kind, whose root names the
    table. The proof of a leaf is its siblings on the way up; ``proof_sha256`` is the hash of these. ``altered`` gives
    the text that is found when the manifest is checked, null where it is as it was; the leaf of that text is folded
    with the siblings of the manifest, and is verified if the root comes out.

    * A parent keeps a copy of its hash state before each child, so that a fold hashes the replacement and the right
      siblings only. Hash states live in one task: a task holds blocks of ``fan ** depth`` leaves, and with each block
      the few runs above it.
    * Ranks, runs and blocks have bounded size, so one source may hold any share of the rows.

    Null is a source of its own and comes first; a null id comes first in its source; rows of one id are in order of
    their digests. Null and empty values differ in the digest. An empty table gives no rows; other columns are not read.
    """
    values = [F.col(c) for c in columns]
    found = F.lit(None).cast("string") if altered is None else F.when(altered.isNotNull(), leaf_digest(
        [altered if c == text_col else F.col(c) for c in columns]))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), leaf_digest(values).alias("leaf"), found.alias("altered"))
    ranked = rank_by(rows, ["doc_id", "leaf"], ["source"], name="pos").withColumn("pos", F.col("pos") - 1)
    ranked = stage_table(ranked, "leaves")
    counts = stage_table(ranked.groupBy("source").agg(F.count("*").alias("n")), "counts")
    sized = ranked.select(F.col("source"), "pos", F.col("leaf").alias("digest"))
    side = counts.select(F.col("source").alias("__source"), "n")
    levels, subroots = tree_levels(sized.join(side, sized["source"].eqNullSafe(side["__source"])).drop("__source"), "source", fan)

    top = rank_by(subroots, ["source"], name="at").select("source", F.lit(0).alias("whole"), (F.col("at") - 1).alias("pos"), "digest")
    top = stage_table(top, "subroots")
    top_levels, _ = tree_levels(top.withColumn("n", F.lit(top.count()).cast("long")), "whole", fan)
    ways = _path_up(top.select("source", "whole", "pos", F.expr(NO_PATH).alias("top")), top_levels, "whole", "pos", "top", fan)
    ways = stage_table(ways.select(F.col("source").alias("__source"), "top"), "ways")

    block = fan ** depth
    blocks = counts.select("source", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {block}"))).alias("block"))
    blocks = _path_up(blocks.withColumn("at", F.col("block")).withColumn("own", F.expr(NO_PATH)), levels[depth:], "source", "at", "own", fan)
    blocks = blocks.join(ways, blocks["source"].eqNullSafe(ways["__source"]))
    none = F.lit(None)
    heads = blocks.select("source", "block", F.lit(-1).cast("long").alias("pos"), none.cast(ranked.schema["doc_id"].dataType).alias("doc_id"),
                          none.cast("string").alias("leaf"), none.cast("string").alias("altered"), F.struct("n", "own", "top").alias("path"))
    leaves = ranked.select("source", F.expr(f"pos div {block}").alias("block"), "pos", "doc_id", "leaf", "altered",
                           none.cast(heads.schema["path"].dataType).alias("path"))
    dealt = heads.unionAll(leaves).repartition("source", "block").sortWithinPartitions("source", "block", "pos")
    proofs = dealt.mapInArrow(_fold_rows(fan, depth), PROOFS.format(id=ranked.schema["doc_id"].dataType.simpleString()))
    return proofs.withColumn("verified", F.col("folded_root") == F.col("root"))


def lowered(text: Column) -> Column:
    """Text with A-Z in lower case and nothing else changed."""
    return F.translate(text, UPPER, LOWER)
