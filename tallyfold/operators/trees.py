"""Decision trees, forests and boosting on binned columns.

Columns are cut once into at most 256 bins and kept as bytes, feature by feature, in blocks of rows. A large node is
split from histograms: every block sends sums per node, feature and bin, and the driver picks the best cut from their
total. Of two siblings only the smaller one is counted; the other is the difference to the parent. In forests and single
trees a node of at most ``LOCAL_ROWS`` rows is sent to one task, which grows it to its end. Boosting on at most
``ROUND_CELLS`` cells runs all its rounds in one task by the same code, as a job for each level costs more than its work. The model never travels to
find histograms except for the tree at hand; the driver holds about 25 bytes a node of the finished model.

Labels of classifiers are 0 and 1.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.hashing import SEED
from tallyfold.operators.quantiles import column_statistics
from tallyfold.session import shared_folder, stage_table

BINS = 256
LOCAL_ROWS = 50_000  # rows of a node that one task grows to its end
TASK_CELLS = 4_000_000  # rows times features in a partition of blocks
LEAST_CELLS = 500_000  # so few that a task of its own does not pay
BLOCK_ROWS = 65_536
ROUND_CELLS = 20_000_000  # rows times features of a boosting whose rounds all run in one task
JOINT = 1024  # bins of features that are counted together
PASS_CELLS = 4_000_000  # histogram cells that one pass may count
TINY = 1e-9  # gains that agree to this part are a tie: the first feature, then the lowest cut wins


# --- binned blocks ------------------------------------------------------------------------------

def find_cuts(df: DataFrame, width: int, bins: int = BINS) -> list[np.ndarray]:
    """Ascending cut values of each feature: the values at evenly spread ranks. Bin b holds values above cut b-1 up to cut b."""
    found = column_statistics(df.select(vector_to_array("features")), width, [i / bins for i in range(1, bins)])
    cuts: list[set] = [set() for _ in range(width)]
    for r in found.select("column", "low").collect():  # at most width * bins rows
        cuts[r["column"]].add(r["low"])
    return [np.array(sorted(c), float) for c in cuts]


def _block_rows(cuts: list[np.ndarray]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(cuts))
            binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)]).astype(np.uint8)
            parts = [binned, *(batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))]
            yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()]) for p in parts], names=["bins", "y", "w", "key"])
    return task


def _packed(x: np.ndarray):
    """The same values in fewer bytes: one value for all rows, or small whole numbers."""
    if len(x) and (x == x[0]).all():
        return x.dtype, len(x), x[:1]
    if x.dtype == np.float64:
        with np.errstate(invalid="ignore"):
            small = x.astype(np.int8)
        if (small == x).all():
            return x.dtype, len(x), small
    return x.dtype, len(x), x


def _unpacked(kind, size: int, x: np.ndarray) -> np.ndarray:
    return x.astype(kind, copy=False) if len(x) == size else np.full(size, x[0], kind)


class Block:
    """Rows of a partition: bins (feature, row), label, weight, a 64-bit key, and the score so far."""

    def __init__(self, bins: np.ndarray, y: np.ndarray, w: np.ndarray, key: np.ndarray, score: np.ndarray) -> None:
        self.bins, self.y, self.w, self.key, self.score = bins, y, w, key, score
        self.codes: dict[int, list] = {}
        self.at: tuple | None = None  # number of a growing tree, and the node of each row
        self.sums: tuple | None = None  # the same, and what is summed up

    def __getstate__(self):
        return self.bins, *(_packed(x) for x in (self.y, self.w, self.key, self.score))

    def __setstate__(self, state) -> None:
        self.__init__(state[0], *(_unpacked(*x) for x in state[1:]))

    def joint(self, layout: Layout) -> list[np.ndarray]:
        """The bins of the features of each group as one number."""
        if layout.joint not in self.codes:
            codes = self.codes[layout.joint] = []
            for group in layout.groups:
                code = self.bins[group[0]]
                for j in group[1:]:
                    code = code.astype(np.uint16) * np.uint16(layout.sizes[j]) + self.bins[j]
                codes.append(code)
        return self.codes[layout.joint]

    def leaves(self, routes: Tree, number: int) -> np.ndarray:
        """The node of each row in a growing tree, from where it was when asked before."""
        known = self.at[1] if self.at is not None and self.at[0] == number else None
        self.at = number, routes.leaf_of(self.bins, known)
        return self.at[1]

    def summands(self, sums: Callable, number: int) -> tuple:
        if self.sums is None or self.sums[0] != number:
            self.sums = number, sums(self)
        return self.sums[1]

    def rescored(self, score: np.ndarray) -> Block:
        out = Block(self.bins, self.y, self.w, self.key, score)
        out.codes = self.codes
        return out


class Layout:
    """The bins each feature has, and groups of features with few bins: their joint bins are counted once for all of them."""

    def __init__(self, sizes: Sequence[int], joint: int = JOINT) -> None:
        self.sizes, self.groups, self.joint, room = list(sizes), [], joint, []
        for j in sorted(range(len(self.sizes)), key=lambda j: -self.sizes[j]):
            i = next((i for i, n in enumerate(room) if n * self.sizes[j] <= joint), len(room))
            if i == len(room):
                self.groups.append([])
                room.append(1)
            self.groups[i].append(j)
            room[i] *= self.sizes[j]
        self.room = room

    def apart(self, group: int, cells: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(feature, sums by node and bin) from the sums by node and joint bin of a group."""
        own = self.groups[group]
        cells = cells.reshape(-1, *(self.sizes[j] for j in own))
        for i, j in enumerate(own):
            yield j, cells.sum(tuple(k + 1 for k in range(len(own)) if k != i))


def _read_block(row, width: int, start: float) -> Block:
    y = np.frombuffer(row.y, np.float64)
    return Block(np.frombuffer(row.bins, np.uint8).reshape(width, len(y)), y, np.frombuffer(row.w, np.float64),
                 np.frombuffer(row.key, np.uint64), np.full(len(y), start))


def _larger_blocks(blocks: Iterator[Block], keyed: bool = True) -> Iterator[Block]:
    """The rows in blocks of about ``BLOCK_ROWS``; where no draw goes by the keys they are left out."""
    def whole() -> Block:
        parts = [np.concatenate([getattr(b, k) for b in held], axis=-1) for k in ("bins", "y", "w", "key", "score")]
        return Block(*parts[:3], parts[3] if keyed else np.zeros(len(parts[1]), np.uint64), parts[4])

    held: list[Block] = []
    for block in blocks:
        if held and sum(len(b.y) for b in held) + len(block.y) > BLOCK_ROWS:
            yield whole()
            held = []
        held.append(block)
    if held:
        yield whole()


def binned_blocks(df: DataFrame, label: str, weight: str | None, id_col: str | None, cuts: list[np.ndarray]) -> DataFrame:
    """Blocks as a written table (bins, y, w, key); partitions hold about ``TASK_CELLS`` cells, fewer where cores would idle.

    Random draws go by the key: a hash of the id, or of the row where there is none, so that they do not depend on
    how the rows lie. Without an id, copies of a row are drawn together.
    """
    key = F.xxhash64(id_col) if id_col else F.xxhash64("x", "y")
    rows = df.select(vector_to_array("features").alias("x"), F.col(label).cast("double").alias("y"),
                     (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"), *([F.col(id_col)] if id_col else []))
    rows = rows.select("x", "y", "w", key.alias("key"))
    cells = df.count() * len(cuts)
    parts = max(1, -(-cells // TASK_CELLS), min(-(-cells // LEAST_CELLS), df.sparkSession.sparkContext.defaultParallelism))
    if rows.rdd.getNumPartitions() > parts:
        rows = rows.coalesce(parts)
    return stage_table(rows.mapInArrow(_block_rows(cuts), "bins binary, y binary, w binary, key binary"), "blocks")


def _mixed(key: np.ndarray, *seeds: int) -> np.ndarray:
    """Uniform doubles in [0, 1) from keys and seeds."""
    x = key.copy()
    for s in seeds:
        x ^= np.uint64((s * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xCA5A826395121157)
        x ^= x >> np.uint64(32)
    return (x >> np.uint64(11)) * 2.0 ** -53


def _drawn(u: np.ndarray) -> np.ndarray:
    """Poisson counts of mean one: how often a row is in a bootstrap sample."""
    steps = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)])
    few = np.zeros(len(u), np.int8)
    for step in steps[:4]:
        few += u >= step
    out, many = few.astype(float), np.flatnonzero(few == 4)
    out[many] = np.searchsorted(steps, u[many], "right")
    return out


def _chosen(width: int, share: int, *seeds: int) -> np.ndarray:
    """Which ``share`` of the features a node or tree may use."""
    if share >= width:
        return np.ones(width, bool)
    draw = _mixed(np.arange(1, width + 1, dtype=np.uint64), *seeds)
    return draw <= np.partition(draw, share - 1)[share - 1]


# --- trees --------------------------------------------------------------------------------------

@dataclass
class Tree:
    """Arrays over nodes, parents first. ``left`` of a leaf is -1; the right child follows the left one."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    rows: np.ndarray

    def leaf_of(self, bins: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """The leaf of each row, from the root or from nodes that are known."""
        at, row = np.zeros(bins.shape[1], np.intp) if at is None else at.copy(), np.arange(bins.shape[1])
        if 4 * len(self.left) <= len(at):
            at, row = self._moved(bins, at)
        while True:
            left = self.left[at[row]]
            row = row[left >= 0]
            if not len(row):
                return at
            node = at[row]
            at[row] = self.left[node] + (bins[self.feature[node], row] > self.cut[node])

    def _moved(self, bins: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Level by level with all rows at once, for a tree with few nodes: where the rows are when most are in a leaf, and those that are not."""
        inner = self.left >= 0
        # A leaf is its own left child, and no bin is above its cut.
        left = np.where(inner, self.left, np.arange(len(inner)))
        cut, offset = np.where(inner, self.cut, 255).astype(np.uint8), np.where(inner, self.feature, 0).astype(np.int64) * len(at)
        flat, place = np.ascontiguousarray(bins).reshape(-1), np.arange(len(at))
        while True:
            seen = np.zeros(len(inner), bool)
            seen[at] = True
            used = np.flatnonzero(seen)
            going = inner[used]
            if not going.any():
                return at, used[:0]
            if going.all() and (offset[used] == offset[used[0]]).all() and (cut[used] == cut[used[0]]).all():
                at = left.take(at) + (bins[self.feature[used[0]]] > cut[used[0]])
                if inner[left[used]].any() or inner[left[used] + 1].any():
                    continue
                return at, used[:0]
            on = inner[at]
            if 2 * np.count_nonzero(on) < len(at):
                return at, np.flatnonzero(on)
            at = left.take(at) + (flat.take(offset.take(at) + place) > cut.take(at))

    def importance(self, width: int) -> np.ndarray:
        inner = self.left >= 0
        return np.bincount(self.feature[inner], self.gain[inner], width)

    def pruned(self, leaves: int) -> Tree:
        """The tree that best-first growth reaches with so many leaves: always the open node of largest gain is split."""
        heap, split = [(-self.gain[0], 0)] if self.left[0] >= 0 else [], set()
        while heap and len(split) < leaves - 1:
            _, node = heapq.heappop(heap)
            split.add(node)
            for child in (self.left[node], self.left[node] + 1):
                if self.left[child] >= 0:
                    heapq.heappush(heap, (-self.gain[child], int(child)))
        return _rebuilt(self, split)


def _rebuilt(tree: Tree, split: set) -> Tree:
    """Only the nodes reached through ``split`` ones, numbered anew."""
    return _renumbered(tree, split)[0]


def _renumbered(tree: Tree, split: set) -> tuple[Tree, np.ndarray]:
    """:func:`_rebuilt`, and for each old node the new one that its rows are in."""
    order, left = [0], []
    for node in order:
        if node in split:
            left.append(len(order))
            order += [int(tree.left[node]), int(tree.left[node]) + 1]
        else:
            left.append(-1)
    new = np.full(len(tree.left), -1)
    new[order] = np.arange(len(order))
    for node in np.flatnonzero(tree.left >= 0):  # parents come first
        for child in (tree.left[node], tree.left[node] + 1):
            if new[child] < 0:
                new[child] = new[node]
    return Tree(tree.feature[order], tree.cut[order], np.array(left, np.int32), tree.value[order], tree.gain[order], tree.rows[order]), new


@dataclass
class Rules:
    """When and how a node is split. Sums are a (of weight * target) and b (of weight); boosting puts in -gradient and curvature."""

    depth: int = 30
    min_rows: int = 1  # of a leaf
    min_split: int = 2  # rows of a node that may be split
    min_weight: float = 0.0  # b of a leaf
    ridge: float = 0.0
    min_gain: float = 0.0
    entropy: bool = False
    share: int = 1 << 30  # features looked at in a node
    seed: int = SEED

    def worth(self, a, b):
        """What a node adds to the objective: the gain of a split is what its sides add over their parent."""
        with np.errstate(divide="ignore", invalid="ignore"):
            if not self.entropy:
                return np.where(b + self.ridge > 0, a * a / (b + self.ridge), 0.0)
            p = np.clip(np.where(b > 0, a / b, 0.0), 0.0, 1.0)
            return b * (np.where(p > 0, p * np.log2(p), 0.0) + np.where(p < 1, (1 - p) * np.log2(1 - p), 0.0))


def _best_cut(cells: np.ndarray, total: np.ndarray, rules: Rules, allowed: np.ndarray):
    """(gain, feature, cut, sums of the left side) of the best cut of one node from its (feature, bin, 3) sums; None if there is none."""
    left = np.cumsum(cells, axis=1)[:, :-1]
    right = total - left
    gain = rules.worth(left[..., 0], left[..., 1]) + rules.worth(right[..., 0], right[..., 1]) - rules.worth(total[0], total[1])
    fine = (left[..., 2] >= rules.min_rows) & (right[..., 2] >= rules.min_rows) & allowed[:, None]
    fine &= (left[..., 1] >= rules.min_weight) & (right[..., 1] >= rules.min_weight)
    gain = np.where(fine, gain, -np.inf)
    top = gain.max(initial=-np.inf)
    if not top > max(rules.min_gain, TINY * abs(rules.worth(total[0], total[1])) * 1e-3):
        return None
    feature, cut = np.unravel_index(int(np.argmax(gain >= top * (1 - TINY))), gain.shape)
    return float(gain[feature, cut]), int(feature), int(cut), left[feature, cut]


class _Growing:
    """A tree that grows on the driver from histograms of all blocks."""

    def __init__(self, width: int, rules: Rules, number: int = 0, columns: np.ndarray | None = None, layout: Layout | None = None) -> None:
        self.width, self.rules, self.number = width, rules, number
        self.layout = layout or Layout([BINS] * width)
        self.columns = np.ones(width, bool) if columns is None else columns
        self.feature, self.cut, self.left, self.heap, self.depth = [-1], [0], [-1], [1], [0]
        self.total: list = [None]
        self.best: list = [None]  # (gain, feature, cut, left sums), or False where no cut is worth it
        self.cells: dict[int, np.ndarray] = {}
        self.parent, self.open, self.kept = [-1], [], set()

    def tree(self, value: Callable) -> Tree:
        sums = np.array(self.total, float).reshape(-1, 3)
        gain = np.array([b[0] if b else 0.0 for b in self.best])
        return Tree(np.array(self.feature, np.int32), np.array(self.cut, np.uint8), np.array(self.left, np.int32),
                    value(sums[:, 0], sums[:, 1]), gain, sums[:, 2].astype(np.int64))

    def routes(self) -> Tree:
        none = np.zeros(len(self.left))
        return Tree(np.array(self.feature, np.int32), np.array(self.cut, np.uint8), np.array(self.left, np.int32), none, none, none)

    def learn(self, node: int, cells: np.ndarray) -> None:
        """Take in the histogram of a node: its sums and its best cut."""
        if self.total[node] is None:
            self.total[node] = cells[0].sum(0)
        rules, rows = self.rules, self.total[node][2]
        self.best[node] = False
        if self.depth[node] < rules.depth and rows >= max(rules.min_split, 2 * rules.min_rows):
            allowed = self.columns & _chosen(self.width, rules.share, rules.seed, self.number, self.heap[node])
            self.best[node] = _best_cut(cells, self.total[node], rules, allowed) or False
        if self.best[node]:
            self.cells[node] = cells

    def split(self, node: int) -> tuple[int, int]:
        _, self.feature[node], self.cut[node], left = self.best[node]
        self.left[node] = child = len(self.left)
        for side, sums in ((0, left), (1, self.total[node] - left)):
            self.feature.append(-1)
            self.cut.append(0)
            self.left.append(-1)
            self.heap.append(2 * self.heap[node] + side)
            self.depth.append(self.depth[node] + 1)
            self.total.append(sums)
            self.best.append(None)
            self.parent.append(node)
        return child, child + 1


def _histograms(block: Block, routes: Tree, wanted: Sequence[int], sums: Callable, layout: Layout, number: int) -> list[np.ndarray]:
    """For each group of features (wanted, joint bin, 3): sums of a, b and rows."""
    a, b, rows = block.summands(sums, number)
    at = block.leaves(routes, number)
    slot = np.full(len(routes.left), -1, np.int64)
    slot[list(wanted)] = np.arange(len(wanted))
    at = slot[at]
    on = at >= 0
    if rows is not None:
        on &= rows > 0
    row = np.flatnonzero(on) if np.count_nonzero(on) < len(on) else slice(None)
    at, a, b = at[row], a[row], b if b is None else b[row]
    out = []
    for code, size in zip(block.joint(layout), layout.room):
        cell, cells = at * size, len(wanted) * size
        cell += code[row]
        count = np.bincount(cell, minlength=cells).astype(float)
        found = (np.bincount(cell, a, cells), count if b is None else np.bincount(cell, b, cells), count)
        out.append(np.stack(found, axis=-1).reshape(len(wanted), size, 3))
    return out


def _spread(found: Sequence[np.ndarray], layout: Layout) -> np.ndarray:
    """(node, feature, bin, 3) from the sums of the groups."""
    out = np.zeros((len(found[0]), len(layout.sizes), BINS, 3))
    for i, cells in enumerate(found):
        for k in range(3):
            for j, own in layout.apart(i, cells[..., k]):
                out[:, j, : own.shape[1], k] = own
    return out


def _added(a, b):
    return a + b


GATHERED = 1 << 25  # bytes of partial sums that the driver may take from all partitions at once


def _total(blocks: RDD | list, part: Callable, made: Callable, size: int) -> np.ndarray:
    """The sum over all blocks of what ``part`` gives: arrays that each partition adds up, ``made`` into one of ``size`` bytes. Where all
    partial sums are small the driver takes them as they are; the shuffle of a tree of sums would cost more than the pass itself."""
    def added(part_blocks: Iterator[Block]) -> Iterator[np.ndarray]:
        total = None
        for block in part_blocks:
            one = part(block)
            if total is None:
                total = one
            else:
                for x, y in zip(total, one):
                    x += y
        if total is not None:
            yield made(total)

    if isinstance(blocks, list):
        return next(added(iter(blocks)))
    sums = blocks.mapPartitions(added)
    if size * blocks.getNumPartitions() > GATHERED:
        return sums.treeReduce(_added)
    found = sums.collect()
    return sum(found[1:], found[0])


def _count(blocks: RDD, jobs: Sequence[tuple[_Growing, Sequence[int], Callable]]) -> None:
    """Histograms of these nodes of these trees, in passes of bounded size. Of two siblings the smaller one is counted."""
    direct, derived = [], []
    for i, (growing, nodes, _) in enumerate(jobs):
        for node in nodes:
            p = growing.parent[node]
            twin = 2 * growing.left[p] + 1 - node if p >= 0 else -1
            larger = twin in nodes and p in growing.cells and (growing.total[node][2], node) > (growing.total[twin][2], twin)
            (derived if larger else direct).append((i, node))
    routes = [growing.routes() for growing, _, _ in jobs]
    most = max(1, PASS_CELLS // (jobs[0][0].width * BINS))
    for at in range(0, len(direct), most):
        part: dict[int, list[int]] = {}
        for i, node in direct[at: at + most]:
            part.setdefault(i, []).append(node)
        found = _counted(blocks, [(routes[i], nodes, jobs[i][2], jobs[i][0].layout, jobs[i][0].number) for i, nodes in part.items()])
        for (i, node), cells in zip([(i, node) for i, nodes in part.items() for node in nodes], found):
            jobs[i][0].cells[node] = cells
    for i, node in derived:
        growing = jobs[i][0]
        p = growing.parent[node]
        growing.cells[node] = growing.cells[p] - growing.cells[2 * growing.left[p] + 1 - node]
    for growing, nodes, _ in jobs:
        for node in nodes:
            growing.learn(node, growing.cells.pop(node))


def _counted(blocks: RDD | list, ask: Sequence[tuple]) -> np.ndarray:
    """(node, feature, bin, 3): histograms of the nodes that :func:`_histograms` is asked for, one after the other."""
    layout = ask[0][3]
    if max(len(one[1]) for one in ask) * JOINT > BLOCK_ROWS:  # so many nodes that joint bins would outnumber the rows of a block
        layout = Layout(layout.sizes, 1)
    ask, groups = [(*one[:3], layout, one[4]) for one in ask], len(layout.groups)
    cells = sum(len(one[1]) for one in ask) * sum(layout.sizes)
    kept = np.arange(BINS) < np.array(layout.sizes)[:, None]

    def made(sums: list[np.ndarray]) -> np.ndarray:
        return np.concatenate([_spread(sums[i: i + groups], layout)[:, kept] for i in range(0, len(sums), groups)])

    found = _total(blocks, lambda block: [x for one in ask for x in _histograms(block, *one)], made, cells * 24)
    out = np.zeros((len(found), len(layout.sizes), BINS, 3))
    out[:, kept] = found
    return out


def _chosen_nodes(growing: _Growing, leaves: int | None) -> list[int]:
    """Nodes that are split by what is known: all that gain, or the best ones first while there are leaves left."""
    if leaves is None:
        return [n for n, best in enumerate(growing.best) if best]
    heap, chosen = [(-growing.best[0][0], 0)] if growing.best[0] else [], []
    while heap and len(chosen) < leaves - 1:
        _, node = heapq.heappop(heap)
        chosen.append(node)
        if growing.left[node] >= 0:
            for child in (growing.left[node], growing.left[node] + 1):
                if growing.best[child]:
                    heapq.heappush(heap, (-growing.best[child][0], child))
    return chosen


def grow(blocks: RDD, growings: Sequence[_Growing], sums: Sequence[Callable], leaves: int | None = None, local: int = 0) -> None:
    """Trees from histograms, all in the same passes: level by level, or best leaf first with a bound on leaves.

    Best-first growth looks ahead: a pass counts the children of all nodes that would be split by what is known so far,
    then the choice is made again; it is final when it needs no unknown child. So a tree takes about as many passes as
    it is deep. Nodes of at most ``local`` rows are left for :func:`_finish`.
    """
    _count(blocks, [(growing, [0], s) for growing, s in zip(growings, sums)])
    while True:
        jobs = []
        for growing, s in zip(growings, sums):
            rules, fresh = growing.rules, []
            for n in _chosen_nodes(growing, leaves):
                if growing.left[n] < 0 and growing.total[n][2] > local:
                    fresh += growing.split(n)
            for child in fresh:
                rows = growing.total[child][2]
                if growing.depth[child] >= rules.depth or rows < max(rules.min_split, 2 * rules.min_rows):
                    growing.best[child] = False  # a leaf for certain
                elif rows <= local:
                    growing.best[child] = False
                    growing.open.append(child)
            unknown = [child for child in fresh if growing.best[child] is None]
            if unknown:
                jobs.append((growing, unknown, s))
        if not jobs:
            break
        _count(blocks, jobs)
        for growing, _, _ in jobs:
            growing.cells = {n: c for n, c in growing.cells.items() if growing.left[n] < 0}
    for growing in growings:
        growing.kept = {n for n in _chosen_nodes(growing, leaves) if growing.left[n] >= 0}


def grow_symmetric(blocks: RDD | list, growing: _Growing, sums: Callable) -> None:
    """All nodes of a level get the same cut, the one of largest total gain. Of two siblings the smaller one is counted."""
    rules, level, above = growing.rules, [0], {}
    for _ in range(rules.depth):
        twins = list(zip(level[::2], level[1::2]))
        small = [min(pair, key=lambda n: (growing.total[n][2], n)) for pair in twins] if above else level
        cells = dict(zip(small, _counted(blocks, [(growing.routes(), small, sums, growing.layout, growing.number)])))
        for pair in twins if above else []:
            one = pair[0] if pair[0] in cells else pair[1]
            other = above[growing.parent[one]] - cells[one]
            cells[sum(pair) - one] = np.where(other[..., 2:] > 0, other, 0.0)
        if growing.total[0] is None:
            growing.total[0] = cells[0][0].sum(0)
        found, total = np.stack([cells[n] for n in level]), np.array([growing.total[n] for n in level])[:, None, None]
        left = np.cumsum(found, axis=2)[:, :, :-1]
        right = total - left
        worth = lambda x: rules.worth(x[..., 0], x[..., 1])
        gain = (worth(left) + worth(right) - worth(total)).sum(0)
        gain = np.where(growing.columns[:, None], gain, -np.inf)
        top = gain.max()
        if not top > max(rules.min_gain, 1e-12):
            break
        feature, cut = map(int, np.unravel_index(int(np.argmax(gain >= top * (1 - TINY))), gain.shape))
        below = []
        for i, node in enumerate(level):
            growing.best[node] = (top / len(level), feature, cut, left[i, feature, cut])
            below += growing.split(node)
        level, above = below, cells
    growing.kept = {n for n, left in enumerate(growing.left) if left >= 0}


# --- nodes that fit a task ----------------------------------------------------------------------

def _grow_local(bins: np.ndarray, a: np.ndarray, b: np.ndarray, rules: Rules, number: int, heap: int, depth: int):
    """A subtree to its end, level by level over all its nodes: arrays feature, cut, left, a, b, rows, gain."""
    n_nodes, row, slot = 1, np.arange(len(a)), np.zeros(len(a), np.int64)
    heaps, start = np.array([heap]), 0
    out = {k: [] for k in ("feature", "cut", "left", "a", "b", "rows", "gain")}
    while True:
        m = len(heaps)
        total = [np.bincount(slot, x, m) for x in (a[row], b[row])]
        count = np.bincount(slot, minlength=m)
        feature, cut, left, gain = np.full(m, -1, np.int32), np.zeros(m, np.uint8), np.full(m, -1, np.int32), np.zeros(m)
        may = (count >= max(rules.min_split, 2 * rules.min_rows)) & (depth < rules.depth)
        live = np.flatnonzero(may[slot])
        if len(live):
            found = _local_cuts(bins, a, b, row[live], slot[live], total, heaps, rules, number)
            if found is not None:
                at, feature[at], cut[at], gain[at] = found[0], found[1], found[2], found[3]
                left[at] = start + m + 2 * np.arange(len(at))
        for key, x in zip(out, (feature, cut, left, *total, count, gain)):
            out[key].append(x)
        inner = left >= 0
        if not inner.any():
            return {k: np.concatenate(v) for k, v in out.items()}
        on = inner[slot]
        row, slot = row[on], slot[on]
        right = bins[feature[slot], row] > cut[slot]
        slot = left[slot] - (start + m) + right
        heaps = np.column_stack([2 * heaps[inner], 2 * heaps[inner] + 1]).ravel()
        start, depth, n_nodes = start + m, depth + 1, n_nodes + len(heaps)


def _sorted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order of small non-negative keys, and the keys in it. Sorting plain longs that end in the place takes a fraction of
    the time of a stable sort of places."""
    bits = max(1, len(key).bit_length())
    packed = (key.astype(np.int64) << bits) | np.arange(len(key))
    packed.sort()
    return packed & ((1 << bits) - 1), packed >> bits


def _local_cuts(bins, a, b, row, slot, total, heaps, rules: Rules, number: int):
    """(nodes, feature, cut, gain) of the best cuts of all nodes of a level that have one."""
    m, width = len(heaps), len(bins)
    a, b = a[row], b[row]
    worth = rules.worth(*total)
    noise = 1e-12 * np.abs(worth)
    if not rules.entropy and not rules.ridge:
        # Sums around the node's own mean say the same and do not cancel.
        mean = np.divide(total[0], total[1], out=np.zeros(m), where=total[1] > 0)
        spread = lambda x: np.bincount(slot, np.divide(x * x, b, out=np.zeros(len(b)), where=b > 0), m)
        before, a = a, a - b * mean[slot]
        total, worth = (np.bincount(slot, a, m), total[1]), np.zeros(m)
        noise = 1e-13 * spread(a) + 1e-24 * spread(before)
    allowed = np.ones((m, width), bool)
    if rules.share < width:
        allowed = np.stack([_chosen(width, rules.share, rules.seed, number, int(h)) for h in heaps])
    parts = []
    for j in range(width):
        on = slice(None) if rules.share >= width else np.flatnonzero(allowed[slot, j])
        order, key = _sorted(slot[on] * BINS + bins[j, row[on]])
        ends = np.flatnonzero((key[1:] != key[:-1]) & (key[1:] >> 8 == key[:-1] >> 8))
        if not len(ends):
            continue
        node = key[ends] >> 8
        first = np.searchsorted(key, node * BINS)
        sums = []
        for x in (a, b):
            run = np.concatenate([[0.0], np.cumsum(x[on][order])])
            sums.append(run[ends + 1] - run[first])
        n_left, n_all = ends + 1 - first, np.searchsorted(key, (node + 1) * BINS) - first
        la, lb = sums
        ra, rb = total[0][node] - la, total[1][node] - lb
        gain = rules.worth(la, lb) + rules.worth(ra, rb) - worth[node]
        fine = (n_left >= rules.min_rows) & (n_all - n_left >= rules.min_rows) & (lb >= rules.min_weight) & (rb >= rules.min_weight)
        parts.append((node[fine], gain[fine], np.full(fine.sum(), j, np.int32), (key[ends] & 255)[fine].astype(np.uint8)))
    if not parts:
        return None
    node, gain, feature, cut = (np.concatenate(x) for x in zip(*parts))
    top = np.full(m, -np.inf)
    np.maximum.at(top, node, gain)
    fine = (gain >= top[node] * (1 - TINY)) & (gain > np.maximum(rules.min_gain, noise)[node])
    at, first = np.unique(node[fine], return_index=True)
    return (at, feature[fine][first], cut[fine][first], gain[fine][first]) if len(at) else None


def _open_rows(width: int, trees: list, mean: float, bootstrap: bool, seed: int):
    """Task: the rows of each open node of each tree, packed; one row for each block, tree and node."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for record in batch.to_pylist():
                block = _read_block(_Record(record), width, 0.0)
                for number, routes, open_ in trees:
                    a, b, rows = _tree_sums(mean, bootstrap, seed, number)(block)
                    b = np.ones(len(a)) if b is None else b
                    rows = b if rows is None else rows
                    at = routes.leaf_of(block.bins)
                    keep = np.flatnonzero((rows > 0) & np.isin(at, open_))
                    keep = keep[np.argsort(at[keep], kind="stable")]
                    edges = np.flatnonzero(np.diff(at[keep], prepend=-1, append=-1))
                    packs = [keep[x:y] for x, y in zip(edges[:-1], edges[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(packs), number, np.int32)), pa.array(np.array([at[p[0]] for p in packs], np.int32)),
                         pa.array([block.bins[:, p].tobytes() for p in packs], pa.binary()), pa.array([a[p].tobytes() for p in packs], pa.binary()),
                         pa.array([b[p].tobytes() for p in packs], pa.binary())], names=["tree", "node", "bins", "a", "b"])
    return task


class _Record:
    def __init__(self, fields: dict) -> None:
        self.__dict__.update(fields)


def _tree_sums(mean: float, bootstrap: bool, seed: int, number: int) -> Callable:
    """Block to (weight * target, weight, what is above 0 where a row counts), with the weights of the bootstrap sample of a tree.
    None stands for ones."""
    def sums(block: Block):
        b = block.w * _drawn(_mixed(block.key, seed, number)) if bootstrap else block.w
        if not bootstrap and (b == 1).all():
            return block.y - mean, None, None
        return b * (block.y - mean), b, b
    return sums


def _subtree_rows(width: int, rules: Rules, where: dict):
    """One open node's packs to its subtree."""
    def task(frame):
        tree, node = int(frame["tree"].iloc[0]), int(frame["node"].iloc[0])
        bins = np.concatenate([np.frombuffer(x, np.uint8).reshape(width, -1) for x in frame["bins"]], axis=1)
        a, b = (np.concatenate([np.frombuffer(x, np.float64) for x in frame[c]]) for c in ("a", "b"))
        heap, depth = where[tree, node]
        found = _grow_local(bins, a, b, rules, tree, heap, depth)
        import pandas as pd

        kinds = {"feature": np.int16, "cut": np.uint8, "left": np.int32, "a": np.float64, "b": np.float64, "rows": np.int32, "gain": np.float64}
        return pd.DataFrame([{"tree": tree, "node": node, **{k: found[k].astype(t).tobytes() for k, t in kinds.items()}}])
    return task


def _finish(frame: DataFrame, growings: list[_Growing], rules: Rules, width: int, mean: float, bootstrap: bool) -> list[Tree]:
    """The trees with their open nodes grown to the end, each in one task; the driver puts the parts together."""
    trees = [(g.number, g.routes(), np.array(g.open)) for g in growings]
    where = {(g.number, n): (g.heap[n], g.depth[n]) for g in growings for n in g.open}
    parts = {}
    if where:
        packs = frame.mapInArrow(_open_rows(width, trees, mean, bootstrap, rules.seed), "tree int, node int, bins binary, a binary, b binary")
        tasks = min(len(where), 4 * frame.sparkSession.sparkContext.defaultParallelism)
        grown = packs.repartition(tasks, "tree", "node").groupBy("tree", "node").applyInPandas(
            _subtree_rows(width, rules, where), "tree int, node int, feature binary, cut binary, left binary, a binary, b binary, rows binary, gain binary")
        parts = {(r.tree, r.node): r for r in grown.toLocalIterator()}
    return [_stitched(g, {n: parts[g.number, n] for n in g.open if (g.number, n) in parts}, mean) for g in growings]


def _stitched(growing: _Growing, parts: dict, mean: float) -> Tree:
    sums = np.array([t if t is not None else (0.0, 0.0, 0.0) for t in growing.total], float).reshape(-1, 3)
    cols = {"feature": [np.array(growing.feature, np.int16)], "cut": [np.array(growing.cut, np.uint8)], "left": [np.array(growing.left, np.int32)],
            "a": [sums[:, 0]], "b": [sums[:, 1]], "rows": [sums[:, 2].astype(np.int32)], "gain": [np.array([x[0] if x else 0.0 for x in growing.best])]}
    size = len(growing.left)
    for node, part in parts.items():
        got = {k: np.frombuffer(part[k], v[0].dtype) for k, v in cols.items()}
        got["left"] = np.where(got["left"] >= 0, got["left"] + (size - 1), -1).astype(np.int32)  # its root takes the node's place
        for k, v in cols.items():
            v[0][node] = got[k][0]
            v.append(got[k][1:])
        size += len(got["left"]) - 1
    feature, cut, left, a, b, rows, gain = (np.concatenate(cols[k]) for k in ("feature", "cut", "left", "a", "b", "rows", "gain"))
    return Tree(feature, cut, left, mean + np.divide(a, b, out=np.zeros(len(a)), where=b > 0), gain, rows)


# --- models -------------------------------------------------------------------------------------

@dataclass
class Ensemble:
    """Trees with the cuts of their columns. ``kind``: proportion (mean of 0/1 shares), mean, logit (summed), sum, vote or median (weighted)."""

    kind: str
    cuts: list
    trees: list = field(default_factory=list)
    weights: list = field(default_factory=list)
    start: float = 0.0

    def binned(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros((len(self.cuts), 0), np.uint8)
        return np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(self.cuts)]).astype(np.uint8)

    def part(self, tree: Tree, bins: np.ndarray) -> np.ndarray:
        """What a tree says of each row, before its weight."""
        value = tree.value[tree.leaf_of(bins)]
        return (value > 0.5) * 2.0 - 1 if self.kind == "vote" else value

    def output(self, score: np.ndarray) -> np.ndarray:
        """The probability of class 1, or the predicted number."""
        return 1 / (1 + np.exp(-score)) if self.kind == "logit" else score

    def scores(self, x: np.ndarray) -> np.ndarray:
        bins = self.binned(x)
        if self.kind == "median":
            values = np.stack([self.part(t, bins) for t in self.trees], axis=1)
            order = np.argsort(values, axis=1, kind="stable")
            seen = np.cumsum(np.array(self.weights)[order], axis=1)
            pick = np.argmax(seen >= 0.5 * sum(self.weights), axis=1)
            return values[np.arange(len(values)), order[np.arange(len(values)), pick]]
        out = np.full(bins.shape[1], self.start)
        for w, t in zip(self.weights, self.trees):
            out += w * self.part(t, bins)
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction``, and ``probability`` for classifiers. One pass scores all trees; the model is one broadcast."""
        model = df.sparkSession.sparkContext.broadcast(self)

        @F.arrow_udf("double")
        def scored(x: pa.Array) -> pa.Array:
            width = len(model.value.cuts)
            return pa.array(model.value.scores(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), width)))

        df = df.withColumn("__s", scored(vector_to_array("features")))
        if self.kind in ("mean", "sum", "median"):
            return df.withColumnRenamed("__s", "prediction")
        p = F.col("__s") if self.kind == "proportion" else 1 / (1 + F.exp(-F.col("__s") / (sum(self.weights) or 1.0 if self.kind == "vote" else 1.0)))
        hit = F.col("__s") > (0.5 if self.kind == "proportion" else 0.0)
        return df.withColumns({"probability": array_to_vector(F.array(1 - p, p)), "prediction": F.when(hit, 1.0).otherwise(0.0)}).drop("__s")

    @property
    def featureImportances(self):
        """Gain by feature; in a forest each tree counts the same."""
        from pyspark.ml.linalg import Vectors

        each = [t.importance(len(self.cuts)) for t in self.trees]
        if self.kind in ("proportion", "mean"):
            each = [g / (g.sum() or 1.0) for g in each]
        return Vectors.dense(np.sum(each, axis=0) if each else np.zeros(len(self.cuts)))


def _layout(cuts: list) -> Layout:
    return Layout([len(c) + 1 for c in cuts])


def _prepared(df: DataFrame, label: str, weight: str | None, id_col: str | None):
    width = len(df.select("features").first()[0])
    cuts = find_cuts(df, width)
    id_col = id_col or ("id" if "id" in df.columns else None)
    frame = binned_blocks(df, label, weight, id_col, cuts)
    y, w = F.col(label).cast("double"), F.col(weight).cast("double") if weight else F.lit(1.0)
    one = df.agg(F.count("*").alias("n"), (F.sum(y * w) / F.sum(w)).alias("mean")).first()
    return width, cuts, frame, one.n, one["mean"]


def _state(frame: DataFrame, width: int, start: float, keyed: bool = True) -> RDD:
    """Blocks in memory. Small files are read several to a partition: the blocks are dealt out again where cores would idle."""
    parts = min(frame.sparkSession.sparkContext.defaultParallelism, frame.count())
    if frame.rdd.getNumPartitions() < parts:
        frame = frame.repartition(parts)
    return frame.rdd.mapPartitions(_reader(width, start, keyed)).persist(StorageLevel.MEMORY_AND_DISK)


def _reader(width: int, start: float, keyed: bool) -> Callable:
    return lambda rows: _larger_blocks((_read_block(row, width, start) for row in rows), keyed)


def fit_trees(df: DataFrame, label: str, kind: str, n_trees: int = 1, bootstrap: bool = False, share: str | float = "all", leaves: int | None = None,
              weight: str | None = None, id_col: str | None = None, local: int = LOCAL_ROWS, **rules) -> Ensemble:
    """A tree or a forest. ``kind`` is "proportion" for labels 0 and 1, "mean" for a number to predict.

    ``share`` is the number of features looked at in each node: "sqrt", "log2", "all" or a fraction. ``leaves`` bounds the
    leaves of a tree: it keeps what best-first growth would have grown.
    """
    width, cuts, frame, n, mean = _prepared(df, label, weight, id_col)
    sizes = {"sqrt": math.sqrt(width), "log2": math.log2(width) if width > 1 else 1, "all": width, "auto": math.sqrt(width) if kind == "proportion" else width}
    rules = Rules(share=max(1, int(sizes[share] if isinstance(share, str) else share * width)), **rules)
    shift = 0.0 if rules.entropy else mean
    layout = _layout(cuts)
    growings = [_Growing(width, rules, t, layout=layout) for t in range(n_trees)]
    if n <= local:
        for g in growings:
            g.open.append(0)
    else:
        blocks = _state(frame, width, 0.0, bootstrap)
        grow(blocks, growings, [_tree_sums(shift, bootstrap, rules.seed, t) for t in range(n_trees)], local=local)
        blocks.unpersist()
    trees = _finish(frame, growings, rules, width, shift, bootstrap)
    return Ensemble(kind, cuts, [t.pruned(leaves) if leaves else t for t in trees], [1.0 / n_trees] * n_trees)


KEEP = 50  # rounds after which the lineage of the scores is cut


class _Rounds:
    """Blocks whose scores change each round: the last two states are kept, and every ``KEEP`` rounds one is written."""

    def __init__(self, frame: DataFrame, width: int, start: float, keyed: bool = False) -> None:
        self.state, self.before, self.n = _state(frame, width, start, keyed), None, 0
        self.context = frame.sparkSession.sparkContext
        if self.context.getCheckpointDir() is None:
            self.context.setCheckpointDir(shared_folder(frame.sparkSession))

    def step(self, change: Callable) -> None:
        if self.before is not None:
            self.before.unpersist()
        self.before, self.state = self.state, self.state.map(change).persist(StorageLevel.MEMORY_AND_DISK)
        self.n += 1
        if self.n % KEEP == 0:
            self.state.checkpoint()

    def close(self) -> None:
        self.state.unpersist()
        if self.before is not None:
            self.before.unpersist()


class _HeldRounds:
    """The same inside one task, which holds all blocks."""

    def __init__(self, blocks: Iterator[Block]) -> None:
        self.state = list(blocks)

    def step(self, change: Callable) -> None:
        self.state = [change(block) for block in self.state]


def _logistic(block: Block):
    p = 1 / (1 + np.exp(-block.score))
    return block.w * (block.y - p), block.w * p * (1 - p)


def _squared(block: Block):
    return block.w * (block.y - block.score), block.w


def _round_sums(slope: Callable, rate: float, seed: int, number: int) -> Callable:
    def sums(block: Block):
        a, b = slope(block)
        if rate < 1:
            on = _mixed(block.key, seed, number) < rate
            return a * on, b * on, on
        return a, None if slope is _squared and (b == 1).all() else b, None
    return sums


def _scored(routes: Tree, value: np.ndarray, number: int):
    def change(block: Block) -> Block:
        return block.rescored(block.score + value[block.leaves(routes, number)])
    return change


def fit_boosted(df: DataFrame, label: str, kind: str, rounds: int = 100, step: float = 0.1, depth: int = 6, leaves: int | None = None,
                ridge: float = 1.0, min_weight: float = 1.0, min_rows: int = 1, min_gain: float = 0.0, rate: float = 1.0, columns: float = 1.0,
                symmetric: bool = False, first_step: float | None = None, weight: str | None = None, id_col: str | None = None, seed: int = SEED) -> Ensemble:
    """Gradient boosting with second derivatives; ``kind`` is "logit" for labels 0 and 1, "sum" for a number to predict.

    A round grows one tree on the slopes of the loss and adds ``step`` of it to the scores, which stay with the rows; of the
    first tree ``first_step``, if that is given.
    ``leaves`` grows best leaf first, ``symmetric`` one cut a level; ``rate`` and ``columns`` draw rows and features for
    each tree.
    """
    width, cuts, frame, n, mean = _prepared(df, label, weight, id_col)
    slope = _logistic if kind == "logit" else _squared
    start = math.log(min(max(mean, 1e-9), 1 - 1e-9) / (1 - min(max(mean, 1e-9), 1 - 1e-9))) if kind == "logit" else mean
    rules = Rules(depth, min_rows, 2, min_weight, ridge, min_gain, seed=seed)
    run = _boosting(_layout(cuts), slope, rules, rounds, step, leaves, rate, columns, symmetric, first_step)
    if n * width <= ROUND_CELLS:
        read = _reader(width, start, rate < 1)
        trees = frame.coalesce(1).rdd.mapPartitions(lambda rows: run(_HeldRounds(read(rows)))).collect()
    else:
        work = _Rounds(frame, width, start, rate < 1)
        trees = list(run(work))
        work.close()
    return Ensemble(kind, cuts, trees, [1.0] * len(trees), start)


def _boosting(layout: Layout, slope: Callable, rules: Rules, rounds: int, step: float, leaves: int | None, rate: float, columns: float,
              symmetric: bool, first_step: float | None) -> Callable:
    """All rounds on a state of blocks, on the driver or in a task: gives the trees one by one."""
    def run(work: _Rounds | _HeldRounds) -> Iterator[Tree]:
        width = len(layout.sizes)
        for r in range(rounds):
            growing = _Growing(width, rules, r, _chosen(width, max(1, int(columns * width)), rules.seed, r, 1), layout)
            sums = _round_sums(slope, rate, rules.seed, r)
            if symmetric:
                grow_symmetric(work.state, growing, sums)
            else:
                grow(work.state, [growing], [sums], leaves)
            part = first_step if r == 0 and first_step is not None else step
            grown = growing.tree(lambda a, b: part * np.divide(a, b + rules.ridge, out=np.zeros(len(a)), where=b + rules.ridge > 0))
            tree, new = _renumbered(grown, growing.kept)
            if len(tree.left) == 1 and rate >= 1 and columns >= 1:
                break  # nothing left to gain
            yield tree
            work.step(_scored(growing.routes(), tree.value[new], r))
    return run


def _reweighted(tree: Tree, alpha: float, scale: float):
    def change(block: Block) -> Block:
        miss = (tree.value[tree.leaf_of(block.bins)] > 0.5) != (block.y > 0.5)
        return block.rescored(block.score * np.exp(alpha * miss) * scale)
    return change


def fit_adaboost(df: DataFrame, label: str, rounds: int = 50, step: float = 1.0, depth: int = 1, weight: str | None = None,
                 id_col: str | None = None) -> Ensemble:
    """Discrete AdaBoost. The error of a round follows from the sums in the leaves, so a stump takes one pass."""
    width, cuts, frame, _, _ = _prepared(df, label, weight, id_col)
    work, out = _Rounds(frame, width, 1.0), Ensemble("vote", cuts)
    for r in range(rounds):
        growing = _Growing(width, Rules(depth), r, layout=_layout(cuts))
        grow(work.state, [growing], [lambda block: (block.w * block.score * block.y, block.w * block.score, None)])
        tree = _rebuilt(growing.tree(lambda a, b: np.divide(a, b, out=np.zeros(len(a)), where=b > 0)), growing.kept)
        ends = [n for n, left in enumerate(growing.left) if left < 0]
        sums = np.array([growing.total[n] for n in ends])
        total = float(sums[:, 1].sum())
        error = float(np.minimum(sums[:, 0], sums[:, 1] - sums[:, 0]).sum()) / total
        if error >= 0.5:
            break
        alpha = step * math.log((1 - error) / max(error, 1e-16))
        out.trees.append(tree)
        out.weights.append(alpha)
        if error <= 1e-12:
            break
        work.step(_reweighted(tree, alpha, growing.total[0][2] / total))
    work.close()
    return out


def fit_adaboost_r2(df: DataFrame, label: str, rounds: int = 50, step: float = 1.0, depth: int = 3, weight: str | None = None,
                    id_col: str | None = None) -> Ensemble:
    """AdaBoost.R2 with linear loss; row weights go to the tree directly instead of a weighted bootstrap."""
    width, cuts, frame, n, mean = _prepared(df, label, weight, id_col)
    work, out = _Rounds(frame, width, 1.0), Ensemble("median", cuts)
    for r in range(rounds):
        growing = _Growing(width, Rules(depth), r, layout=_layout(cuts))
        grow(work.state, [growing], [lambda block: (block.w * block.score * (block.y - mean), block.w * block.score, None)])
        tree = _rebuilt(growing.tree(lambda a, b: mean + np.divide(a, b, out=np.zeros(len(a)), where=b > 0)), growing.kept)

        def errors(block: Block):
            e = np.abs(tree.value[tree.leaf_of(block.bins)] - block.y)
            w = block.w * block.score
            return np.array([e.max(initial=0.0)]), np.array([float(w @ e), float(w.sum())])

        (worst,), (lost, total) = work.state.map(errors).reduce(lambda x, y: (np.maximum(x[0], y[0]), x[1] + y[1]))
        if not worst:
            out.trees.append(tree)
            out.weights.append(1.0)
            break
        loss = lost / total / worst
        if loss >= 0.5 and out.trees:
            break
        beta = loss / (1 - loss)
        out.trees.append(tree)
        out.weights.append(step * math.log(1 / beta))
        if loss >= 0.5:
            break

        def change(block: Block, tree=tree, worst=worst, beta=beta, scale=n / total) -> Block:
            e = np.abs(tree.value[tree.leaf_of(block.bins)] - block.y)
            return block.rescored(block.score * beta ** (step * (1 - e / worst)) * scale)

        work.step(change)
    work.close()
    return out
