"""Suffix arrays by induced sorting, and common prefixes in text order, in numpy."""

from __future__ import annotations

import numpy as np

from tallyfold.llm.common import Slices



def _is_small(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one (S type); the end of the text is smaller than any byte."""
    n = len(text)
    up = np.zeros(n, np.int8)
    up[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1].astype(np.int16))
    up[-1] = -1
    nxt = np.where(up != 0, np.arange(n), n)
    nxt = np.minimum.accumulate(nxt[::-1])[::-1]  # the next place where neighbours differ decides
    return up[nxt] > 0


def _deal(where: dict[int, list[np.ndarray]], char: np.ndarray, at: np.ndarray) -> None:
    """Append the positions to the list of their character, in the order given."""
    if not len(at):
        return
    order = np.argsort(char, kind="stable")
    char, at = char[order], at[order]
    cut = [0, *((char[1:] != char[:-1]).nonzero()[0] + 1).tolist(), len(at)]
    for c, a, b in zip(char[cut[:-1]].tolist(), cut, cut[1:]):
        where.setdefault(c, []).append(at[a:b])


def _induce(text: np.ndarray, small: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """All suffixes in order, from the order of the leftmost-smaller ones: larger types left to right, then smaller ones.

    A bucket is scanned a generation at a time: its present suffixes hand their left neighbours to later buckets or, in a
    run of one character, to the next generation of the same bucket.
    """
    n = len(text)
    chars = np.bincount(text, minlength=256).nonzero()[0].tolist()
    start: dict[int, list[np.ndarray]] = {}
    _deal(start, text[seeds], seeds)
    large: dict[int, list[np.ndarray]] = {}
    if not small[n - 1]:
        large[int(text[n - 1])] = [np.array([n - 1], np.int32)]
    done_large: dict[int, np.ndarray] = {}
    none = np.zeros(0, np.int32)
    for c in chars:
        queue, k = large.get(c, []), 0
        large[c] = queue
        while k < len(queue):
            left = queue[k] - 1
            left = left[queue[k] > 0]
            left = left[~small[left]]
            _deal(large, text[left], left)  # those of this very character go to the end of this queue
            k += 1
        done_large[c] = np.concatenate(queue) if queue else none
        for seed in start.get(c, []):
            left = seed[seed > 0] - 1
            _deal(large, text[left], left)
    tiny: dict[int, list[np.ndarray]] = {}
    parts = []
    for c in reversed(chars):
        queue, k = tiny.get(c, []), 0
        tiny[c] = queue
        while k < len(queue):
            left = queue[k] - 1
            left = left[queue[k] > 0]
            left = left[small[left]]
            _deal(tiny, text[left], left)
            k += 1
        back = done_large[c][::-1]
        left = back[back > 0] - 1
        left = left[small[left]]
        _deal(tiny, text[left], left)
        parts += [np.concatenate(queue) if queue else none, back]
    return np.concatenate(parts)[::-1]


def _order_of_names(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of a string of names, by its first ``depth`` names at least: ranks of pairs, doubled."""
    n = len(names)
    rank = names.astype(np.int64) + 1
    order, width = np.argsort(rank), 1
    while width < depth and int(rank.max()) < n:
        second = np.zeros(n, np.int64)
        second[: n - width] = rank[width:] if width < n else 0
        key = rank * (n + 1) + second
        order = np.argsort(key)
        key = key[order]
        new = np.ones(n, np.int64)
        new[1:] = key[1:] != key[:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        width *= 2
    return order


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of a byte string in order of their first ``depth`` bytes at least.

    Leftmost-smaller substrings are sorted by one induction and named; the string of their names, at most half as long,
    is sorted in turn; a second induction gives all suffixes from that.
    """
    n = len(text)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    small = _is_small(text)
    lms = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(np.int32)
    if len(lms) > 1:
        first = _induce(text, small, lms)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        by_piece = first[is_lms[first]]
        number = np.zeros(n, np.int32)
        number[lms] = np.arange(len(lms), dtype=np.int32)
        nth = number[by_piece]
        stop = np.append(lms[1:].astype(np.int64) + 1, n)
        digest = Slices(text).hash(lms.astype(np.int64), stop)
        size = stop - lms
        new = np.ones(len(lms), bool)
        new[1:] = (digest[nth][1:] != digest[nth][:-1]) | (size[nth][1:] != size[nth][:-1])
        names = np.empty(len(lms), np.int64)
        names[nth] = np.cumsum(new) - 1
        # Leftmost-smaller places are at least two bytes apart.
        lms = lms[_order_of_names(names, depth // 2 + 1)] if not new.all() else by_piece
    return _induce(text, small, lms)


def permuted_common_prefixes(text: np.ndarray, at: np.ndarray, before: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix, up to ``most``, of the suffixes at ``at`` and those just before them in sorted order.

    ``at`` is in text order. All suffixes reach ``most`` bytes. Eight bytes are compared at a time, on the pairs still equal.
    """
    out = np.zeros(len(at), np.int32)
    if not len(at):
        return out
    eight = np.ndarray((len(text) - 7,), np.uint64, np.ascontiguousarray(text), strides=(1,))
    alive = np.arange(len(at))
    for step in [*range(0, most - 7, 8), *([most - 8] if most % 8 else [])]:
        x = eight[at[alive] + step] ^ eight[before[alive] + step]
        stop = x != 0
        low = x[stop] & (~x[stop] + np.uint64(1))
        out[alive[stop]] = step + (np.log2(low.astype(np.float64)).astype(np.int32) >> 3)
        alive = alive[~stop]
    out[alive] = most
    return out
