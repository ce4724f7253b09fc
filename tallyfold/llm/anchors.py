"""Runs of equal-length windows that share a minimizer: how long repeats are found without moving every window."""

from __future__ import annotations

import numpy as np

from tallyfold.llm.common import Slices, sliding_min

PLACE = np.uint64((1 << 31) - 1)  # a text in Spark has fewer bytes than this


def window_runs(slices: Slices, off: np.ndarray, window: int, k: int):
    """For a chunk of documents: anchor hash, first window, document and number of windows of each run.

    ``slices`` holds the units (bytes or words), ``off`` the first unit of each document. The anchor of a window is the
    smallest hash of the k units long pieces in it, the leftmost if several are equal in their upper half; so equal windows
    have equal anchors at equal places. A run is a stretch of neighbouring windows with one anchor. Every window inside
    one document is in exactly one run.
    """
    n = len(slices)
    none = np.zeros(0, np.int64)
    if n < window:
        return none.astype(np.uint64), none, none, none
    pieces = slices.every(k)
    least = sliding_min((pieces & ~PLACE) | np.arange(len(pieces), dtype=np.uint64), window - k + 1)
    valid = np.zeros(len(least) + 2, bool)
    valid[1:-1] = True
    for end, begin in zip(off[1:].tolist(), off[:-1].tolist()):
        valid[max(begin, end - window + 1) + 1: end + 1] = False
    valid = valid[: len(least) + 2]
    valid[-1] = False
    inside = valid[1:-1]
    new = np.ones(len(least), bool)
    new[1:] = least[1:] != least[:-1]
    first = np.flatnonzero(inside & (new | ~valid[:-2]))
    place = (least[first] & PLACE).astype(np.int64)
    last = np.flatnonzero(inside & (np.append(new[1:], True) | ~valid[2:]))
    return pieces[place], first, np.searchsorted(off, first, "right") - 1, last - first + 1
