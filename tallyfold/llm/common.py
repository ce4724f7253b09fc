"""Shared helpers: text columns as numpy arrays, rolling hashes, held-out rows."""

from __future__ import annotations

import hashlib
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
BASE_INV = pow(BASE, -1, 1 << 64)
CHUNK = 1 << 20  # bytes of text that numpy works on at a time; one longer document is one chunk


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``. A null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def arrow_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column laid end to end, and n + 1 offsets into them. Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    off = np.frombuffer(offsets, kind)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0]: off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def text_chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of whole documents, about ``limit`` bytes at a time."""
    data, off = arrow_text(column)
    start, n = 0, len(off) - 1
    while start < n:
        end = max(start + 1, int(np.searchsorted(off, off[start] + limit, "right")) - 1)
        yield start, end, data[off[start]: off[end]], off[start: end + 1] - off[start]
        start = end


def byte_table(seed: int) -> np.ndarray:
    """A random 64-bit value for each byte: the letters of a polynomial hash.

    Polynomials modulo 2^64 agree on some pairs of different words of 1,024 bytes and more, whatever the base. They number the
    features of the text classifiers; where equality decides a result, :class:`Slices` or :func:`digests` are used.
    """
    return np.random.default_rng(seed).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and for each document the index of its first word."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    gap = np.ones(n + 2, bool)
    gap[1:-1] = SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    word = ~gap[1:-1]
    starts = np.flatnonzero(word & (gap[:-2] | edge[:-1]))
    ends = np.flatnonzero(word & (gap[2:] | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, off)


class Powers:
    """Powers of the hash base and of its inverse, grown when a longer text comes."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def need(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, CHUNK + (CHUNK >> 2))
            one = np.ones(1, np.uint64)
            self.up = np.concatenate([one, np.cumprod(np.full(n, BASE, np.uint64))])
            self.down = np.concatenate([one, np.cumprod(np.full(n, BASE_INV, np.uint64))])
        return self.up, self.down


def prefix_hash(letters: np.ndarray, powers: Powers) -> np.ndarray:
    """Running sums whose differences, scaled back, are hashes of any slice: see :func:`slice_hash`."""
    up, _ = powers.need(len(letters) + 1)
    sums = np.zeros(len(letters) + 1, np.uint64)
    np.cumsum(letters * up[: len(letters)], out=sums[1:])
    return sums


def slice_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """64-bit hashes of the slices [start, end); equal slices give equal hashes wherever they lie."""
    _, down = powers.need(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xCA5A826395121157)
    x ^= x >> np.uint64(32)
    return x


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One 64-bit value from two, scrambled on both sides of the sum."""
    x = left ^ (left >> np.uint64(32))
    x *= np.uint64(0x9FB21C651E98DF25)
    x += right
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class Slices:
    """64-bit hashes of slices of a sequence; equal slices give equal hashes wherever they lie.

    Level j holds a hash of the 2^j units from each place, joined from two of the level below. Every join scrambles, so
    there is no sum or power whose identities could make different slices agree. Up to eight bytes are packed, not hashed.
    A slice is named by the first and the last block of the largest level that fits, and its length. One level is held at
    a time, so ask for short slices first.
    """

    def __init__(self, units: np.ndarray) -> None:
        self._units, self._packed = units, units.dtype == np.uint8
        self._at, self._level = 0, units.astype(np.uint64, copy=False)

    def __len__(self) -> int:
        return len(self._units)

    def level(self, j: int) -> np.ndarray:
        if j < self._at:
            self._at, self._level = 0, self._units.astype(np.uint64, copy=False)
        while self._at < j:
            half = 1 << self._at
            left, right = self._level[:-half], self._level[half:]
            self._level = left | (right << np.uint64(8 * half)) if self._packed and self._at < 3 else _join(left, right)
            self._at += 1
        return self._level

    def every(self, k: int) -> np.ndarray:
        """Hashes of the k units from each place."""
        j = k.bit_length() - 1
        blocks, n = self.level(j), max(0, len(self._units) - k + 1)
        return mix(blocks[:n] if k == 1 << j else _join(blocks[:n], blocks[k - (1 << j):][:n]))

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the slices [start, end)."""
        size = ends - starts
        level = np.frexp(size.astype(np.float64))[1] - 1  # of an empty slice -1
        out = np.zeros(len(size), np.uint64)
        for j in np.unique(level).tolist():
            if j >= 0:
                rows, blocks = np.flatnonzero(level == j), self.level(j)
                out[rows] = _join(blocks[starts[rows]], blocks[ends[rows] - (1 << j)])
        return mix(out + size.astype(np.uint64))


def joined_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All words with one space after each, and where each begins; an extra place at the end."""
    size = ends - starts
    begin = np.concatenate([[0], np.cumsum(size + 1)])
    out = np.full(begin[-1], 0x20, np.uint8)
    nth = np.repeat(np.arange(len(size)), size)
    step = np.arange(len(nth)) - np.repeat(np.cumsum(size) - size, size)
    out[begin[nth] + step] = data[starts[nth] + step]
    return out.tobytes(), begin


def digests(data: bytes, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit cryptographic digests of byte slices as two columns: what has equal digests is taken for equal."""
    view, blake = memoryview(data), hashlib.blake2b
    raw = b"".join([blake(view[a:b], digest_size=16).digest() for a, b in zip(starts.tolist(), stops.tolist())])
    both = np.frombuffer(raw, np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, in about log2(width) passes."""
    done, out = 1, values
    while done * 2 <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    if done < width:
        rest = width - done
        out = np.minimum(out[:-rest], out[rest:])
    return out


def per_worker(key: tuple, make):
    """``make()`` once per Python worker process. Task functions are unpickled anew for each task; this keeps their tables."""
    store = sys.modules.setdefault("tallyfold_per_worker", types.ModuleType("tallyfold_per_worker")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]
