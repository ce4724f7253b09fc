"""Seeded ordering of rows by a hash of their id: the same on every engine and every run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEED = 12345
HASH_SPACE = 1 << 32


def hash32(key: Column, seed: int | str = SEED) -> Column:
    """First 32 bits of ``md5(key || ':' || seed)`` as a long in [0, 2^32)."""
    text = F.concat(key.cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def hash60(key: Column, seed: int | str = SEED) -> Column:
    """First 60 bits of the same md5, for draws from more rows than 32 bits can number."""
    text = F.concat(key.cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def unit_interval(key: Column, seed: int | str = SEED) -> Column:
    """Uniform double in [0, 1) from the same hash."""
    return hash32(key, seed) / F.lit(float(HASH_SPACE))


def bucket_of(h: Column, bits: int) -> Column:
    """The leading ``bits`` of a 32-bit hash: evenly filled buckets that keep the hash order."""
    return F.shiftright(h, 32 - bits).cast("int")
