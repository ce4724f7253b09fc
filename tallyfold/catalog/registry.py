"""Named queries over the test tables, each with the SQL that must give the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyfold.sources.io import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of one folder as attributes, read on use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Tables`; ``sql`` is its twin for another engine."""

    def add(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def h32(key: str, seed: str = "12345") -> str:
    """SQL text of the seeded row hash."""
    return f"('0x' || substr(md5(({key})::VARCHAR || ':{seed}'), 1, 8))::BIGINT"


def h60(key: str, seed: str = "12345") -> str:
    """SQL text of its longer form."""
    return f"('0x' || substr(md5(({key})::VARCHAR || ':{seed}'), 1, 15))::BIGINT"


# Line number of a lineitem row, in SQL both engines read. The pair (order, line) repeats in the test tables, so the price
# in cents (below 10^9) tells such lines apart; it stays in the long range up to a billion orders.
LINE_ID = "((l_orderkey * 8 + l_linenumber) * 1000000000 + CAST(ROUND(l_extendedprice * 100) AS BIGINT))"
