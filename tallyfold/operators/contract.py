"""Data contracts: names, types, nulls, uniqueness and value checks, all failures reported together."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Field:
    """One expected column. ``checks`` maps a check name to (kind, arguments)."""

    name: str
    kind: str
    nullable: bool = False
    unique: bool = False
    in_range: tuple | None = None
    ge: float | None = None
    isin: tuple | None = None
    max_length: int | None = None

    def rules(self) -> list[tuple[str, Column]]:
        """(check, condition for a bad row). A null value fails only the null check."""
        c, out = F.col(self.name), []
        if not self.nullable:
            out.append(("not_null", c.isNull()))
        if self.in_range:
            out.append((f"in_range({self.in_range[0]}, {self.in_range[1]})", ~c.between(*self.in_range)))
        if self.ge is not None:
            out.append((f"ge({self.ge})", c < self.ge))
        if self.isin:
            out.append((f"isin{self.isin}", ~c.isin(list(self.isin))))
        if self.max_length is not None:
            out.append((f"str_length({self.max_length})", F.length(c) > self.max_length))
        return out


def validate(df: DataFrame, contract: Sequence[Field], strict: bool = True) -> DataFrame:
    """(column, check, n_failed, sample) for every failing check; empty when the contract holds.

    All value checks share one aggregate row. Uniqueness counts rows beyond the first per key.
    """
    spark, have = df.sparkSession, dict(df.dtypes)
    shape = [(f.name, "missing", 1, None) for f in contract if f.name not in have]
    shape += [(f.name, f"type({f.kind})", 1, have[f.name]) for f in contract if f.name in have and have[f.name] != f.kind]
    if strict:
        shape += [(n, "unexpected", 1, None) for n in have if n not in {f.name for f in contract}]
    present = [f for f in contract if f.name in have]
    rules = [(f.name, check, bad) for f in present for check, bad in f.rules()]
    out = spark.createDataFrame(shape, "column string, check string, n_failed long, sample string")
    if rules:
        aggs = []
        for i, (name, _, bad) in enumerate(rules):
            aggs += [F.count_if(bad).alias(f"n{i}"), F.min(F.when(bad, F.col(name).cast("string"))).alias(f"s{i}")]
        cells = [F.struct(F.lit(name).alias("column"), F.lit(check).alias("check"), F.col(f"n{i}").alias("n_failed"),
                          F.col(f"s{i}").alias("sample")) for i, (name, check, _) in enumerate(rules)]
        out = out.unionByName(df.agg(*aggs).select(F.explode(F.array(*cells)).alias("c")).select("c.*"))
    for f in present:
        if f.unique:
            copies = df.groupBy(f.name).count().filter("count > 1")
            out = out.unionByName(copies.agg(
                F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("n_failed"),
                F.min(F.col(f.name).cast("string")).alias("sample"),
            ).select(F.lit(f.name).alias("column"), F.lit("unique").alias("check"), "n_failed", "sample"))
    return out.filter("n_failed > 0")


def imputation_audit(before: DataFrame, after: DataFrame, key: str, col: str) -> DataFrame:
    """(key, filled): what the cells that were null before hold after a fill."""
    empty = before.filter(F.col(col).isNull()).select(key)
    return empty.join(after.select(key, F.col(col).alias("filled")), key, "left")
