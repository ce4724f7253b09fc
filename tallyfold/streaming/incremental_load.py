"""Batch-by-batch load of the star schema from a stream of cleaned loans.

Every micro-batch calls the same set-based build as a full load. Tables live in numbered versions
and a batch only reads the version before it, so a replayed batch writes the same rows again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyfold.plans.warehouse import Star, build_dimensions, build_loans

TABLES = ("states", "borrowers", "banks", "dates", "loan_profiles", "loans")


def _path(folder: str, version: int, table: str) -> str:
    return f"{folder}/v{version}/{table}"


def read_star(spark: SparkSession, folder: str, version: int) -> Star:
    """Dimensions of one version; the fact is the union of all batches up to it."""
    dims = [spark.read.parquet(_path(folder, version, t)) for t in TABLES[:-1]]
    facts = spark.read.parquet(*[_path(folder, v, "loans") for v in range(version + 1)])
    return Star(*dims, facts)


def load_batch(batch: DataFrame, version: int, folder: str) -> None:
    """Write version ``version``: grown dimensions and this batch's own fact rows."""
    spark = batch.sparkSession
    old = read_star(spark, folder, version - 1) if version else None
    star = build_dimensions(batch, old)
    star.loans = build_loans(batch, star, old.loans if old else None)
    for t in TABLES:
        getattr(star, t).write.mode("overwrite").parquet(_path(folder, version, t))


def load_stream(loans: DataFrame, folder: str, checkpoint: str):
    """Start the load of a streaming frame of loans; returns the running query."""
    return (loans.writeStream.foreachBatch(lambda df, i: load_batch(df, i, folder))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
