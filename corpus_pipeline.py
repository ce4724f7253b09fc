"""A corpus pipeline: five stages over documents, each written as Parquet and read again by the next.

A stage first removes the intermediate tables of the stage before it, whose result is written by then. So the rows
given to a stage must have been written, not merely planned.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable
from contextvars import ContextVar, copy_context

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm.bpe_prefix import encode_digests
from tallyfold.llm.catalog import tokenizer_path, toxicity
from tallyfold.llm.common import read
from tallyfold.llm.decontaminate import contaminated
from tallyfold.llm.exact_radix import exact_groups, squeeze
from tallyfold.llm.shingle_join import jaccard_components
from tallyfold.llm.toxic_gru import score
from tallyfold.session import drop_staged, recorded, shared_folder

NO_ID = -(1 << 63)
_LEFT: ContextVar[tuple[str, ...]] = ContextVar("left", default=())  # what the last stage of this run staged


def _tidy(stage: Callable[[SparkSession, DataFrame, str], DataFrame]):
    """The stage, with the intermediate tables of the stage before it removed. Runs in other threads are left alone."""

    @functools.wraps(stage)
    def tidied(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_staged(spark, list(_LEFT.get()))
        with recorded() as paths:
            out = stage(spark, docs, sf_dir)
        _LEFT.set(tuple(paths))
        return out

    return tidied


@_tidy
def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.7. The network learns from the labelled rows of the tables in ``sf_dir``.

    Null and empty texts have the score of a text without words and stay; rows of one id are judged each by its text.
    """
    return score(docs, toxicity(spark, sf_dir), name="toxic_score", whole_rows=True).filter("toxic_score < 0.7").drop("toxic_score")


@_tidy
def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal but for white space: the longest, then that of the smallest id.

    Null and empty texts and texts of white space alone are one group; a null id loses ties.
    """
    kept = exact_groups(docs).filter("kept").select(F.coalesce("doc_id", F.lit(NO_ID)).alias("stay_id"), "text_sha256", "n_points").distinct()
    keyed = docs.select(*docs.columns, F.coalesce("doc_id", F.lit(NO_ID)).alias("stay_id"),
                        F.sha2(squeeze(F.col("text")), 256).alias("text_sha256"), F.coalesce(F.char_length("text"), F.lit(0)).alias("n_points"))
    keys = ["stay_id", "text_sha256", "n_points"]
    return keyed.join(kept.hint("merge"), keys, "left_semi").dropDuplicates(keys).drop(*keys)


@_tidy
def dissimilar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 or more over 5-word shingles: the smallest id.

    A document without shingles is a group of its own; rows of one id stay or go together.
    """
    groups = jaccard_components(docs, k=5, percent=80)
    return _without(docs, groups.groupBy("doc_id").agg(F.max(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("stays")).filter("NOT stays"))


@_tidy
def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item (0.8 of its 5-word shingles). Null and empty texts hold none and stay; rows of one id stay or go together."""
    return _without(docs, contaminated(docs, read(spark, sf_dir, "benchmark")))


@_tidy
def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document left. Null and empty texts have no tokens."""
    return encode_digests(docs, tokenizer_path())


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    gone = gone.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("gone_id")).distinct()
    return docs.withColumn("gone_id", F.coalesce("doc_id", F.lit(NO_ID))).join(gone.hint("merge"), "gone_id", "left_anti").drop("gone_id")


STAGES = [
    ("toxicity", harmless),
    ("exact_dedup", distinct),
    ("ngram_jaccard_join", dissimilar),
    ("benchmark_decontamination", uncontaminated),
    ("bpe", encoded),
]

# The score of a trained network has no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each stage's rows are written to the shared folder and read again."""
    return copy_context().run(_run, spark, sf_dir)


def _run(spark: SparkSession, sf_dir: str) -> DataFrame:
    _LEFT.set(())
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_folder(spark)}/tallyfold/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
