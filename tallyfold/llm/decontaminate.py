"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.session import stage_table

NO_ID = -(1 << 63)
GAP = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """Lower-cased words; null has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), GAP), lambda w: w != "")


def _grams(words: str, width: int, one) -> Column:
    """``one`` of the ``width`` words from each place; an empty array for shorter texts."""
    last = F.size(words) - width
    places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: one(*[F.get(F.col(words), i + j) for j in range(width)]))


def _hashes(words: str, width: int) -> Column:
    return _grams(words, width, lambda *w: F.xxhash64(F.lit(width), *w))


def _texts(words: str, width: int) -> Column:
    return _grams(words, width, lambda *w: F.concat_ws(" ", *w))


def contaminated(docs: DataFrame, items: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id",
                 text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, n_item_shingles, n_shared): pairs in which the document holds ``percent`` of the item's shingles.

    Shingles are ``k`` lower-cased words; an item of fewer words is one shingle of its own width. Items are partitioned by
    that width and by their size: an item of q distinct shingles keeps the q - ceil(q * percent / 100) + 1 smallest of their
    hashes, its MinHash sketch. A document that holds the asked share of an item must hold one of these, whatever its own
    length, so nothing is lost; a signature of a whole long document would say nothing about a short item in it. Documents
    look up only their hashes within the range of the sketches of one width. Candidate pairs are verified on the words
    themselves.

    Only built-in functions run here. The sketches follow the items, not the documents; the optimizer sends them to the
    documents if their measured size is below its limit and shuffles otherwise.

    Null and empty texts hold nothing and empty items are in no document. Null ids are kept as null. Rows that repeat an
    id and a text give each pair once. Empty tables give no rows; other columns are not read.
    """
    source = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.xxhash64(text_col).alias("mark"),
                         F.col(text_col).alias("text"))
    tests = items.select(F.col(item_id).alias("item_id"), words_of(F.col(item_text)).alias("item_words")).filter("size(item_words) > 0") \
        .withColumn("width", F.least(F.size("item_words"), F.lit(k)))
    wide = None
    for width in range(1, k + 1):
        part = tests.filter(F.col("width") == width).select(
            "item_id", "width", _hashes("item_words", width).alias("hashes"), F.array_distinct(_texts("item_words", width)).alias("shingles"))
        wide = part if wide is None else wide.unionAll(part)
    tests = stage_table(wide.select("*", F.xxhash64("shingles").alias("item_mark")), "items")
    sorted_hashes = F.array_sort(F.array_distinct("hashes"))
    q = F.size("shingles")
    kept = q - F.ceil(q * percent / 100).cast("int") + 1
    sketch = stage_table(tests.select("item_id", "item_mark", "width", F.explode(F.slice(sorted_hashes, F.lit(1), kept)).alias("hash"))
                         .distinct(), "sketches")
    widths = sketch.groupBy("width").agg(F.min("hash").alias("low"), F.max("hash").alias("high")).collect()  # at most k rows
    if not widths:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, n_item_shingles int, n_shared int")
    words = source.select("doc_id", "mark", words_of(F.col("text")).alias("words"))
    found = []
    for r in widths:
        hashes = words.select("doc_id", "mark", F.explode(_hashes("words", r["width"])).alias("hash")) \
            .filter(F.col("hash").between(r["low"], r["high"]))
        own = sketch.filter(F.col("width") == r["width"]).select("hash", "item_id", "item_mark")
        found.append(hashes.join(own, "hash").select("doc_id", "mark", "item_id", "item_mark"))
    pairs = stage_table(reduce(DataFrame.unionAll, found).distinct(), "candidates")
    texts = source.join(pairs.select("doc_id", "mark").distinct().hint("merge"), ["doc_id", "mark"]).dropDuplicates(["doc_id", "mark"]) \
        .select("doc_id", "mark", words_of(F.col("text")).alias("words"))
    checked = []
    for r in widths:
        whole = texts.select("doc_id", "mark", F.array_distinct(_texts("words", r["width"])).alias("held"))
        own = tests.filter(F.col("width") == r["width"]).select("item_id", "item_mark", "shingles")
        checked.append(pairs.join(own, (pairs["item_id"].eqNullSafe(own["item_id"])) & (pairs["item_mark"] == own["item_mark"]))
                       .select(pairs["doc_id"], "mark", pairs["item_id"], "shingles").join(whole, ["doc_id", "mark"])
                       .select("doc_id", "item_id", F.size("shingles").alias("n_item_shingles"),
                               F.size(F.array_intersect("shingles", "held")).alias("n_shared")))
    return reduce(DataFrame.unionAll, checked).filter(100 * F.col("n_shared") >= percent * F.col("n_item_shingles")).distinct() \
        .withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))
