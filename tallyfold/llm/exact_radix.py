"""Exact dedup by distributed most-significant-digit radix partitioning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.session import stage_table

WHITESPACE = " \t\n\x0b\x0c\r"


def squeeze(text: Column) -> Column:
    """Text without ASCII white space; null becomes empty."""
    out = F.coalesce(text, F.lit(""))
    for char in WHITESPACE:
        out = F.replace(out, F.lit(char), F.lit(""))
    return out


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", first: int = 64,
                 growth: int = 16, widest: int = 1 << 20) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, n_points (code points of the original text).

    Texts are compared as byte strings after :func:`squeeze`. A string is read as its length followed by its bytes.
    Each round splits every open group by its next digit, ``first`` bytes at the start and ``growth`` times as many in
    each later round up to ``widest``. A group of one leaves at once; a group whose bytes are used up is a group of equal
    texts. Equality rests on all bytes; the digest is only a column of the result. Rounds carry the rest of the open
    texts alone, so the bytes moved shrink as the digits grow. Counts are combined before the shuffle, and the way back
    from groups to rows is a join that adaptive execution can split, so a group may hold any share of the rows. It is a merge
    join at every size: the table of groups follows the input and is not to be broadcast.

    The row with most code points, then the smallest id, stays. Null text counts as empty; a null id loses ties and may
    be a keep_id of its own. Rows that repeat both id and text are all marked kept. An empty table gives no rows.
    """
    body = squeeze(F.col(text_col))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.char_length(text_col), F.lit(0)).alias("n_points"),
        F.sha2(body, 256).alias("text_sha256"), F.octet_length(body).alias("size"),
        body.cast("binary").alias("rest"), F.lit(0).cast("long").alias("grp"))
    width, used, done = first, 0, []
    while True:
        keyed = rows.withColumn("digit", F.expr(f"substring(rest, 1, {width})"))
        groups = (keyed.groupBy("grp", "size", "digit").agg(F.count("*").alias("n")).filter("n > 1")
                  .select("grp", "size", "digit", F.monotonically_increasing_id().alias("next")))
        groups = stage_table(groups, "radix-groups")  # written, so the new numbers stay as they are
        used += width
        open_ = F.col("next").isNotNull() & (F.col("size") > used)
        split = stage_table(keyed.join(groups.hint("merge"), ["grp", "size", "digit"], "left").select(
            "doc_id", "n_points", "text_sha256", "size", F.col("next").alias("grp"), open_.alias("open"),
            F.when(open_, F.expr(f"substring(rest, {width + 1})")).alias("rest")), "radix-rows")
        done.append(split.filter("NOT open"))
        rows = split.filter("open").drop("open")
        if rows.isEmpty():
            break
        width = min(width * growth, widest)
    ended = [part.filter("grp IS NOT NULL").select("doc_id", "n_points", "text_sha256", F.lit(i).alias("round"), "grp")
             for i, part in enumerate(done)]
    ended = reduce(DataFrame.unionAll, ended)
    best = stage_table(ended.groupBy("round", "grp").agg(
        F.min(F.struct((-F.col("n_points")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id")).alias("best"),
        F.count("*").alias("group_size")), "radix-best")
    copies = ended.join(best.hint("merge"), ["round", "grp"]).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("n_points") == -F.col("best.less"))).alias("kept"),
        "text_sha256", "n_points")
    single = [part.filter("grp IS NULL").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
        "text_sha256", "n_points") for part in done]
    return reduce(DataFrame.unionAll, [*single, copies])
