"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.ordered import rank_by, running_totals
from tallyfold.session import stage_table

WORD = r"[^\x20\x09-\x0D]+"


def shuffle_key(doc_id: Column, seed: str = "mix") -> Column:
    """The place of a document in its source's shuffled order: the same in every run and every engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def water_targets(sources: DataFrame, weights: Sequence[int], repeats: int, budget: int) -> DataFrame:
    """sources (source, source_size, ...) with ``nth``, ``weight`` and ``target``.

    Sources by code point, null last, take the weights in turn. A target is the source's share of the budget by weight,
    at most ``repeats`` times its size; what the full ones leave is shared again by weight until none is above. That is
    one water level for all: target = least(level * weight, cap). Each round of the search for the level is one
    aggregate over the table of sources; the driver sees two numbers.
    """
    turn = F.array(*[F.lit(int(w)) for w in weights])
    ranked = rank_by(sources.withColumn("unnamed", F.col("source").isNull()), ["unnamed", "source"], name="nth").drop("unnamed")
    ranked = stage_table(ranked.withColumn("weight", F.get(turn, ((F.col("nth") - 1) % len(weights)).cast("int")))
                         .withColumn("cap", F.col("source_size") * repeats), "sources")
    level = None
    while True:
        full = F.lit(False) if level is None else F.col("weight") * F.lit(level) > F.col("cap")
        caps, free = ranked.agg(F.sum(F.when(full, F.col("cap")).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        found = float(budget - caps) / free if free else level or 0.0
        if found == level:
            return ranked.withColumn("target", F.least(F.col("weight") * F.lit(level), F.col("cap").cast("double"))).drop("cap")
        level = found


def _with_source(rows: DataFrame, side: DataFrame) -> DataFrame:
    """Columns of the row's source added. ``side`` is a written table, so its size decides whether it is broadcast, and a
    hot source can be split otherwise."""
    side = side.withColumnRenamed("source", "of_source")
    return rows.join(side, rows["source"].eqNullSafe(side["of_source"])).drop("of_source")


def fair_queue(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), repeats: int = 3, share: float = 1.0, seed: str = "mix",
               id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, mark, size, source_size, weight, target, copies, taken for every row.

    The budget is ``share`` of all words. Each source is a queue of its documents in shuffled order, run through up to
    ``repeats`` times. A document leaves its queue at the virtual time (words of the source up to and with it) / target;
    all queues are merged by one global range sort on that time, and the merged queue is cut before the first document
    that would pass the budget. ``copies`` counts how often a document comes before the cut; ``taken`` is copies * size.

    * A running total within a source works on range chunks, so a source may hold any share of the rows, as does the
      running total over the merged queue.
    * By the time 1 + max(largest document / target) every queue has sent its target, so later entries, which the cut
      can never reach, are left out of the sort.
    * In its queue a document is known by the running total itself, and a source's part of the merged queue is a prefix
      of its own, so what returns from the sort is one number a source.

    Size counts words ``[^\\x20\\x09-\\x0D]+``; null and empty texts have size 0 and are never taken. Null is a source of
    its own and comes last. Rows of one id, source and size are interchangeable; ``mark``, a hash of the text, tells
    different texts apart. A source of empty texts has target 0. An empty table gives no rows; other columns are not read.
    """
    rows = stage_table(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.xxhash64(F.col(text_col)).alias("mark"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        shuffle_key(F.col(id_col), seed).alias("place")), "sizes")
    queues = running_totals(rows, ["place", "doc_id", "size", "mark"], {"done": "size"}, ["source"]).drop("place", "total_done")
    queues = stage_table(queues, "queues")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.max("size").alias("largest"))
    budget = int(share * (rows.agg(F.sum("size")).first()[0] or 0))
    sources = stage_table(water_targets(sources, weights, repeats, budget), "targets")
    horizon = sources.filter("target > 0").agg(F.max(1 + F.col("largest") / F.col("target"))).first()[0] or 1.0

    timed = _with_source(queues.filter("size > 0"), sources.select("source", "source_size", "target", "nth")).filter("target > 0")
    position = F.explode(F.transform(F.sequence(F.lit(0), F.lit(repeats - 1)), lambda turn: turn * F.col("source_size") + F.col("done")))
    entries = timed.select("source", "nth", "size", "target", position.alias("position")) \
        .withColumn("finish", F.col("position") / F.col("target")).filter(F.col("finish") <= horizon * (1 + 1e-9)) \
        .select("finish", "nth", "position", "size", "source")
    merged = running_totals(entries, ["finish", "nth", "position"], {"spent": "size"})
    cut = stage_table(merged.filter(F.col("spent") <= budget).groupBy("source").agg(F.max("position").alias("reached")), "cut")

    of_source = sources.join(cut.withColumnRenamed("source", "of_source"), F.col("source").eqNullSafe(F.col("of_source")), "left")
    of_source = stage_table(of_source.select("source", "source_size", "weight", "target", F.coalesce("reached", F.lit(0)).alias("reached")), "reached")
    turns = F.array(*[(F.lit(turn) * F.col("source_size") + F.col("done") <= F.col("reached")).cast("int") for turn in range(repeats)])
    copies = F.when(F.col("size") > 0, F.aggregate(turns, F.lit(0), lambda a, b: a + b)).otherwise(0)
    return _with_source(queues, of_source).withColumn("copies", copies).select(
        "doc_id", "source", "mark", "size", "source_size", "weight", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), repeats: int = 3, share: float = 1.0, seed: str = "mix",
                    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as :func:`fair_queue` takes it, with all their columns.

    Of rows that repeat id, source and text one stands for all, as often as they are taken together.
    """
    plan = fair_queue(docs, weights, repeats, share, seed, id_col, text_col, source_col)
    plan = plan.groupBy("doc_id", "source", "mark").agg(F.sum("copies").cast("int").alias("__copies")).filter("__copies > 0")
    plan = stage_table(plan.select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("mark").alias("__mark"), "__copies"), "plan")
    keyed = docs.withColumn("__of", F.xxhash64(F.col(text_col)))
    on = keyed[id_col].eqNullSafe(plan["__id"]) & keyed[source_col].eqNullSafe(plan["__source"]) & (keyed["__of"] == plan["__mark"])
    kept = keyed.join(plan.hint("merge"), on).dropDuplicates(["__id", "__source", "__mark"])
    return kept.withColumn("__turn", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)
