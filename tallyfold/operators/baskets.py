"""Frequent itemsets and association rules over transactions."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.rowsets import dedup
from tallyfold.session import stage_table


def clean_lines(df: DataFrame, txn: str, item: str, quantity: str | None = None, price: str | None = None) -> DataFrame:
    """Lines with a transaction, an item, and positive quantity and price; each item once per transaction."""
    keep = F.col(item).isNotNull() & F.col(txn).isNotNull()
    keep = keep & (F.col(item).cast("string") != "") & (F.col(txn).cast("string") != "")
    for c in (quantity, price):
        if c:
            keep = keep & (F.col(c) > 0)
    return dedup(df.filter(keep), [txn, item])


def baskets(df: DataFrame, txn: str, item: str) -> DataFrame:
    """(txn, items): the distinct items of each transaction, the input shape of the miner."""
    pairs = df.select(txn, item).distinct()
    return pairs.groupBy(txn).agg(F.array_sort(F.collect_list(item)).alias("items"))


def mine(transactions: DataFrame, min_support: float = 0.01, min_confidence: float = 0.8):
    return FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(transactions)


def frequent_itemsets(transactions: DataFrame, min_support: float = 0.01) -> DataFrame:
    """(items, freq, support), most frequent first."""
    transactions = stage_table(transactions, "baskets")
    model, n = mine(transactions, min_support), transactions.count()
    sets = model.freqItemsets.select(F.array_sort("items").alias("items"), "freq", (F.col("freq") / F.lit(n)).alias("support"))
    return sets.orderBy(F.desc("support"), "items")


def association_rules(transactions: DataFrame, min_support: float = 0.01, min_confidence: float = 0.8) -> DataFrame:
    """(antecedent, consequent, confidence, lift, support)."""
    rules = mine(stage_table(transactions, "baskets"), min_support, min_confidence).associationRules
    return rules.withColumn("antecedent", F.array_sort("antecedent"))
