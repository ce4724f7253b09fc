"""Retail lines to baskets, itemsets and rules."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyfold.functions.scalars import rename
from tallyfold.operators.baskets import association_rules, baskets, clean_lines, frequent_itemsets
from tallyfold.operators.rowsets import dedup
from tallyfold.session import stage_table

# Column names of the retail lines.
RENAMES = {"InvoiceNo": "invoice_no", "StockCode": "stock_code", "Description": "description",
           "Quantity": "quantity", "InvoiceDate": "invoice_date", "UnitPrice": "unit_price",
           "CustomerID": "customer_id", "Country": "country"}


def retail_baskets(lines: DataFrame) -> DataFrame:
    kept = clean_lines(dedup(rename(lines, RENAMES)), "invoice_no", "description", "quantity", "unit_price")
    return baskets(kept, "invoice_no", "description")


def mine_retail(lines: DataFrame, min_support: float = 0.01, min_confidence: float = 0.8) -> tuple[DataFrame, DataFrame]:
    items = stage_table(retail_baskets(lines), "baskets")
    return frequent_itemsets(items, min_support), association_rules(items, min_support, min_confidence)
