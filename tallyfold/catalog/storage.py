"""Sources and sinks: what is written and read back must be the rows of the table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.catalog.registry import Tables, query
from tallyfold.functions import scalars
from tallyfold.sources import io
from tallyfold.session import shared_folder, stage_table


def _path(t: Tables, label: str) -> str:
    return f"{shared_folder(t.spark)}/tallyfold/{label}-{uuid.uuid4().hex}"


@query("csv_round_trip", "SELECT * FROM customer")
def csv_round_trip(t: Tables) -> DataFrame:
    path = _path(t, "csv")
    t.customer.write.option("header", True).csv(path)
    return io.read_csv(t.spark, path, t.customer.schema)


@query("partitioned_round_trip", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, o_orderstatus FROM orders")
def partitioned_round_trip(t: Tables) -> DataFrame:
    path = _path(t, "parquet")
    io.write_table(t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus"), path,
                   ["o_orderstatus"], compression="none")
    return t.spark.read.parquet(path)


@query("warehouse_table_cycle", "SELECT s_suppkey, s_name, 'appended after truncate' AS step FROM supplier UNION ALL "
       "SELECT 0, 'listed', 'before drop' UNION ALL SELECT 1, 'not listed', 'after drop'")
def warehouse_table_cycle(t: Tables) -> DataFrame:
    """Create, append, truncate, append, list and drop one table; what it held and whether it was listed."""
    name = f"cycle_{uuid.uuid4().hex}"
    rows = t.supplier.select("s_suppkey", "s_name")
    io.create_table(t.spark, name, "s_suppkey BIGINT, s_name STRING")
    io.create_table(t.spark, name, "s_suppkey BIGINT, s_name STRING")
    io.append_rows(rows, name)
    io.truncate_table(t.spark, name)
    io.append_rows(rows, name)
    held = stage_table(t.spark.table(name), "cycle")
    before = name in io.list_tables(t.spark)
    io.drop_table(t.spark, name)
    after = name in io.list_tables(t.spark)
    listed = t.spark.createDataFrame(
        [(0, "listed" if before else "not listed", "before drop"), (1, "listed" if after else "not listed", "after drop")],
        "s_suppkey long, s_name string, step string")
    return held.select("s_suppkey", "s_name", F.lit("appended after truncate").alias("step")).unionAll(listed)


@query("split_bundle", "SELECT o_orderkey, o_totalprice, CASE o_orderkey % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'test' END AS split "
       "FROM orders WHERE o_orderkey % 3 < 2")
def split_bundle(t: Tables) -> DataFrame:
    """All splits saved as one table; two of them loaded by name."""
    path, rest = _path(t, "splits"), F.col("o_orderkey") % 3
    rows = t.orders.select("o_orderkey", "o_totalprice", F.when(rest == 0, "train").when(rest == 1, "val").otherwise("test").alias("split"))
    io.save_splits(rows, path)
    return io.load_splits(t.spark, path, "train").unionByName(io.load_splits(t.spark, path, "val"))


@query("importance_log", "SELECT 'run_' || (c_nationkey % 2) AS run_id, c_mktsegment AS feature, count(*)::DOUBLE AS importance FROM customer GROUP BY 1, 2")
def importance_log(t: Tables) -> DataFrame:
    """Importance rows of two runs appended one after the other."""
    path = _path(t, "importances")
    for i in (0, 1):
        own = t.customer.filter(F.col("c_nationkey") % 2 == i).groupBy(F.col("c_mktsegment").alias("feature"))
        io.append_importances(own.agg(F.count("*").cast("double").alias("importance")), path, f"run_{i}")
    return t.spark.read.parquet(path)


@query("run_log", "SELECT 'e' || (user_id % 5) AS experiment, event_id::VARCHAR AS run_id, event_type AS name, value FROM events")
def run_log(t: Tables) -> DataFrame:
    """Run rows appended in two batches."""
    path = _path(t, "runs")
    runs = t.events.select(F.concat(F.lit("e"), (F.col("user_id") % 5).cast("string")).alias("experiment"),
                           F.col("event_id").cast("string").alias("run_id"), F.col("event_type").alias("name"), "value", "event_id")
    for i in (0, 1):
        io.append_runs(runs.filter(F.col("event_id") % 2 == i).drop("event_id"), path)
    return t.spark.read.parquet(path)


@query("renamed_columns", "SELECT c_custkey AS borrower_key, c_name AS name, c_nationkey, c_acctbal AS balance, c_mktsegment AS industry FROM customer")
def renamed_columns(t: Tables) -> DataFrame:
    return scalars.rename(t.customer, {"c_custkey": "borrower_key", "c_name": "name", "c_acctbal": "balance", "c_mktsegment": "industry"})


@query("columns_by_type", "SELECT c_custkey, c_nationkey, c_acctbal, concat_ws('|', c_name, c_mktsegment) AS texts FROM customer")
def columns_by_type(t: Tables) -> DataFrame:
    """The numeric columns as they are, the text columns joined."""
    return t.customer.select(*scalars.numeric_cols(t.customer), F.concat_ws("|", *scalars.string_cols(t.customer)).alias("texts"))
