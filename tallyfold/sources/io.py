"""Reading and writing tables, split bundles, fitted tables, importances and run logs."""

from __future__ import annotations

import io
import json
import pickle
from collections.abc import Sequence

from pyspark.ml.util import JavaMLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, header: bool = True) -> DataFrame:
    """CSV with a declared schema (no inference pass); without one every column is read as text."""
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE")
    return reader.schema(schema).csv(path) if schema else reader.csv(path)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None, mode: str = "overwrite",
                compression: str = "snappy") -> None:
    writer = df.write.mode(mode).option("compression", compression)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def save_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """All encoded splits as one table partitioned by split, so one split is read without the others."""
    write_table(df, path, [split])


def load_splits(spark: SparkSession, path: str, name: str | None = None, split: str = "split") -> DataFrame:
    rows = spark.read.parquet(path)
    return rows if name is None else rows.filter(F.col(split) == name)


def append_importances(df: DataFrame, path: str, run_id: str) -> None:
    """Importance rows of one run, appended under their run id."""
    df.select(F.lit(run_id).alias("run_id"), "feature", "importance").write.mode("append").parquet(path)


def append_runs(runs: DataFrame, path: str) -> None:
    runs.write.mode("append").parquet(path)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


class _Saver(pickle.Pickler):
    """Pickles an object; its tables and Spark models go to folders of their own, named by number."""

    def __init__(self, buffer: io.BytesIO, path: str):
        super().__init__(buffer)
        self.path, self.count = path, 0

    def persistent_id(self, obj):
        if not isinstance(obj, (DataFrame, JavaMLWritable)):
            return None
        self.count += 1
        place = f"{self.path}/part-{self.count}"
        if isinstance(obj, DataFrame):
            obj.write.mode("overwrite").parquet(place)
            return "table", self.count, obj.schema.json()
        obj.write().overwrite().save(place)
        return "model", self.count, type(obj)


class _Loader(pickle.Unpickler):
    def __init__(self, buffer: io.BytesIO, spark: SparkSession, path: str):
        super().__init__(buffer)
        self.spark, self.path = spark, path

    def persistent_load(self, pid):
        kind, number, what = pid
        place = f"{self.path}/part-{number}"
        if kind == "model":
            return what.load(place)
        return self.spark.read.schema(T.StructType.fromJson(json.loads(what))).parquet(place)


def save_fitted(spark: SparkSession, obj, path: str) -> None:
    """Save a fitted encoder, recipe or model of this library with all tables and Spark models inside it.

    Fitted tables are copied, so the saved object outlives the session and its staged tables. A folder is written whole or,
    if its last part is missing, cannot be loaded.
    """
    buffer = io.BytesIO()
    _Saver(buffer, path).dump(obj)
    spark.createDataFrame([(buffer.getvalue(),)], "state binary").coalesce(1).write.mode("overwrite").parquet(f"{path}/object")


def load_fitted(spark: SparkSession, path: str):
    """The object saved at ``path``. Load only from folders you trust: it is a pickle."""
    state = spark.read.parquet(f"{path}/object").first().state
    return _Loader(io.BytesIO(bytes(state)), spark, path).load()


# --- warehouse tables --------------------------------------------------------------------------

def create_table(spark: SparkSession, name: str, ddl: str) -> None:
    """Create an empty table unless it exists."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet OPTIONS (compression 'zstd')")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def truncate_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")


def append_rows(df: DataFrame, name: str) -> None:
    df.write.mode("append").saveAsTable(name)


def list_tables(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables() if not t.isTemporary)
