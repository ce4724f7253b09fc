"""Time buckets, daily profiles and calendar counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOURS = [f"{h:02d}:00" for h in range(24)]


def resample_sum(df: DataFrame, ts: str, val: str, unit: str, name: str = "total") -> DataFrame:
    """Sum per hour or minute from the first to the last bucket; empty buckets give 0."""
    sums = (df.filter(F.col(ts).isNotNull()).groupBy(F.date_trunc(unit, ts).alias("bucket"))
            .agg(F.sum(val).alias("__v")))
    ends = df.agg(F.date_trunc(unit, F.min(ts)).alias("a"), F.date_trunc(unit, F.max(ts)).alias("b"))
    days = ends.select("a", "b", F.explode(F.sequence(F.to_date("a"), F.to_date("b"))).alias("d"))
    per_day = F.sequence(F.greatest(F.col("d").cast("timestamp"), F.col("a")),
                         F.least(F.col("d").cast("timestamp") + F.expr("INTERVAL 1 DAY") - F.expr(f"INTERVAL 1 {unit}"),
                                 F.col("b")),
                         F.expr(f"INTERVAL 1 {unit}"))
    calendar = days.select(F.explode(per_day).alias("bucket"))
    return calendar.join(sums, "bucket", "left").select("bucket", F.coalesce("__v", F.lit(0.0)).alias(name))


def daily_profile(df: DataFrame, ts: str, val: str) -> DataFrame:
    """One row per date with the 24 hourly sums as columns and the weekday name."""
    hourly = resample_sum(df, ts, val, "hour")
    cells = hourly.select(F.date_format("bucket", "yyyy-MM-dd").alias("date"),
                          F.date_format("bucket", "HH:mm").alias("time"), "total")
    wide = cells.groupBy("date").pivot("time", HOURS).agg(F.first("total"))
    return wide.withColumn("day_name", F.date_format(F.to_date("date"), "EEEE"))


def daily_vectors(df: DataFrame, ts: str, val: str) -> DataFrame:
    """(date, profile): the 24 hourly sums in order; hours outside the data count as 0."""
    wide = daily_profile(df, ts, val)
    hours = [F.coalesce(F.col(f"`{h}`"), F.lit(0.0)) for h in HOURS]
    return wide.select("date", F.array(*hours).alias("profile"))


def count_by_weekday(df: DataFrame, ts: str) -> DataFrame:
    """Rows per weekday with Monday = 0 as sort order."""
    day = F.date_format(ts, "EEEE")
    return df.groupBy(day.alias("day_name"), F.weekday(ts).alias("day_order")).count().orderBy("day_order")


def count_by_hour(df: DataFrame, ts: str) -> DataFrame:
    return df.groupBy(F.hour(ts).alias("hour")).count()
