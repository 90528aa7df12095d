"""Hourly layers derived from the ``events`` table, shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegrid.functions.timeparts import hour_key



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def fixed(col: Column) -> Column:
    """Six decimals, half up; the nudge keeps ties from falling either way with the order of summation."""
    return F.round(col + F.lit(1e-9), 6)


def _of(kind: str) -> Column:
    return F.when(F.col("event_type") == kind, F.col("value"))


def hourly(spark: SparkSession, sf_dir: str, keys=("event_type",)) -> DataFrame:
    """Hourly total, mean and count per series."""
    slots = events(spark, sf_dir).groupBy(*keys, hour_key("ts").alias("datetime"))
    return slots.agg(fixed(F.sum("value")).alias("total"), fixed(F.avg("value")).alias("mean"), F.count(F.lit(1)).alias("n"))


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather-like measures of each hour, one conditional aggregation."""
    kinds = ("view", "click", "signup", "error")
    rows = events(spark, sf_dir).where(F.col("event_type").isin(*kinds))
    return rows.groupBy(hour_key("ts").alias("datetime")).agg(
        fixed(F.avg(_of("view"))).alias("temperature"),
        fixed(F.avg(_of("click"))).alias("humidity"),
        fixed(F.avg(_of("error"))).alias("precipitation"),
        fixed(F.avg(_of("signup"))).alias("wind_speed"),
        F.count(_of("view")).cast("double").alias("cloud_cover"),
    )


def load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load-like total of each hour."""
    rows = events(spark, sf_dir).where(F.col("event_type") == "purchase")
    return rows.groupBy(hour_key("ts").alias("datetime")).agg(fixed(F.sum("value")).alias("total_load"))


def canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegrid.operators.flatten import to_canonical_columns
    from tidegrid.operators.joins import join_signals

    return to_canonical_columns(join_signals(weather(spark, sf_dir), load(spark, sf_dir)))
