"""Report tables: forecast view, key figures, performance, data profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidegrid.functions.labels import METRIC_LIMITS, condition_labels, grade_metric
from tidegrid.functions.timeparts import age_minutes, freshness
from tidegrid.operators.aggregates import missing_total, table_profile
from tidegrid.operators.ranking import last_row, latest
from tidegrid.operators.windows import horizon, tail_n


def forecast_view(
    actual: DataFrame,
    predicted: DataFrame,
    value: str = "electricity_demand",
    keys: Sequence[str] = (),
    ts: str = "datetime",
    hours: int = 24,
) -> DataFrame:
    """The last ``hours`` actual rows and the first ``hours`` forecast rows with their band, in one table."""
    real = F.lit(None).cast("double")
    past = tail_n(actual, hours, keys, ts).select(
        *keys, ts, F.lit("actual").alias("series"), F.col(value).cast("double").alias("value"), real.alias("lower"), real.alias("upper")
    )
    ahead = horizon(predicted, hours, keys, ts).select(
        *keys,
        ts,
        F.lit("forecast").alias("series"),
        F.col("predicted").alias("value"),
        F.col("confidence_lower").alias("lower"),
        F.col("confidence_upper").alias("upper"),
    )
    return past.unionByName(ahead)


def kpi_row(
    actual: DataFrame,
    predicted: DataFrame,
    value: str = "electricity_demand",
    keys: Sequence[str] = (),
    ts: str = "datetime",
    hours: int = 24,
) -> DataFrame:
    """Current value, peak of the next ``hours`` steps, their mean and its change in percent.

    Mean and change need all ``hours`` steps, else NULL; a current value of zero or less has change 0.
    """
    now = latest(actual, value, keys, ts).select(*keys, F.col(value).alias("current_load"))
    ahead = horizon(predicted, hours, keys, ts).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"), F.max("predicted").alias("peak"), F.avg("predicted").alias("mean")
    )
    if keys:
        both = now.join(ahead, list(keys), "left")
    else:
        row = ahead.select(F.struct("__n", "peak", "mean")).scalar()
        both = now.withColumn("__a", row).select(*now.columns, "__a.*")
    full = F.col("__n") >= hours
    change = F.when(F.col("current_load") > 0, (F.col("mean") / F.col("current_load") - 1.0) * 100.0).otherwise(0.0)
    return both.select(
        *keys,
        F.coalesce("current_load", F.lit(0.0)).alias("current_load"),
        F.coalesce("peak", F.lit(0.0)).alias("peak_load"),
        F.when(full, F.col("mean")).alias("next_mean"),
        F.when(full, change).alias("change_pct"),
    )


def performance_row(metrics: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Long metric table with the grade of every graded metric."""
    graded = metrics.where(F.col("metric").isin(*METRIC_LIMITS))
    return graded.select(*keep, "metric", "value", grade_metric(F.col("metric"), F.col("value")).alias("grade"))


def key_drivers(actual: DataFrame, keys: Sequence[str] = (), ts: str = "datetime") -> DataFrame:
    """Newest conditions of each series with their labels."""
    newest = condition_labels(last_row(actual, keys, ts), ts)
    return newest.select(
        *keys, ts, "temperature", "temperature_status", "humidity", "humidity_status", "day_type", F.hour(ts).alias("hour")
    )


def prediction_freshness(predicted: DataFrame, now) -> DataFrame:
    moment = F.lit(str(now)).cast("timestamp_ntz")
    made = F.col("generated_at").cast("timestamp_ntz")
    return predicted.withColumns({"age_minutes": age_minutes(made, moment), "freshness": freshness(made, moment)})


def data_profile(df: DataFrame, ts: str = "datetime") -> DataFrame:
    """Records, date range, missing cells and their percent."""
    profile = table_profile(df, ts).select("total_rows", F.to_date("start").alias("first_day"), F.to_date("end").alias("last_day"))
    missing = missing_total(df).select(F.struct("missing", "missing_pct")).scalar()
    return profile.withColumn("__m", missing).select("total_rows", "first_day", "last_day", "__m.*")
