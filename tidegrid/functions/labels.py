"""Condition labels and metric grades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidegrid.functions.timeparts import is_weekend

# Fixed thresholds.
TEMPERATURE_HIGH, TEMPERATURE_NORMAL = 32.0, 25.0
HUMIDITY_HIGH, HUMIDITY_NORMAL = 80.0, 60.0
METRIC_LIMITS = {"mape": (5.0, 10.0), "rmse": (50.0, 100.0), "r2": (0.85, 0.70)}
HIGHER_IS_BETTER = ("r2",)
LOWER_IS_BETTER = ("rmse", "mae", "mape")
RAIN_HUMIDITY = 80.0


def level(col: str, high: float, normal: float) -> Column:
    value = F.col(col)
    return F.when(value > high, "High").when(value > normal, "Normal").when(value.isNotNull(), "Low")


def condition_labels(df: DataFrame, ts: str = "datetime") -> DataFrame:
    return df.withColumns(
        {
            "temperature_status": level("temperature", TEMPERATURE_HIGH, TEMPERATURE_NORMAL),
            "humidity_status": level("humidity", HUMIDITY_HIGH, HUMIDITY_NORMAL),
            "day_type": F.when(is_weekend(ts) == 1, "Weekend").otherwise("Weekday"),
        }
    )


def grade_metric(name: Column, value: Column) -> Column:
    """Good, OK or Poor; NULL for a metric without thresholds."""
    name = F.lower(name)
    grade = F.when(value.isNull(), None)
    for metric, (good, ok) in METRIC_LIMITS.items():
        better = (lambda v, t: v >= t) if metric in HIGHER_IS_BETTER else (lambda v, t: v <= t)
        for limit, label in ((good, "Good"), (ok, "OK")):
            grade = grade.when((name == metric) & better(value, limit), label)
        grade = grade.when(name == metric, "Poor")
    return grade


def improvement(metric: str, old: Column, new: Column) -> Column:
    """Percent by which ``new`` improves on ``old``; 0 for a metric without a direction."""
    if metric in LOWER_IS_BETTER:
        return F.try_divide(old - new, old) * 100.0
    if metric in HIGHER_IS_BETTER:
        return F.try_divide(new - old, F.abs(old)) * 100.0
    return F.lit(0.0)


def interactions(
    df: DataFrame,
    pairs=(("temperature", "hour_sin"), ("temperature", "is_weekend"), ("humidity", "temperature")),
) -> DataFrame:
    """``a_x_b`` for every pair of which both columns exist."""
    have = [(a, b) for a, b in pairs if a in df.columns and b in df.columns]
    return df.withColumns({f"{a}_x_{b}": F.col(a) * F.col(b) for a, b in have})


def extended_features(df: DataFrame, ts: str = "datetime", holidays: DataFrame | None = None) -> DataFrame:
    """Optional extras: quarter, year, heat_index, wind_chill, rain_indicator and, with a date table, is_holiday.

    The holiday table (one ``date`` per row) joins on the day; whether it is broadcast is left to its measured size.
    """
    t = F.col(ts)
    rain = (F.col("precipitation") > 0) & (F.col("humidity") > RAIN_HUMIDITY)
    out = df.withColumns(
        {
            "quarter": F.quarter(t),
            "year": F.year(t),
            "heat_index": F.col("temperature") * F.col("humidity"),
            "wind_chill": F.col("temperature") - 0.5 * F.col("wind_speed"),
            "rain_indicator": F.coalesce(rain.cast("int"), F.lit(0)),
        }
    )
    if holidays is None:
        return out
    days = holidays.select(F.col("date").alias("__day"), F.lit(1).alias("is_holiday")).distinct()
    joined = out.withColumn("__day", F.to_date(t)).join(days, "__day", "left").drop("__day")
    return joined.withColumn("is_holiday", F.coalesce("is_holiday", F.lit(0)))
