from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.operators import aggregates, joins, ranking
from tidegrid.plans import reports
from tidegrid.sources import layers, spine

T0 = datetime(2024, 1, 1)


def hours(spark, rows):
    return spark.createDataFrame([(k, T0 + timedelta(hours=h), v) for k, h, v in rows], "k string, datetime timestamp_ntz, x double")


def test_exact_percentiles_beyond_the_sketch(spark):
    """A series longer than the sketch, with one value making up a third of it."""
    rng = np.random.default_rng(5)
    big = np.concatenate([rng.normal(0, 1, 40_000), np.full(20_000, 0.25)])
    rows = [("big", float(v)) for v in big] + [("small", v) for v in (1.0, 2.0, 4.0, 8.0)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(8)
    got = {r["k"]: r for r in aggregates.exact_percentiles(df, "x", [0.025, 0.5, 0.975], ["k"]).collect()}
    for j, q in enumerate((0.025, 0.5, 0.975)):
        assert got["big"][f"p{j}"] == pytest.approx(np.quantile(big, q), abs=1e-12)
        assert got["small"][f"p{j}"] == pytest.approx(np.quantile([1, 2, 4, 8], q), abs=1e-12)
    whole = aggregates.exact_percentiles(df, "x", [0.5]).first()
    assert whole["p0"] == pytest.approx(np.median([v for _, v in rows]))


def test_stats_of_nothing_are_zero(spark):
    empty = hours(spark, []).select("x")
    assert tuple(aggregates.series_stats(empty, "x").first()) == (0.0,) * 5


@pytest.mark.parametrize("mean,direction", [(101.0, "stable"), (101.5, "up"), (98.0, "down")])
def test_trend(spark, mean, direction):
    now = spark.createDataFrame([(100.0,)], "current_value double")
    ahead = hours(spark, [("a", h, mean) for h in range(30)])
    assert aggregates.trend(now, ahead, "x").first()["direction"] == direction


def test_trend_is_neutral_without_forecast_or_current(spark):
    zero = spark.createDataFrame([(0.0,)], "current_value double")
    ahead = hours(spark, [("a", 0, 1.0)])
    assert aggregates.trend(zero, ahead, "x").first()["direction"] == "neutral"
    now = spark.createDataFrame([(1.0,)], "current_value double")
    assert aggregates.trend(now, ahead.limit(0), "x").first()["direction"] == "neutral"


def test_peak_takes_the_earliest(spark):
    df = hours(spark, [("a", 3, 9.0), ("a", 1, 9.0), ("a", 2, 1.0), ("b", 0, None)])
    got = {r["k"]: (r["peak_value"], r["peak_time"]) for r in aggregates.peak(df, "x", keys=["k"]).collect()}
    assert got["a"] == (9.0, T0 + timedelta(hours=1)) and got["b"] == (None, None)


def test_metrics_guard_zero_and_constant_actuals(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, 3.0)], "y double, p double")
    m = aggregates.forecast_metrics(df, "y", "p").first()
    assert m["mape"] is None and m["r2"] is None and m["mae"] == 2.0 and m["forecast_bias"] == 2.0


def test_overfit(spark):
    df = spark.createDataFrame([(1.0, 1.1), (1.0, 1.3), (0.0, 1.0)], "train_rmse double, val_rmse double")
    assert [r["verdict"] for r in aggregates.overfit_check(df).collect()] == ["ok", "overfitting", "undetermined"]


def test_left_joins_refuse_repeated_columns(spark):
    a = hours(spark, [("a", 0, 1.0)]).drop("k")
    with pytest.raises(ValueError):
        joins.join_all_signals(a, [a], ["datetime"])


def test_recent_hours_prefer_the_hourly_table(spark):
    daily = hours(spark, [("a", h, 1.0) for h in range(24)])
    hourly = hours(spark, [("a", h, 2.0) for h in (20, 22, 30)])
    got = layers.load_recent(hourly, daily, T0 + timedelta(hours=23), 4, ["k"]).orderBy("datetime").collect()
    assert [(r["datetime"].hour, r["x"]) for r in got] == [(19, 1.0), (20, 2.0), (21, 1.0), (22, 2.0), (23, 1.0)]


def test_run_targets():
    now = datetime(2024, 3, 1, 0, 20)
    assert spine.run_target("HOURLY", now) == {"date": datetime(2024, 2, 29).date(), "hour": "23"}
    assert spine.run_target("COMPACTION_MONTHLY", now) == {"year": 2024, "month": 2}
    assert spine.run_target("BACKFILL", now)["start"].isoformat() == "2021-10-27"


def test_kpi_needs_a_whole_horizon(spark):
    actual = hours(spark, [("a", 0, 10.0)])
    ahead = hours(spark, [("a", h, 12.0) for h in range(1, 24)]).withColumnRenamed("x", "predicted")
    row = reports.kpi_row(actual, ahead, "x", ["k"]).first()
    assert row["peak_load"] == 12.0 and row["next_mean"] is None and row["change_pct"] is None


def test_forecast_freshness(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00",), ("2023-12-31T22:00:00",), ("2023-12-31T00:00:00",)], "generated_at string")
    got = reports.prediction_freshness(df, "2024-01-01 00:30:00").collect()
    assert [r["freshness"] for r in got] == ["fresh", "stale", "old"]


def test_pages_and_thresholds(spark):
    df = hours(spark, [("a", h, float(h)) for h in range(10)])
    assert [r["x"] for r in ranking.page(df, 2, 4).collect()] == [4.0, 5.0, 6.0, 7.0]
    shares = spark.createDataFrame([("p", 3.0), ("q", 1.0), ("z", 0.0)], "feature string, importance double")
    scaled = aggregates.normalise_importance(shares)
    assert [(r["feature"], r["importance"]) for r in ranking.importance_at_least(scaled, 0.1).collect()] == [("p", 0.75), ("q", 0.25)]
    nothing = aggregates.normalise_importance(shares.withColumn("importance", F.lit(0.0)))
    assert {r["importance"] for r in nothing.collect()} == {0.0}
