from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from tidegrid.operators import compaction
from tidegrid.plans import jobs
from tidegrid.session import scratch_path
from tidegrid.sources import layers, sinks
from tidegrid.streaming.hourly import upsert

T0 = datetime(2024, 2, 1)


def rows(spark, days, hours=range(24), value=1.0):
    data = [("a", T0 + timedelta(days=d, hours=h), value) for d in days for h in hours]
    return spark.createDataFrame(data, "k string, datetime timestamp_ntz, x double")


def test_compaction_is_idempotent_and_loses_nothing(spark):
    root = scratch_path(spark, "layer")
    for h in range(4):
        sinks.write_layer(rows(spark, range(3), [h]), root)
    sinks.write_layer(rows(spark, [1], [0]), root)  # a repeated hour
    first = compaction.compact_day(spark, root, "2024-02-02", ["k"]).collect()
    assert [(r["status"], r["files"]) for r in first] == [("success", 5)]
    compaction.compact_day(spark, root, keys=["k"])
    again = compaction.compact_day(spark, root, keys=["k"]).collect()
    assert {(r["status"], r["files"], r["rows"]) for r in again} == {("already_compacted", 1, 4)}
    assert layers.read_layer(spark, root).count() == 12
    assert compaction.compact_day(spark, root + "-none").first()["status"] == "no_files"


def test_month_needs_all_days_and_to_be_over(spark):
    daily, monthly = scratch_path(spark, "daily"), scratch_path(spark, "monthly")
    sinks.write_layer(rows(spark, range(29), [0, 1]), daily)  # February 2024
    sinks.write_layer(rows(spark, range(29, 35), [0]), daily)  # some of March
    early = compaction.compact_month(spark, daily, monthly, "2024-02-29").collect()
    assert {r["status"] for r in early} == {"incomplete"}
    late = {r["month"]: r["status"] for r in compaction.compact_month(spark, daily, monthly, "2024-04-02", ["k"]).collect()}
    assert late == {2: "success", 3: "incomplete_data"}
    assert layers.read_layer(spark, monthly).count() == 58
    assert layers.read_layer(spark, monthly).select("month").distinct().collect()[0][0] == "02"


def test_hourly_rows_go_only_when_covered(spark):
    hourly, daily = scratch_path(spark, "hourly"), scratch_path(spark, "daily")
    sinks.write_layer(rows(spark, [0, 1], [5, 6]), hourly)
    sinks.write_layer(rows(spark, [0], [5, 6]).union(rows(spark, [1], [5])), daily)
    got = {r["day"]: r["retired"] for r in compaction.retire_hourly(spark, hourly, daily, ["k"]).collect()}
    assert got == {"01": True, "02": False}
    assert layers.read_layer(spark, hourly).count() == 2


def test_upsert_replaces_touched_hours_only(spark):
    out = scratch_path(spark, "gold")
    upsert(rows(spark, [0, 1]), out, ["k"])
    late = rows(spark, [1], [3], 9.0)
    for _ in range(2):  # repeating a batch changes nothing
        upsert(late, out, ["k"])
        got = {r["datetime"]: r["x"] for r in layers.read_layer(spark, out).collect()}
        assert len(got) == 48 and got[T0 + timedelta(days=1, hours=3)] == 9.0
        assert sum(v == 9.0 for v in got.values()) == 1


def test_partition_span_prunes(spark):
    root = scratch_path(spark, "layer")
    sinks.write_layer(rows(spark, range(5)), root)
    df = layers.load_recent(layers.read_layer(spark, root), None, T0 + timedelta(days=2), 3, ["k"])
    assert df.count() == 4
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_prediction_copies(spark):
    root = scratch_path(spark, "predictions")
    made = spark.createDataFrame([("2024-01-01 00:00:00", 1.5)], "prediction_for string, predicted_value double")
    sinks.write_prediction(made, root, "2024-01-01")
    for place in ("latest", "date=2024-01-01"):
        row = layers.read_predictions(spark, f"{root}/{place}").first()
        assert (row["datetime"], row["predicted"]) == (datetime(2024, 1, 1), 1.5)


def test_every_day_compacted_alone_equals_the_full_run(spark):
    """Two series with outages, nulls and impossible values: the edge index finds what imputation needs at any distance."""
    rng = np.random.default_rng(11)
    weather, load = [], []
    for key in "ab":
        for d in [*range(6), *range(45, 52)]:
            for h in range(0, 24, 3):
                t = datetime(2024, 1, 1) + timedelta(days=d, hours=h)
                gone = key == "a" and d in (3, 4, 5, 46) or rng.random() < 0.2
                temperature = None if key == "b" and d < 4 else float(rng.choice([20.0, 99.0, -40.0], p=[0.8, 0.1, 0.1]) + rng.integers(0, 5))
                weather.append((key, t, temperature, None if rng.random() < 0.9 else 50.0))
                load.append((key, t, None if gone else float(rng.choice([100, -5], p=[0.85, 0.15]) + rng.integers(0, 9))))
    root = scratch_path(spark, "lake")
    weather = spark.createDataFrame(weather, "zone string, datetime timestamp_ntz, temperature double, humidity double")
    for c in ("wind_speed", "precipitation", "cloud_cover"):
        weather = weather.withColumn(c, F.lit(None).cast("double"))
    sinks.write_layer(weather, f"{root}/silver/weather")
    sinks.write_layer(spark.createDataFrame(load, "zone string, datetime timestamp_ntz, total_load double"), f"{root}/silver/electricity")
    jobs.silver_to_gold(spark, f"{root}/silver", f"{root}/full", ["zone"])
    full = layers.read_layer(spark, f"{root}/full")
    sinks.write_layer(full.drop(*sinks.LEVELS["day"]), f"{root}/hourly")
    rows = lambda df: sorted(map(repr, df.select("zone", "datetime", "electricity_demand", "temperature", "humidity").collect()))
    for d in (0, 3, 5, 45, 46, 51):
        on = (datetime(2024, 1, 1) + timedelta(days=d)).date()
        jobs.daily_compaction(spark, f"{root}/silver", f"{root}/daily", f"{root}/hourly", on, ["zone"])
        own = F.to_date("datetime") == F.lit(str(on)).cast("date")
        assert rows(layers.read_layer(spark, f"{root}/daily").where(own)) == rows(full.where(own)), on
