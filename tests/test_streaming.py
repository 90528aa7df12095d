from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from tidegrid.models import forecast as fc
from tidegrid.models import training
from tidegrid.models.scoring import scorer
from tidegrid.operators.features import FeatureConfig, build_features
from tidegrid.operators.windows import lag_features, rolling_features
from tidegrid.session import scratch_path
from tidegrid.streaming import features as stateful
from tidegrid.streaming import hourly as st

T0 = datetime(2024, 1, 1)


def test_streamed_features_equal_batch(spark):
    """Two keys, hours arriving over several micro-batches, state trimmed to the look-back."""
    rng = np.random.default_rng(3)
    rows = [(k, T0 + timedelta(hours=h), float(rng.integers(0, 100))) for k in "ab" for h in range(60)]
    df = spark.createDataFrame(rows, "k string, datetime timestamp_ntz, x double")
    flat = scratch_path(spark, "arrivals")
    for part in range(3):
        lo, hi = T0 + timedelta(hours=20 * part), T0 + timedelta(hours=20 * part + 19)
        df.where(df.datetime.between(lo, hi)).coalesce(1).write.mode("append").parquet(flat)
    arrivals = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(flat)
    out = scratch_path(spark, "sink")
    wide = stateful.stream_features(arrivals, "x", ["k"], lags=(1, 24), windows=(3,))
    st.write_stream(wide, out, scratch_path(spark, "checkpoint")).awaitTermination()
    got = spark.read.parquet(out).orderBy("k", "datetime").toPandas()
    batch = rolling_features(lag_features(df, ["x"], (1, 24), ["k"]).select("k", "datetime", "x", "x_lag_1", "x_lag_24"), ["x"], [3], ["k"])
    want = batch.orderBy("k", "datetime").toPandas()[list(got.columns)]
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_second_run_reads_only_new_files(spark):
    flat, out, kept = (scratch_path(spark, n) for n in ("in", "out", "checkpoint"))
    schema = "k string, datetime timestamp_ntz, x double"
    for part in range(2):
        spark.createDataFrame([("a", T0 + timedelta(hours=part), float(part))], schema).write.mode("append").parquet(flat)
        arrivals = spark.readStream.schema(schema).parquet(flat)
        st.write_stream(arrivals, out, kept).awaitTermination()
        assert spark.read.parquet(out).count() == part + 1
    assert sorted(r["x"] for r in spark.read.parquet(out).collect()) == pytest.approx([0.0, 1.0])


def arrive(spark, frames):
    """A stream that brings one frame in each micro-batch."""
    flat = scratch_path(spark, "arrivals")
    for frame in frames:
        frame.coalesce(1).write.mode("append").parquet(flat)
    return spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(flat)


def hours(spark, values, key="a"):
    """Rows of one series from (hour, value) pairs."""
    return spark.createDataFrame([(key, T0 + timedelta(hours=h), v) for h, v in values], "k string, datetime timestamp_ntz, x double")


def test_a_late_and_a_corrected_hour_revise_the_hours_after_them(spark):
    rng = np.random.default_rng(5)
    value = {h: float(rng.integers(0, 50)) for h in range(80)}
    first = [(h, v) for h, v in value.items() if h < 60 and h != 30]
    late = {**value, 40: 99.0}
    steps = [first, [(30, value[30]), (60, value[60])], [(40, 99.0)], [(h, value[h]) for h in range(61, 80)]]
    out = scratch_path(spark, "out")
    made = stateful.stream_features(arrive(spark, [hours(spark, s) for s in steps]), "x", ["k"], lags=(1, 24), windows=(3, 6), revise=40)
    st.stream_upsert(made, out, scratch_path(spark, "checkpoint"), ["k"]).awaitTermination()
    got = spark.read.parquet(out).select(*made.columns).orderBy("datetime").toPandas()
    df = hours(spark, sorted(late.items()))
    batch = rolling_features(lag_features(df, ["x"], (1, 24), ["k"], by="time"), ["x"], [3, 6], ["k"], by="time")
    pd.testing.assert_frame_equal(got, batch.select(*made.columns).orderBy("datetime").toPandas(), check_dtype=False)


def test_hours_beyond_the_kept_look_back_give_nothing(spark):
    steps = [[(h, 1.0) for h in range(100)], [(10, 5.0)], [(95, 7.0)]]
    out = scratch_path(spark, "sink")
    made = stateful.stream_features(arrive(spark, [hours(spark, s) for s in steps]), "x", ["k"], lags=(2,), windows=(3,), revise=10)
    st.write_stream(made, out, scratch_path(spark, "checkpoint")).awaitTermination()
    rows = [(r["datetime"], r["x"]) for r in spark.read.parquet(out).collect()]
    assert len(rows) == 100 + 3 and (T0 + timedelta(hours=10), 5.0) not in rows
    assert (T0 + timedelta(hours=95), 7.0) in rows


@pytest.mark.parametrize("kind", ["gbt", "linear"])
def test_streamed_forecasts_equal_the_batch_model(spark, kind):
    rng = np.random.default_rng(2)
    rows = [(k, T0 + timedelta(hours=h), float(rng.normal(100, 20)), float(rng.normal(20, 5))) for k in "ab" for h in range(150)]
    df = spark.createDataFrame(rows, "k string, datetime timestamp_ntz, electricity_demand double, temperature double")
    config = FeatureConfig(lags=(1, 24), windows=(3,), by="time")
    view, names = fc.training_rows(df, config, keys=["k"])
    fitted = training.fit_model(view.persist(), names, {"maxIter": 6, "maxDepth": 4} if kind == "gbt" else None, kind)
    parts = [df.where(df.datetime.between(T0 + timedelta(hours=50 * n), T0 + timedelta(hours=50 * n + 49))) for n in range(3)]
    out = scratch_path(spark, "sink")
    made = stateful.stream_forecast(arrive(spark, parts), scorer(fitted), ["electricity_demand", "temperature"], ["k"], config=config)
    st.write_stream(made, out, scratch_path(spark, "checkpoint")).awaitTermination()
    got = {(r["k"], r["based_on_data_until"]): r for r in spark.read.parquet(out).collect()}
    built = build_features(df, config, ["k"])
    from pyspark.ml.feature import VectorAssembler

    want = fitted.transform(VectorAssembler(inputCols=names, outputCol="features").transform(built)).collect()
    assert len(got) == len(want) == 2 * (150 - 24)
    for r in want:
        assert got[r["k"], r["datetime"]]["predicted_value"] == pytest.approx(r["prediction"], rel=1e-9)
    last = fc.forecast_next(df, fitted, config, ["k"]).collect()
    for r in last:
        own = got[r["k"], r["based_on_data_until"]]
        assert own["prediction_for"] == r["prediction_for"] and own["predicted_value"] == pytest.approx(r["predicted_value"], rel=1e-9)


def test_panes_merge_all_values_of_a_window(spark):
    rng = np.random.default_rng(8)
    rows = [("a", T0 + timedelta(hours=h, minutes=int(m)), float(rng.normal())) for h in range(40) if h != 20 for m in rng.integers(0, 60, 3)]
    rows.append(("a", T0 + timedelta(hours=60), 0.0))
    df = spark.createDataFrame(rows, "k string, datetime timestamp_ntz, x double")
    parts = [df.where(df.datetime.between(T0 + timedelta(hours=20 * n), T0 + timedelta(hours=20 * n + 19, minutes=59))) for n in range(4)]
    out = scratch_path(spark, "sink")
    made = st.stream_rolling(arrive(spark, parts), "x", [2, 5], ["k"])
    assert made._jdf.queryExecution().logical().toString().count("TransformWithState") == 1
    st.write_stream(made, out, scratch_path(spark, "checkpoint")).awaitTermination()
    got = {(r["datetime"], r["window"]): r for r in spark.read.parquet(out).collect()}
    by_hour = {}
    for _, t, x in rows:
        by_hour.setdefault((t - T0) // timedelta(hours=1), []).append(x)
    want = {(T0 + timedelta(hours=h), w): sum((by_hour[h - k] for k in range(w)), []) for h in range(40) for w in (2, 5) if all(h - k in by_hour for k in range(w))}
    assert set(got) == set(want)
    for key, xs in want.items():
        assert got[key]["rolling_mean"] == pytest.approx(np.mean(xs)) and got[key]["rolling_std"] == pytest.approx(np.std(xs, ddof=1))


def test_a_correction_in_the_same_micro_batch_stays(spark):
    """Each hour arrives twice within one micro-batch, the later copy first in the file."""
    steps = [[(h, 100.0 + h, h + 5) for h in range(a, a + 30)] + [(h, float(h), h) for h in range(a, a + 30)] for a in (0, 30)]
    frames = [
        spark.createDataFrame([("a", T0 + timedelta(hours=h), v, T0 + timedelta(hours=t)) for h, v, t in s], "k string, datetime timestamp_ntz, x double, came timestamp_ntz")
        for s in steps
    ]
    out = scratch_path(spark, "out")
    made = stateful.stream_features(arrive(spark, frames), "x", ["k"], lags=(1,), windows=(), order="came")
    st.stream_upsert(made, out, scratch_path(spark, "checkpoint"), ["k"]).awaitTermination()
    got = [(r["x"], r["x_lag_1"]) for r in spark.read.parquet(out).orderBy("datetime").collect()]
    assert got == [(100.0 + h, 99.0 + h if h else None) for h in range(60)]


def test_a_long_calendar_takes_no_more_micro_batches(spark):
    from tidegrid.plans.queries_streams import MOST_RUNS, as_stream

    rows = [("a", T0 + timedelta(days=d), float(d)) for d in range(0, 1000, 2)]
    seen = []

    def merge(batch, out, keys, ts, order):
        days = [r["datetime"] for r in batch.select("datetime").collect()]
        seen.append((min(days), max(days), len(days)))

    arrivals = as_stream(spark, spark.createDataFrame(rows, "k string, datetime timestamp_ntz, x double"))
    st.stream_upsert(arrivals, "", scratch_path(spark, "checkpoint"), ["k"], merge=merge).awaitTermination()
    assert sum(n for _, _, n in seen) == 500 and len(seen) <= MOST_RUNS
    assert all(a[1] < b[0] for a, b in zip(seen, seen[1:]))


def test_a_merge_does_not_run_the_stream_again(spark, tmp_path):
    """Every evaluation of the micro-batch adds a line to a file."""
    from pyspark.sql import functions as F

    log = str(tmp_path / "runs")

    def noted(x):
        with open(log, "a") as f:
            f.write("x\n")
        return x

    flat = arrive(spark, [hours(spark, [(h, float(h)) for h in range(5)])])
    marked = flat.withColumn("x", F.udf(noted, "double")("x"))
    st.stream_upsert(marked, scratch_path(spark, "out"), scratch_path(spark, "checkpoint"), ["k"]).awaitTermination()
    assert len(open(log).readlines()) == 5
