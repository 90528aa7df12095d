from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidegrid.operators import features, joins, quality, windows
from tidegrid.operators.segments import framed, with_position

START = datetime(2024, 1, 30, 20)


def series(spark, values, key=None):
    rows = [(key, START + timedelta(hours=h), v) for h, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, datetime timestamp_ntz, x double")


def values(df):
    return [r["x"] for r in df.orderBy("datetime").collect()]


_ = None
GAPS = [
    ([0, _, _, _, _, _, 6], [0, 1, 2, 3, 4, 5, 6], [0, 1, 2, 3, 4, 5, 6]),
    ([0, _, _, _, _, _, _, _, _, 9], [0, 1, 2, 3, _, _, 6, 7, 8, 9], [0, 1, 2, 3, 3, 3, 6, 7, 8, 9]),
    ([_, _, _, _, _, 1], [_, _, 1, 1, 1, 1], [1] * 6),
    ([4, _, _, _, _, _], [4, 4, 4, 4, _, _], [4] * 6),
    ([_] * 5 + [1, _, _, 4] + [_] * 5, None, [1, 1, 1, 1, 1, 1, 2, 3, 4, 4, 4, 4, 4, 4]),
    ([_, _, _], [_, _, _], [_, _, _]),
]


@pytest.mark.parametrize("given,line,full", GAPS)
@pytest.mark.parametrize("unit", ["HOUR", "DAY", "MONTH"])
def test_gap_rules(spark, given, line, full, unit):
    df = series(spark, [None if v is None else float(v) for v in given])
    if line:
        assert values(windows.interpolate_linear(df, ["x"], keys=["k"], unit=unit)) == line
    assert values(windows.interpolate_linear(df, ["x"], keys=["k"], unit=unit, fill_rest=True)) == full


def random_frame(seed, n=400, keys=("a", "b", None)):
    rng = np.random.default_rng(seed)
    rows = []
    for key in keys:
        hours = np.sort(rng.choice(5 * n, size=n if key == "a" else n // 4, replace=False))
        for h in hours:
            v = None if rng.random() < 0.35 else float(np.round(rng.normal(50, 20), 2))
            rows.append((key, START + timedelta(hours=int(h)), v))
    return rows


def by_key(rows):
    frame = pd.DataFrame(rows, columns=["k", "datetime", "x"]).astype({"x": "float64"})
    return frame.groupby("k", dropna=False, sort=False)


def key_of(k):
    return None if k is None or k != k else k


def compare(df, expected, cols):
    got = {(r["k"], r["datetime"]): r for r in df.collect()}
    assert len(got) == len(expected)
    for (k, ts), row in expected.items():
        for c in cols:
            a, b = got[(k, ts)][c], row[c]
            assert (a is None and b != b) or a == pytest.approx(b, abs=1e-9), (k, ts, c, a, b)


@pytest.mark.parametrize("unit", ["DAY", "MONTH"])
def test_fills_match_pandas_across_segments(spark, unit):
    rows = random_frame(1)
    expected = {}
    for k, g in by_key(rows):
        line = g["x"].interpolate("linear", limit=3, limit_direction="both")
        done = line.ffill().bfill()
        for i in g.index:
            expected[(key_of(k), g.at[i, "datetime"].to_pydatetime())] = {"x": done[i]}
    df = spark.createDataFrame(rows, "k string, datetime timestamp_ntz, x double")
    compare(windows.interpolate_linear(df, ["x"], keys=["k"], fill_rest=True, unit=unit), expected, ["x"])


def test_lag_and_rolling_match_pandas_in_small_runs(spark):
    """Runs of 7 rows force every frame across a border; one series holds two thirds of the rows."""
    rows = random_frame(2)
    expected, cols = {}, ["lag1", "lag5", "mean", "std"]
    for k, g in by_key(rows):
        part = pd.DataFrame(
            {
                "lag1": g["x"].shift(1),
                "lag5": g["x"].shift(5),
                "mean": g["x"].rolling(3).mean(),
                "std": g["x"].rolling(3).std(),
            }
        )
        for i in g.index:
            expected[(key_of(k), g.at[i, "datetime"].to_pydatetime())] = part.loc[i]
    df = spark.createDataFrame(rows, "k string, datetime timestamp_ntz, x double")

    def build(over):
        lags = windows.lag_columns(["x"], [1, 5])(over)
        mean, std = windows.rolling_columns(["x"], [3])(over)
        return [lags[0].alias("lag1"), lags[1].alias("lag5"), mean.alias("mean"), std.alias("std")]

    compare(framed(df, ["k"], "datetime", 5, build, "DAY", run_rows=6), expected, cols)
    compare(framed(df, ["k"], "datetime", 5, build, None), expected, cols)


def test_lead_crosses_runs(spark):
    df = series(spark, [float(v) for v in range(20)], "a")
    out = framed(df, ["k"], "datetime", 1, lambda over: [F.expr(f"lead(x, 3) OVER ({over}) AS y")], "HOUR", 4, lookahead=3)
    assert [r["y"] for r in out.orderBy("datetime").collect()] == [*map(float, range(3, 20)), None, None, None]


def test_by_time_equals_rows_on_a_full_grid(spark):
    df = series(spark, [float(v * v % 17) for v in range(60)], "a")
    by_rows = windows.rolling_features(df, ["x"], [3, 6], ["k"]).orderBy("datetime").collect()
    by_time = windows.rolling_features(df, ["x"], [3, 6], ["k"], by="time").orderBy("datetime").collect()
    assert [tuple(r)[:3] for r in by_rows] == [tuple(r)[:3] for r in by_time]
    for a, b in zip(by_rows, by_time):
        assert all((x is None and y is None) or x == pytest.approx(y) for x, y in zip(a[3:], b[3:]))


def test_short_window_is_null(spark):
    df = series(spark, [0.0, 1.0, 2.0, None, 4.0, 5.0], "a")
    out = windows.rolling_features(df, ["x"], [3], ["k"]).orderBy("datetime").collect()
    assert [r["x_rolling_mean_3"] for r in out] == [None, None, 1.0, None, None, None]


def test_position_without_keys_and_null_keys(spark):
    rows = random_frame(3)
    df = spark.createDataFrame(rows, "k string, datetime timestamp_ntz, x double")
    placed = with_position(df, ["k"], "datetime", "DAY")
    per_key = placed.groupBy("k").agg(F.min("__pos"), F.max("__pos"), F.count("*"), F.countDistinct("__pos"), F.max("__total"))
    for r in per_key.collect():
        assert r[1] == 1 and r[2] == r[3] == r[4] == r[5]
    whole = with_position(df.where("k = 'a'"), [], "datetime", "DAY").orderBy("datetime").collect()
    assert [r["__pos"] for r in whole] == list(range(1, len(whole) + 1))


def test_split_and_folds(spark):
    df = series(spark, [float(v) for v in range(10)], "a")
    sizes = {r["split"]: r["count"] for r in windows.time_split(df, keys=["k"]).groupBy("split").count().collect()}
    assert sizes == {"train": 7, "val": 1, "test": 2}
    with pytest.raises(ValueError):
        windows.time_split(df, (0.5, 0.2, 0.2))
    thirteen = series(spark, [float(v) for v in range(13)], "a")
    folds = windows.time_folds(thirteen, 5, ["k"]).collect()
    for fold, start in zip(range(1, 6), (3, 5, 7, 9, 11)):
        train = [r["x"] for r in folds if r["fold"] == fold and r["role"] == "train"]
        test = sorted(r["x"] for r in folds if r["fold"] == fold and r["role"] == "test")
        assert sorted(train) == list(range(start)) and test == [start, start + 1]


def test_impute_fills_twice(spark):
    """The filled value between 10 and 100 takes part in the second pass, after 100 is removed."""
    rows = [(START + timedelta(hours=h), t, 5.0) for h, t in enumerate([10.0, None, 100.0, 20.0])]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, temperature double, electricity_demand double")
    out = windows.impute_canonical(df).orderBy("datetime").collect()
    assert [r["temperature"] for r in out] == [10.0, 55.0, 37.5, 20.0]


def test_outlier_limits_are_strict(spark):
    rows = [(60.0, 0.0), (60.1, -1.0), (-10.0, 1.0), (-10.1, 2.0)]
    df = spark.createDataFrame(rows, "temperature double, electricity_demand double")
    out = quality.null_outliers(df, windows.PHYSICAL_LIMITS).collect()
    assert [tuple(r) for r in out] == [(60.0, 0.0), (None, None), (-10.0, 1.0), (None, 2.0)]


def test_feature_matrix_layout_and_label(spark):
    hours = 200
    rows = [(START + timedelta(hours=h), *[float((h * m) % 23) for m in (3, 5, 7, 11, 13)]) for h in range(hours)]
    names = ["electricity_demand", "temperature", "humidity", "wind_speed", "precipitation"]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, " + ", ".join(f"{n} double" for n in names))
    out = features.build_features(df)
    assert len(out.columns) == 169 and out.count() == hours - 168
    assert features.has_features("trees") and "trees" in features.list_features()
    with pytest.raises(TypeError):
        features.register_features("bad", 3)
    labelled = features.build_features(df, features.FeatureConfig(lags=(1,), windows=(3,), label="electricity_demand"))
    row = labelled.orderBy("datetime").first()
    assert row["electricity_demand"] == rows[2][1] and row["label"] == rows[3][1]


def test_regularise_spreads_long_series_and_keeps_null_keys(spark):
    """Two thousand slots: more than one chunk of the grid."""
    rows = [(k, START + timedelta(hours=h), float(h)) for k in ("a", None) for h in (0, 7, 1024, 2000)]
    df = spark.createDataFrame(rows, "k string, datetime timestamp_ntz, x double")
    out = joins.regularise(df, ["k"])
    counts = out.groupBy("k").agg(F.count("*").alias("n"), F.countDistinct("datetime").alias("d"), F.sum("x").alias("s"))
    assert {(r["n"], r["d"], r["s"]) for r in counts.collect()} == {(2001, 2001, 3031.0)}
    assert counts.count() == 2
