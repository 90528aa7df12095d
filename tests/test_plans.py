"""What the physical plans must and must not contain."""

import os

import pytest

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidegrid.operators import features
from tidegrid.plans import tables

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    [
        "zscore_outliers",
        "freshness",
        "month_closed",
        "series_stats_events",
        "exact_percentiles",
        "normalise_importance",
        "pending_units",
        "cross_units",
        "recent_168h",
        "regularise",
        "trend",
        "report_kpi",
        "report_data_profile",
        "interpolate_and_fill",
        "time_folds",
    ],
)
def test_no_cross_joins(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(entry.queries()["recent_days"](spark, SF))
    assert "GreaterThanOrEqual(ts" in text and "props" not in text
    text = plan(entry.queries()["daily_order_canonical"](spark, SF))
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in text


def test_wide_matrix_is_one_window(spark):
    rows = tables.hourly(spark, SF)
    text = plan(features.build_features(rows, features.FeatureConfig(unit=None), ["event_type"]))
    assert text.count("Window [") == 1
    # In runs: one more to number the rows, and two for the sums over the segment summary.
    assert plan(features.build_features(rows, keys=["event_type"])).count("Window [") <= 4


def test_dedup_is_an_aggregate(spark):
    text = plan(entry.queries()["dedup_first"](spark, SF))
    assert "Window" not in text and text.count("partial_min_by") == 1


def test_a_hot_series_is_split(spark):
    """98 of 100 rows in one series: its rows stay in many tasks when statistics come back, and percentiles are exact."""
    import numpy as np

    from tidegrid.operators.aggregates import exact_percentiles
    from tidegrid.operators.joins import with_series_stats

    df = spark.range(60_000, numPartitions=8).select(
        F.when(F.col("id") % 100 < 98, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"), F.pow(F.pmod(F.xxhash64("id"), F.lit(10**6)), F.lit(2.5)).alias("x")
    )
    joined = with_series_stats(df, ["k"], F.avg("x").alias("m"))
    held = joined.where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(held) >= 8 and max(r["count"] for r in held) < 0.2 * 60_000
    got = {r["k"]: (r["p0"], r["p1"]) for r in exact_percentiles(df, "x", [0.025, 0.5], ["k"]).collect()}
    rows = df.toPandas()
    for k, own in rows.groupby("k")["x"]:
        assert np.allclose(got[k], np.quantile(own, [0.025, 0.5]), rtol=1e-12)
    plan = exact_percentiles(df, "x", [0.5], ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "percentile(" not in plan.replace("percentile_approx(", "")
