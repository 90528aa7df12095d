"""Next-hour and multi-hour forecasts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from tidegrid.functions.timeparts import next_hour
from tidegrid.models.training import Fitted, fit_model
from tidegrid.operators.features import TARGET, FeatureConfig, build_features, feature_names, label_name, training_view
from tidegrid.operators.joins import with_series_stats
from tidegrid.operators.ranking import last_row
from tidegrid.operators.segments import POS, TOTAL, UNIT, with_position
from tidegrid.operators.windows import SPLIT_RATIOS, time_split
from tidegrid.session import cut_lineage


def training_rows(
    df: DataFrame,
    config: FeatureConfig = FeatureConfig(),
    target: str = TARGET,
    steps: int = 1,
    keys: Sequence[str] = (),
    ts: str = "datetime",
    cut=cut_lineage,
    only: Sequence[str] | None = None,
) -> tuple[DataFrame, list[str]]:
    """Features known at an hour, labelled with the target ``steps`` hours later, split by time.

    The current target is a legitimate feature of a future label. ``cut`` stores the wide feature table before the
    split numbers its rows, which reads it twice.
    """
    built = cut(build_features(df, replace(config, label=target, label_steps=steps), keys, ts))
    view, names = training_view(built, "label", keys, ts, only=only)
    return time_split(view, keys=keys, ts=ts), names


def forecast_next(
    recent: DataFrame,
    fitted: Fitted,
    config: FeatureConfig = FeatureConfig(),
    keys: Sequence[str] = (),
    ts: str = "datetime",
    steps: int = 1,
) -> DataFrame:
    """One record per series: the prediction for ``steps`` hours after its newest row."""
    built = build_features(recent, replace(config, drop=True), keys, ts)
    newest = last_row(built, keys, ts)
    packed = VectorAssembler(inputCols=fitted.names, outputCol="features", handleInvalid="keep").transform(newest)
    used = recent.groupBy(*keys).agg(F.count(F.lit(1)).cast("int").alias("historical_hours_used"))
    scored = fitted.transform(packed.select(*keys, ts, "features"))
    both = scored.join(used, list(keys)) if keys else scored.withColumn("historical_hours_used", used.scalar())
    ahead = F.col(ts) + F.expr(f"INTERVAL {steps} HOUR") if steps != 1 else next_hour(ts)
    return both.select(
        *keys,
        ahead.alias("prediction_for"),
        F.col("prediction").alias("predicted_value"),
        F.col(ts).alias("based_on_data_until"),
        F.lit(len(fitted.names)).alias("feature_count"),
        "historical_hours_used",
    )


def horizon_rows(
    df: DataFrame,
    horizon: Sequence[int],
    config: FeatureConfig = FeatureConfig(),
    target: str = TARGET,
    keys: Sequence[str] = (),
    ts: str = "datetime",
    cut=cut_lineage,
    only: Sequence[str] | None = None,
) -> tuple[DataFrame, list[str]]:
    """One stored table for all steps: features of an hour and the target so many hours later as ``label_<step>``.

    All labels come from the window node of the features. Beside them stand ``position`` in the series and, for each step,
    ``size_<step>``, the rows of the series that have its label; both are counted once.
    """
    steps = sorted(set(horizon))
    config = replace(config, label=target, label_steps=steps)
    labels = [label_name(config, h) for h in steps]
    built = cut(build_features(df, config, keys, ts))
    # The wide columns become one vector before anything else moves.
    names = feature_names(built, "", (*keys, *labels)) if only is None else list(only)
    packed = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep").transform(built)
    placed = with_position(packed.select(*keys, ts, "features", *labels), keys, ts, UNIT)
    sizes = [F.count(name).alias(f"size_{h}") for name, h in zip(labels, steps)]
    return cut(with_series_stats(placed.withColumnRenamed(POS, "position").drop(TOTAL), keys, *sizes)), names


def split_of(step: int, ratios: Sequence[float] = SPLIT_RATIOS) -> Column:
    """``split`` of a row of ``horizon_rows`` for one step, as ``time_split`` would give it for the rows with that label."""
    size = F.col(f"size_{step}")
    train, val = (F.floor(size * F.lit(float(share))) for share in ratios[:2])
    return F.when(F.col("position") <= train, "train").when(F.col("position") <= train + val, "val").otherwise("test")


def fit_by_step(
    df: DataFrame,
    horizon: Sequence[int],
    config: FeatureConfig = FeatureConfig(),
    target: str = TARGET,
    keys: Sequence[str] = (),
    params=None,
    kind: str = "gbt",
    only: Sequence[str] | None = None,
    parallelism: int = 4,
) -> dict[int, Fitted]:
    """One direct model per step ahead, all from one stored table; ``parallelism`` fits run at a time."""
    table, names = horizon_rows(df, horizon, config, target, keys, only=only)

    def fit(step: int) -> tuple[int, Fitted]:
        label = F.col(f"label_{step}")
        view = table.where(label.isNotNull()).select("features", label.alias("label"), split_of(step).alias("split")).persist()
        try:
            return step, fit_model(view, names, params, kind)
        finally:
            view.unpersist()

    # Threads only submit Spark jobs; the work runs on the executors.
    with ThreadPool(parallelism) as pool:
        return dict(pool.map(fit, sorted(set(horizon))))


def fit_horizon(
    df: DataFrame,
    horizon: Sequence[int],
    config: FeatureConfig = FeatureConfig(),
    target: str = TARGET,
    keys: Sequence[str] = (),
    params=None,
    kind: str = "gbt",
) -> Fitted:
    """One model for all steps, with the step as its last feature: one fit instead of one for each step."""
    table, names = horizon_rows(df, horizon, config, target, keys)
    steps = sorted(set(horizon))
    each = F.array(*[F.struct(F.lit(h).alias("step"), F.col(f"label_{h}").alias("label"), split_of(h).alias("split")) for h in steps])
    rows = table.select("features", F.explode(each).alias("one")).where("one.label IS NOT NULL")
    rows = rows.select(F.col("features").alias("base"), "one.*")
    view = VectorAssembler(inputCols=["base", "step"], outputCol="features").transform(rows).select("features", "label", "split").persist()
    try:
        return fit_model(view, [*names, "step"], params, kind)
    finally:
        view.unpersist()


def forecast_horizon(
    recent: DataFrame, models: dict[int, Fitted] | Fitted, config: FeatureConfig = FeatureConfig(), keys: Sequence[str] = (), steps: Sequence[int] = ()
) -> DataFrame:
    """One row per series and step. The features of the newest hour are built once; ``models`` is one model per step or one for all ``steps``."""
    built = build_features(recent, replace(config, drop=True), keys)
    newest = cut_lineage(last_row(built, keys, "datetime"))
    used = recent.groupBy(*keys).agg(F.count(F.lit(1)).cast("int").alias("historical_hours_used"))
    newest = newest.join(used, list(keys)) if keys else newest.withColumn("historical_hours_used", used.scalar())
    some = models if isinstance(models, Fitted) else next(iter(models.values()))
    names = [name for name in some.names if name != "step"]
    packed = VectorAssembler(inputCols=names, outputCol="base" if isinstance(models, Fitted) else "features", handleInvalid="keep").transform(newest)
    packed = packed.select(*keys, "datetime", "historical_hours_used", packed.columns[-1])
    if isinstance(models, Fitted):
        rows = packed.withColumn("step", F.explode(F.array(*[F.lit(h) for h in sorted(set(steps))])))
        scored = models.transform(VectorAssembler(inputCols=["base", "step"], outputCol="features").transform(rows))
    else:
        parts = [fitted.transform(packed.withColumn("step", F.lit(step))) for step, fitted in sorted(models.items())]
        scored = reduce(DataFrame.unionByName, parts)
    return scored.select(
        *keys,
        F.expr("datetime + make_dt_interval(0, step)").alias("prediction_for"),
        F.col("prediction").alias("predicted_value"),
        F.col("datetime").alias("based_on_data_until"),
        F.lit(len(some.names)).alias("feature_count"),
        "historical_hours_used",
        "step",
    )
