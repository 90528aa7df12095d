"""Boosted-tree training, evaluation, importance and prediction bands."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegrid.functions import errors
from tidegrid.operators.aggregates import exact_percentiles, forecast_metrics, normalise_importance
from tidegrid.operators.joins import with_scalars

# Fixed hyperparameters. Column sampling is per tree node in Spark; there is no L1/L2 or gamma.
TREE_PARAMS = {
    "maxDepth": 6,
    "stepSize": 0.1,
    "maxIter": 100,
    "subsamplingRate": 0.8,
    "featureSubsetStrategy": "0.8",
    "seed": 42,
}
BAND_LEVEL = 0.95
HELD_OUT = "is_validation"


def tree_estimator(params: Mapping | None = None, early_stopping: bool = False) -> Pipeline:
    """Standardise, then boosted trees. ``early_stopping`` watches the rows flagged ``is_validation``."""
    trees = GBTRegressor(featuresCol="scaled", labelCol="label", cacheNodeIds=True, checkpointInterval=10)
    trees = trees.setParams(**{**TREE_PARAMS, **(params or {})})
    if early_stopping:
        trees = trees.setValidationIndicatorCol(HELD_OUT)
    return Pipeline(stages=[StandardScaler(withMean=True, withStd=True, inputCol="features", outputCol="scaled"), trees])


def linear_estimator(params: Mapping | None = None, early_stopping: bool = False) -> Pipeline:
    """Standardise, then least squares by the normal equations: one pass, sums combined before the shuffle."""
    least = LinearRegression(featuresCol="scaled", labelCol="label", solver="normal").setParams(**(params or {}))
    return Pipeline(stages=[StandardScaler(withMean=True, withStd=True, inputCol="features", outputCol="scaled"), least])


_ESTIMATORS: dict[str, Callable[..., Pipeline]] = {"gbt": tree_estimator, "linear": linear_estimator}


def register_model(name: str, estimator: Callable[..., Pipeline]) -> None:
    """Register a function ``(params, early_stopping) -> pyspark.ml.Pipeline``."""
    if not callable(estimator):
        raise TypeError(f"model {name} must be callable")
    _ESTIMATORS[name] = estimator


def model(name: str) -> Callable[..., Pipeline]:
    if name not in _ESTIMATORS:
        raise ValueError(f"unknown model {name}, available: {list_models()}")
    return _ESTIMATORS[name]


def list_models() -> list[str]:
    return sorted(_ESTIMATORS)


@dataclass
class Fitted:
    model: PipelineModel
    names: list[str]
    metrics: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)


def stopping_point(scores: Sequence[float], patience: int, min_delta: float = 0.0) -> int:
    """How many rounds to keep: up to the best one, once ``patience`` rounds in a row have not been better by more than ``min_delta``."""
    best, kept, waited = float("inf"), 0, 0
    for k, score in enumerate(scores, 1):
        if score < best - min_delta:
            best, kept, waited = score, k, 0
        else:
            waited += 1
            if waited >= patience:
                break
    return kept


def cut_back(trees: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The model of the first trees alone. Boosting adds trees in order, so it is what a shorter fit would have given."""
    if rounds >= trees.getNumTrees:
        return trees
    spark = SparkSession.getActiveSession()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    kept = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(jvm.double, rounds)
    own, weight = trees._java_obj.trees(), trees._java_obj.treeWeights()
    for k in range(rounds):
        kept[k], weights[k] = own[k], weight[k]
    made = GBTRegressionModel(jvm.org.apache.spark.ml.regression.GBTRegressionModel(f"{trees.uid}_{rounds}", kept, weights))
    made._resetUid(made._java_obj.uid())
    return made.setFeaturesCol(trees.getFeaturesCol()).setPredictionCol(trees.getPredictionCol())


def fit_model(
    view: DataFrame,
    names: Sequence[str],
    params: Mapping | None = None,
    kind: str = "gbt",
    early_stopping: bool = False,
    patience: int | None = None,
    min_delta: float = 0.0,
) -> Fitted:
    """Fit on ``split = 'train'`` (scaler included) and report train and validation error.

    With early stopping the trees also see the validation rows, flagged, but the scaler is still fitted on train only. With
    ``patience`` all trees are fitted, the validation RMSE of every number of first trees is taken in one pass, and the trees
    behind the best one before ``patience`` rounds without a gain of ``min_delta`` are dropped. Without either the model must
    have all the trees that were asked for.
    """
    pipeline = model(kind)(params, early_stopping)
    train = view.where(F.col("split") == "train")
    rounds = None
    if early_stopping:
        scaler, trees = pipeline.getStages()
        scale = scaler.fit(train)
        flagged = view.where(F.col("split").isin("train", "val")).withColumn(HELD_OUT, F.col("split") == "val")
        fitted = PipelineModel([scale, trees.fit(scale.transform(flagged))])
    else:
        fitted = pipeline.fit(train)
        _all_trees(fitted.stages[-1])
    if patience is not None:
        *before, trees = fitted.stages
        held = PipelineModel(before).transform(view.where(F.col("split") == "val"))
        rounds = stopping_point([e**0.5 for e in trees.evaluateEachIteration(held, "squared")], patience, min_delta)
        fitted = PipelineModel([*before, cut_back(trees, rounds)])
    scored = fitted.transform(view.where(F.col("split").isin("train", "val")))
    rows = scored.groupBy("split").agg(
        errors.rmse("label", "prediction").alias("rmse"),
        errors.mape("label", "prediction").alias("mape"),
        F.count(F.lit(1)).alias("n"),
    )
    metrics: dict[str, float] = {} if rounds is None else {"rounds": float(rounds)}
    for row in rows.collect():  # at most two rows
        metrics[f"{row['split']}_rmse"] = row["rmse"]
        metrics[f"{row['split']}_samples"] = float(row["n"])
        if row["split"] == "val":
            metrics["val_mape"] = row["mape"]
    return Fitted(fitted, list(names), metrics)


def _all_trees(last) -> None:
    if isinstance(last, GBTRegressionModel) and last.getNumTrees != last.getMaxIter():
        raise RuntimeError(f"boosting stopped after {last.getNumTrees} of {last.getMaxIter()} trees")


def evaluate(fitted: Fitted, view: DataFrame, split: str | None = "test", keys: Sequence[str] = ()) -> DataFrame:
    """The five metrics over one split."""
    rows = view if split is None else view.where(F.col("split") == split)
    return forecast_metrics(fitted.transform(rows), "label", "prediction", keys)


def feature_importance(spark: SparkSession, fitted: Fitted) -> DataFrame:
    """One row per feature, unused ones 0, shares add up to one, largest first. Rows: the number of features."""
    weights = fitted.model.stages[-1].featureImportances.toArray()
    rows = [(n, float(w)) for n, w in zip(fitted.names, weights)]
    return normalise_importance(spark.createDataFrame(rows, "feature string, importance double")).orderBy(
        F.desc("importance"), "feature"
    )


def select_features(importance: DataFrame) -> DataFrame:
    """Features whose importance is at least the median."""
    middle = exact_percentiles(importance, "importance", [0.5]).withColumnRenamed("p0", "__median")
    return with_scalars(importance, middle).where(F.col("importance") >= F.col("__median")).drop("__median")


def residual_quantiles(
    scored: DataFrame, level: float = BAND_LEVEL, keys: Sequence[str] = ()
) -> DataFrame:
    """Lower and upper residual quantile (label - prediction), overall or per group such as the hour."""
    tail = (1.0 - level) / 2.0
    residual = scored.select(*keys, (F.col("label") - F.col("prediction")).alias("residual"))
    marks = exact_percentiles(residual, "residual", [tail, 1.0 - tail], keys)
    return marks.withColumnsRenamed({"p0": "residual_low", "p1": "residual_high"})


def prediction_band(
    scored: DataFrame, validation: DataFrame, level: float = BAND_LEVEL, keys: Sequence[str] = ()
) -> DataFrame:
    """Add lower and upper: point prediction plus the validation residual quantiles."""
    marks = residual_quantiles(validation, level, keys)
    both = scored.join(marks, list(keys), "left") if keys else with_scalars(scored, marks)
    return both.withColumns(
        {
            "lower": F.col("prediction") + F.col("residual_low"),
            "upper": F.col("prediction") + F.col("residual_high"),
        }
    ).drop("residual_low", "residual_high")


#: The Poisson distribution with mean 1, summed up: how often a row enters a resample.
POISSON = (0.36787944, 0.73575888, 0.91969860, 0.98101184, 0.99634015, 0.99940582, 0.99991676)


def resampled(rows: DataFrame, by: Sequence[str], replicates: int) -> DataFrame:
    """Rows as often as a Poisson bootstrap draws them, with the number of the ``replicate``.

    The draws are hashes of the columns ``by``, so they do not depend on how the rows are spread over tasks.
    """
    unit = F.pmod(F.xxhash64(*by, "replicate"), F.lit(2**40)) / F.lit(float(2**40))
    times = reduce(lambda a, b: a + b, [F.when(unit > share, 1).otherwise(0) for share in POISSON])
    drawn = rows.withColumn("replicate", F.explode(F.sequence(F.lit(1), F.lit(replicates)))).withColumn("__times", times)
    return drawn.where("__times > 0").withColumn("__again", F.explode(F.sequence(F.lit(1), F.col("__times")))).drop("__again", "__times")


def bootstrap_band(
    scored: DataFrame,
    validation: DataFrame,
    level: float = BAND_LEVEL,
    replicates: int = 10,
    keys: Sequence[str] = (),
    ts: str = "datetime",
) -> DataFrame:
    """Add lower and upper: the point plus residual quantiles of the same hour of the day, averaged over resampled validation rows.

    All replicates are drawn and ranked in one pass. Hours that validation does not have take the quantiles of all its hours.
    """
    tail = (1.0 - level) / 2.0
    residual = validation.select(*keys, ts, F.hour(ts).alias("__hour"), (F.col("label") - F.col("prediction")).alias("residual"))
    drawn = resampled(residual, [*keys, ts], replicates)
    marks = exact_percentiles(drawn, "residual", [tail, 1.0 - tail], ["__hour", "replicate"])
    by_hour = marks.groupBy("__hour").agg(F.avg("p0").alias("__low"), F.avg("p1").alias("__high"))
    every = exact_percentiles(residual, "residual", [tail, 1.0 - tail])
    out = with_scalars(scored.withColumn("__hour", F.hour(ts)).join(F.broadcast(by_hour), "__hour", "left"), every)  # 24 rows
    point = F.col("prediction")
    bounds = {"lower": point + F.coalesce("__low", "p0"), "upper": point + F.coalesce("__high", "p1")}
    return out.withColumns(bounds).drop("__hour", "__low", "__high", "p0", "p1")


def predict_with_metadata(
    fitted: Fitted,
    df: DataFrame,
    validation: DataFrame,
    model_type: str,
    version: str,
    importance: DataFrame | None = None,
    keys: Sequence[str] = (),
    ts: str = "datetime",
    level: float = BAND_LEVEL,
) -> DataFrame:
    """Predictions with band, model columns and, if given, the importance map."""
    banded = prediction_band(fitted.transform(df), fitted.transform(validation), level)
    out = banded.select(
        *keys,
        ts,
        F.col("prediction").alias("predicted_value"),
        F.col("lower").alias("confidence_lower"),
        F.col("upper").alias("confidence_upper"),
        F.lit(model_type).alias("model_type"),
        F.lit(version).alias("model_version"),
        F.lit(len(fitted.names)).alias("feature_count"),
    )
    if importance is None:
        return out
    pairs = importance.agg(F.map_from_entries(F.collect_list(F.struct("feature", "importance"))).alias("m"))
    return out.withColumn("feature_importance", pairs.scalar())


