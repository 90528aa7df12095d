"""Fitted pipelines as plain arrays, for scoring inside a stateful operator."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import StandardScalerModel
from pyspark.ml.regression import GBTRegressionModel, LinearRegressionModel
from pyspark.sql import functions as F

from tidegrid.models.training import Fitted
from tidegrid.session import scratch_path


@dataclass(frozen=True)
class Trees:
    """Nodes of all trees behind each other; a leaf leads to itself."""

    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    weights: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        while True:
            # A missing value goes to the right, as a comparison with it is false.
            onward = np.where(x[rows, self.feature[at]] <= self.limit[at], self.left[at], self.right[at])
            if (onward == at).all():
                return self.value[at] @ self.weights
            at = onward


@dataclass(frozen=True)
class Linear:
    coefficients: np.ndarray
    intercept: float

    def predict(self, x: np.ndarray) -> np.ndarray:
        return x @ self.coefficients + self.intercept


@dataclass(frozen=True)
class Scorer:
    """Names of the features in order, how they are scaled, and the regressor."""

    names: tuple[str, ...]
    mean: np.ndarray
    scale: np.ndarray
    regressor: Trees | Linear

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Predictions for rows of features; NaN where a feature is missing."""
        made = np.full(len(x), np.nan)
        whole = ~np.isnan(x).any(axis=1)
        if whole.any():
            made[whole] = self.regressor.predict((x[whole] - self.mean) * self.scale)
        return made


def _trees(model: GBTRegressionModel) -> Trees:
    """The stored nodes of a boosted model; their number follows its trees and depth, never the data."""
    spark = model._spark_session if hasattr(model, "_spark_session") else None
    from pyspark.sql import SparkSession

    spark = spark or SparkSession.getActiveSession()
    path = scratch_path(spark, "trees")
    model.write().save(path)
    node = F.col("nodeData")
    rows = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("id"),
        node["prediction"].alias("value"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        node["split"]["featureIndex"].alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("limit"),
        node["split"]["numCategories"].alias("categories"),
    )
    nodes = rows.orderBy("tree", "id").toPandas()
    if (nodes["categories"] > 0).any():
        raise ValueError("categorical splits are not supported")
    place = {key: k for k, key in enumerate(zip(nodes["tree"], nodes["id"]))}
    own = np.arange(len(nodes))
    leaf = (nodes["left"] < 0).to_numpy()

    def child(side: str) -> np.ndarray:
        return np.where(leaf, own, [place.get(key, k) for k, key in enumerate(zip(nodes["tree"], nodes[side]))])

    return Trees(
        np.where(leaf, 0, nodes["feature"]).astype(np.int64),
        np.where(leaf, np.inf, nodes["limit"]),
        child("left"),
        child("right"),
        nodes["value"].to_numpy("float64"),
        np.array([place[t, 0] for t in range(nodes["tree"].max() + 1)]),
        np.array(model.treeWeights),
    )


_REGRESSORS: dict[type, Callable[..., Trees | Linear]] = {
    GBTRegressionModel: _trees,
    LinearRegressionModel: lambda m: Linear(m.coefficients.toArray(), float(m.intercept)),
}


def scorer(fitted: Fitted) -> Scorer:
    """Arrays of a fitted pipeline: a scaler, if it has one, and boosted trees or a linear model."""
    *before, last = fitted.model.stages
    if type(last) not in _REGRESSORS:
        raise TypeError(f"no arrays for a {type(last).__name__}")
    size = len(fitted.names)
    mean, scale = np.zeros(size), np.ones(size)
    for stage in before:
        if not isinstance(stage, StandardScalerModel):
            raise TypeError(f"no arrays for a {type(stage).__name__}")
        mean = stage.mean.toArray() if stage.getWithMean() else mean
        spread = stage.std.toArray()
        scale = np.divide(1.0, spread, out=np.zeros(size), where=spread != 0) if stage.getWithStd() else scale
    return Scorer(tuple(fitted.names), mean, scale, _REGRESSORS[type(last)](last))
