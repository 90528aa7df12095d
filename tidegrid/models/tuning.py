"""Time-ordered cross-validation and parameter search."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegrid.functions.labels import HIGHER_IS_BETTER
from tidegrid.models.training import Fitted, evaluate, model
from tidegrid.operators.aggregates import aggregate_folds, melt_metrics
from tidegrid.operators.windows import time_folds
from tidegrid.session import cut_lineage

#: Rows that a task of a fit has. A boosted tree is some eight short jobs; with fewer rows a task these only start tasks.
TASK_ROWS = 50_000
METRICS = ("rmse", "mape", "mae", "r2", "forecast_bias")


def fit_tasks(n: int) -> int:
    """Tasks for a fit on ``n`` rows."""
    return max(1, -(-n // TASK_ROWS))


def packed(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows in as many parts as a fit wants, however they are stored. Parts and their order follow from the rows alone."""
    mark = F.xxhash64(*rows.columns)
    return rows.repartition(fit_tasks(n), mark).sortWithinPartitions(mark)


def at_a_time(spark: SparkSession, n: int) -> int:
    """Fits on up to ``n`` rows that keep all cores busy: many of a task each, or two that fill the cluster by turns."""
    return max(2, 2 * spark.sparkContext.defaultParallelism // fit_tasks(n))


def cross_validate(
    view: DataFrame,
    names: Sequence[str],
    params: Mapping | None = None,
    k: int = 5,
    keys: Sequence[str] = (),
    ts: str = "datetime",
    kind: str = "gbt",
    parallelism: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Metrics per fold and their summary. A failed fold is left out; if all fail, the first error is raised.

    The folds are laid out and stored once; each fit reads its part. Without ``parallelism`` as many run at a time as keep
    the cores busy.
    """
    spark = view.sparkSession
    folds = cut_lineage(time_folds(view.select(*keys, ts, "label", "features"), k, keys, ts))
    sizes = dict(folds.where("role = 'train'").groupBy("fold").count().collect())

    def run(fold: int):
        part = folds.where(F.col("fold") == fold)
        try:
            fitted = model(kind)(params, False).fit(packed(part.where("role = 'train'"), sizes.get(fold, 0)))
            found = evaluate(Fitted(fitted, list(names), {}), part.where("role = 'test'"), None).first()
            return fold, found, None
        except Exception as problem:  # a fold may lack rows; the others still count
            return fold, None, problem

    results = _each(run, range(1, k + 1), parallelism or at_a_time(spark, max(sizes.values(), default=0)))
    good = [(fold, *[_number(found[m]) for m in METRICS]) for fold, found, problem in results if problem is None]
    if not good:
        raise ValueError("all folds failed") from results[0][2]
    per_fold = spark.createDataFrame(good, "fold int, " + ", ".join(f"{m} double" for m in METRICS))
    return per_fold, aggregate_folds(melt_metrics(per_fold, METRICS, ["fold"]))


def grid(ranges: Mapping[str, Sequence]) -> list[dict]:
    names = list(ranges)
    return [dict(zip(names, values)) for values in product(*ranges.values())]


def sampled(ranges: Mapping[str, Sequence], n: int, seed: int = 42) -> list[dict]:
    """``(low, high)`` pairs: whole numbers inclusive, reals uniform; longer lists are choices."""
    source = random.Random(seed)

    def draw(span):
        if isinstance(span, tuple) and len(span) == 2:
            low, high = span
            whole = isinstance(low, int) and isinstance(high, int)
            return source.randint(low, high) if whole else source.uniform(low, high)
        return source.choice(list(span))

    return [{name: draw(span) for name, span in ranges.items()} for _ in range(n)]


def search(
    view: DataFrame, names: Sequence[str], trials: Sequence[Mapping], metric: str = "rmse", kind: str = "gbt",
    parallelism: int | None = None,
) -> DataFrame:
    """Fit every trial on train, score on validation; one row per trial, best first. A failed trial has no score.

    Without ``parallelism`` as many run at a time as keep the cores busy.
    """
    spark: SparkSession = view.sparkSession
    rows = view.where(F.col("split").isin("train", "val")).persist()
    size = rows.where("split = 'train'").count()
    train = packed(rows.where("split = 'train'"), size).persist()

    def run(item):
        number, params = item
        try:
            fitted = model(kind)(params, False).fit(train)
            found = evaluate(Fitted(fitted, list(names), {}), rows, "val").first()
            return number, params, found, None
        except Exception as problem:
            return number, params, None, problem

    try:
        results = _each(run, list(enumerate(trials, 1)), parallelism or at_a_time(spark, size))
    finally:
        train.unpersist()
        rows.unpersist()
    if all(found is None for _, _, found, _ in results):
        raise ValueError("all trials failed") from results[0][3]
    out = [
        (
            number,
            {p: str(v) for p, v in params.items()},
            _number(found[metric]) if found else None,
            {m: _number(found[m]) for m in METRICS} if found else None,
        )
        for number, params, found, _ in results
    ]
    table = spark.createDataFrame(
        out, "trial int, params map<string,string>, score double, metrics map<string,double>"
    )
    best = F.desc_nulls_last("score") if metric in HIGHER_IS_BETTER else F.asc_nulls_last("score")
    return table.orderBy(best, "trial")


def grid_search(view, names, ranges, metric="rmse", max_trials=None, seed=42, **options) -> DataFrame:
    """All combinations; a cap draws that many of them at random, seeded."""
    trials = grid(ranges)
    if max_trials and len(trials) > max_trials:
        trials = random.Random(seed).sample(trials, max_trials)
    return search(view, names, trials, metric, **options)


def random_search(view, names, ranges, n=10, metric="rmse", seed=42, **options) -> DataFrame:
    return search(view, names, sampled(ranges, n, seed), metric, **options)


def _each(run, items, parallelism):
    # Threads only submit Spark jobs; the work runs on the executors.
    with ThreadPool(max(1, parallelism)) as pool:
        return pool.map(run, items)


def _number(value):
    return None if value is None else float(value)
