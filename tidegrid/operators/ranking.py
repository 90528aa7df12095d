"""Latest rows, top-k and pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def latest(df: DataFrame, col: str, keys: Sequence[str] = (), ts: str = "datetime") -> DataFrame:
    """Value of the newest row of each series; an aggregate, so a hot series combines map-side."""
    return df.groupBy(*keys).agg(F.max(ts).alias(ts), F.max_by(F.col(col), F.col(ts)).alias(col))


def last_row(df: DataFrame, keys: Sequence[str] = (), ts: str = "datetime") -> DataFrame:
    """The newest row of each series, whole."""
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(ts)).alias("__row"), F.max(ts).alias("__seen"))
    # Without keys an empty input still aggregates to one row.
    return newest.where(F.col("__seen").isNotNull()).select(
        *[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns]
    )


def importance_at_least(df: DataFrame, threshold: float = 0.01, n: int | None = None) -> DataFrame:
    kept = df.where(F.col("importance") >= threshold).orderBy(F.desc("importance"), "feature")
    return kept.limit(n) if n else kept


def top_features(df: DataFrame, n: int = 10) -> DataFrame:
    return df.orderBy(F.desc("importance"), "feature").limit(n)


def top_trials(df: DataFrame, metric: str = "score", minimise: bool = True, n: int = 5) -> DataFrame:
    return df.orderBy(F.asc(metric) if minimise else F.desc(metric), "trial").limit(n)


def page(df: DataFrame, number: int, size: int = 100, order: Sequence[Column | str] = ("datetime",)) -> DataFrame:
    """Page ``number`` (from 1) of the ordered rows."""
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def sort_time(df: DataFrame, keys: Sequence[str] = (), ts: str = "datetime") -> DataFrame:
    """Total order, for sinks only."""
    return df.orderBy(*keys, ts)
