"""The feature matrix and named feature builders."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F, types as T

from tidegrid.functions.labels import interactions
from tidegrid.functions.timeparts import time_features
from tidegrid.operators.quality import drop_warmup
from tidegrid.operators.segments import UNIT, framed, framed_by_time, quoted
from tidegrid.operators.windows import LAGS, WINDOWS, lag_columns, rolling_columns

# Fixed names that are never features.
METADATA_COLUMNS = ("query_date", "processed_at", "signal")
EXCLUDE = ("datetime", "query_date", "source", "processed_at", "signal")
TARGET = "electricity_demand"


@dataclass(frozen=True)
class FeatureConfig:
    lags: Sequence[int] = LAGS
    windows: Sequence[int] = WINDOWS
    with_interactions: bool = False
    by: str = "rows"
    shift: int = 0
    unit: str | None = UNIT
    drop: bool = True
    skip: Sequence[str] = field(default_factory=tuple)
    label: str | None = None
    label_steps: int | Sequence[int] = 1

    @property
    def steps(self) -> tuple[int, ...]:
        return (self.label_steps,) if isinstance(self.label_steps, int) else tuple(self.label_steps)


def numeric_columns(df: DataFrame, skip: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def build_features(
    df: DataFrame, config: FeatureConfig = FeatureConfig(), keys: Sequence[str] = (), ts: str = "datetime"
) -> DataFrame:
    """Calendar columns, then lags and rolling statistics of every numeric column, then interactions; rows of the
    warm-up are dropped.

    All window columns share one specification and are issued in one projection: one sort and one Window node,
    whatever their number. With ``config.label`` the value of that column ``label_steps`` rows ahead is added as
    ``label`` in the same pass; of several steps each as ``label_<step>``, and these may be NULL at the end of a series.
    """
    if ts not in df.columns:
        raise ValueError(f"no time column {ts}")
    timed = time_features(df, ts)
    cols = numeric_columns(timed, (*keys, *METADATA_COLUMNS, *config.skip))
    makers = []
    if config.lags:
        makers.append(lag_columns(cols, config.lags, config.by))
    if config.windows:
        makers.append(rolling_columns(cols, config.windows, config.by, config.shift))
    if config.label:
        makers.append(lambda over: [_ahead(config, step, over) for step in config.steps])
    lookback = max([*config.lags, *(w + config.shift for w in config.windows), 1])
    lookahead = max(config.steps) if config.label else 0

    def build(over: str):
        return [column for make in makers for column in make(over)]

    if config.by == "rows":
        out = framed(timed, keys, ts, lookback, build, config.unit, lookahead=lookahead)
    else:
        out = framed_by_time(timed, keys, ts, lookback, build, lookahead=lookahead)
    if config.with_interactions:
        out = interactions(out)
    return drop_warmup(out, [label_name(config, step) for step in config.steps] if config.label and len(config.steps) > 1 else ()) if config.drop else out


def label_name(config: FeatureConfig, step: int) -> str:
    return "label" if isinstance(config.label_steps, int) else f"label_{step}"


def _ahead(config: FeatureConfig, steps: int, over: str):
    target, name = f"CAST({quoted(config.label)} AS DOUBLE)", label_name(config, steps)
    if config.by == "rows":
        return F.expr(f"lead({target}, {steps}) OVER ({over}) AS {name}")
    return F.expr(f"first({target}) OVER ({over} RANGE BETWEEN {steps} FOLLOWING AND {steps} FOLLOWING) AS {name}")


def feature_names(df: DataFrame, target: str = TARGET, keys: Sequence[str] = (), exclude: Sequence[str] = EXCLUDE):
    """Numeric columns left after the exclusion list, the keys and the target."""
    return numeric_columns(df, (*keys, *exclude, target, "label", "split", "step"))


def training_view(
    df: DataFrame,
    target: str = TARGET,
    keys: Sequence[str] = (),
    ts: str = "datetime",
    exclude: Sequence[str] = EXCLUDE,
    keep: Sequence[str] = (),
    only: Sequence[str] | None = None,
) -> tuple[DataFrame, list[str]]:
    """(keys, time, label, features) in one table, rows without a target dropped; and the feature names (``only`` those named)."""
    if target not in df.columns:
        raise ValueError(f"target {target} not found, available: {df.columns[:10]}")
    names = feature_names(df, target, (*keys, *keep), exclude) if only is None else list(only)
    known = df.where(F.col(target).isNotNull()).withColumn("label", F.col(target).cast("double"))
    packed = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep").transform(known)
    return packed.select(*keys, ts, *keep, "label", "features"), names


_BUILDERS: dict[str, Callable[..., DataFrame]] = {"trees": build_features}


def register_features(name: str, builder: Callable[..., DataFrame]) -> None:
    """Register a builder ``(df, ...) -> DataFrame`` for use with ``df.transform``."""
    if not callable(builder):
        raise TypeError(f"feature builder {name} must be callable")
    _BUILDERS[name] = builder


def features(name: str) -> Callable[..., DataFrame]:
    if name not in _BUILDERS:
        raise ValueError(f"unknown features {name}, available: {list_features()}")
    return _BUILDERS[name]


def list_features() -> list[str]:
    return sorted(_BUILDERS)


def has_features(name: str) -> bool:
    return name in _BUILDERS
