"""Lag and rolling features, and forecasts, per arriving hour from the recent hours kept as state."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidegrid.functions.timeparts import TIME_FEATURES, time_features
from tidegrid.models.scoring import Scorer
from tidegrid.operators.features import FeatureConfig
from tidegrid.operators.windows import LAGS, WINDOWS

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
HOUR = 3600
#: No hour is as early as this.
NEVER = -(2**62)
#: What ranks the rows of one hour in a micro-batch. Spark renames columns that begin with an underscore here.
ORDER = "tidegrid_order"


def calendar(hours: np.ndarray, circle: np.ndarray) -> np.ndarray:
    """TIME_FEATURES of hour numbers, one row each; ``circle`` has sine and cosine of the 24 hours."""
    times = pd.DatetimeIndex(pd.to_datetime(hours * HOUR, unit="s"))
    parts = (times.hour, times.dayofweek, times.day, times.month, times.dayofweek >= 5)
    return np.concatenate([np.stack([np.asarray(p, dtype="float64") for p in parts], axis=1), circle[hours % 24]], axis=1)


def hour_circle(spark: SparkSession) -> np.ndarray:
    """Sine and cosine of the 24 hours as Spark computes them, to the last bit."""
    day = spark.range(24).select((F.lit("1970-01-01").cast("timestamp_ntz") + F.expr("make_dt_interval(0, CAST(id AS INT))")).alias("datetime"))
    rows = time_features(day).select("hour", "hour_sin", "hour_cos").collect()
    return np.array([[r["hour_sin"], r["hour_cos"]] for r in sorted(rows)])


class Recent:
    """Values of the known hours of one series, by hour number, and what follows from them."""

    def __init__(self, hours: np.ndarray, values: np.ndarray, names: Sequence[str]):
        order = np.argsort(hours)
        self.hours, self.values = hours[order], values[order]
        self.place = {name: k for k, name in enumerate(names)}

    def at(self, hours: np.ndarray, back: int) -> np.ndarray:
        """Rows of values ``back`` hours before the given hours; NaN where the hour is not known."""
        wanted = hours - back
        k = np.minimum(np.searchsorted(self.hours, wanted), len(self.hours) - 1)
        return np.where((self.hours[k] == wanted)[:, None], self.values[k], np.nan)

    def features(self, hours: np.ndarray, lags: Sequence[int], windows: Sequence[int]) -> dict[str, np.ndarray]:
        """Every column, its lags and its rolling statistics at these hours; a window that is not full has none."""
        made = {name: self.at(hours, 0)[:, k] for name, k in self.place.items()}
        for lag in lags:
            there = self.at(hours, lag)
            made |= {f"{name}_lag_{lag}": there[:, k] for name, k in self.place.items()}
        for w in windows:
            # Added up in the order of Spark's own aggregates: a constant must not differ in the last bit, since
            # standardising would blow that up. A NaN within the window makes both statistics NaN.
            total, mean, squares = 0.0, 0.0, 0.0
            for n, back in enumerate(reversed(range(w)), 1):
                x = self.at(hours, back)
                total = total + x
                delta = x - mean
                step = delta / n
                mean = mean + step
                squares = squares + delta * (delta - step)
            average, spread = total / w, np.sqrt(squares / (w - 1.0)) if w > 1 else np.full_like(total, np.nan)
            for name, k in self.place.items():
                made[f"{name}_rolling_mean_{w}"], made[f"{name}_rolling_std_{w}"] = average[:, k], spread[:, k]
        return made


class RecentHours(StatefulProcessor):
    """State: the values of each hour, no older than ``revise`` hours and the longest look-back before the newest.

    Output: one row for every hour that arrived, and for every known later hour whose lags or windows hold one that did. Hours whose
    whole look-back is no longer kept give nothing: what cannot be computed exactly is left to the batch job.
    """

    def __init__(self, keys, ts, cols, lags, windows, revise, scorer: Scorer | None = None, circle: np.ndarray | None = None, order: str | None = None):
        self.keys, self.ts, self.cols, self.lags, self.windows = keys, ts, cols, lags, windows
        self.revise, self.scorer, self.circle, self.order = revise, scorer, circle, order
        self.lookback = max([*lags, *(w - 1 for w in windows), 0])
        self.offsets = sorted({0, *lags, *range(max(windows, default=1))})

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.hours = handle.getMapState("hours", "hour long", "values array<double>")
        self.floor = handle.getValueState("floor", "hour long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        floor = self.floor.get()[0] if self.floor.exists() else NEVER
        arrived: dict[int, list[float]] = {}
        placed: dict[int, float] = {}
        for chunk in rows:
            numbers = (chunk[self.ts].to_numpy("datetime64[s]").astype("int64") // HOUR).tolist()
            values = chunk[self.cols].to_numpy("float64", na_value=np.nan).tolist()
            if self.order is None:
                arrived.update(zip(numbers, values))
                continue
            for h, place, v in zip(numbers, chunk[ORDER].fillna(NEVER).tolist(), values):
                if h not in placed or place >= placed[h]:
                    arrived[h], placed[h] = v, place
        arrived = {h: v for h, v in arrived.items() if h >= floor}
        if not arrived:
            return
        known = {h[0]: list(v[0]) for h, v in self.hours.iterator()}
        old = set(known)
        known.update(arrived)
        hours = np.fromiter(known, np.int64, len(known))
        values = np.array([known[h] for h in hours.tolist()], dtype="float64")
        newest = int(hours.max())
        keep = max(floor, newest - self.revise - self.lookback)
        for h, v in arrived.items():
            if h >= keep:
                self.hours.updateValue((h,), (v,))
        for h in [h for h in old if h < keep]:
            self.hours.removeKey((h,))
        self.floor.update((keep,))
        touched = np.unique((np.fromiter(arrived, np.int64, len(arrived))[:, None] + np.array(self.offsets)).ravel())
        touched = touched[np.isin(touched, hours) & ((floor == NEVER) | (touched - self.lookback >= floor))]
        if len(touched):
            yield from self.output(key, touched, hours, values)

    def output(self, key, touched: np.ndarray, hours: np.ndarray, values: np.ndarray) -> Iterator[pd.DataFrame]:
        columns: dict[str, object] = {k: [v] * len(touched) for k, v in zip(self.keys, key)}
        times = pd.to_datetime(touched * HOUR, unit="s")
        if self.scorer is None:
            made = Recent(hours, values, self.cols).features(touched, self.lags, self.windows)
            yield pd.DataFrame(columns | {self.ts: times} | {c: made[c] for c in feature_names(self.cols, self.lags, self.windows)})
            return
        recent = Recent(hours, np.concatenate([values, calendar(hours, self.circle)], axis=1), [*self.cols, *TIME_FEATURES])
        made = recent.features(touched, self.lags, self.windows)
        predicted = self.scorer.predict(np.stack([made[name] for name in self.scorer.names], axis=1))
        used = np.searchsorted(recent.hours, touched, side="right") - np.searchsorted(recent.hours, touched - self.lookback)
        columns |= {"prediction_for": times + pd.Timedelta(hours=1), "predicted_value": predicted, "based_on_data_until": times}
        columns |= {"feature_count": np.full(len(touched), len(self.scorer.names), np.int32), "historical_hours_used": used.astype(np.int32)}
        # A correction can also take a value away: without a whole look-back there is no forecast, and no row.
        yield pd.DataFrame(columns)[~np.isnan(predicted)]

    def close(self) -> None:
        pass


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


def feature_names(cols: Sequence[str], lags: Sequence[int], windows: Sequence[int]) -> list[str]:
    rolled = [f"{c}_rolling_{kind}_{w}" for c in cols for w in windows for kind in ("mean", "std")]
    return [*cols, *(f"{c}_lag_{k}" for c in cols for k in lags), *rolled]


def _stateful(df: DataFrame, cols, keys, ts, schema: T.StructType, processor: RecentHours, mode: str) -> DataFrame:
    use_rocksdb(df.sparkSession)
    rows = df.select(
        *keys,
        F.col(ts).cast("timestamp_ntz").alias(ts),
        *[F.col(c).cast("double").alias(c) for c in cols],
        *([F.unix_micros(F.col(processor.order).cast("timestamp")).alias(ORDER)] if processor.order else []),
    )
    schema = T.StructType([*[df.schema[k] for k in keys], *schema.fields])
    return rows.groupBy(*keys).transformWithStateInPandas(statefulProcessor=processor, outputStructType=schema, outputMode=mode, timeMode="none")


def stream_features(
    df: DataFrame,
    col: str | Sequence[str],
    keys: Sequence[str],
    ts: str = "datetime",
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = WINDOWS,
    revise: int = 0,
    order: str | None = None,
) -> DataFrame:
    """Features of each arriving hour, and again of later hours that it changes.

    Lags and windows are by time, as on a gap-free grid. State per series: the values of the longest look-back (168 hours)
    and ``revise`` hours more. An hour that comes late or again, up to ``revise`` hours behind the newest, gives new rows for
    itself and for all known later hours within its reach; a sink that merges by series and hour (``stream_upsert``) then
    equals the batch answer. Older hours are exact as long as their look-back is kept, and otherwise give nothing. Hours that
    come in order, one micro-batch after the other, are never revised, so an append-only sink may take them. Keys are
    required: they are what spreads the state. ``order`` is the time at which a row arrives: of rows of one series and hour in
    one micro-batch the latest stays.
    """
    cols = [col] if isinstance(col, str) else list(col)
    schema = T.StructType([T.StructField(ts, T.TimestampNTZType())])
    for name in feature_names(cols, lags, windows):
        schema = schema.add(name, T.DoubleType())
    processor = RecentHours(list(keys), ts, cols, list(lags), list(windows), revise, order=order)
    return _stateful(df, cols, keys, ts, schema, processor, "append")


def stream_forecast(
    df: DataFrame,
    model: Scorer,
    cols: Sequence[str],
    keys: Sequence[str],
    ts: str = "datetime",
    config: FeatureConfig = FeatureConfig(),
    revise: int = 0,
    order: str | None = None,
) -> DataFrame:
    """A forecast of the next hour for each arriving hour whose look-back is whole, and again for later hours that it changes.

    ``cols`` are the numeric columns that the model's features were built from; calendar columns follow from the hour. The
    columns are those of ``forecast_next``: ``prediction_for``, ``predicted_value``, ``based_on_data_until``,
    ``feature_count`` and ``historical_hours_used``. Lags and windows are by time. State, revisions and ``order`` as in
    ``stream_features``.
    """
    if config.shift or config.with_interactions:
        raise ValueError("the stream builds neither shifted windows nor interactions")
    known = set(feature_names([*cols, *TIME_FEATURES], config.lags, config.windows))
    if missing := [name for name in model.names if name not in known]:
        raise ValueError(f"the stream does not build the features {missing[:5]}")
    schema = T.StructType()
    for name, kind in (("prediction_for", T.TimestampNTZType()), ("predicted_value", T.DoubleType()), ("based_on_data_until", T.TimestampNTZType())):
        schema = schema.add(name, kind)
    schema = schema.add("feature_count", T.IntegerType()).add("historical_hours_used", T.IntegerType())
    processor = RecentHours(list(keys), ts, list(cols), list(config.lags), list(config.windows), revise, model, hour_circle(df.sparkSession), order)
    return _stateful(df, cols, keys, ts, schema, processor, "append")
