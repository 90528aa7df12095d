"""Rolling statistics on a stream from hourly panes with mergeable moments."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidegrid.streaming.features import HOUR, use_rocksdb


def merged(parts: np.ndarray) -> tuple[float, float, float]:
    """Number, mean and sum of squared deviations of groups that each have their own (rows: number, mean, squares)."""
    n = parts[:, 0].sum()
    mean = (parts[:, 0] * parts[:, 1]).sum() / n
    return n, mean, (parts[:, 2] + parts[:, 0] * (parts[:, 1] - mean) ** 2).sum()


class HourPanes(StatefulProcessor):
    """State: number, mean and squared deviations of each hour of the longest window, and one timer for the earliest open hour.

    When the watermark has passed the ends of some hours, all windows that end with these are merged from the panes and
    emitted, and the next timer is that of the earliest hour still open.
    """

    def __init__(self, keys: list[str], ts: str, col: str, windows: list[int]):
        self.keys, self.ts, self.col, self.windows = keys, ts, col, windows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = handle.getMapState("panes", "hour long", "n double, mean double, squares double")
        self.next = handle.getValueState("next", "hour long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = self.next.get()[0] if self.next.exists() else None
        for chunk in rows:
            hour = chunk[self.ts].to_numpy("datetime64[s]").astype("int64") // HOUR
            known = pd.DataFrame({"hour": hour, "x": chunk[self.col].astype("float64")}).dropna()
            for h, x in known.groupby("hour")["x"]:
                own = np.array([[len(x), x.mean(), ((x - x.mean()) ** 2).sum()]])
                if self.panes.containsKey((int(h),)):
                    own = np.concatenate([own, [self.panes.getValue((int(h),))]])
                self.panes.updateValue((int(h),), tuple(float(v) for v in merged(own)))
                if first is None or h < first:
                    first = int(h)
                    self.wait(first)
        return iter(())

    def wait(self, hour: int) -> None:
        self.handle.registerTimer((hour + 1) * HOUR * 1000)
        self.next.update((hour,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.next.exists():
            return
        panes = {h[0]: v for h, v in self.panes.iterator()}
        closed = timerValues.getCurrentWatermarkInMs() // (HOUR * 1000)  # hours before this one
        out = []
        for hour in sorted(h for h in panes if self.next.get()[0] <= h < closed):
            for size in self.windows:
                own = [panes.get(hour - back) for back in range(size)]
                if None not in own:
                    n, mean, squares = merged(np.array(own, dtype="float64"))
                    out.append((*key, pd.Timestamp(hour * HOUR, unit="s"), size, mean, np.sqrt(squares / (n - 1)) if n > 1 else None))
        for h in [h for h in panes if h <= closed - max(self.windows)]:
            self.panes.removeKey((h,))
        if later := [h for h in panes if h >= closed]:
            self.wait(min(later))
        else:
            self.next.clear()
        if out:
            yield pd.DataFrame(out, columns=[*self.keys, self.ts, "window", "rolling_mean", "rolling_std"])

    def close(self) -> None:
        pass


def stream_rolling(
    timed: DataFrame, col: str, windows: Sequence[int], keys: Sequence[str], ts: str = "datetime"
) -> DataFrame:
    """Rolling mean and sample deviation of all values of the last 3, 6 ... hours, per hour and window length.

    ``timed`` has a watermark on ``ts``. A window is emitted when the watermark passes its end, if each of its hours has a
    value. All lengths share one operator; a row enters one pane, and a pane is merged into the windows that end with each
    hour. Rows behind the watermark are dropped. Keys are required: they are what spreads the state.
    """
    use_rocksdb(timed.sparkSession)
    rows = timed.select(*keys, ts, F.col(col).cast("double").alias(col))
    schema = T.StructType([rows.schema[k] for k in keys])
    schema = schema.add(ts, T.TimestampNTZType()).add("window", T.IntegerType())
    schema = schema.add("rolling_mean", T.DoubleType()).add("rolling_std", T.DoubleType())
    return rows.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=HourPanes(list(keys), ts, col, list(windows)), outputStructType=schema, outputMode="append", timeMode="EventTime"
    )
