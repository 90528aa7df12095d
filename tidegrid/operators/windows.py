"""Lag and rolling features, gap filling, ordered splits and folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegrid.operators.quality import null_outliers
from tidegrid.operators.segments import (
    POS,
    TOTAL,
    UNIT,
    Build,
    framed,
    framed_by_time,
    neighbour_names,
    quoted,
    with_neighbours,
    with_position,
)
from tidegrid.schemas import CANONICAL_MEASURES

# Fixed values of the feature set.
LAGS = (1, 2, 3, 24, 168)
WINDOWS = (3, 6, 12, 24)
SPLIT_RATIOS = (0.7, 0.15, 0.15)
PHYSICAL_LIMITS = {"temperature": (-10.0, 60.0), "electricity_demand": (0.0, None)}


def lag_columns(cols: Sequence[str], lags: Sequence[int], by: str = "rows") -> Build:
    def one(c: str, k: int, over: str) -> str:
        if by == "rows":
            return f"lag({quoted(c)}, {k}) OVER ({over})"
        return f"first({quoted(c)}) OVER ({over} RANGE BETWEEN {k} PRECEDING AND {k} PRECEDING)"

    return lambda over: [F.expr(f"{one(c, k, over)} AS {quoted(f'{c}_lag_{k}')}") for c in cols for k in lags]


def rolling_columns(cols: Sequence[str], windows: Sequence[int], by: str = "rows", shift: int = 0) -> Build:
    """Mean and sample deviation; NULL unless the frame holds ``size`` non-NULL values."""
    kind = "ROWS" if by == "rows" else "RANGE"
    last = f"{shift} PRECEDING" if shift else "CURRENT ROW"

    def build(over: str) -> list[Column]:
        out = []
        for c in cols:
            for size in windows:
                frame = f"({over} {kind} BETWEEN {size - 1 + shift} PRECEDING AND {last})"
                full = f"count({quoted(c)}) OVER {frame} = {size}"
                for name, f in (("mean", "avg"), ("std", "stddev_samp")):
                    value = f"CASE WHEN {full} THEN {f}({quoted(c)}) OVER {frame} END"
                    out.append(F.expr(f"{value} AS {quoted(f'{c}_rolling_{name}_{size}')}"))
        return out

    return build


def _framed(df, keys, ts, lookback, build, by, unit):
    if by == "rows":
        return framed(df, keys, ts, lookback, build, unit)
    return framed_by_time(df, keys, ts, lookback, build)


def lag_features(
    df: DataFrame,
    cols: Sequence[str],
    lags: Sequence[int] = LAGS,
    keys: Sequence[str] = (),
    ts: str = "datetime",
    by: str = "rows",
    unit: str | None = UNIT,
) -> DataFrame:
    """``{col}_lag_{k}``: the value k rows earlier (``by="time"``: k hours earlier)."""
    return _framed(df, keys, ts, max(lags), lag_columns(cols, lags, by), by, unit)


def rolling_features(
    df: DataFrame,
    cols: Sequence[str],
    windows: Sequence[int] = WINDOWS,
    keys: Sequence[str] = (),
    ts: str = "datetime",
    by: str = "rows",
    shift: int = 0,
    unit: str | None = UNIT,
) -> DataFrame:
    """``{col}_rolling_mean_{w}`` and ``{col}_rolling_std_{w}``; ``shift=1`` leaves the current row out."""
    return _framed(df, keys, ts, max(windows) + shift - 1, rolling_columns(cols, windows, by, shift), by, unit)


def _replace(df: DataFrame, source: DataFrame, values: dict[str, Column]) -> DataFrame:
    return source.select(*[values[c].alias(c) if c in values else F.col(c) for c in df.columns])


def ffill(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (), ts: str = "datetime", unit: str = UNIT):
    """Last non-NULL value at or before each row."""
    near = with_neighbours(df, cols, keys, ts, unit)
    return _replace(df, near, {c: F.col(neighbour_names(c)[0]) for c in cols})


def bfill(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (), ts: str = "datetime", unit: str = UNIT):
    """First non-NULL value at or after each row."""
    near = with_neighbours(df, cols, keys, ts, unit)
    return _replace(df, near, {c: F.col(neighbour_names(c)[2]) for c in cols})


def _interpolated(c: str, limit: int, fill_rest: bool) -> Column:
    pv, pi, nv, ni = (quoted(n) for n in neighbour_names(c))
    since, until = f"({POS} - {pi})", f"({ni} - {POS})"
    slope = f"({nv} - {pv}) / ({ni} - {pi})"
    # Forward fill repeats the last interpolated value of a long gap; the ends take the nearest value.
    rest = f"{pv} + {slope} * {limit}" if fill_rest else "NULL"
    inner = f"CASE WHEN {since} <= {limit} OR {until} <= {limit} THEN {pv} + {slope} * {since} ELSE {rest} END"
    before = nv if fill_rest else f"CASE WHEN {until} <= {limit} THEN {nv} END"
    after = pv if fill_rest else f"CASE WHEN {since} <= {limit} THEN {pv} END"
    return F.expr(
        f"CASE WHEN {quoted(c)} IS NOT NULL THEN {quoted(c)} WHEN {pi} IS NOT NULL AND {ni} IS NOT NULL THEN {inner} "
        f"WHEN {ni} IS NOT NULL THEN {before} WHEN {pi} IS NOT NULL THEN {after} END"
    )


def interpolate_linear(
    df: DataFrame,
    cols: Sequence[str],
    limit: int = 3,
    keys: Sequence[str] = (),
    ts: str = "datetime",
    fill_rest: bool = False,
    unit: str = UNIT,
) -> DataFrame:
    """Linear by row position, at most ``limit`` rows in from each side of a gap, ends take the nearest value.

    ``fill_rest`` adds the forward and then backward fill of what is left, in the same pass.
    """
    near = with_neighbours(df, cols, keys, ts, unit)
    return _replace(df, near, {c: _interpolated(c, limit, fill_rest) for c in cols})


def impute_canonical(
    df: DataFrame,
    keys: Sequence[str] = (),
    ts: str = "datetime",
    cols: Sequence[str] = CANONICAL_MEASURES,
    limits: dict[str, tuple[float | None, float | None]] = PHYSICAL_LIMITS,
    fill_rest: bool = True,
    unit: str = UNIT,
    cut=lambda d: d,
) -> DataFrame:
    """Fill, set physical outliers to NULL, fill again.

    The second pass only touches columns that have limits: the others cannot have new NULLs. ``cut`` may store the
    rows between the passes (see ``session.cut_lineage``) so that a deep input is not computed again.
    """
    cols = [c for c in cols if c in df.columns]
    limits = {c: v for c, v in limits.items() if c in cols}
    filled = interpolate_linear(df, cols, 3, keys, ts, fill_rest, unit)
    if not limits:
        return filled
    return interpolate_linear(null_outliers(cut(filled), limits), list(limits), 3, keys, ts, fill_rest, unit)


def time_split(
    df: DataFrame,
    ratios: Sequence[float] = SPLIT_RATIOS,
    keys: Sequence[str] = (),
    ts: str = "datetime",
    unit: str = UNIT,
) -> DataFrame:
    """Add ``split``: the first rows are train, then val, the remainder test; sizes are floored."""
    if abs(sum(ratios) - 1.0) > 0.01:
        raise ValueError(f"split ratios must add up to 1, got {sum(ratios)}")
    train = F.floor(F.col(TOTAL) * F.lit(float(ratios[0])))
    val = F.floor(F.col(TOTAL) * F.lit(float(ratios[1])))
    label = F.when(F.col(POS) <= train, "train").when(F.col(POS) <= train + val, "val").otherwise("test")
    return with_position(df, keys, ts, unit).withColumn("split", label).drop(POS, TOTAL)


def time_folds(
    df: DataFrame, k: int = 5, keys: Sequence[str] = (), ts: str = "datetime", unit: str = UNIT
) -> DataFrame:
    """Expanding-window folds: one row per (fold, row) with ``role`` train or test.

    Test blocks have n // (k + 1) rows and end at the last row; train is everything before the block. A row is
    emitted only for the folds that use it, at most k times.
    """
    size = F.floor(F.col(TOTAL) / (k + 1))
    start = F.col(TOTAL) - (F.lit(k + 1) - F.col("fold")) * size
    placed = with_position(df, keys, ts, unit).where(size > 0)
    folds = placed.select("*", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("fold"))
    return (
        folds.where(F.col(POS) <= start + size)
        .withColumn("role", F.when(F.col(POS) <= start, "train").otherwise("test"))
        .drop(POS, TOTAL)
    )


def tail_n(df: DataFrame, n: int = 24, keys: Sequence[str] = (), ts: str = "datetime") -> DataFrame:
    """Last n rows of each series. Spark keeps only n rows per series and map task before the shuffle."""
    return _ranked(df, n, keys, F.col(ts).desc())


def horizon(df: DataFrame, h: int = 24, keys: Sequence[str] = (), ts: str = "datetime") -> DataFrame:
    """First h rows of each series."""
    return _ranked(df, h, keys, F.col(ts).asc())


def _ranked(df: DataFrame, n: int, keys: Sequence[str], order: Column) -> DataFrame:
    if not keys:
        return df.orderBy(order).limit(n)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return df.withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")
