"""Ordered computation over a series without ever putting a whole series in one task.

A plain ``Window.partitionBy(keys).orderBy(ts)`` sends each series to one task, which fails as soon as one series
holds a large share of the rows (and always when there are no keys). The helpers here cut every series into
*segments* (calendar blocks of ``ts``) or *runs* (blocks of consecutive rows), work inside them, and carry what
crosses a border:

* ``with_position``: exact row number. Rows per segment are counted, counts are summed over the (few) segments of a
  series, and the sum is joined back as the segment's offset.
* ``with_neighbours``: nearest non-NULL value before and after each row, with its row number. The first and last
  non-NULL of each segment travel across borders the same way.
* ``framed``: any ROWS frame of bounded size. Rows near the end of a run are copied into the next run as a halo, so
  each run is complete on its own; the copies are dropped afterwards.

Sizes: a segment summary holds one row per (series, segment), e.g. 1 200 for a century of months. Segment size is
bounded by the grain of the series (744 hourly slots in a month), because (keys, ts) is unique after
``dedup_first``; choose a smaller ``unit`` for finer grains.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tidegrid.sources.spine import step_seconds

UNIT = "MONTH"
RUN_ROWS = 4096

SEG, POS, TOTAL, RUN, SLOT = "__seg", "__pos", "__total", "__run", "__slot"
RUNNING = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"

# Builds window columns from the text of a window's partitioning and order; frames are added by the builder. Text keeps
# wide matrices cheap to declare: one parsed expression per column.
Build = Callable[[str], Sequence[Column]]


def quoted(name: str) -> str:
    return f"`{name}`"


def over_text(parts: Sequence[str], order: str) -> str:
    by = f"PARTITION BY {', '.join(quoted(p) for p in parts)} " if parts else ""
    return f"{by}ORDER BY {quoted(order)}"


def segment(ts: str, unit: str | int = UNIT) -> Column:
    """Calendar block of a timestamp, or block of ``unit`` consecutive numbers when the order column is an integer."""
    if isinstance(unit, int):
        return F.floor(F.col(ts) / unit)
    return F.date_trunc(unit, F.col(ts)).cast("timestamp_ntz")


def _grouped(df: DataFrame, keys: Sequence[str], ts: str, unit: str | int) -> DataFrame:
    # One struct column as the grouping key: structs compare field by field with NULL = NULL, so series with a
    # NULL key survive the join back without a null-safe (and re-shuffling) condition.
    return df.withColumn(SEG, F.struct(*[F.col(k) for k in keys], segment(ts, unit).alias(SEG)))


def _series_window(keys: Sequence[str]) -> WindowSpec:
    """Over a segment summary only: one row per (series, segment)."""
    return Window.partitionBy(*[F.col(SEG)[k] for k in keys]) if keys else Window.partitionBy(F.lit(0))


def _before(keys: Sequence[str]) -> WindowSpec:
    return _series_window(keys).orderBy(F.col(SEG)[SEG]).rowsBetween(Window.unboundedPreceding, -1)


def with_position(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    unit: str | int = UNIT,
    order: Sequence[Column] = (),
    pos: str = POS,
    total: str = TOTAL,
) -> DataFrame:
    """Add the 1-based row number within the series and the number of rows of the series."""
    grouped = _grouped(df, keys, ts, unit)
    whole = _series_window(keys)
    offsets = (
        grouped.groupBy(SEG)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .select(
            SEG,
            F.coalesce(F.sum("__rows").over(_before(keys)), F.lit(0)).alias("__offset"),
            F.sum("__rows").over(whole).alias(total),
        )
    )
    inside = Window.partitionBy(SEG).orderBy(F.col(ts), *order)
    return (
        grouped.withColumn("__inside", F.row_number().over(inside))
        .join(offsets, SEG)
        .withColumn(pos, F.col("__offset") + F.col("__inside"))
        .select(*df.columns, pos, total)
    )


def neighbour_names(col: str) -> tuple[str, str, str, str]:
    return f"__pv_{col}", f"__pi_{col}", f"__nv_{col}", f"__ni_{col}"


def with_neighbours(
    df: DataFrame, cols: Sequence[str], keys: Sequence[str], ts: str, unit: str | int = UNIT
) -> DataFrame:
    """Add the row number and, per column, value and row number of the nearest non-NULL at or before / at or after."""
    up = f"(PARTITION BY {SEG} ORDER BY {quoted(ts)} {RUNNING})"
    # Descending order keeps the frame a running one; UNBOUNDED FOLLOWING frames are quadratic.
    down = f"(PARTITION BY {SEG} ORDER BY {quoted(ts)} DESC {RUNNING})"
    rank = F.row_number().over(Window.partitionBy(SEG).orderBy(ts)).alias("__inside")
    ranked = _grouped(df, keys, ts, unit).select("*", rank)

    def at(c: str) -> str:
        return f"CASE WHEN {quoted(c)} IS NOT NULL THEN __inside END"

    # Border values of each segment, then what reaches it from the segments before and after.
    edges = ranked.groupBy(SEG).agg(
        F.expr("count(1) AS __rows"),
        *[
            F.expr(f"{f} AS {quoted(side + c)}")
            for c in cols
            for side, f in (
                ("first_v_", f"min_by({quoted(c)}, {at(c)})"),
                ("first_i_", f"min({at(c)})"),
                ("last_v_", f"max_by({quoted(c)}, {at(c)})"),
                ("last_i_", f"max({at(c)})"),
            )
        ],
    )
    edges = edges.withColumn("__offset", F.coalesce(F.sum("__rows").over(_before(keys)), F.lit(0)))
    part = f"PARTITION BY {', '.join(f'{SEG}.{quoted(k)}' for k in keys)} " if keys else ""
    before, after = (
        f"({part}ORDER BY {SEG}.{SEG}{way} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)" for way in ("", " DESC")
    )

    def carry(side: str, c: str, over: str, name: str) -> str:
        value, place = quoted(f"{side}_v_{c}"), quoted(f"{side}_i_{c}")
        edge = f"CASE WHEN {place} IS NOT NULL THEN named_struct('v', {value}, 'i', __offset + {place}) END"
        return f"last({edge}, true) OVER {over} AS {quoted(name + c)}"

    carried = edges.selectExpr(
        SEG,
        "__offset",
        *[carry("last", c, before, "before_") for c in cols],
        *[carry("first", c, after, "after_") for c in cols],
    )
    near, out = [], []
    for c in cols:
        pv, pi, nv, ni = (quoted(x) for x in neighbour_names(c))
        for value, place, over in ((pv, pi, up), (nv, ni, down)):
            near += [f"last({quoted(c)}, true) OVER {over} AS {value}", f"last({at(c)}, true) OVER {over} AS {place}"]
        for value, place, side in ((pv, pi, f"before_{c}"), (nv, ni, f"after_{c}")):
            out += [
                f"coalesce({value}, {quoted(side)}.v) AS {value}",
                f"coalesce(__offset + {place}, {quoted(side)}.i) AS {place}",
            ]
    columns = [quoted(c) for c in df.columns]
    local = ranked.selectExpr(*columns, SEG, "__inside", *near)
    return local.join(carried, SEG).selectExpr(*columns, f"__offset + __inside AS {POS}", *out)


def framed(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    lookback: int,
    build: Build,
    unit: str | int | None = UNIT,
    run_rows: int = RUN_ROWS,
    lookahead: int = 0,
) -> DataFrame:
    """Append ``build(over)`` where every frame reaches at most ``lookback`` ROWS back and ``lookahead`` ahead. Exact
    on any grid.

    ``unit=None`` uses one plain window per series (one shuffle instead of two): right when every series is known to
    fit in a task.
    """
    if unit is None:
        return df.select("*", *build(over_text(keys, ts)))
    placed = with_position(df, keys, ts, unit)
    span = (F.lit(0), F.col(TOTAL) - 1)
    return _haloed(placed, df.columns, keys, F.col(POS) - 1, span, POS, lookback, lookahead, build, run_rows)


def framed_by_time(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    lookback: int,
    build: Build,
    step: str = "1 hour",
    run_rows: int = RUN_ROWS,
    lookahead: int = 0,
) -> DataFrame:
    """Same with RANGE frames over the slot number of ``ts``. One shuffle, no counting: the slot is a function of ts."""
    # The window orders by the slot, so frame bounds count steps of the grid.
    placed = df.withColumn(SLOT, slot_number(ts, step))
    return _haloed(placed, df.columns, keys, F.col(SLOT), None, SLOT, lookback, lookahead, build, run_rows)


def slot_number(ts: str, step: str = "1 hour") -> Column:
    origin = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.floor(F.timestamp_diff("MICROSECOND", origin, F.col(ts)) / (step_seconds(step) * 1_000_000))


def _haloed(placed, columns, keys, place, span, order, lookback, lookahead, build, run_rows) -> DataFrame:
    size = max(run_rows, lookback + 1, lookahead + 1)
    own = F.floor(place / size)
    first = F.floor((place - lookahead) / size) if lookahead else own
    last = F.floor((place + lookback) / size)
    if span is not None:
        first, last = F.greatest(first, F.floor(span[0] / size)), F.least(last, F.floor(span[1] / size))
    runs = placed.withColumn(RUN, F.explode(F.sequence(first, last)))
    return (
        runs.select(*columns, RUN, order, own.alias("__own"), *build(over_text([*keys, RUN], order)))
        .where(F.col(RUN) == F.col("__own"))
        .drop(RUN, order, "__own")
    )
