"""Filters, deduplication and contract checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidegrid.operators.joins import join_stats, with_scalars
from tidegrid.operators.segments import UNIT, framed, quoted
from tidegrid.schemas import CANONICAL_REQUIRED, CORRUPT

Limits = dict[str, tuple[float | None, float | None]]

# Fixed documented ranges; off unless asked for.
RANGE_RULES: Limits = {"temperature": (15.0, 40.0), "humidity": (30.0, 100.0), "wind_speed": (0.0, 50.0)}
MAX_MISSING_RATIO = 0.3


def dedup_first(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[Column | str]) -> DataFrame:
    """One row per (keys, ts): the first by ``order``.

    An aggregate rather than a ranking window, so each map task already reduces a hot group of copies to one row.
    """
    group = [*keys, ts]
    rest = [c for c in df.columns if c not in group]
    place = F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order)])
    if not rest:
        return df.dropDuplicates(group)
    first = F.min_by(F.struct(*rest), place).alias("__row")
    return df.groupBy(*group).agg(first).select(*[F.col(c) if c in group else F.col("__row")[c].alias(c) for c in df.columns])


def dedup_last(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[Column | str]) -> DataFrame:
    """One row per (keys, ts): the last by ``order``."""
    group = [*keys, ts]
    rest = [c for c in df.columns if c not in group]
    place = F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order)])
    last = F.max_by(F.struct(*rest), place).alias("__row")
    return df.groupBy(*group).agg(last).select(*[F.col(c) if c in group else F.col("__row")[c].alias(c) for c in df.columns])


def fullest(cols: Sequence[str]) -> list[Column]:
    """Order for copies of which nothing tells the age: fewest NULLs first, then by value, so that the choice is fixed."""
    missing = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in cols], F.lit(0))
    return [missing, *[F.col(c) for c in cols]]


def outside(col: str, low: float | None, high: float | None) -> Column:
    """Strictly outside the closed range."""
    tests = [F.col(col) < low] if low is not None else []
    tests += [F.col(col) > high] if high is not None else []
    bad = tests[0]
    for test in tests[1:]:
        bad = bad | test
    return bad


def null_outliers(df: DataFrame, limits: Limits) -> DataFrame:
    """Values outside their closed range become NULL; the row stays."""
    return df.withColumns({c: F.when(outside(c, *v), None).otherwise(F.col(c)) for c, v in limits.items()})


def outlier_counts(df: DataFrame, limits: Limits, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.count_if(outside(c, *v)).alias(f"{c}_outliers") for c, v in limits.items()])


def range_violations(df: DataFrame, rules: Limits = RANGE_RULES) -> DataFrame:
    """Rows breaking any documented range, with the list of offending columns."""
    offending = F.array_compact(F.array(*[F.when(outside(c, *v), F.lit(c)) for c, v in rules.items() if c in df.columns]))
    return df.withColumn("violations", offending).where(F.size("violations") > 0)


def zscore_outliers(df: DataFrame, cols: Sequence[str], threshold: float = 3.5, keys: Sequence[str] = ()) -> DataFrame:
    """Rows with |x - mean| > threshold * sample deviation for any column, per series.

    Moments are partial-aggregated per series and joined back; a hot series is neither one task's window nor shuffled.
    """
    moments = [f(F.col(c)).alias(f"__{n}_{c}") for c in cols for n, f in (("avg", F.avg), ("std", F.stddev_samp))]
    bad = None
    for c in cols:
        test = F.abs(F.col(c) - F.col(f"__avg_{c}")) > threshold * F.col(f"__std_{c}")
        bad = test if bad is None else bad | test
    if keys:
        group = F.struct(*keys)
        stats = df.groupBy(group.alias("__k")).agg(*moments, F.count(F.lit(1)).alias("__size"))
        joined = join_stats(df.withColumn("__k", group), stats, "__k", "__size")
    else:
        joined = with_scalars(df, df.agg(*moments))
    return joined.where(bad).select(*df.columns)


def drop_null_critical(df: DataFrame, cols: Sequence[str] = CANONICAL_REQUIRED) -> DataFrame:
    return df.dropna(subset=[c for c in cols if c in df.columns])


def drop_warmup(df: DataFrame, but: Sequence[str] = ()) -> DataFrame:
    """Drop rows with any NULL (outside the columns ``but``), as lag and rolling columns have at the start of a series.

    One IS NOT NULL per column instead of ``dropna``: its single predicate over all columns makes Catalyst's constraint
    propagation exponential on wide tables.
    """
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in df.columns if c not in but]))


def drop_null_target(df: DataFrame, target: str) -> DataFrame:
    return df.where(F.col(target).isNotNull())


def nan_to_null(df: DataFrame) -> DataFrame:
    real = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in real})


def between(df: DataFrame, ts: str, low, high) -> DataFrame:
    """Inclusive on both ends."""
    return df.where(F.col(ts).between(_time(low), _time(high)))


def between_dates(df: DataFrame, ts: str, first, last) -> DataFrame:
    """Whole calendar days, written as a half-open range so that it reaches the scan."""
    upper = F.date_add(F.lit(str(last)).cast("date"), 1).cast("timestamp_ntz")
    return df.where((F.col(ts) >= _time(first)) & (F.col(ts) < upper))


def _time(value) -> Column:
    return F.lit(value if isinstance(value, Column) else str(value)).cast("timestamp_ntz")


def only_signal(df: DataFrame, signal: str = "total_load") -> DataFrame:
    return df.where(F.col("signal") == signal)


# Contract checks


def payload_problem(source: str) -> Column:
    """NULL for a good document, else the first problem found."""
    if source == "weather":
        hours = F.try_element_at("days", F.lit(1))["hours"]
        return (
            F.when(F.col("days").isNull() | (F.size("days") == 0), "no days")
            .when(hours.isNull() | (F.size(hours) == 0), "no hours")
        )
    return F.when(F.col("data").isNull() & F.col("history").isNull(), "no data or history")


def check_payload(df: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """Split documents into good ones and bad ones with a ``problem`` column. Nothing is raised or lost."""
    problem = payload_problem(source)
    if CORRUPT in df.columns:
        problem = F.when(F.col(CORRUPT).isNotNull(), "unreadable").otherwise(problem)
    marked = df.withColumn("problem", problem)
    return marked.where(F.col("problem").isNull()).drop("problem"), marked.where(F.col("problem").isNotNull())


def check_silver(df: DataFrame, required: Sequence[str] = ("datetime",), ts: str = "datetime") -> DataFrame:
    """One row: row count and whether the contract holds (not empty, required columns, timestamp type)."""
    missing = [c for c in required if c not in df.columns]
    timely = ts in df.columns and isinstance(df.schema[ts].dataType, (T.TimestampNTZType, T.TimestampType))
    rows = F.count(F.lit(1))
    return df.agg(
        rows.alias("row_count"),
        F.lit(",".join(missing)).alias("missing_columns"),
        F.lit(timely).alias("ts_is_timestamp"),
        ((rows > 0) & F.lit(not missing and timely)).alias("valid"),
    )


def check_canonical(
    df: DataFrame, keys: Sequence[str] = (), ts: str = "datetime", required: Sequence[str] = CANONICAL_REQUIRED
) -> DataFrame:
    """One row: rows, NULLs in required columns, repeated (keys, ts) pairs, verdict. Time order is not a table
    property in Spark; uniqueness is what downstream windows rely on."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    nulls = [F.sum(f"__null_{c}").alias(f"null_{c}") for c in required]
    # Pre-aggregated per (keys, ts): a repeated hour collapses before the shuffle.
    slots = df.groupBy(*keys, ts).agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count_if(F.col(c).isNull()).alias(f"__null_{c}") for c in required]
    )
    checked = slots.agg(
        F.coalesce(F.sum("__rows"), F.lit(0)).alias("row_count"),
        *nulls,
        F.coalesce(F.sum(F.col("__rows") - 1), F.lit(0)).alias("repeated_slots"),
    )
    clean = F.col("row_count") > 0
    for c in required:
        clean = clean & (F.col(f"null_{c}") == 0)
    return checked.withColumn("valid", F.coalesce(clean & (F.col("repeated_slots") == 0), F.lit(False)))


def out_of_order(
    df: DataFrame, keys: Sequence[str], ts: str, arrival: str, unit: str | int = UNIT
) -> DataFrame:
    """Rows whose ``ts`` lies before that of the row that arrived just before them in the same series.

    ``arrival`` is a timestamp, or a sequence number with ``unit`` the numbers per segment.
    """
    seen = framed(df, keys, arrival, 1, lambda over: [F.expr(f"lag({quoted(ts)}) OVER ({over}) AS __prev")], unit)
    return seen.where(F.col(ts) < F.col("__prev")).drop("__prev")


def check_features(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Missing features are an error, extra columns are ignored; returns the frame in feature order, keys first."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing features: {missing[:10]}")
    return df
