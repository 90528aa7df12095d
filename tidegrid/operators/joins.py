"""Joins on the hour, attaching one-row aggregates, regular grids and explicit unit products."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidegrid.sources.spine import series_grid


def join_signals(
    weather: DataFrame, load: DataFrame, keys: Sequence[str] = (), ts: str = "datetime", how: str = "inner"
) -> DataFrame:
    """Weather and load of the same hour. The join key holds the hour, so one long series still spreads out."""
    return weather.join(load, [*keys, ts], how)


def join_all_signals(spine: DataFrame, others: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Chained left joins on the same keys: each table is shuffled once, the growing left side never again."""
    shared = set(on)
    for i, other in enumerate(others):
        clash = (set(other.columns) - shared) & set(spine.columns)
        for done in others[:i]:
            clash |= (set(other.columns) & set(done.columns)) - shared
        if clash:
            raise ValueError(f"columns {sorted(clash)} appear in more than one table; drop or rename them first")
    return reduce(lambda left, right: left.join(right, list(on), "left"), others, spine)


def pending_units(wanted: DataFrame, landed: DataFrame, on: Sequence[str]) -> DataFrame:
    """Wanted units that have not landed."""
    return wanted.join(landed.select(*on).distinct(), list(on), "left_anti")


def product_with(df: DataFrame, name: str, values: Sequence) -> DataFrame:
    """Each row once per value of a fixed list; a generator, not a cross join."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))


def align_actual_predicted(
    actual: DataFrame, predicted: DataFrame, keys: Sequence[str] = (), ts: str = "datetime"
) -> DataFrame:
    """Actual and predicted value of the same series and hour (never by array position)."""
    return actual.join(predicted, [*keys, ts], "inner")


def regularise(
    df: DataFrame, keys: Sequence[str] = (), ts: str = "datetime", step: str = "1 hour", start=None, end=None
) -> DataFrame:
    """Put a series on a gap-free grid; missing slots become rows of NULLs.

    The grid runs from the first to the last slot of each series, or over [start, end] when given.
    """
    # Joined on a struct, in which NULL keys are equal, so a series with a NULL key keeps its values.
    slot = F.struct(*keys, ts)
    grid = series_grid(df, keys, ts, step, start, end).withColumn("__slot", slot)
    rest = [c for c in df.columns if c not in (*keys, ts)]
    return grid.join(df.select(slot.alias("__slot"), *rest), "__slot", "left").select(*df.columns)


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a global aggregate through a scalar subquery."""
    row = one_row.select(F.struct(*one_row.columns).alias("s")).scalar()
    return df.withColumn("__s", row).select(*df.columns, *[F.col("__s")[c].alias(c) for c in one_row.columns])


#: A series is hot when it holds more than one in HOT of all rows, so there are at most HOT of them.
HOT = 1000


def join_stats(rows: DataFrame, stats: DataFrame, key: str, size: str) -> DataFrame:
    """``rows`` with the statistics of their key; ``stats`` has one row per key, ``size`` its number of rows.

    Hot keys are at most HOT by their share of all rows: only they are broadcast, so their rows stay where they are. All
    others are shuffled, into partitions that no key can fill. ``key`` is one column without NULLs (a struct of the keys).
    """
    total = stats.agg(F.sum(size)).scalar()
    hot = F.coalesce(F.col(size) * HOT > total, F.lit(False))
    few = stats.where(hot)
    flags = F.broadcast(few.select(key, F.lit(True).alias("__hot")))
    marked = rows.join(flags, key, "left")
    near = marked.where("__hot").drop("__hot").join(F.broadcast(few), key)
    return near.unionByName(marked.where("__hot IS NULL").drop("__hot").join(stats.where(~hot), key))


def with_series_stats(df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    """Attach per-series aggregates. Partial aggregation comes first; a hot series is not shuffled in the join back."""
    if not keys:
        return with_scalars(df, df.agg(*aggs))
    group = F.struct(*keys)
    stats = df.groupBy(group.alias("__k")).agg(*aggs, F.count(F.lit(1)).alias("__size"))
    return join_stats(df.withColumn("__k", group), stats, "__k", "__size").drop("__k", "__size")
