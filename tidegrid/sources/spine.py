"""Date and hour spines and the target of a scheduled run."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed first day of the history.
HISTORY_START = date(2021, 10, 27)
CHUNK = 1024


def date_spine(spark: SparkSession, start, end, unit: str = "DAY", name: str = "datetime") -> DataFrame:
    """Every day or hour from start to end, both inclusive."""
    if unit.upper() == "DAY":
        lo, hi = (F.lit(str(v)).cast("date") for v in (start, end))
    else:
        lo, hi = (F.lit(str(v)).cast("timestamp_ntz") for v in (start, end))
    slots = F.sequence(lo, hi, F.expr(f"INTERVAL 1 {unit}"))
    return spark.range(1).select(F.explode(slots).alias(name))


def series_grid(
    df: DataFrame, keys: Sequence[str], ts: str, step: str = "1 hour", start=None, end=None
) -> DataFrame:
    """All slots of each series.

    The bounds are one partial-aggregated row per series. They are expanded in two steps, first to chunks of slots that
    are spread over the tasks, so neither one long array nor one long series is a single task's work.
    """
    low = F.min(ts) if start is None else F.lit(str(start)).cast("timestamp_ntz")
    high = F.max(ts) if end is None else F.lit(str(end)).cast("timestamp_ntz")
    chunk = f"INTERVAL {CHUNK * step_seconds(step)} SECOND"
    bounds = df.groupBy(*keys).agg(low.alias("__low"), high.alias("__high")).where("__low <= __high")
    chunks = bounds.selectExpr(
        *[f"`{k}`" for k in keys], "__high", f"explode(sequence(__low, __high, {chunk})) AS __from"
    ).repartition(*keys, "__from")
    last = f"least(__from + INTERVAL {(CHUNK - 1) * step_seconds(step)} SECOND, __high)"
    slots = f"explode(sequence(__from, {last}, INTERVAL {step})) AS `{ts}`"
    return chunks.selectExpr(*[f"`{k}`" for k in keys], slots)


def step_seconds(step: str) -> int:
    """Length of a step such as ``1 hour`` or ``15 minutes``."""
    count, unit = step.split()
    return int(count) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def run_target(mode: str, now: datetime, history_start: date = HISTORY_START) -> dict:
    """What a scheduled run covers: all days up to yesterday, the previous hour, yesterday, or the previous month."""
    yesterday = now.date() - timedelta(days=1)
    mode = mode.upper()
    if mode == "BACKFILL":
        return {"start": history_start, "end": yesterday}
    if mode == "HOURLY":
        hour = now.replace(minute=0, second=0, microsecond=0) - timedelta(hours=1)
        return {"date": hour.date(), "hour": f"{hour:%H}"}
    if mode in ("DAILY", "COMPACTION", "COMPACTION_DAILY"):
        return {"date": yesterday}
    if mode == "COMPACTION_MONTHLY":
        last = now.date().replace(day=1) - timedelta(days=1)
        return {"year": last.year, "month": last.month}
    raise ValueError(f"unknown mode {mode}")
