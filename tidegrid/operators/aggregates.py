"""Per-series summaries, forecast metrics and run tallies."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegrid.functions import errors
from tidegrid.operators.joins import join_stats, with_scalars, with_series_stats
from tidegrid.operators.segments import UNIT, framed, quoted

TREND_PERCENT = 1.0
DIGEST = 10000
BUCKETS = 4096


def exact_percentiles(df: DataFrame, col: str, levels: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """Exact interpolated percentiles per series, named ``p0``, ``p1``, ... in the order of ``levels``.

    The built-in exact percentile keeps all distinct values of a group in one buffer. Here the wanted rank is searched for by
    counting: a quantile sketch (bounded size, merged map-side) brackets it, one pass counts the values below the bracket and
    in BUCKETS equal parts of it, and only the values of the one part that holds the rank, some n * 6 / DIGEST / BUCKETS of
    n, are ranked, pre-aggregated by value. All passes combine before they shuffle, and a hot series is counted where its
    rows are.
    """
    slack = 3.0 / DIGEST
    values = df.where(F.col(col).isNotNull()).select((F.struct(*keys) if keys else F.struct(F.lit(0))).alias("__k"), F.col(col).cast("double").alias("__v"))
    wanted = [q for level in levels for q in (max(0.0, level - slack), min(1.0, level + slack))]
    sketch = values.groupBy("__k").agg(
        F.percentile_approx("__v", wanted, DIGEST).alias("__q"),
        F.min("__v").alias("__min"),
        F.max("__v").alias("__max"),
        F.count(F.lit(1)).alias("__n"),
    )
    # Short series are searched whole: the sketch holds them anyway and rounding of ranks could slip.
    small = F.col("__n") <= DIGEST
    places = [
        F.struct(
            F.lit(j).alias("j"),
            F.floor(F.lit(level) * (F.col("__n") - 1)).alias("r0"),
            F.ceil(F.lit(level) * (F.col("__n") - 1)).alias("r1"),
            (F.lit(level) * (F.col("__n") - 1) - F.floor(F.lit(level) * (F.col("__n") - 1))).alias("w"),
            F.when(small, F.col("__min")).otherwise(F.col("__q")[2 * j]).alias("low"),
            F.when(small, F.col("__max")).otherwise(F.col("__q")[2 * j + 1]).alias("high"),
        )
        for j, level in enumerate(levels)
    ]
    brackets = sketch.select("__k", "__n", F.array(*places).alias("__b"))

    def attached(rows: DataFrame, stats: DataFrame) -> DataFrame:
        if keys:
            return join_stats(rows, stats, "__k", "__n")
        return with_scalars(rows, stats.drop("__k"))

    near = attached(values, brackets).select("__k", "__n", "__v", F.explode("__b").alias("b"))
    share = F.try_divide(F.col("__v") - F.col("b.low"), F.col("b.high") - F.col("b.low"))
    part = F.when(F.col("__v") < F.col("b.low"), F.lit(-1)).otherwise(F.least(F.floor(F.coalesce(share, F.lit(0.0)) * BUCKETS), F.lit(BUCKETS - 1)))
    near = near.where(F.col("__v") <= F.col("b.high")).withColumn("part", part)
    counted = near.groupBy("__k", "__n", "b", "part").agg(F.count(F.lit(1)).alias("c"), F.min("__v").alias("first"), F.max("__v").alias("last"))
    # At most BUCKETS + 1 rows of a series and level meet in this window.
    upto = F.sum("c").over(Window.partitionBy("__k", "b.j").orderBy("part"))
    placed = counted.withColumn("upto", upto).withColumn("below", F.col("upto") - F.col("c"))

    def holds(rank: Column) -> Column:
        return (F.col("below") <= rank) & (rank < F.col("upto"))

    # A part that holds only one of the two ranks holds the lower one as its last value, or the upper one as its first.
    low, high = holds(F.col("b.r0")), holds(F.col("b.r1"))
    chosen = placed.where(low | high).groupBy("__k", "__n", "b").agg(
        F.max(F.when(low & (~high | (F.col("first") == F.col("last"))), F.col("last"))).alias("v0"),
        F.max(F.when(high & (~low | (F.col("first") == F.col("last"))), F.col("first"))).alias("v1"),
        F.max(F.when(low & high, F.col("part"))).alias("inside"),
        F.max(F.when(low & high, F.col("below"))).alias("before"),
    )
    # Values of the parts that hold both ranks and more than one value.
    chosen_parts = F.collect_list(F.struct(F.col("b.j").alias("j"), "inside", "before")).alias("parts")
    open_ = chosen.where("v0 IS NULL").groupBy("__k", *(["__n"] if keys else [])).agg(chosen_parts)
    met = attached(near.drop("__n"), open_).withColumn("p", F.explode("parts"))
    met = met.where((F.col("p.j") == F.col("b.j")) & (F.col("p.inside") == F.col("part")))
    tallied = met.groupBy("__k", F.col("b.j").alias("j"), F.col("b.r0").alias("r0"), F.col("b.r1").alias("r1"), F.col("p.before").alias("before"), "__v").agg(F.count(F.lit(1)).alias("c"))
    upto = F.col("before") + F.sum("c").over(Window.partitionBy("__k", "j").orderBy("__v"))
    ranked = tallied.withColumn("upto", upto).withColumn("below", F.col("upto") - F.col("c"))
    fine = ranked.groupBy("__k", "j").agg(
        F.max(F.when(holds(F.col("r0")), F.col("__v"))).alias("f0"), F.max(F.when(holds(F.col("r1")), F.col("__v"))).alias("f1")
    )
    both = chosen.select("__k", F.col("b.j").alias("j"), F.col("b.w").alias("w"), "v0", "v1").join(fine, ["__k", "j"], "left")
    one = F.coalesce("v0", "f0") + (F.coalesce("v1", "f1") - F.coalesce("v0", "f0")) * F.col("w")
    result = both.groupBy("__k").agg(*[F.max(F.when(F.col("j") == j, one)).alias(f"p{j}") for j in range(len(levels))])
    return result.select(*[F.col("__k")[k].alias(k) for k in keys], *[f"p{j}" for j in range(len(levels))])


def series_stats(df: DataFrame, col: str, keys: Sequence[str] = ()) -> DataFrame:
    """min, max, mean, sample std and exact median; zeros for an empty input without keys."""
    moments = [
        F.min(col).alias("min"),
        F.max(col).alias("max"),
        F.avg(col).alias("mean"),
        F.stddev_samp(col).alias("std"),
    ]
    middle = exact_percentiles(df, col, [0.5], keys).withColumnRenamed("p0", "median")
    if keys:
        group = F.struct(*keys)
        stats = df.groupBy(*keys).agg(*moments).withColumn("__k", group)
        return stats.join(middle.select(group.alias("__k"), "median"), "__k", "left").drop("__k")
    zero = F.lit(0.0)
    one = df.agg(F.count(col).alias("__n"), *moments).withColumn("median", middle.select("median").scalar())
    names = ("min", "max", "mean", "std", "median")
    return one.select(*[F.when(F.col("__n") == 0, zero).otherwise(F.col(c)).alias(c) for c in names])


def missing_profile(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """NULL count and percent per column, one pass and one row per (series, column)."""
    cols = [c for c in df.columns if c not in keys]
    counted = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count_if(F.col(c).isNull()).alias(f"m_{c}") for c in cols]
    )
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m_{c}").alias("missing")) for c in cols])
    long = counted.select(*keys, "__rows", F.explode(cells).alias("c"))
    percent = F.try_divide(F.col("c.missing") * 100.0, F.col("__rows"))
    return long.select(*keys, "c.column", "c.missing", percent.alias("missing_pct"))


def missing_total(df: DataFrame) -> DataFrame:
    """NULL cells of the whole table and their percent."""
    missing = reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in df.columns])
    rows = F.count(F.lit(1))
    return df.agg(
        missing.alias("missing"), F.try_divide(missing * 100.0, rows * len(df.columns)).alias("missing_pct")
    )


def table_profile(df: DataFrame, ts: str = "datetime") -> DataFrame:
    """Rows, columns, columns per type, missing cells, time range and whole days covered."""
    types: dict[str, int] = {}
    for f in df.schema:
        types[f.dataType.simpleString()] = types.get(f.dataType.simpleString(), 0) + 1
    missing = reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in df.columns])
    kinds = [x for name, n in sorted(types.items()) for x in (F.lit(name), F.lit(n))]
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.lit(len(df.columns)).alias("total_columns"),
        F.create_map(*kinds).alias("column_types"),
        missing.alias("missing_values"),
        F.min(ts).alias("start"),
        F.max(ts).alias("end"),
        F.timestamp_diff("DAY", F.min(ts), F.max(ts)).alias("days"),
    )


def split_stats(df: DataFrame, target: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys, "split").agg(
        F.count(F.lit(1)).alias("samples"),
        F.avg(target).alias("target_mean"),
        F.stddev_samp(target).alias("target_std"),
    )


def forecast_metrics(df: DataFrame, y: str, p: str, keys: Sequence[str] = ()) -> DataFrame:
    """rmse, mape, mae, r2 and forecast_bias in one aggregation."""
    return df.groupBy(*keys).agg(
        errors.rmse(y, p).alias("rmse"),
        errors.mape(y, p).alias("mape"),
        errors.mae(y, p).alias("mae"),
        errors.r2(y, p).alias("r2"),
        errors.bias(y, p).alias("forecast_bias"),
    )


def validate_predictions(df: DataFrame, y: str, p: str, low: str, high: str, keys: Sequence[str] = ()) -> DataFrame:
    """The five metrics plus interval coverage and skipped MAPE rows."""
    return df.groupBy(*keys).agg(
        errors.rmse(y, p).alias("rmse"),
        errors.mape(y, p).alias("mape"),
        errors.mape_skipped(y).alias("mape_skipped"),
        errors.mae(y, p).alias("mae"),
        errors.r2(y, p).alias("r2"),
        errors.bias(y, p).alias("bias"),
        errors.coverage(y, low, high).alias("coverage"),
    )


def direction_accuracy(
    df: DataFrame, y: str, p: str, keys: Sequence[str] = (), ts: str = "datetime", unit: str | None = UNIT
) -> DataFrame:
    """Percent of steps whose rise (> 0) is predicted, over consecutive rows; NULL for fewer than two rows."""

    def steps(over: str) -> list[Column]:
        pairs = ((y, "__actual_up"), (p, "__predicted_up"))
        return [F.expr(f"{quoted(c)} - lag({quoted(c)}) OVER ({over}) > 0 AS {name}") for c, name in pairs]

    hit = (F.col("__actual_up") == F.col("__predicted_up")).cast("int")
    stepped = framed(df.select(*keys, ts, y, p), keys, ts, 1, steps, unit)
    return stepped.groupBy(*keys).agg((F.avg(hit) * 100.0).alias("direction_accuracy"))


def melt_metrics(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per metric."""
    return df.unpivot(list(keep), list(names), "metric", "value")


def aggregate_folds(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean, population std, min and max of each metric over folds (long input: metric, value)."""
    return df.groupBy(*keys, "metric").agg(
        F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )


def overfit_check(df: DataFrame, train: str = "train_rmse", val: str = "val_rmse", threshold: float = 0.2) -> DataFrame:
    """(val - train) / train against the threshold; undetermined for a train error of zero or none."""
    gap = F.try_divide(F.col(val) - F.col(train), F.col(train))
    return df.withColumns(
        {
            "relative_gap": gap,
            "is_overfitting": F.coalesce(gap > threshold, F.lit(False)),
            "verdict": F.when(gap.isNull(), "undetermined").when(gap > threshold, "overfitting").otherwise("ok"),
        }
    )


def peak(df: DataFrame, value: str, ts: str = "datetime", keys: Sequence[str] = ()) -> DataFrame:
    """Largest value and its time; the earliest wins a tie."""
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(value).alias("v"), -_micros(ts)))
    return df.groupBy(*keys).agg(F.max(value).alias("peak_value"), F.max_by(F.col(ts), known).alias("peak_time"))


def _micros(ts: str) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(ts))


def trend(current: DataFrame, forecast: DataFrame, value: str, h: int = 24, keys: Sequence[str] = (), ts: str = "datetime"):
    """Mean of the next ``h`` forecast rows against ``current_value`` (one row per series).

    Within one percent is stable; without forecast, or with a current value of zero, neutral with zeros.
    """
    from tidegrid.operators.windows import horizon

    ahead = horizon(forecast.where(F.col(value).isNotNull()), h, keys, ts).groupBy(*keys).agg(F.avg(value).alias("__ahead"))
    if keys:
        both = current.join(ahead, list(keys), "left")
    else:
        both = current.withColumn("__ahead", ahead.scalar())
    now, mean = F.col("current_value"), F.col("__ahead")
    usable = mean.isNotNull() & now.isNotNull() & (now != 0)
    change = F.when(usable, (mean - now) / F.when(now != 0, now) * 100.0).otherwise(0.0)
    return both.select(
        *keys,
        "current_value",
        F.when(usable, mean).otherwise(0.0).alias("avg_forecast"),
        F.when(usable, mean - now).otherwise(0.0).alias("change_abs"),
        change.alias("change_pct"),
        F.when(~usable, "neutral")
        .when(change > TREND_PERCENT, "up")
        .when(change < -TREND_PERCENT, "down")
        .otherwise("stable")
        .alias("direction"),
    )


def normalise_importance(df: DataFrame, value: str = "importance", keys: Sequence[str] = ()) -> DataFrame:
    """Shares that add up to one; unchanged where the total is zero."""
    whole = with_series_stats(df, keys, F.sum(value).alias("__sum"))
    share = F.when(F.col("__sum") > 0, F.col(value) / F.col("__sum")).otherwise(F.col(value))
    return whole.withColumn(value, share).drop("__sum")


def run_tally(df: DataFrame, keys: Sequence[str] = ("source", "signal")) -> DataFrame:
    """Units by outcome."""
    return df.groupBy(*keys).agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("success", "failed", "skipped")])


def month_completeness(df: DataFrame, now, ts: str = "datetime", keys: Sequence[str] = ()) -> DataFrame:
    """Days present of each month against its length; complete only once the month is over."""
    day = F.to_date(ts)
    days = df.select(*keys, day.alias("__day")).distinct()
    last = F.last_day("__month")
    today = F.lit(str(now)).cast("timestamp_ntz").cast("date")
    months = days.groupBy(*keys, F.trunc("__day", "MM").alias("__month")).agg(F.count("__day").alias("days_present"))
    return months.select(
        *keys,
        F.year("__month").alias("year"),
        F.month("__month").alias("month"),
        "days_present",
        F.day(last).alias("days_expected"),
        (last < today).alias("closed"),
        ((last < today) & (F.col("days_present") >= F.day(last))).alias("complete"),
    )


def distinct_months(df: DataFrame, ts: str = "datetime") -> DataFrame:
    month = F.trunc(F.to_date(ts), "MM")
    return df.select(F.year(month).alias("year"), F.month(month).alias("month")).distinct()


def resample(df: DataFrame, keys: Sequence[str], ts: str, aggs: Sequence[Column], step: str = "1 hour") -> DataFrame:
    """Aggregate onto a coarser grid."""
    count, unit = step.split()
    slot = F.date_trunc(unit.rstrip("s"), F.col(ts)) if count == "1" else F.window(ts, step)["start"]
    return df.groupBy(*keys, slot.cast("timestamp_ntz").alias(ts)).agg(*aggs)
