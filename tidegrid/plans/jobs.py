"""The batch jobs: each is one composition of operators over whole tables, with a written layer between stages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegrid.functions.timeparts import calendar_features
from tidegrid.models import registry as reg
from tidegrid.models.forecast import forecast_next, training_rows
from tidegrid.models.training import TREE_PARAMS, evaluate, feature_importance, fit_model, residual_quantiles
from tidegrid.operators.compaction import (
    compact_day,
    compact_electricity_docs,
    compact_month,
    compact_weather_docs,
    retire_hourly,
)
from tidegrid.operators.features import TARGET, FeatureConfig
from tidegrid.operators.flatten import (
    align_hours,
    signal_parser,
    slice_hour_electricity,
    slice_hour_weather,
    to_canonical_columns,
)
from tidegrid.operators.joins import join_all_signals, join_signals, pending_units, regularise
from tidegrid.operators.quality import (
    check_canonical,
    check_payload,
    dedup_first,
    dedup_last,
    drop_null_critical,
    fullest,
    null_outliers,
    outside,
)
from tidegrid.operators.windows import PHYSICAL_LIMITS, impute_canonical
from tidegrid.schemas import CANONICAL_MEASURES, CORRUPT
from tidegrid.session import cut_lineage
from tidegrid.sources.bronze import read_bronze
from tidegrid.sources.layers import load_recent, read_layer
from tidegrid.sources.sinks import (
    LEVELS,
    overwrite_gold,
    path_exists,
    replace_partitions,
    with_partition_cols,
    write_prediction,
)
from tidegrid.streaming.hourly import ARRIVAL, read_bronze_stream, silver_rows, upsert

PARTS = LEVELS["day"]
# Columns that a scan adds to a document.
SCAN_COLUMNS = ("file_name", "arrived_at", "query_date", CORRUPT, "signal", "hour")


def keep_bad(docs: DataFrame, source: str, path: str, mode: str = "overwrite") -> None:
    """Store what cannot be read or has no payload: the problem, the file, and the text where there is any."""
    _, bad = check_payload(docs, source)
    bad.select("problem", "file_name", F.col(CORRUPT).alias("text")).write.mode(mode).parquet(path)


def bronze_to_silver(
    spark: SparkSession, bronze: str, silver: str, keys: Sequence[str] = (), quarantine: str | None = None
) -> None:
    """All landed weather and load documents to typed silver tables; of an hour's copies the first to arrive stays.

    Bad documents are stored below ``quarantine``, one table per source.
    """
    for source, signal in (("weather", None), ("electricity", "total_load")):
        docs = read_bronze(spark, bronze, source, signal)
        if quarantine:
            keep_bad(docs, source, f"{quarantine}/{source}")
        rows = silver_rows(docs, source, keys, arrival=True)
        unique = dedup_first(rows.where(F.col("datetime").isNotNull()), keys, "datetime", ARRIVAL).drop(*ARRIVAL)
        replace_partitions(with_partition_cols(unique), f"{silver}/{source}", "day", [*keys, "datetime"])


def gold_rows(
    weather: DataFrame, load: DataFrame, keys: Sequence[str] = (), fill_grid: bool = False
) -> DataFrame:
    """Join on the hour over whole tables, impute, drop rows without demand or temperature.

    Whole tables rather than day files: a UTC day and a local day overlap only in part.
    """
    joined = to_canonical_columns(join_signals(weather.drop(*PARTS), load.drop(*PARTS), keys), keys)
    if fill_grid:
        joined = regularise(joined, keys)
    # Imputation reads its input more than once, so the join is stored first.
    return drop_null_critical(impute_canonical(cut_lineage(joined), keys, cut=cut_lineage))


def silver_to_gold(
    spark: SparkSession, silver: str, gold: str, keys: Sequence[str] = (), fill_grid: bool = False
) -> DataFrame:
    """Write the canonical table by day; returns its contract check."""
    rows = gold_rows(read_layer(spark, f"{silver}/weather"), read_layer(spark, f"{silver}/electricity"), keys, fill_grid)
    refresh_edges(spark, silver, keys)
    replace_partitions(with_partition_cols(rows), gold, "day", [*keys, "datetime"])
    return check_canonical(read_layer(spark, gold), keys)


def backfill(
    spark: SparkSession,
    bronze: str,
    silver: str,
    gold: str,
    monthly: str,
    now,
    keys: Sequence[str] = (),
    quarantine: str | None = None,
) -> DataFrame:
    """Bronze to silver to gold for all days in one plan per layer, then the closed months."""
    bronze_to_silver(spark, bronze, silver, keys, quarantine)
    check = silver_to_gold(spark, silver, gold, keys)
    compact_month(spark, gold, monthly, now, keys)
    return check


def hourly_increment(
    spark: SparkSession,
    bronze: str,
    silver: str,
    gold_hourly: str,
    checkpoints: str,
    keys: Sequence[str] = (),
    granularity: str = "hourly",
    quarantine: str | None = None,
) -> None:
    """Each newly landed document once: merged into silver, joined with the stored hours of the other source, merged
    into hourly gold. Hours of any age are accepted, since the tables themselves are the state; a later copy of an hour
    replaces an earlier one. Impossible values become NULL before gold, as in the full run."""
    sources = (("weather", None), ("electricity", "total_load"))
    for (source, signal), (other, _) in zip(sources, reversed(sources)):
        docs = read_bronze_stream(spark, bronze, source, signal, granularity)

        def apply(batch: DataFrame, _: int, source=source, other=other) -> None:
            if batch.isEmpty():
                return
            if quarantine:
                keep_bad(batch, source, f"{quarantine}/{source}", "append")
            rows = silver_rows(batch, source, keys, arrival=True)
            fresh = dedup_last(rows.where(F.col("datetime").isNotNull()), keys, "datetime", ARRIVAL).drop(*ARRIVAL)
            fresh = cut_lineage(fresh)
            upsert(fresh, f"{silver}/{source}", keys)
            if not path_exists(spark, f"{silver}/{other}"):
                return
            days = cut_lineage(with_partition_cols(fresh).select(*PARTS).distinct())
            refresh_edges(spark, silver, keys, days)
            stored = read_layer(spark, f"{silver}/{other}").join(days, list(PARTS), "left_semi").drop(*PARTS)
            pair = (fresh, stored) if source == "weather" else (stored, fresh)
            joined = to_canonical_columns(join_signals(*pair, keys), keys)
            gold = drop_null_critical(null_outliers(joined, PHYSICAL_LIMITS))
            upsert(gold, gold_hourly, keys)

        query = docs.writeStream.foreachBatch(apply).option("checkpointLocation", f"{checkpoints}/{source}")
        query.trigger(availableNow=True).start().awaitTermination()


def _joined(spark: SparkSession, silver: str, keys: Sequence[str], near=lambda rows: rows) -> DataFrame:
    weather, load = (near(read_layer(spark, f"{silver}/{s}")).drop(*PARTS) for s in ("weather", "electricity"))
    return to_canonical_columns(join_signals(weather, load, keys), keys)


def day_edges(joined: DataFrame, keys: Sequence[str] = (), ts: str = "datetime") -> DataFrame:
    """Per series and day, for each measure: whether it has a value (``any_<measure>``), and one within its limits (``good_<measure>``)."""
    measures = [c for c in CANONICAL_MEASURES if c in joined.columns]
    flags = [F.bool_or(F.col(c).isNotNull()).alias(f"any_{c}") for c in measures]
    good = {c: ~outside(c, *PHYSICAL_LIMITS[c]) if c in PHYSICAL_LIMITS else F.lit(True) for c in measures}
    flags += [F.bool_or(F.col(c).isNotNull() & good[c]).alias(f"good_{c}") for c in measures]
    return joined.groupBy(*keys, F.to_date(ts).alias("on_day")).agg(*flags)


def refresh_edges(spark: SparkSession, silver: str, keys: Sequence[str] = (), days: DataFrame | None = None) -> None:
    """Bring the edge index of silver up to date: for the given days (columns PARTS), or for all.

    The index has one row per series and day of joined silver. Whoever changes silver refreshes the days it touched.
    """
    near = (lambda rows: rows.join(F.broadcast(days), list(PARTS), "left_semi")) if days is not None else (lambda rows: rows)
    replace_partitions(with_partition_cols(day_edges(_joined(spark, silver, keys, near), keys), "on_day"), f"{silver}/edges", "day", [*keys])


def imputation_span(edges: DataFrame, on, keys: Sequence[str] = ()) -> DataFrame:
    """Per series the first and last day (``low``, ``high``) that the imputation of the day ``on`` depends on.

    On either side that is, for each measure, the nearest day with a value within its limits: nothing beyond such a value
    reaches the day, in either pass. Where there is none, values outside the limits may still shape what is filled in, so
    all days that have any count; a measure without any value on a side needs nothing from it.
    """
    day, target = F.col("on_day"), F.lit(str(on)).cast("date")
    measures = [c.removeprefix("good_") for c in edges.columns if c.startswith("good_")]

    def reach(side, nearest, farthest) -> list[Column]:
        return [F.coalesce(nearest(F.when(side & F.col(f"good_{c}"), day)), farthest(F.when(side & F.col(f"any_{c}"), day)), target) for c in measures]

    low = F.least(target, *reach(day < target, F.max, F.min))
    high = F.greatest(target, *reach(day > target, F.min, F.max))
    return edges.groupBy(*keys).agg(low.alias("low"), high.alias("high"))


def daily_compaction(
    spark: SparkSession, silver: str, gold_daily: str, gold_hourly: str, on, keys: Sequence[str] = ()
) -> DataFrame:
    """One day: merge its silver files, rebuild its gold, and drop its hourly gold if the daily table now covers it.

    The gold of the day equals that of a full run. The edge index tells, by series, which days before and after hold the
    values that imputation looks for, at any distance; only these and what lies between them are read.
    """
    for source in ("weather", "electricity"):
        compact_day(spark, f"{silver}/{source}", on, keys)
    if path_exists(spark, f"{silver}/edges"):
        today = spark.createDataFrame([tuple(str(on).split("-"))], ", ".join(f"{p} string" for p in PARTS))
        refresh_edges(spark, silver, keys, today)
    else:
        refresh_edges(spark, silver, keys)
    edges = read_layer(spark, f"{silver}/edges").drop(*PARTS)
    span = cut_lineage(imputation_span(edges, on, keys))
    group = F.struct(*keys) if keys else F.lit(0)
    spans = span.select(group.alias("__k"), "low", "high")
    listed = edges.select(group.alias("__k"), "on_day").join(spans, "__k").where(F.col("on_day").between(F.col("low"), F.col("high")))
    days = [str(r["on_day"]) for r in listed.select("on_day").distinct().collect()]  # the calendar bounds them

    def near(rows: DataFrame) -> DataFrame:
        rows = rows.where(F.concat_ws("-", *PARTS).isin(days))
        if not keys:
            return rows
        placed = rows.withColumn("__k", group).join(spans, "__k").where(F.to_date("datetime").between(F.col("low"), F.col("high")))
        return placed.drop("__k", "low", "high")

    rows = gold_rows(*(near(read_layer(spark, f"{silver}/{s}")) for s in ("weather", "electricity")), keys)
    rows = rows.where(F.to_date("datetime") == F.lit(str(on)).cast("date"))
    replace_partitions(with_partition_cols(rows), gold_daily, "day", [*keys, "datetime"])
    return retire_hourly(spark, gold_hourly, gold_daily, keys, on=on)


def compact_bronze(
    spark: SparkSession, bronze: str, out: str, signals: Sequence[str] = ("total_load",), granularity: str = "hourly"
) -> None:
    """One-hour documents to one document per day, per source and signal. Days that are not there stay as they are."""
    if out.rstrip("/") == bronze.rstrip("/"):
        raise ValueError("compacted documents go to a folder of their own")
    docs = compact_weather_docs(read_bronze(spark, bronze, "weather", granularity=granularity))
    _land(docs, f"{out}/weather")
    for signal in signals:
        docs = compact_electricity_docs(read_bronze(spark, bronze, "electricity", signal, granularity))
        _land(docs, f"{out}/electricity/{signal}")


def _land(docs: DataFrame, path: str) -> None:
    placed = with_partition_cols(docs, "query_date") if "year" not in docs.columns else docs
    writer = placed.drop(*SCAN_COLUMNS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*PARTS).json(path)


def slice_bronze(
    spark: SparkSession, bronze: str, out: str, hours: DataFrame, signals: Sequence[str] = ("total_load",)
) -> None:
    """Cut day documents to the wanted (query_date, hour) units that have not landed yet.

    ``hours`` has query_date and hour (``HH``, local). Output directories carry the hour; a unit counts as landed when its
    directory has a document.
    """
    tasks = [("weather", None), *[("electricity", s) for s in signals]]
    for source, signal in tasks:
        there = "/".join(p for p in (out, source, signal) if p)
        todo = hours
        if path_exists(spark, there):
            landed = read_bronze(spark, out, source, signal, "hourly")
            todo = cut_lineage(pending_units(hours, landed, ["query_date", "hour"]))
        docs = read_bronze(spark, bronze, source, signal, "daily").drop("hour").join(todo, "query_date")
        hour = F.col("hour")
        cut = slice_hour_weather(docs, hour) if source == "weather" else slice_hour_electricity(docs, hour, signal)
        cut.drop(*[c for c in SCAN_COLUMNS if c != "hour"]).write.mode("append").partitionBy(*PARTS, "hour").json(there)


def six_signal_silver(spark: SparkSession, bronze: str, silver: str, names: Mapping[str, Sequence[str] | None]) -> None:
    """Parse each signal, align its hours, replace its table. ``names`` lists the columns of the map signals."""
    for name in ("weather", *[s for s in names if s != "weather"]):
        docs = read_bronze(spark, bronze, "weather" if name == "weather" else "electricity", None if name == "weather" else name)
        parse = signal_parser(name)
        listed = names.get(name)
        rows = parse(docs, listed) if listed else parse(docs)
        align_hours(rows).write.mode("overwrite").parquet(f"{silver}/{name}")


def six_signal_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Weather as the spine, every other signal left-joined on hour_ict, calendar columns added.

    Each table is first reduced to one row per hour, so that a rerun or an overlap cannot multiply rows.
    """
    noise = ("position", "zone", "signal", "query_date", "file_name", "arrived_at", "datetime_utc", "datetime_ict")
    shaped = []
    for name, df in tables.items():
        keep = [c for c in df.columns if c not in noise and c != "hour_ict"]
        place = [c for c in ("file_name", "position") if c in df.columns]
        rows = dedup_first(df.select("hour_ict", *keep, *place), [], "hour_ict", [*place, *fullest(keep)]).drop(*place)
        shaped.append((name, rows.drop("datetime")))
    spine = dict(shaped)["weather"]
    others = [df for name, df in shaped if name != "weather"]
    return calendar_features(join_all_signals(spine, others, ["hour_ict"]), "hour_ict")


def six_signal_gold(spark: SparkSession, silver: str, gold: str, signals: Sequence[str]) -> None:
    tables = {s: spark.read.parquet(f"{silver}/{s}") for s in signals}
    # Numeric year and month give way to the zero-padded partition columns of the same meaning.
    overwrite_gold(six_signal_rows(tables), gold, "hour_ict")


def full_training(
    spark: SparkSession,
    gold: DataFrame,
    root: str,
    keys: Sequence[str] = (),
    config: FeatureConfig = FeatureConfig(),
    params: Mapping | None = None,
    target: str = TARGET,
    steps: int = 1,
    early_stopping: bool = False,
    kind: str = "gbt",
    only: Sequence[str] | None = None,
) -> dict:
    """Features, split, fit, evaluate, register. Returns the version, metrics and the importance table (of trees)."""
    started = datetime.now(timezone.utc)
    view, names = training_rows(gold, config, target, steps, keys, only=only)
    view = cut_lineage(view)
    fitted = fit_model(view, names, params, kind, early_stopping=early_stopping)
    sizes = {r["split"]: r["count"] for r in view.groupBy("split").count().collect()}
    tested = evaluate(fitted, view).first().asDict()
    metrics = {**fitted.metrics, **{k: v for k, v in tested.items() if v is not None}}
    marks = residual_quantiles(fitted.transform(view.where("split = 'val'"))).first()
    if marks is not None:
        metrics.update({k: marks[k] for k in ("residual_low", "residual_high") if marks[k] is not None})
    completed = datetime.now(timezone.utc)
    version = reg.version_name(completed)
    used = {**(TREE_PARAMS if kind == "gbt" else {}), **(params or {})}
    record = reg.training_record(
        spark, kind, version, started, completed, sizes, names, used, metrics, tags={"target": target}
    )
    reg.save_model(fitted, record, root)
    importance = feature_importance(spark, fitted) if kind == "gbt" else None
    return {"version": version, "metrics": metrics, "importance": importance, "fitted": fitted}


def prediction(
    spark: SparkSession,
    hourly: DataFrame,
    daily: DataFrame | None,
    root: str,
    end,
    out: str | None = None,
    keys: Sequence[str] = (),
    config: FeatureConfig = FeatureConfig(),
    margin: int = 24,
    kind: str = "gbt",
) -> DataFrame:
    """Next-hour record per series from the recent hours and the latest model.

    The look-back is the longest lag plus a margin: exactly the longest lag would leave no usable row as soon as one
    hour is missing.
    """
    fitted, row = reg.load_model(spark, root, kind)
    hours = max([*config.lags, *config.windows]) + margin
    recent = load_recent(hourly, daily, end, hours, keys)
    made = forecast_next(recent, fitted, config, keys)
    low, high = (fitted.metrics.get(f"residual_{side}") for side in ("low", "high"))
    now = datetime.now(timezone.utc).isoformat()
    point = F.col("predicted_value")
    out_rows = made.select(
        *keys,
        F.col("prediction_for").cast("string").alias("prediction_for"),
        "predicted_value",
        (point + F.lit(low)).cast("double").alias("confidence_lower"),
        (point + F.lit(high)).cast("double").alias("confidence_upper"),
        F.lit(kind).alias("model_type"),
        F.lit(row["version"]).alias("model_version"),
        F.lit(now).alias("generated_at"),
        F.col("based_on_data_until").cast("string").alias("based_on_data_until"),
        "feature_count",
        "historical_hours_used",
    )
    if out:
        write_prediction(out_rows, out, now[:10])
    return out_rows

