"""Unions of overlapping data and compaction of small files and one-hour documents."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegrid.operators.aggregates import month_completeness
from tidegrid.operators.flatten import records
from tidegrid.operators.quality import dedup_first, fullest
from tidegrid.schemas import CORRUPT
from tidegrid.session import cut_lineage
from tidegrid.sources.layers import read_layer, where_parts
from tidegrid.sources.sinks import LEVELS, drop_partition_dir, path_exists, replace_partitions


def union_files(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all inputs by column name; columns missing somewhere are NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_dedup(first: DataFrame, *others: DataFrame, keys: Sequence[str] = (), ts: str = "datetime") -> DataFrame:
    """Union where a (keys, ts) present in several inputs is taken from the earliest input."""
    ranked = [df.withColumn("__rank", F.lit(i)) for i, df in enumerate((first, *others))]
    rows = union_files(ranked)
    columns = [c for c in rows.columns if c != "__rank"]
    rest = [c for c in columns if c not in (*keys, ts)]
    return dedup_first(rows, keys, ts, ["__rank", *fullest(rest)]).select(*columns)


# One-hour documents to one document per day

# Columns of a scanned document that are no part of it, or are rebuilt.
DERIVED = ("_metadata", CORRUPT, "arrived_at", "year", "month", "day", "hour")


def _day_documents(df, group, slot, record, envelope, file_name):
    """Keep the first record of each slot, then collect the slots of a day in time order.

    Records are reduced to one per (document group, slot) before they are collected, so a list never holds more than
    the slots of one day even if the same hour landed many times.
    """
    rows = df.select(*group, slot.alias("__slot"), record.alias("__record"), F.col(file_name).alias("__file"))
    slots = rows.where(F.col("__record").isNotNull()).groupBy(*group, "__slot").agg(
        F.min_by("__record", "__file").alias("__record")
    )
    # Compared by slot: a record may hold a map, which has no order.
    pairs = F.collect_list(F.struct(F.col("__slot"), F.col("__record")))
    ordered = F.array_sort(pairs, lambda a, b: F.when(a["__slot"] < b["__slot"], -1).otherwise(1))
    days = slots.groupBy(*group).agg(F.transform(ordered, lambda r: r["__record"]).alias("__records"))
    first = df.groupBy(*group).agg(F.min_by(F.struct(*envelope), F.col(file_name)).alias("__envelope"))
    return days.join(first, list(group)).select(*group, "__records", *[F.col("__envelope")[c].alias(c) for c in envelope])


def compact_weather_docs(df: DataFrame, keys: Sequence[str] = (), file_name: str = "file_name") -> DataFrame:
    """One-hour weather documents of a day become one document: hours sorted, the first document's envelope kept."""
    group = [*keys, "query_date"]
    envelope = [c for c in df.columns if c not in (*group, "days", file_name, *DERIVED)]
    hours = F.try_element_at(F.col("days"), F.lit(1))["hours"]
    record = F.try_element_at(hours, F.lit(1))
    out = _day_documents(df, group, record["datetime"], record, envelope, file_name)
    kind = df.schema["days"].dataType.elementType
    parts = {"datetime": F.col("query_date").cast("string"), "hours": F.col("__records")}
    day = F.struct(
        *[parts.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in kind.fields]
    )
    return out.withColumn("days", F.array(day)).drop("__records")


def compact_electricity_docs(
    df: DataFrame, keys: Sequence[str] = ("signal", "zone"), file_name: str = "file_name"
) -> DataFrame:
    """One-hour electricity documents of a day and signal become one: histories concatenated and sorted, provenance
    rebuilt without the hour."""
    group = [*keys, "query_date"]
    envelope = [c for c in df.columns if c not in (*group, "data", "history", file_name, *DERIVED)]
    flat = df.select("*", F.explode_outer(records()).alias("__r"))
    if not envelope:
        envelope, flat = ["__none"], flat.withColumn("__none", F.lit(None).cast("string"))
    out = _day_documents(flat, group, F.col("__r.datetime"), F.col("__r"), envelope, file_name)
    text = F.lit(None).cast("string")
    tag = F.struct(
        (F.col("signal") if "signal" in group else text).alias("signal"),
        F.col("query_date").cast("string").alias("query_date"),
        (F.col("zone") if "zone" in group else text).alias("zone"),
        text.alias("hour"),
    )
    return out.withColumns({"history": F.col("__records"), "_metadata": tag}).drop("__records", "__none")


# Parquet partitions


def in_arrival_order(layer: DataFrame) -> DataFrame:
    """A scanned layer with ``__arrival``: time and name of the file, and the place in it."""
    about = layer.metadataColumn("_metadata")
    place = F.struct(about["file_modification_time"], about["file_path"], about["row_index"])
    return layer.withColumn("__arrival", place)


def partition_status(df: DataFrame, level: str = "day") -> DataFrame:
    """Files per partition and whether compaction has anything to do."""
    parts = list(LEVELS[level])
    name = df.metadataColumn("_metadata")["file_path"]
    # Rows are first counted per file: a large partition shrinks to its file list map-side.
    files = df.groupBy(*parts, name.alias("__file")).agg(F.count(F.lit(1)).alias("__rows"))
    grouped = files.groupBy(*parts).agg(F.count(F.lit(1)).alias("files"), F.sum("__rows").alias("rows"))
    return grouped.withColumn("status", F.when(F.col("files") > 1, "pending").otherwise("already_compacted"))


def compact_day(
    spark: SparkSession, root: str, on=None, keys: Sequence[str] = (), ts: str = "datetime", level: str = "day"
) -> DataFrame:
    """Merge the files of one partition, or of every partition with more than one, and keep each (keys, ts) once.

    Returns one row per inspected partition with the status before the run: success, already_compacted or no_files.
    Running it again changes nothing.
    """
    parts = list(LEVELS[level])
    if not path_exists(spark, root):
        return spark.createDataFrame([("no_files", 0, 0)], "status string, files long, rows long")
    layer = read_layer(spark, root)
    if on is not None:
        year, month, *day = str(on).split("-")
        layer = where_parts(layer, year, month, *day)
    status = cut_lineage(partition_status(layer, level))
    todo = status.where(F.col("status") == "pending").select(*parts)
    if status.isEmpty():
        return spark.createDataFrame([("no_files", 0, 0)], "status string, files long, rows long")
    if not todo.isEmpty():
        rows = in_arrival_order(layer).join(todo, parts, "left_semi")
        merged = dedup_first(rows, [*keys, *parts], ts, ["__arrival"]).select(*layer.columns)
        replace_partitions(merged, root, level, [*keys, ts])
    return status.withColumn(
        "status", F.when(F.col("status") == "pending", "success").otherwise(F.col("status"))
    )


def compact_month(
    spark: SparkSession,
    daily_root: str,
    monthly_root: str,
    now,
    keys: Sequence[str] = (),
    ts: str = "datetime",
    series: Sequence[str] | None = None,
) -> DataFrame:
    """Write every complete, closed month of the daily layer that the monthly layer (year, month directories) lacks.

    A month is complete when each of its series (columns ``series``, by default ``keys``) has all its days; days are told
    from the directories. Returns one row per month with a status: success, already_compacted, incomplete (not over) or
    incomplete_data (days missing). Of copies of a (keys, ts) the first to arrive stays.
    """
    daily = read_layer(spark, daily_root)
    own = list(keys if series is None else series)
    placed = daily.withColumn("__day", F.make_date(*[F.col(p).cast("int") for p in LEVELS["day"]]))
    each = month_completeness(placed, now, "__day", own)
    months = each.groupBy("year", "month").agg(
        F.min("days_present").alias("days_present"),
        F.min("days_expected").alias("days_expected"),
        F.bool_and("closed").alias("closed"),
        F.bool_and("complete").alias("complete"),
    )
    known = spark.createDataFrame([], "year int, month int, __there boolean")
    if path_exists(spark, monthly_root):
        parts = [F.col(p).cast("int").alias(p) for p in ("year", "month")]
        known = read_layer(spark, monthly_root).select(*parts).distinct().withColumn("__there", F.lit(True))
    state = (
        F.when(F.col("__there"), "already_compacted")
        .when(F.col("complete"), "success")
        .when(~F.col("closed"), "incomplete")
        .otherwise("incomplete_data")
    )
    months = cut_lineage(months.join(known, ["year", "month"], "left").withColumn("status", state).drop("__there"))
    # One filter per month, known before the scan: only their directories are read. The calendar bounds the list.
    wanted = [f"{r.year:04d}-{r.month:02d}" for r in months.where("status = 'success'").select("year", "month").collect()]
    if wanted:
        rows = in_arrival_order(daily.where(F.concat_ws("-", "year", "month").isin(wanted)))
        merged = dedup_first(rows, [*keys, "year", "month"], ts, ["__arrival"]).drop("__arrival", "day")
        replace_partitions(merged, monthly_root, "month", [*keys, ts])
    return months


def retire_hourly(
    spark: SparkSession, hourly_root: str, daily_root: str, keys: Sequence[str] = (), ts: str = "datetime", on=None
) -> DataFrame:
    """Remove hourly day directories, or that of the day ``on``, once every one of their (keys, ts) is in the daily layer.

    Days with a row missing from the daily layer stay. Returns one row per day with ``retired``.
    """
    parts = list(LEVELS["day"])
    hourly = read_layer(spark, hourly_root, on).select(*parts, *keys, ts).distinct()
    if path_exists(spark, daily_root):
        present = read_layer(spark, daily_root, on).select(*keys, ts).distinct().withColumn("__there", F.lit(1))
        matched = hourly.join(present, [*keys, ts], "left")
    else:
        matched = hourly.withColumn("__there", F.lit(None).cast("int"))
    days = matched.groupBy(*parts).agg((F.count("__there") == F.count(F.lit(1))).alias("retired"))
    days = cut_lineage(days)
    # One directory call per day: the list is bounded by the calendar.
    for row in days.where("retired").toLocalIterator():
        drop_partition_dir(spark, "/".join([hourly_root.rstrip("/"), *[f"{p}={row[p]}" for p in parts]]))
    return days

