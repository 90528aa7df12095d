"""Incremental silver, deduplication, joins, roll-ups and upserts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidegrid.operators.compaction import union_dedup
from tidegrid.operators.flatten import (
    POSITION,
    WEATHER_NAMES,
    coerce_numeric,
    flatten_electricity,
    flatten_weather,
    select_electricity,
    select_weather,
)
from tidegrid.operators.quality import dedup_first, fullest, payload_problem
from tidegrid.schemas import CORRUPT, WEATHER_DOC, electricity_doc
from tidegrid.sources.bronze import ARRIVED, FILE_NAME, PARTS, query_date, scan_documents
from tidegrid.sources.layers import read_layer
from tidegrid.sources.sinks import LEVELS, path_exists, replace_partitions, with_partition_cols
from tidegrid.streaming import panes


def event_time(df: DataFrame, ts: str = "datetime", delay: str = "2 hours") -> DataFrame:
    """TIMESTAMP event time with a watermark."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def naive_time(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def read_bronze_stream(
    spark: SparkSession,
    root: str,
    source: str,
    signal: str | None = None,
    granularity: str = "hourly",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Newly landed documents, each file once (the checkpoint remembers what was read)."""
    doc = WEATHER_DOC if source == "weather" else electricity_doc(signal)
    path = "/".join(p for p in (root.rstrip("/"), source, signal) if p)
    schema = T.StructType(doc.fields + PARTS.fields).add(CORRUPT, T.StringType())

    def reader():
        options = {"basePath": path, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        made = spark.readStream.options(**options)
        return made.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else made

    return scan_documents(reader, path, schema, granularity).withColumn("query_date", query_date())


#: What tells rows of the same hour apart: when their file arrived, its name, their place in the document.
ARRIVAL = (ARRIVED, FILE_NAME, POSITION)


def silver_rows(docs: DataFrame, source: str, keys: Sequence[str] = (), arrival: bool = False) -> DataFrame:
    """Documents to typed silver rows, with ``arrival`` also the columns ARRIVAL; the same for batch and stream."""
    good = docs.where(payload_problem(source).isNull())
    keep = ("query_date", *keys, *([ARRIVED, FILE_NAME] if arrival else []))
    own = [*keys, *(ARRIVAL if arrival else [])]
    if source == "weather":
        rows = coerce_numeric(flatten_weather(good, keep), list(WEATHER_NAMES))
        return select_weather(rows, own)
    return select_electricity(coerce_numeric(flatten_electricity(good, keep=keep), ["value"]), own)


def stream_silver(
    spark: SparkSession,
    root: str,
    out: str,
    checkpoint: str,
    source: str,
    signal: str | None = None,
    granularity: str = "hourly",
    keys: Sequence[str] = (),
    delay: str = "2 hours",
    files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Bronze to silver for whatever has landed since the last run, hours deduplicated."""
    docs = read_bronze_stream(spark, root, source, signal, granularity, files_per_trigger)
    rows = stream_dedup(silver_rows(docs, source, keys), keys, "datetime", delay)
    return write_stream(with_partition_cols(naive_time(rows, "datetime")), out, checkpoint, LEVELS["day"])


def write_stream(
    df: DataFrame, out: str, checkpoint: str, partition_by: Sequence[str] = (), mode: str = "append"
) -> StreamingQuery:
    """Parquet sink that processes everything available and stops."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.format("parquet").start(out)


def stream_dedup(df: DataFrame, keys: Sequence[str] = (), ts: str = "datetime", delay: str = "2 hours") -> DataFrame:
    """One row per (keys, hour), the first to arrive; state is dropped once the watermark passes."""
    return event_time(df, ts, delay).dropDuplicatesWithinWatermark([*keys, ts])


def stream_join(
    weather: DataFrame,
    load: DataFrame,
    keys: Sequence[str] = (),
    ts: str = "datetime",
    delay: str = "2 hours",
) -> DataFrame:
    """Inner join of two streams on series and hour; the hour in the key lets both watermarks clear state."""
    return event_time(weather, ts, delay).join(event_time(load, ts, delay), [*keys, ts], "inner")


def stream_hourly(
    df: DataFrame, keys: Sequence[str], ts: str, aggs: Sequence[Column], delay: str = "2 hours"
) -> DataFrame:
    """Hourly roll-up, emitted when the hour closes."""
    slots = event_time(df, ts, delay).groupBy(*keys, F.window(ts, "1 hour").alias("__w")).agg(*aggs)
    return slots.withColumn(ts, F.col("__w.start").cast("timestamp_ntz")).drop("__w")


def stream_day_status(
    df: DataFrame, keys: Sequence[str] = (), ts: str = "datetime", slots: int = 24, delay: str = "2 hours"
) -> DataFrame:
    """Hours seen per day and whether the day is complete, emitted when the day closes. Input: one row per hour."""
    days = event_time(df, ts, delay).groupBy(*keys, F.window(ts, "1 day").alias("__w"))
    return days.agg(F.count(F.lit(1)).alias("hours_present")).select(
        *keys,
        F.to_date(F.col("__w.start")).alias("day"),
        "hours_present",
        (F.col("hours_present") >= slots).alias("complete"),
    )


def stream_rolling(
    df: DataFrame,
    col: str,
    windows: Sequence[int],
    keys: Sequence[str],
    ts: str = "datetime",
    delay: str = "2 hours",
) -> DataFrame:
    """Rolling mean and sample deviation per window length, for hours whose window is full; see ``panes``."""
    return panes.stream_rolling(event_time(df, ts, delay), col, windows, keys, ts)


def upsert(
    batch: DataFrame, out: str, keys: Sequence[str] = (), ts: str = "datetime", order: Sequence[str] = ()
) -> None:
    """Merge a batch into a day-partitioned table: a batch row replaces the stored row of its (keys, ts).

    ``order`` ranks rows of one (keys, ts) within the batch, first wins; without it the fullest row does.
    Only the day directories the batch touches are read and rewritten. Repeating a batch changes nothing.
    """
    spark = batch.sparkSession
    columns = [c for c in batch.columns if c not in order]
    rest = [c for c in columns if c not in (*keys, ts)]
    fresh = dedup_first(batch, keys, ts, order or fullest(rest)).select(*columns)
    rows = with_partition_cols(fresh, ts)
    if path_exists(spark, out):
        stored = read_layer(spark, out)
        touched = rows.select(*LEVELS["day"]).distinct()
        rows = union_dedup(rows, stored.join(touched, list(LEVELS["day"]), "left_semi"), keys=keys, ts=ts)
    replace_partitions(rows, out, "day", [*keys, ts])


def stream_upsert(
    df: DataFrame,
    out: str,
    checkpoint: str,
    keys: Sequence[str] = (),
    ts: str = "datetime",
    order: Sequence[str] = (),
    merge: Callable[..., None] = upsert,
) -> StreamingQuery:
    """Late and corrected hours replace what is stored. ``order`` ranks rows of one micro-batch, first wins.

    A merge reads its micro-batch several times; it is kept meanwhile, or each time would run the stream's operators again.
    """

    def apply(batch: DataFrame, _: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                merge(batch, out, keys, ts, order)
        finally:
            batch.unpersist()

    return (
        df.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
