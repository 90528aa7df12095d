"""Writers: partition layout, staged replacement, inventories, exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tidegrid.session import cut_lineage
from tidegrid.sources.footers import read_footers

LEVELS = {"year": ("year",), "month": ("year", "month"), "day": ("year", "month", "day")}
_FORMAT = {"year": "yyyy", "month": "MM", "day": "dd"}


def partition_columns(ts: Column | str, level: str = "day") -> dict[str, Column]:
    t = F.col(ts) if isinstance(ts, str) else ts
    return {p: F.date_format(t, _FORMAT[p]) for p in LEVELS[level]}


def with_partition_cols(df: DataFrame, ts: str = "datetime", level: str = "day") -> DataFrame:
    """Add zero-padded year, month, day text columns of the given level."""
    return df.withColumns(partition_columns(ts, level))


def write_layer(
    df: DataFrame,
    root: str,
    ts: str = "datetime",
    level: str | None = "day",
    mode: str = "append",
    sort: Sequence[str] = (),
    fmt: str = "parquet",
    tasks: int | None = None,
) -> None:
    """Write snappy Parquet in the year/month/day layout.

    The rebalance hint gives small partitions one file each and lets AQE split a partition that is too large for one
    task, so neither small files nor a hot day become a problem. ``tasks`` fixes the number of writers instead: for
    little data in very many directories, which AQE would hand to a single writer.
    """
    parts = list(LEVELS[level]) if level else []
    if level:
        df = with_partition_cols(df, ts, level)
    df = df.repartition(tasks, *parts) if tasks else df.hint("rebalance", *parts)
    order = [*parts, *(sort or [ts])]
    writer = df.sortWithinPartitions(*order).write.format(fmt).mode(mode).option("compression", "snappy")
    if mode == "overwrite" and level:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*parts) if parts else writer).save(root)


def append_silver(df: DataFrame, root: str, fmt: str = "parquet") -> None:
    """Append cleaned rows to a signal table. An empty input adds no rows."""
    df.write.format(fmt).mode("append").option("compression", "snappy").save(root)


def overwrite_gold(df: DataFrame, root: str, ts: str = "hour_ict", replace: str = "all") -> None:
    """Replace the gold table (``all``), or only the months present in ``df`` (``touched``)."""
    parts = list(LEVELS["month"])
    rows = with_partition_cols(df, ts, "month").hint("rebalance", *parts).sortWithinPartitions(*parts, ts)
    kind = "static" if replace == "all" else "dynamic"
    rows.write.mode("overwrite").option("partitionOverwriteMode", kind).partitionBy(*parts).parquet(root)


def replace_partitions(df: DataFrame, root: str, level: str = "day", sort: Sequence[str] = ("datetime",)) -> None:
    """Swap in new contents for exactly the partitions present in ``df``, which may be derived from ``root``.

    The rows are stored first: the swap then never reads what it replaces, and a lost executor or a failed swap can be
    repeated from the stored copy.
    """
    parts = list(LEVELS[level])
    staged = cut_lineage(df.hint("rebalance", *parts).sortWithinPartitions(*parts, *sort))
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(
        "compression", "snappy"
    ).partitionBy(*parts).parquet(root)


def write_prediction(df: DataFrame, root: str, day) -> None:
    """A latest copy and a dated copy of the same stored rows."""
    stored = cut_lineage(df)
    for place in ("latest", f"date={day}"):
        stored.write.mode("overwrite").json(f"{root.rstrip('/')}/{place}")


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Counts taken while the frame is written; read them from ``Observation.get`` after the write."""
    seen = Observation(name)
    counts = [F.count(F.lit(1)).alias("row_count"), F.lit(len(df.columns)).alias("column_count")]
    return df.observe(seen, *counts, F.max(F.current_timestamp()).alias("written_at")), seen


def partition_inventory(
    spark: SparkSession, root: str, parts: Sequence[str] = LEVELS["day"], hourly: str = "_30", daily: str = "data"
) -> DataFrame:
    """Files, rows and bytes per partition of a layer; hourly files are ``HH_30.*``, daily ones ``data.*``.

    Only footers are read, each file by one task among many.
    """
    stem = F.substring_index("file", ".", 1)
    return read_footers(spark, root).groupBy(*[F.col("partition")[p].alias(p) for p in parts]).agg(
        F.count(F.lit(1)).alias("file_count"),
        F.count_if(stem.endswith(hourly)).alias("hourly_files"),
        (F.count_if(stem == daily) > 0).alias("has_daily"),
        F.sum("rows").alias("row_count"),
        F.sum("bytes").alias("byte_count"),
    )


def latest_partition(df: DataFrame, parts: Sequence[str] = LEVELS["day"]) -> DataFrame:
    """The newest partition. Only partition columns are read."""
    return df.agg(F.max(F.struct(*parts)).alias("p")).select("p.*")


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def drop_partition_dir(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
