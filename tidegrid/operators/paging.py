"""Pages of an ordered table by a fence index: a page reads the range it lies in, whatever comes before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegrid.sources.sinks import path_exists

FENCE, ROWS, BEFORE = "fence", "fence_rows", "rows_before"


def write_ranges(df: DataFrame, root: str, order: Sequence[str], ranges: int | None = None) -> None:
    """Store the rows in ``ranges`` ranges of ``order`` (default: shuffle partitions), and the fence index beside them.

    Range boundaries are sampled, so ranges are about equal. The index has one row per range: how many rows it has, and how
    many lie in the ranges before it. Rows that tie in ``order`` share a range; make the order unique for stable pages.
    """
    spark = df.sparkSession
    count = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(count, *order).withColumn(FENCE, F.spark_partition_id()).sortWithinPartitions(*order)
    ranged.write.mode("overwrite").partitionBy(FENCE).parquet(f"{root}/rows")
    stored = spark.read.parquet(f"{root}/rows")
    # One row per range, as many as the write had tasks.
    sizes = sorted((int(r[FENCE]), r["n"]) for r in stored.groupBy(FENCE).agg(F.count(F.lit(1)).alias("n")).collect())
    before, listed = 0, []
    for fence, n in sizes:
        listed.append((fence, n, before))
        before += n
    fences = spark.createDataFrame(listed, f"{FENCE} int, {ROWS} bigint, {BEFORE} bigint")
    fences.coalesce(1).write.mode("overwrite").parquet(f"{root}/fences")


def read_page(spark: SparkSession, root: str, number: int, size: int, order: Sequence[str]) -> DataFrame:
    """Page ``number`` (from 1) of the stored rows, in order. Only the ranges that it touches are read.

    Pages behind the last row are empty.
    """
    if number < 1 or size < 1:
        raise ValueError("pages count from 1 and hold at least one row")
    if not path_exists(spark, f"{root}/fences"):
        raise ValueError(f"no fence index below {root}")
    first, end = (number - 1) * size, number * size
    fences = spark.read.parquet(f"{root}/fences").where((F.col(BEFORE) < end) & (F.col(BEFORE) + F.col(ROWS) > first))
    touched = sorted((r[FENCE], r[BEFORE]) for r in fences.collect())  # ranges of one page
    rows = spark.read.parquet(f"{root}/rows")
    columns = [c for c in rows.columns if c != FENCE]
    near = rows.where(F.col(FENCE).isin([f for f, _ in touched])).select(*columns)
    return near.orderBy(*order).offset(first - touched[0][1] if touched else 0).limit(size)
