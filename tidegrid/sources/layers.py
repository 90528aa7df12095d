"""Parquet layers (silver, gold), prediction and registry readers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegrid.operators.quality import between, dedup_first, fullest
from tidegrid.schemas import PREDICTION_ANY, REGISTRY
from tidegrid.sources.bronze import scan_documents

PARTS = ("year", "month", "day")


def read_layer(spark: SparkSession, root: str, on: date | str | None = None) -> DataFrame:
    """A whole layer, or one day of it through its partition directories."""
    df = _as_text_parts(spark.read.parquet(root))
    if on is None:
        return df
    day = date.fromisoformat(str(on))
    return where_parts(df, day.year, day.month, day.day)


def _as_text_parts(df: DataFrame) -> DataFrame:
    # Directories are zero padded; a session that infers their type would read numbers.
    widths = {"year": 4, "month": 2, "day": 2}
    typed = [c for c in widths if c in df.columns and df.schema[c].dataType.typeName() != "string"]
    return df.withColumns({c: F.lpad(F.col(c).cast("string"), widths[c], "0") for c in typed})


def where_parts(df: DataFrame, year=None, month=None, day=None) -> DataFrame:
    for name, value, width in (("year", year, 4), ("month", month, 2), ("day", day, 2)):
        if value is not None and name in df.columns:
            df = df.where(F.col(name) == f"{int(value):0{width}d}")
    return df


def where_span(df: DataFrame, low: datetime, high: datetime) -> DataFrame:
    """Directory filter implied by a time range: comparison of year-month-day text prunes partitions."""
    have = [c for c in PARTS if c in df.columns]
    if not have:
        return df
    stamp = F.concat_ws("-", *[F.col(c) for c in have])
    formats = {1: "%Y", 2: "%Y-%m", 3: "%Y-%m-%d"}[len(have)]
    return df.where(stamp.between(low.strftime(formats), high.strftime(formats)))


def load_canonical(spark: SparkSession, root: str, year: int | None = None, month: int | None = None) -> DataFrame:
    """Gold rows, optionally of one year or one month. Unordered: sort at the sink, windows order themselves."""
    return where_parts(read_layer(spark, root), year, month)


def load_recent(
    hourly: DataFrame,
    daily: DataFrame | None,
    end: datetime | str,
    hours: int = 168,
    keys: Sequence[str] = (),
    ts: str = "datetime",
) -> DataFrame:
    """The last ``hours`` + 1 slots up to ``end``. A row of the hourly table wins over the daily one."""
    last = datetime.fromisoformat(str(end))
    first = last - timedelta(hours=hours)

    def bounded(df: DataFrame) -> DataFrame:
        return between(where_span(df, first, last), ts, first, last)

    # Both inputs are cut to the range before the union, so only the range is shuffled.
    rows = bounded(hourly).withColumn("__rank", F.lit(0))
    if daily is not None:
        rows = rows.unionByName(bounded(daily).withColumn("__rank", F.lit(1)), allowMissingColumns=True)
    columns = [c for c in rows.columns if c != "__rank"]
    rest = [c for c in columns if c not in (*keys, ts)]
    return dedup_first(rows, keys, ts, ["__rank", *fullest(rest)]).select(*columns)


def recent_days(df: DataFrame, now: datetime | str, days: int = 30, ts: str = "datetime") -> DataFrame:
    """Rows of the last ``days`` days before ``now`` over all partitions."""
    low = datetime.fromisoformat(str(now)) - timedelta(days=days)
    return where_span(df, low, datetime.max).where(F.col(ts) >= F.lit(str(low)).cast("timestamp_ntz"))


def read_silver(spark: SparkSession, root: str, signals: Sequence[str], fmt: str = "parquet") -> dict[str, DataFrame]:
    """One lazy scan per signal table; ``fmt`` is any installed table format."""
    return {s: spark.read.format(fmt).load(f"{root.rstrip('/')}/{s}") for s in signals}


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Prediction documents of either layout as one row per predicted hour."""
    return normalise_predictions(scan_documents(lambda: spark.read.option("recursiveFileLookup", True), path, PREDICTION_ANY))


def normalise_predictions(docs: DataFrame) -> DataFrame:
    # A single record becomes an array of one, so that both layouts go through the same generator.
    single = F.array(
        F.struct(
            F.col("prediction_for").alias("datetime"),
            F.col("predicted_value").alias("predicted"),
            F.col("confidence_lower").alias("lower"),
            F.col("confidence_upper").alias("upper"),
        )
    )
    # By index rather than arrays_zip, which is NULL as soon as one array is absent.
    values = F.transform(
        "predictions",
        lambda v, i: F.struct(
            F.get("timestamps", i).alias("datetime"),
            v.alias("predicted"),
            F.get("confidence_intervals.lower", i).alias("lower"),
            F.get("confidence_intervals.upper", i).alias("upper"),
        ),
    )
    rows = F.when(F.col("predicted_value").isNotNull(), single).otherwise(values)
    return docs.select(
        F.explode(rows).alias("p"), "model_type", "model_version", "generated_at", "based_on_data_until"
    ).select(
        F.col("p.datetime").try_cast("timestamp_ntz").alias("datetime"),
        "p.predicted",
        F.col("p.lower").alias("confidence_lower"),
        F.col("p.upper").alias("confidence_upper"),
        "model_type",
        "model_version",
        "generated_at",
        "based_on_data_until",
    )


def read_registry(spark: SparkSession, root: str) -> DataFrame:
    """The registry table of model versions."""
    return spark.read.schema(REGISTRY).parquet(root)


def read_model_documents(spark: SparkSession, root: str, name: str = "metadata.json") -> DataFrame:
    """Metadata (or metrics) kept as one JSON document per version."""
    return (
        spark.read.schema(REGISTRY)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", name)
        .json(root)
    )
