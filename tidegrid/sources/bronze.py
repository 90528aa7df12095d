"""Landed JSON documents: scan, choose hourly or daily files, quarantine unreadable ones, land new ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidegrid.schemas import CORRUPT, WEATHER_DOC, electricity_doc

FILE_NAME, ARRIVED = "file_name", "arrived_at"
# Spark's own part files hold one document per line. Any other file is one document, which may be indented.
LINES, WHOLE = "part-*", "{[^p]*,p[^a]*,pa[^r]*,par[^t]*,part[^-]*}.json"
# An hour document lies below an hour directory or is called HH_30; all others cover a day.
HOURLY = r"/hour=[^/]+/[^/]*$|/[0-9]{2}_30[.]json$"
PARTS = T.StructType([T.StructField(n, T.StringType()) for n in ("year", "month", "day", "hour")])


def scan_documents(reader, path: str, schema: T.StructType, granularity: str = "all") -> DataFrame:
    """Every document below ``path``, whatever its file's layout, with its file's path and time of arrival.

    ``reader`` is ``spark.read`` or ``spark.readStream``; called anew for each layout.
    """
    found = None
    for glob, whole in ((LINES, False), (WHOLE, True)):
        df = reader().option("multiLine", whole).option("pathGlobFilter", glob).schema(schema).json(path)
        # Electricity documents have a field called _metadata, which would hide the file metadata column.
        about = df.metadataColumn("_metadata")
        df = df.withColumns({FILE_NAME: about["file_path"], ARRIVED: about["file_modification_time"]})
        found = df if found is None else found.unionByName(df)
    hourly = F.col(FILE_NAME).rlike(HOURLY)
    return found.where({"hourly": hourly, "daily": ~hourly, "all": F.lit(True)}[granularity])


def read_bronze(
    spark: SparkSession,
    root: str,
    source: str,
    signal: str | None = None,
    granularity: str = "all",
    on_error: str = "quarantine",
) -> DataFrame:
    """One row per document with year, month, day, hour (text), the file name and when the file arrived.

    ``granularity``: documents of an hour, of a day, or all. ``on_error="quarantine"`` keeps an unreadable document as a
    row whose ``_corrupt_record`` holds the text; ``"fail"`` stops. A file that cannot be read at all always stops the job.
    """
    doc = WEATHER_DOC if source == "weather" else electricity_doc(signal)
    path = "/".join(p for p in (root.rstrip("/"), source, signal) if p)
    # Partition columns are declared as text so that zero padding survives.
    schema = T.StructType(doc.fields + PARTS.fields)
    options = {"basePath": path, "mode": "FAILFAST"}
    if on_error == "quarantine":
        schema = schema.add(CORRUPT, T.StringType())
        options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    df = scan_documents(lambda: spark.read.options(**options), path, schema, granularity)
    if signal:
        df = df.withColumn("signal", F.lit(signal))
    return df.withColumn("query_date", query_date())


def query_date():
    return F.to_date(F.concat_ws("-", "year", "month", "day"))


def with_provenance(df: DataFrame, signal, day, zone, hour=None) -> DataFrame:
    """Attach signal, query date, zone and hour as the document's ``_metadata``."""
    text = T.StringType()
    fields = {"signal": signal, "query_date": day, "zone": zone, "hour": hour}
    return df.withColumn("_metadata", F.struct(*[F.lit(v).cast(text).alias(k) for k, v in fields.items()]))


def write_bronze(df: DataFrame, root: str, partition_by=("year", "month", "day"), mode: str = "append") -> None:
    """Land documents as JSON, one per line, below ``source[/signal]/year/month/day``."""
    df.write.mode(mode).partitionBy(*partition_by).json(root)
