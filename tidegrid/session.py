"""Session settings and the shared scratch area used to cut lineage and stage writes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings every job expects. Shuffle width is left to the cluster: AQE coalesces from there.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Zero-padded month/day directories must stay text.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Recording the Python call site of every column costs seconds on a matrix of hundreds of columns.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "tidegrid", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach. Only a local-mode session may fall back to a temporary one."""
    known = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if known:
        return known
    if not is_local(spark):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="tidegrid-")
    spark.conf.set(CHECKPOINT_CONF, made)
    return made


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store the rows as Parquet in the shared folder and read them back.

    Later passes read the stored columns they need, also after an executor is lost.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
