"""Model versions as a table: training records, comparison, best and latest version, retention, promotion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidegrid.functions.labels import HIGHER_IS_BETTER, LOWER_IS_BETTER, improvement
from tidegrid.models.training import Fitted
from tidegrid.schemas import REGISTRY

KEEP_VERSIONS = 5
PROMOTION_METRIC = "rmse"


def version_name(moment: datetime) -> str:
    return f"v1.0.{int(moment.timestamp())}"


def training_record(
    spark: SparkSession,
    model_type: str,
    version: str,
    started: datetime,
    completed: datetime,
    samples: Mapping[str, int],
    names: Sequence[str],
    params: Mapping,
    metrics: Mapping[str, float],
    mode: str = "FULL_TRAIN",
    tags: Mapping[str, str] | None = None,
    notes: str = "",
) -> DataFrame:
    """One registry row."""
    training = (
        started.isoformat(),
        completed.isoformat(),
        (completed - started).total_seconds(),
        sum(samples.get(s, 0) for s in ("train", "val", "test")),
        samples.get("train", 0),
        samples.get("val", 0),
        samples.get("test", 0),
        len(names),
        list(names),
        mode,
        {k: str(v) for k, v in params.items()},
    )
    known = {k: float(v) for k, v in metrics.items() if v is not None}
    return spark.createDataFrame([(model_type, version, training, known, dict(tags or {}), notes)], REGISTRY)


def save_model(fitted: Fitted, record: DataFrame, root: str) -> str:
    """Store the fitted stages below type/version and append the registry row last, so a version is listed only
    once it can be loaded."""
    row = record.select("model_type", "version").first()
    path = f"{root.rstrip('/')}/models/{row['model_type']}/{row['version']}"
    fitted.model.write().overwrite().save(path)
    record.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/registry")
    return path


def registry(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(REGISTRY).parquet(f"{root.rstrip('/')}/registry")


def latest_version(reg: DataFrame) -> DataFrame:
    """The newest row of each model type, by completion time."""
    newest = F.max_by(F.struct(*reg.columns), F.struct("training.completed_at", "version")).alias("r")
    return reg.groupBy("model_type").agg(newest).select("r.*")


def load_model(spark: SparkSession, root: str, model_type: str, version: str = "latest") -> tuple[Fitted, dict]:
    """A fitted model and its registry row."""
    rows = registry(spark, root).where(F.col("model_type") == model_type)
    row = (latest_version(rows) if version == "latest" else rows.where(F.col("version") == version)).first()
    if row is None:
        raise ValueError(f"no version {version} of {model_type}")
    stages = PipelineModel.load(f"{root.rstrip('/')}/models/{model_type}/{row['version']}")
    return Fitted(stages, list(row["training"]["feature_names"]), dict(row["metrics"])), row.asDict(recursive=True)


def compare_versions(reg: DataFrame, first: str, second: str, metric: str = PROMOTION_METRIC) -> DataFrame:
    """Whether ``second`` beats ``first`` on a metric, by how many percent, and the sentence saying so."""
    picked = reg.select("version", F.col("metrics")[metric].alias("value"))
    pair = picked.where(F.col("version").isin(first, second)).agg(
        F.lit(first).alias("version1"),
        F.lit(second).alias("version2"),
        F.lit(metric).alias("metric"),
        F.max(F.when(F.col("version") == first, F.col("value"))).alias("version1_value"),
        F.max(F.when(F.col("version") == second, F.col("value"))).alias("version2_value"),
    )
    return with_comparison(pair, metric)


def with_comparison(pair: DataFrame, metric: str) -> DataFrame:
    old, new = F.col("version1_value"), F.col("version2_value")
    gain = F.coalesce(improvement(metric, old, new), F.lit(0.0))
    if metric in LOWER_IS_BETTER:
        better = new < old
    elif metric in HIGHER_IS_BETTER:
        better = new > old
    else:
        better = F.lit(None).cast("boolean")
    size = F.format_string("%.2f", F.abs(gain))
    v1, v2, name = F.col("version1"), F.col("version2"), F.col("metric")

    def sentence(word: str):
        return F.concat(v2, F.lit(" is "), size, F.lit(f"% {word} than "), v1, F.lit(" on "), name)

    return pair.withColumns(
        {
            "is_version2_better": better,
            "improvement_percentage": gain,
            "summary": F.when(gain > 0, sentence("better"))
            .when(gain < 0, sentence("worse"))
            .otherwise(F.concat(v2, F.lit(" has same "), name, F.lit(" as "), v1)),
        }
    )


def best_model(reg: DataFrame, metric: str = PROMOTION_METRIC, minimise: bool | None = None) -> DataFrame:
    """The row with the best value of a metric; rows without it do not take part."""
    low = metric not in HIGHER_IS_BETTER if minimise is None else minimise
    value = F.col("metrics")[metric]
    return reg.where(value.isNotNull()).orderBy(value.asc() if low else value.desc(), "version").limit(1)


def registry_report(reg: DataFrame) -> DataFrame:
    """Version, sizes and metrics, newest first."""
    return reg.select(
        "model_type", "version", "training.completed_at", "training.total_samples", "training.features_count", "metrics"
    ).orderBy(F.desc("completed_at"), "version")


def retain_versions(reg: DataFrame, n: int = KEEP_VERSIONS) -> DataFrame:
    """Rows of each model type with ``keep`` true for the newest n."""
    rank = F.row_number().over(
        Window.partitionBy("model_type").orderBy(F.desc("training.completed_at"), F.desc("version"))
    )
    return reg.withColumn("keep", rank <= n)


def promote(reg: DataFrame, metric: str = PROMOTION_METRIC) -> DataFrame:
    """The version of each model type that should serve: best metric, first version on a tie."""
    value = F.col("metrics")[metric]
    order = F.struct((-value if metric in HIGHER_IS_BETTER else value).alias("v"), F.col("version"))
    chosen = F.min_by(F.struct(*reg.columns), order).alias("r")
    return reg.where(value.isNotNull()).groupBy("model_type").agg(chosen).select("r.*")
