"""Registered queries: the streaming operators, run over whole tables with availableNow and compared with batch SQL.

Windows close when the watermark passes them, so the last ones of a finite input stay open; the oracles leave out
exactly those.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegrid.models.scoring import Linear, Scorer
from tidegrid.operators.features import FeatureConfig
from tidegrid.plans import tables
from tidegrid.plans.catalog import HOURLY, LOAD, USER_HOURLY, WEATHER, i, n, query, r, t
from tidegrid.plans.queries_lake import landed, load_docs, weather_docs
from tidegrid.session import scratch_path
from tidegrid.sources import layers
from tidegrid.streaming import features as stateful
from tidegrid.streaming import hourly as st

KEY = ["event_type"]
RETENTION = "40 days"
LAGS, WINDOWS = (1, 2, 3, 24, 168), (3, 6, 12, 24)


#: Micro-batches of an hourly table. Each costs the same few jobs, so those of a long calendar hold more days.
MOST_RUNS = 12


def as_stream(spark: SparkSession, rows: DataFrame, ts: str = "datetime", days: int = 5, most: int | None = MOST_RUNS) -> DataFrame:
    """Rows as a stream, in order of time: runs of ``days`` days, each in as many files as there are tasks.

    A micro-batch takes the files of one run. Files are read oldest first, and a run is written when the one before it is
    complete, so no batch mixes early and late runs. Of more than ``most`` runs, neighbours are joined; state that
    grows with a micro-batch, as that of single events, is kept small without ``most``.
    """
    root, flat = scratch_path(spark, "arrivals"), scratch_path(spark, "stream")
    run = F.floor(F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")) / days).alias("run")
    width = spark.sparkContext.defaultParallelism
    rows.select("*", run).repartition(width, "run", F.xxhash64(*rows.columns)).write.partitionBy("run").parquet(root)
    runs = sorted(int(r["run"]) for r in spark.read.parquet(root).select("run").distinct().collect())  # the calendar bounds them
    joined = -(-len(runs) // most) if most and runs else 1
    for k in range(0, len(runs), joined):
        part = spark.read.schema(rows.schema).parquet(*(f"{root}/run={each}" for each in runs[k : k + joined]))
        part.repartition(width).write.mode("append").parquet(flat)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", width).parquet(flat)


def finished(spark: SparkSession, df: DataFrame, schema=None) -> DataFrame:
    out = scratch_path(spark, "sink")
    st.write_stream(df, out, scratch_path(spark, "checkpoint")).awaitTermination()
    return spark.read.schema(schema or df.schema).parquet(out)


@query("stream_silver", f"WITH {LOAD} SELECT {t('datetime + INTERVAL 7 HOUR', 'datetime')}, {r('total_load::FLOAT::DOUBLE', 'total_load')} FROM load")
def stream_silver(spark, d):
    docs = load_docs(spark, d, "data")
    root = landed(spark, docs, "electricity", "total_load")
    out = scratch_path(spark, "silver")
    st.stream_silver(
        spark, root, out, scratch_path(spark, "checkpoint"), "electricity", "total_load", "all", delay=RETENTION
    ).awaitTermination()
    return layers.read_layer(spark, out).select("datetime", "total_load")


@query(
    "stream_dedup",
    f"SELECT {n('count(DISTINCT event_id)', 'events')}, count(*)::BIGINT AS rows FROM events",
)
def stream_dedup(spark, d):
    """Every event arrives twice in the same micro-batch; one copy stays."""
    rows = tables.events(spark, d).select("event_id", "ts")
    twice = as_stream(spark, rows.unionByName(rows), "ts", most=None)
    kept = finished(spark, st.naive_time(st.stream_dedup(twice, ["event_id"], "ts"), "ts"))
    return kept.agg(F.countDistinct("event_id").alias("events"), F.count(F.lit(1)).alias("rows"))


@query(
    "stream_join",
    f"WITH {WEATHER}, {LOAD} SELECT {t('w.datetime', 'datetime')}, {r('temperature')}, {r('total_load')} FROM weather w JOIN load l ON l.datetime = w.datetime",
)
def stream_join(spark, d):
    weather = as_stream(spark, tables.weather(spark, d).select("datetime", "temperature"))
    joined = st.stream_join(weather, as_stream(spark, tables.load(spark, d)))
    return finished(spark, st.naive_time(joined, "datetime"))


# Emitted: windows that end no later than the watermark, two hours behind the newest event time.


@query(
    "stream_hourly",
    f"""WITH {HOURLY} SELECT event_type, {t('datetime')}, {r('total')}, {n('n')} FROM hourly, (SELECT max(ts) AS last FROM events)
WHERE datetime + INTERVAL 1 HOUR <= last - INTERVAL 2 HOUR""",
)
def stream_hourly(spark, d):
    rows = as_stream(spark, tables.events(spark, d).select("event_type", F.col("ts").alias("datetime"), "value"), most=None)
    aggs = [F.sum("value").alias("total"), F.count(F.lit(1)).alias("n")]
    return finished(spark, st.stream_hourly(rows, KEY, "datetime", aggs))


@query(
    "stream_day_status",
    f"""WITH {HOURLY} SELECT event_type, strftime(datetime, '%Y-%m-%d') AS day, {n('count(*)', 'hours_present')}, (count(*) >= 24) AS complete
FROM hourly, (SELECT max(datetime) AS last FROM hourly) WHERE date_trunc('day', datetime) + INTERVAL 1 DAY <= last - INTERVAL 2 HOUR GROUP BY 1, 2""",
)
def stream_day_status(spark, d):
    rows = as_stream(spark, tables.hourly(spark, d).select(*KEY, "datetime"))
    return finished(spark, st.stream_day_status(rows, KEY))


def _stream_rolling_sql() -> str:
    parts = []
    for w in WINDOWS:
        over = f"(PARTITION BY event_type ORDER BY datetime RANGE BETWEEN INTERVAL '{w - 1} hours' PRECEDING AND CURRENT ROW)"
        parts.append(
            f"SELECT event_type, datetime, {w} AS window, avg(total) OVER {over} AS m, stddev_samp(total) OVER {over} AS s, "
            f"count(total) OVER {over} AS c FROM hourly"
        )
    return f"""WITH {HOURLY}, x AS ({' UNION ALL '.join(parts)})
SELECT event_type, {t('datetime')}, {i('"window"', '"window"')}, {r('m', 'rolling_mean')}, {r('s', 'rolling_std')} FROM x, (SELECT max(datetime) AS last FROM hourly)
WHERE c = "window" AND datetime + INTERVAL 1 HOUR <= last - INTERVAL 2 HOUR"""


@query("stream_rolling", _stream_rolling_sql())
def stream_rolling(spark, d):
    rows = as_stream(spark, tables.hourly(spark, d).select(*KEY, "datetime", "total"))
    return finished(spark, st.stream_rolling(rows, "total", WINDOWS, KEY))


_LAGS = "\n".join(
    f"LEFT JOIN hourly l{k} ON l{k}.event_type = a.event_type AND l{k}.datetime = a.datetime - INTERVAL {k} HOUR" for k in LAGS
)
def _over(w: int) -> str:
    return f"(PARTITION BY event_type ORDER BY datetime RANGE BETWEEN INTERVAL '{w - 1} hours' PRECEDING AND CURRENT ROW)"


_STATS = ", ".join(f"count(total) OVER {_over(w)} AS c{w}, avg(total) OVER {_over(w)} AS m{w}, stddev_samp(total) OVER {_over(w)} AS s{w}" for w in WINDOWS)
_ROLLED = ", ".join(r(f"CASE WHEN c{w} = {w} THEN {v}{w} END", f"total_rolling_{name}_{w}") for w in WINDOWS for v, name in (("m", "mean"), ("s", "std")))


@query(
    "stream_features",
    f"""WITH {HOURLY}, x AS (SELECT *, {_STATS} FROM hourly)
SELECT a.event_type, {t('a.datetime', 'datetime')}, {r('a.total', 'total')}, {', '.join(r(f'l{k}.total', f'total_lag_{k}') for k in LAGS)},
{_ROLLED} FROM x a {_LAGS}""",
)
def stream_features(spark, d):
    rows = as_stream(spark, tables.hourly(spark, d).select(*KEY, "datetime", "total"))
    return finished(spark, stateful.stream_features(rows, "total", KEY, lags=LAGS, windows=WINDOWS))


@query(
    "stream_upsert",
    f"""WITH {USER_HOURLY} SELECT {n('user_id')}, {t('datetime')}, {r("total + CASE WHEN date_part('day', datetime) % 2 = 0 THEN 1000 ELSE 0 END", 'total')} FROM user_hourly""",
)
def stream_upsert(spark, d):
    """Every hour arrives, then the even days arrive again, corrected; the correction stays."""
    rows = tables.hourly(spark, d, ["user_id"]).select("user_id", "datetime", "total")
    out, kept = scratch_path(spark, "gold"), scratch_path(spark, "checkpoint")
    st.stream_upsert(as_stream(spark, rows), out, kept, ["user_id"]).awaitTermination()
    late = rows.where(F.day("datetime") % 2 == 0).withColumn("total", F.col("total") + 1000.0)
    again = scratch_path(spark, "checkpoint")
    st.stream_upsert(as_stream(spark, late), out, again, ["user_id"]).awaitTermination()
    return layers.read_layer(spark, out).select("user_id", "datetime", "total")


@query(
    "stream_silver_weather",
    f"WITH {WEATHER} SELECT {t('datetime')}, {r('humidity::FLOAT::DOUBLE', 'humidity')} FROM weather",
)
def stream_silver_weather(spark, d):
    root = landed(spark, weather_docs(tables.weather(spark, d), []), "weather")
    out = scratch_path(spark, "silver")
    st.stream_silver(
        spark, root, out, scratch_path(spark, "checkpoint"), "weather", None, "all", delay=RETENTION
    ).awaitTermination()
    return layers.read_layer(spark, out).select("datetime", "humidity")


_CORRECTED = "total + CASE WHEN date_part('day', datetime) % 2 = 0 THEN 1000 ELSE 0 END"


@query(
    "stream_revisions",
    f"""WITH {HOURLY.replace('hourly AS', 'first_hourly AS')}, hourly AS (SELECT event_type, datetime, {_CORRECTED} AS total FROM first_hourly),
x AS (SELECT *, {_STATS} FROM hourly)
SELECT a.event_type, {t('a.datetime', 'datetime')}, {r('a.total', 'total')}, {', '.join(r(f'l{k}.total', f'total_lag_{k}') for k in LAGS)},
{_ROLLED} FROM x a {_LAGS}""",
)
def stream_revisions(spark, d):
    """Each hour arrives; those of even days arrive again five days later, corrected. The merged table equals the batch answer."""
    out = scratch_path(spark, "features")
    made = stateful.stream_features(_corrected(spark, d), "total", KEY, lags=LAGS, windows=WINDOWS, revise=11 * 24, order="arrives")
    st.stream_upsert(made, out, scratch_path(spark, "checkpoint"), KEY).awaitTermination()
    return layers.read_layer(spark, out).select(*made.columns)


def _corrected(spark: SparkSession, d: str) -> DataFrame:
    """Hours in order of arrival: an hour when it ends, and on even days once more, with another value, five days later."""
    rows = tables.hourly(spark, d).select(*KEY, "datetime", "total")
    first = rows.withColumn("arrives", F.col("datetime"))
    again = rows.where(F.day("datetime") % 2 == 0).withColumn("total", F.col("total") + 1000.0)
    again = again.withColumn("arrives", F.col("datetime") + F.expr("INTERVAL 5 DAYS"))
    return as_stream(spark, first.unionByName(again), "arrives")


_SHORT = FeatureConfig(lags=(1, 24), windows=(3,), by="time")
_USED = ["total", "total_lag_24", "total_rolling_mean_3"]


@query(
    "stream_forecast",
    f"""WITH {HOURLY.replace('hourly AS', 'first_hourly AS')}, hourly AS (SELECT event_type, datetime, {_CORRECTED} AS total FROM first_hourly),
x AS (SELECT *, {_STATS} FROM hourly)
SELECT a.event_type, {t('a.datetime', 'based_on_data_until')}, {t('a.datetime + INTERVAL 1 HOUR', 'prediction_for')},
{r('round(0.5 * a.total + 0.3 * l24.total + 0.2 * a.m3, 3)', 'predicted_value')}, 3::INTEGER AS feature_count
FROM x a {_LAGS} WHERE c3 = 3 AND l24.total IS NOT NULL""",
)
def stream_forecast(spark, d):
    """A forecast as each hour arrives, revised when it is corrected: the model weighs the hour, the day before and the last three hours."""
    out = scratch_path(spark, "forecasts")
    weights = Scorer(tuple(_USED), np.zeros(3), np.ones(3), Linear(np.array([0.5, 0.3, 0.2]), 0.0))
    made = stateful.stream_forecast(_corrected(spark, d), weights, ["total"], KEY, config=_SHORT, revise=11 * 24, order="arrives")
    st.stream_upsert(made, out, scratch_path(spark, "checkpoint"), KEY, "based_on_data_until").awaitTermination()
    rows = layers.read_layer(spark, out)
    return rows.select(*KEY, "based_on_data_until", "prediction_for", F.round("predicted_value", 3).alias("predicted_value"), "feature_count")
