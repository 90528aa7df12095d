"""Registered queries: nested documents, landing, inventories, compaction, exports. Documents are built from ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegrid.operators import compaction, flatten, quality
from tidegrid.plans import jobs, tables
from tidegrid.plans.catalog import CANON, HOURLY, LOAD, USER_HOURLY, WEATHER, i, n, query, r, t
from tidegrid.schemas import WEATHER_DOC
from tidegrid.session import scratch_path
from tidegrid.sources.footers import read_footers
from tidegrid.sources import bronze, layers, sinks

KINDS = ["view", "click", "signup", "error", "purchase"]
MEASURES = ["temperature", "humidity", "precipitation", "wind_speed", "cloud_cover"]


# Building documents. Hours are unique per day after the hourly aggregation, so a day's list has at most 24 records.


def _text(col: str):
    return F.col(col).cast("string")


def weather_docs(hours: DataFrame, by: list[str]) -> DataFrame:
    """Documents with the hours of each group (a day, or a day and hour)."""
    record = F.struct(
        F.date_format("datetime", "HH:mm:ss").alias("datetime"),
        *[_text(long).alias(short) for short, long in flatten.WEATHER_NAMES.items()],
    )
    dated = sinks.with_partition_cols(hours, "datetime").withColumn("hour", F.date_format("datetime", "HH"))
    grouped = dated.groupBy("year", "month", "day", *[b for b in by if b == "hour"])
    docs = grouped.agg(F.sort_array(F.collect_list(record)).alias("__hours"))
    kind = WEATHER_DOC["days"].dataType
    day = F.struct(
        F.concat_ws("-", "year", "month", "day").alias("datetime"),
        F.lit(None).cast("double").alias("temp"),
        F.lit(None).cast("double").alias("humidity"),
        F.col("__hours").alias("hours"),
    )
    return docs.select(
        *grouped_columns(by),
        F.lit(1).alias("queryCost"),
        F.lit("somewhere").alias("address"),
        F.array(day).cast(kind).alias("days"),
    )


def grouped_columns(by: list[str]) -> list[str]:
    return ["year", "month", "day", *[b for b in by if b == "hour"]]


def signal_docs(hours: DataFrame, signal: str, record, field: str, by: list[str], zone="Z") -> DataFrame:
    dated = sinks.with_partition_cols(hours, "datetime").withColumn("hour", F.date_format("datetime", "HH"))
    docs = dated.groupBy(*grouped_columns(by)).agg(F.collect_list(F.struct("datetime", record.alias("r"))).alias("x"))
    # Records may hold maps, which have no order of their own.
    ordered = F.array_sort("x", lambda a, b: F.when(a["datetime"] < b["datetime"], -1).otherwise(1))
    items = F.transform(ordered, lambda x: x["r"])
    placed = docs.select(*grouped_columns(by), F.lit(zone).alias("zone"), items.alias(field))
    day = F.concat_ws("-", "year", "month", "day")
    return bronze.with_provenance(placed, F.lit(signal), day, F.col("zone"), F.col("hour") if "hour" in by else None)


def iso():
    return F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("datetime")


def load_docs(spark, d, field="data", by=("day",), signal="total_load") -> DataFrame:
    record = F.struct(iso(), _text("total_load").alias("value"))
    return signal_docs(tables.load(spark, d), signal, record, field, list(by))


def map_hours(spark: SparkSession, d: str) -> DataFrame:
    """Per hour the total of each event type as a map (at most five entries)."""
    pairs = F.map_from_entries(F.collect_list(F.struct("event_type", "total"))).alias("parts")
    return tables.hourly(spark, d).groupBy("datetime").agg(pairs)


def landed(spark: SparkSession, docs: DataFrame, source: str, signal=None, by=("day",)) -> str:
    root = scratch_path(spark, "bronze")
    path = "/".join(p for p in (root, source, signal) if p)
    bronze.write_bronze(docs, path, ("year", "month", "day", *[b for b in by if b == "hour"]))
    return root


# Flattening


_WEATHER_SQL = f"SELECT {t('datetime')}, {', '.join(r(c) for c in MEASURES)} FROM weather"


@query("flatten_weather", f"WITH {WEATHER} {_WEATHER_SQL}")
def flatten_weather(spark, d):
    root = landed(spark, weather_docs(tables.weather(spark, d), []), "weather")
    docs = bronze.read_bronze(spark, root, "weather")
    good, _ = quality.check_payload(docs, "weather")
    rows = flatten.coerce_numeric(flatten.flatten_weather(good), list(flatten.WEATHER_NAMES), "double")
    return flatten.select_weather(rows, kind="double")


_LOAD_SQL = f"SELECT {t('datetime + INTERVAL 7 HOUR', 'datetime')}, {r('total_load')} FROM load"


@query("flatten_electricity", f"WITH {LOAD} {_LOAD_SQL}")
def flatten_electricity(spark, d):
    root = landed(spark, load_docs(spark, d), "electricity", "total_load")
    docs = bronze.read_bronze(spark, root, "electricity", "total_load")
    rows = flatten.coerce_numeric(flatten.flatten_electricity(docs), ["value"], "double")
    return flatten.select_electricity(rows, kind="double")


@query(
    "parse_signal",
    f"WITH {LOAD} SELECT {t('datetime', 'datetime_utc')}, {t('datetime + INTERVAL 7 HOUR', 'hour_ict')}, {r('total_load', 'total_load_mw')} FROM load",
)
def parse_signal(spark, d):
    root = landed(spark, load_docs(spark, d, "history"), "electricity", "total_load")
    docs = bronze.read_bronze(spark, root, "electricity", "total_load")
    rows = flatten.align_hours(flatten.signal_parser("total_load")(docs))
    return rows.select("datetime_utc", "hour_ict", "total_load_mw")


@query(
    "parse_weather_utc",
    f"WITH {WEATHER} SELECT {t('datetime + INTERVAL 7 HOUR', 'hour_ict')}, {r('temperature', 'temp')}, {r('humidity')} FROM weather",
)
def parse_weather_utc(spark, d):
    root = landed(spark, weather_docs(tables.weather(spark, d), []), "weather")
    rows = flatten.align_hours(flatten.parse_weather_utc(bronze.read_bronze(spark, root, "weather")))
    return rows.select("hour_ict", "temp", "humidity")


def _pivot_sql(prefix: str) -> str:
    cols = ", ".join(r(f"max(total) FILTER (WHERE event_type = '{k}')", f"{prefix}_{k}_mw") for k in KINDS)
    return f"WITH {HOURLY} SELECT strftime(datetime, '%Y-%m-%dT%H:%M:%SZ') AS datetime, {cols} FROM hourly GROUP BY hourly.datetime"


@query("mix_wide", _pivot_sql("mix"))
def mix_wide(spark, d):
    record = F.struct(iso(), F.col("parts").alias("powerConsumptionBreakdown"))
    docs = signal_docs(map_hours(spark, d), "electricity_mix", record, "data", [])
    root = landed(spark, docs, "electricity", "electricity_mix")
    rows = flatten.parse_mix(bronze.read_bronze(spark, root, "electricity", "electricity_mix"), KINDS)
    return rows.select("datetime", *[f"mix_{k}_mw" for k in KINDS])


@query("flows_wide", _pivot_sql("flow"))
def flows_wide(spark, d):
    record = F.struct(iso(), F.col("parts").alias("exchange"))
    docs = signal_docs(map_hours(spark, d), "electricity_flows", record, "history", [])
    root = landed(spark, docs, "electricity", "electricity_flows")
    # Open zone list: discovered from the data.
    rows = flatten.parse_flows(bronze.read_bronze(spark, root, "electricity", "electricity_flows"))
    return rows.select("datetime", *[f"flow_{k}_mw" for k in KINDS])


# Several documents per file: one series per user, all users of a day landing in the same files

_ZONES = f"""{USER_HOURLY}, zoned AS (SELECT user_id::VARCHAR AS zone, datetime, total, mean FROM user_hourly)"""


def zoned_docs(spark, d, source: str) -> DataFrame:
    hours = tables.hourly(spark, d, ["user_id"]).select(_text("user_id").alias("zone"), "datetime", "total", "mean")
    dated = sinks.with_partition_cols(hours, "datetime")
    if source == "weather":
        record = F.struct(F.date_format("datetime", "HH:mm:ss").alias("datetime"), _text("total").alias("temp"), _text("mean").alias("humidity"))
        docs = dated.groupBy("year", "month", "day", F.col("zone").alias("address")).agg(F.sort_array(F.collect_list(record)).alias("h"))
        day = F.struct(F.concat_ws("-", "year", "month", "day").alias("datetime"), F.col("h").alias("hours"))
        return docs.select("year", "month", "day", "address", F.array(day).alias("days"))
    record = F.struct(iso(), _text("total").alias("value"))
    return dated.groupBy("year", "month", "day", "zone").agg(F.sort_array(F.collect_list(record)).alias("data"))


@query(
    "flatten_weather_zones",
    f"WITH {_ZONES} SELECT zone AS address, {t('datetime')}, {r('total', 'temperature')}, {r('mean', 'humidity')} FROM zoned",
)
def flatten_weather_zones(spark, d):
    root = landed(spark, zoned_docs(spark, d, "weather").coalesce(4), "weather")
    good, _ = quality.check_payload(bronze.read_bronze(spark, root, "weather"), "weather")
    rows = flatten.flatten_weather(good, ["query_date", "address"])
    return flatten.select_weather(rows, ["address"], "double").select("address", "datetime", "temperature", "humidity")


@query(
    "flatten_electricity_zones",
    f"WITH {_ZONES} SELECT zone, {t('datetime + INTERVAL 7 HOUR', 'datetime')}, {r('total', 'total_load')} FROM zoned",
)
def flatten_electricity_zones(spark, d):
    root = landed(spark, zoned_docs(spark, d, "electricity").coalesce(4), "electricity", "total_load")
    docs = bronze.read_bronze(spark, root, "electricity", "total_load")
    return flatten.select_electricity(flatten.flatten_electricity(docs), ["zone"], "double")


@query("quarantine_documents", f"WITH {LOAD}, k AS (SELECT DISTINCT CAST(datetime AS DATE) AS day FROM load) SELECT 'unreadable' AS problem, {n('count(*)', 'documents')} FROM k WHERE date_part('day', day) % 2 = 0 HAVING count(*) > 0 UNION ALL SELECT 'good', {n('count(*)', 'documents')} FROM k")
def quarantine_documents(spark, d):
    """Every even day a cut-off document lands beside the good one; all of them are stored with their text."""
    root = landed(spark, load_docs(spark, d), "electricity", "total_load")
    days = tables.load(spark, d).select(F.to_date("datetime").alias("datetime")).distinct().where(F.day("datetime") % 2 == 0)
    broken = sinks.with_partition_cols(days).select("year", "month", "day", F.lit('{"zone": "Z", "data": [{"datetime": "2024').alias("value"))
    path = f"{root}/electricity/total_load"
    broken.write.mode("append").partitionBy("year", "month", "day").option("compression", "none").text(f"{root}/texts")
    for row in broken.select("year", "month", "day").collect():  # one directory per day
        place = f"year={row.year}/month={row.month}/day={row.day}"
        files = spark.read.text(f"{root}/texts/{place}")
        files.write.mode("append").format("text").save(f"{path}/{place}")
    kept = scratch_path(spark, "quarantine")
    docs = bronze.read_bronze(spark, root, "electricity", "total_load")
    jobs.keep_bad(docs, "electricity", kept)
    good, _ = quality.check_payload(docs, "electricity")
    bad = spark.read.parquet(kept).where("text IS NOT NULL").groupBy("problem").agg(F.count("*").alias("documents"))
    return bad.unionByName(good.agg(F.lit("good").alias("problem"), F.count("*").alias("documents")))


# Hour slices


@query(
    "slice_hour_weather",
    f"WITH {WEATHER} SELECT {t('datetime')}, strftime(datetime, '%H') AS payload_hour, {r('temperature')} FROM weather WHERE date_part('hour', datetime) = 13",
)
def slice_hour_weather(spark, d):
    root = landed(spark, weather_docs(tables.weather(spark, d), []), "weather")
    docs = flatten.slice_hour_weather(bronze.read_bronze(spark, root, "weather"), "13")
    rows = docs.select("*", flatten.payload_hour(docs).alias("payload_hour"))
    flat = flatten.flatten_weather(rows, ["query_date", "payload_hour"])
    return flatten.select_weather(flat, ["payload_hour"], "double").select("datetime", "payload_hour", "temperature")


@query(
    "slice_hour_electricity",
    f"""WITH {LOAD} SELECT {t('datetime + INTERVAL 7 HOUR', 'datetime')}, strftime(datetime, '%H') AS payload_hour, '05' AS tagged_hour, {r('total_load')}
FROM load WHERE date_part('hour', datetime + INTERVAL 7 HOUR) = 5""",
)
def slice_hour_electricity(spark, d):
    root = landed(spark, load_docs(spark, d), "electricity", "total_load")
    docs = flatten.slice_hour_electricity(bronze.read_bronze(spark, root, "electricity", "total_load"), "05", "total_load")
    rows = docs.select("*", flatten.payload_hour(docs).alias("payload_hour"), F.col("_metadata.hour").alias("tagged_hour"))
    flat = flatten.flatten_electricity(rows, keep=["payload_hour", "tagged_hour"])
    return flatten.select_electricity(flat, ["payload_hour", "tagged_hour"], "double")


@query("compact_docs_weather", f"WITH {WEATHER} {_WEATHER_SQL}")
def compact_docs_weather(spark, d):
    root = landed(spark, weather_docs(tables.weather(spark, d), ["hour"]), "weather", by=["day", "hour"])
    docs = bronze.read_bronze(spark, root, "weather", granularity="hourly").drop("hour")
    days = compaction.compact_weather_docs(docs)
    return flatten.select_weather(flatten.flatten_weather(days, ["query_date"]), kind="double")


@query("compact_docs_electricity", f"WITH {LOAD} {_LOAD_SQL}")
def compact_docs_electricity(spark, d):
    docs = load_docs(spark, d, "history", ["day", "hour"])
    root = landed(spark, docs, "electricity", "total_load", ["day", "hour"])
    docs = bronze.read_bronze(spark, root, "electricity", "total_load").drop("hour")
    days = compaction.compact_electricity_docs(docs)
    rows = flatten.flatten_electricity(days.withColumn("data", F.lit(None).cast(docs.schema["data"].dataType)), keep=[])
    return flatten.select_electricity(rows, kind="double")


@query(
    "quality_payload",
    f"""WITH d AS (SELECT date_trunc('day', ts) AS day, count(*) FILTER (WHERE event_type = 'view' AND date_part('hour', ts) = 0) AS c FROM events GROUP BY 1)
SELECT coalesce(CASE WHEN c = 0 THEN 'no hours' WHEN c % 3 = 0 THEN 'no days' END, 'good') AS problem, {n('count(*)', 'documents')} FROM d GROUP BY 1""",
)
def quality_payload(spark, d):
    """Documents broken by rule: a day without views in hour 0 has no hours, every third count loses its days."""
    day = F.date_trunc("DAY", F.col("ts")).cast("timestamp_ntz").alias("datetime")
    views = F.count_if((F.col("event_type") == "view") & (F.hour("ts") == 0)).alias("c")
    days = sinks.with_partition_cols(tables.events(spark, d).groupBy(day).agg(views), "datetime")
    kind = WEATHER_DOC["days"].dataType
    hour = F.struct(F.lit("00:00:00").alias("datetime"), _text("c").alias("temp"))
    hours = F.when(F.col("c") > 0, F.array(hour)).otherwise(F.array().cast("array<struct<datetime:string,temp:string>>"))
    one = F.array(F.struct(_text("datetime").alias("datetime"), hours.alias("hours")))
    body = F.when((F.col("c") > 0) & (F.col("c") % 3 == 0), F.lit(None)).otherwise(one)
    docs = days.select("year", "month", "day", F.lit(1).alias("queryCost"), body.alias("days"))
    root = landed(spark, docs, "weather")
    good, bad = quality.check_payload(bronze.read_bronze(spark, root, "weather"), "weather")
    both = good.select(F.lit("good").alias("problem")).unionByName(bad.select("problem"))
    return both.groupBy("problem").agg(F.count(F.lit(1)).alias("documents"))


# Layers, inventories, compaction


def _hourly_layer(spark, d) -> str:
    """The load series appended in three runs, so that every day directory holds several files."""
    root = scratch_path(spark, "layer")
    rows = tables.load(spark, d)
    for third in range(3):
        sinks.write_layer(rows.where(F.hour("datetime") % 3 == third), root)
    return root


@query(
    "partition_inventory",
    f"""WITH {LOAD} SELECT strftime(datetime, '%Y') AS year, strftime(datetime, '%m') AS month, strftime(datetime, '%d') AS day,
{n("count(DISTINCT date_part('hour', datetime) % 3)", 'file_count')}, 0::BIGINT AS hourly_files, false AS has_daily, {n('count(*)', 'row_count')} FROM load GROUP BY 1, 2, 3""",
)
def partition_inventory(spark, d):
    return sinks.partition_inventory(spark, _hourly_layer(spark, d)).drop("byte_count")


@query(
    "file_bounds",
    f"""WITH {LOAD} SELECT {n('count(*)', 'row_count')}, {n('sum((total_load IS NULL)::INT)', 'nulls')}, {r('min(total_load)', 'least')}, {r('max(total_load)', 'greatest')} FROM load""",
)
def file_bounds(spark, d):
    """Rows, nulls and bounds of the load of a layer, out of the footers of its files."""
    of = lambda name: F.col(name)["total_load"]
    return read_footers(spark, _hourly_layer(spark, d)).agg(
        F.sum("rows").alias("row_count"), F.sum(of("nulls")).alias("nulls"), F.min(of("low").cast("double")).alias("least"), F.max(of("high").cast("double")).alias("greatest")
    )


@query(
    "compact_day",
    f"""WITH {LOAD}, f AS (SELECT strftime(datetime, '%Y-%m-%d') AS k, count(DISTINCT date_part('hour', datetime) % 3) AS files FROM load GROUP BY 1)
SELECT {t('datetime')}, {r('total_load')}, CASE WHEN files > 1 THEN 'success' ELSE 'already_compacted' END AS status, 'already_compacted' AS second_run
FROM load JOIN f ON f.k = strftime(datetime, '%Y-%m-%d')""",
)
def compact_day(spark, d):
    root = _hourly_layer(spark, d)
    parts = list(sinks.LEVELS["day"])
    first = compaction.compact_day(spark, root).select(*parts, "status")
    again = compaction.compact_day(spark, root).select(*parts, F.col("status").alias("second_run"))
    rows = layers.read_layer(spark, root)
    return rows.join(first, parts).join(again, parts).select("datetime", "total_load", "status", "second_run")


@query(
    "compact_month",
    f"""WITH o AS (SELECT o_orderkey, date_trunc('month', o_orderdate) AS m, o_orderdate FROM orders),
full_months AS (SELECT m FROM o, (SELECT max(CAST(o_orderdate AS DATE)) AS last FROM orders)
  GROUP BY m, last HAVING count(DISTINCT CAST(o_orderdate AS DATE)) >= date_part('day', last_day(m)) AND last_day(m) < last)
SELECT {n('o_orderkey')}, strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month FROM o WHERE m IN (SELECT m FROM full_months)""",
)
def compact_month(spark, d):
    rows = tables.table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias("datetime"))
    now = rows.agg(F.max("datetime")).first()[0]
    daily, monthly = scratch_path(spark, "daily"), scratch_path(spark, "monthly")
    sinks.write_layer(rows, daily, tasks=spark.sparkContext.defaultParallelism)
    # Orders are rows, not series: a month needs all its days, not all its orders every day.
    compaction.compact_month(spark, daily, monthly, now, ["o_orderkey"], series=[])
    if not sinks.path_exists(spark, monthly):  # no month is complete
        return spark.createDataFrame([], "o_orderkey long, year string, month string")
    return layers.read_layer(spark, monthly).select("o_orderkey", "year", "month")


@query(
    "retire_hourly",
    f"""WITH {LOAD}, d AS (SELECT strftime(datetime, '%Y-%m-%d') AS day, count(*) AS hours, count(*) FILTER (WHERE date_part('hour', datetime) = 5) AS five FROM load GROUP BY 1)
SELECT day, (five = 0) AS retired, CASE WHEN five = 0 THEN 0 ELSE hours END::BIGINT AS rows_left FROM d""",
)
def retire_hourly(spark, d):
    """The daily layer lacks hour 5, so only days without that hour may go."""
    hourly, daily = _hourly_layer(spark, d), scratch_path(spark, "daily")
    sinks.write_layer(tables.load(spark, d).where(F.hour("datetime") != 5), daily)
    before = layers.read_layer(spark, hourly).select("year", "month", "day").distinct().count()
    days = compaction.retire_hourly(spark, hourly, daily)
    assert days.count() == before
    left = layers.read_layer(spark, hourly).groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("rows_left"))
    both = days.join(left, ["year", "month", "day"], "left")
    return both.select(
        F.concat_ws("-", "year", "month", "day").alias("day"), "retired", F.coalesce("rows_left", F.lit(0)).alias("rows_left")
    )


@query("load_canonical", f"WITH {CANON} SELECT {t('datetime')}, {r('electricity_demand')} FROM canon WHERE date_part('month', datetime) = 1")
def load_canonical(spark, d):
    root = scratch_path(spark, "gold")
    sinks.write_layer(tables.canonical(spark, d), root)
    return layers.load_canonical(spark, root, 2024, 1).select("datetime", "electricity_demand")


@query(
    "read_layer_day",
    f"WITH {CANON} SELECT {t('datetime')}, {r('electricity_demand')} FROM canon WHERE CAST(datetime AS DATE) = (SELECT max(CAST(datetime AS DATE)) FROM canon)",
)
def read_layer_day(spark, d):
    root = scratch_path(spark, "gold")
    sinks.write_layer(tables.canonical(spark, d), root)
    newest = sinks.latest_partition(layers.read_layer(spark, root)).first()
    return layers.read_layer(spark, root, "-".join(newest)).select("datetime", "electricity_demand")


@query("csv_round_trip", f"WITH {LOAD} SELECT {t('datetime')}, {r('total_load')} FROM load")
def csv_round_trip(spark, d):
    path = scratch_path(spark, "csv")
    sinks.export_csv(tables.load(spark, d), path)
    return spark.read.schema("datetime timestamp_ntz, total_load double").option("header", True).csv(path)


@query("observed_write", f"WITH {LOAD} SELECT {n('count(*)', 'row_count')}, 2::INTEGER AS column_count FROM load")
def observed_write(spark, d):
    rows, seen = sinks.observed(tables.load(spark, d), "load")
    rows.write.parquet(scratch_path(spark, "observed"))
    counts = seen.get
    stored = tables.load(spark, d).agg(F.count(F.lit(1)).alias("__n"))
    return stored.select(F.lit(counts["row_count"]).alias("row_count"), F.lit(counts["column_count"]).alias("column_count"))


@query(
    "read_predictions",
    f"""WITH {LOAD}, d AS (SELECT *, CAST(datetime AS DATE) AS day FROM load) SELECT {t('datetime')}, {r('total_load', 'predicted')},
{r('total_load - 50', 'confidence_lower')}, {r('total_load + 50', 'confidence_upper')} FROM d""",
)
def read_predictions(spark, d):
    """Odd days as one document of arrays, even days as one document per hour."""
    rows = tables.load(spark, d).withColumns(
        {"lower": F.col("total_load") - 50.0, "upper": F.col("total_load") + 50.0, "at": F.date_format("datetime", "yyyy-MM-dd HH:mm:ss")}
    )
    odd = F.day("datetime") % 2 == 1
    single = rows.where(~odd).select(
        F.col("at").alias("prediction_for"),
        F.col("total_load").alias("predicted_value"),
        F.col("lower").alias("confidence_lower"),
        F.col("upper").alias("confidence_upper"),
        F.lit("gbt").alias("model_type"),
    )
    packed = rows.where(odd).groupBy(F.to_date("datetime")).agg(
        F.sort_array(F.collect_list(F.struct("at", "total_load", "lower", "upper"))).alias("x")
    )
    arrays = packed.select(
        F.col("x.total_load").alias("predictions"),
        F.col("x.at").alias("timestamps"),
        F.struct(F.col("x.lower").alias("lower"), F.col("x.upper").alias("upper")).alias("confidence_intervals"),
        F.lit("gbt").alias("model_type"),
    )
    root = scratch_path(spark, "predictions")
    single.write.json(f"{root}/single")
    arrays.write.json(f"{root}/arrays")
    return layers.read_predictions(spark, root).select("datetime", "predicted", "confidence_lower", "confidence_upper")


# Jobs


def _bronze_lake(spark, d, by=("day",)) -> str:
    """Weather and load documents below one root."""
    root = scratch_path(spark, "bronze")
    parts = ("year", "month", "day", *[b for b in by if b == "hour"])
    bronze.write_bronze(weather_docs(tables.weather(spark, d), list(by)), f"{root}/weather", parts)
    bronze.write_bronze(load_docs(spark, d, "data", by), f"{root}/electricity/total_load", parts)
    return root


# The load documents are UTC and move by seven hours, the weather documents are local and stay.
_SHIFTED = f"""{WEATHER}, {LOAD},
gold AS (SELECT w.datetime, l.total_load::FLOAT::DOUBLE AS electricity_demand,
    {', '.join(f'w.{c}::FLOAT::DOUBLE AS {c}' for c in ('temperature', 'humidity', 'wind_speed', 'precipitation'))}
  FROM weather w JOIN load l ON w.datetime = l.datetime + INTERVAL 7 HOUR),
bounded AS (SELECT * REPLACE (CASE WHEN temperature BETWEEN -10 AND 60 THEN temperature END AS temperature,
                              CASE WHEN electricity_demand >= 0 THEN electricity_demand END AS electricity_demand) FROM gold)"""
_GOLD = ("electricity_demand", "temperature", "humidity", "wind_speed", "precipitation")


@query(
    "job_backfill",
    f"WITH {_SHIFTED} SELECT {t('datetime')}, {r('electricity_demand')} FROM gold",
)
def job_backfill(spark, d):
    root = scratch_path(spark, "lake")
    now = tables.events(spark, d).agg(F.max("ts")).first()[0]
    jobs.backfill(spark, _bronze_lake(spark, d), f"{root}/silver", f"{root}/gold", f"{root}/monthly", now)
    return layers.load_canonical(spark, f"{root}/gold").select("datetime", "electricity_demand")


@query(
    "job_hourly_increment",
    f"""WITH {_SHIFTED} SELECT {t('datetime')}, {', '.join(r(c) for c in _GOLD)} FROM bounded
WHERE temperature IS NOT NULL AND electricity_demand IS NOT NULL""",
)
def job_hourly_increment(spark, d):
    """Three arrivals: the load without its noon hours and off by one, all weather, then the whole load, late and corrected."""
    root, lake = scratch_path(spark, "lake"), scratch_path(spark, "bronze")
    load = tables.load(spark, d)
    wrong = load.where(F.hour("datetime") != 12).withColumn("total_load", F.col("total_load") + 1.0)
    record = F.struct(iso(), _text("total_load").alias("value"))
    arrivals = [
        ("electricity/total_load", signal_docs(wrong, "total_load", record, "data", [])),
        ("weather", weather_docs(tables.weather(spark, d), [])),
        ("electricity/total_load", load_docs(spark, d)),
    ]
    for place, docs in arrivals:
        bronze.write_bronze(docs, f"{lake}/{place}")
        if sinks.path_exists(spark, f"{lake}/weather"):
            jobs.hourly_increment(spark, lake, f"{root}/silver", f"{root}/gold", f"{root}/checkpoints", granularity="daily")
    return layers.load_canonical(spark, f"{root}/gold").select("datetime", *_GOLD)


@query("job_slice_and_compact", f"WITH {LOAD} {_LOAD_SQL}")
def job_slice_and_compact(spark, d):
    """Day documents cut to hour documents and compacted to days again."""
    lake, cut, whole = _bronze_lake(spark, d), scratch_path(spark, "hours"), scratch_path(spark, "days")
    hours = F.explode(F.sequence(F.lit(0), F.lit(23)))
    days = bronze.read_bronze(spark, lake, "electricity", "total_load").select("query_date").distinct()
    units = days.select("query_date", hours.alias("h")).select(
        "query_date", F.lpad(F.col("h").cast("string"), 2, "0").alias("hour")
    )
    jobs.slice_bronze(spark, lake, cut, units)
    jobs.compact_bronze(spark, cut, whole)
    docs = bronze.read_bronze(spark, whole, "electricity", "total_load", "daily")
    rows = flatten.coerce_numeric(flatten.flatten_electricity(docs, keep=[]), ["value"], "double")
    return flatten.select_electricity(rows, kind="double")


@query("job_slice_rerun", f"WITH {LOAD} SELECT {n('count(*)', 'documents')}, {n('count(*)', 'hours')} FROM load")
def job_slice_rerun(spark, d):
    """Slicing and compacting twice, the second time with one more day wanted: nothing doubles, nothing is lost."""
    lake, cut, whole = _bronze_lake(spark, d), scratch_path(spark, "hours"), scratch_path(spark, "days")
    hours = F.explode(F.sequence(F.lit(0), F.lit(23)))
    docs = bronze.read_bronze(spark, lake, "electricity", "total_load")
    units = docs.select("query_date").distinct().select("query_date", hours.alias("h"))
    units = units.select("query_date", F.lpad(F.col("h").cast("string"), 2, "0").alias("hour"))
    first = units.where(F.col("query_date") != units.agg(F.max("query_date")).scalar())
    for wanted in (first, units, units):
        jobs.slice_bronze(spark, lake, cut, wanted)
    jobs.compact_bronze(spark, cut, whole)
    one = bronze.read_bronze(spark, cut, "electricity", "total_load", "hourly")
    last = one.agg(F.max("query_date")).first()[0]
    # One more compaction, of the last day only, leaves the other days alone.
    jobs._land(compaction.compact_electricity_docs(one.where(F.col("query_date") == F.lit(last))), f"{whole}/electricity/total_load")
    slices = one.agg(F.count("*").alias("documents"))
    flat = flatten.flatten_electricity(bronze.read_bronze(spark, whole, "electricity", "total_load"), keep=[])
    return slices.withColumn("hours", flat.agg(F.count("*").alias("c")).scalar())


@query(
    "keep_first_arrival",
    f"""WITH {LOAD} SELECT {t('datetime + INTERVAL 7 HOUR', 'datetime')}, {r('total_load::FLOAT::DOUBLE', 'total_load')}, {r('(total_load - 1)::FLOAT::DOUBLE', 'latest')} FROM load""",
)
def keep_first_arrival(spark, d):
    """Every hour lands three times: as it is, unreadable as a number, and smaller by one. The first stays; an upsert takes the last."""
    root, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    for change in (F.col("total_load"), F.lit(None).cast("double"), F.col("total_load") - 1.0):
        record = F.struct(iso(), _text("total_load").alias("value"))
        docs = signal_docs(tables.load(spark, d).withColumn("total_load", change), "total_load", record, "data", [])
        bronze.write_bronze(docs, f"{root}/electricity/total_load")
    bronze.write_bronze(weather_docs(tables.weather(spark, d), []), f"{root}/weather")
    jobs.bronze_to_silver(spark, root, silver)
    jobs.hourly_increment(spark, root, f"{silver}-now", f"{silver}-gold", f"{silver}-seen", granularity="all")
    latest = layers.read_layer(spark, f"{silver}-now/electricity").select("datetime", F.col("total_load").alias("latest"))
    return layers.read_layer(spark, f"{silver}/electricity").select("datetime", "total_load").join(latest, "datetime")


_SIX = f"""{WEATHER}, {HOURLY}, mix AS (SELECT datetime, {', '.join(f"max(total) FILTER (WHERE event_type = '{k}') AS mix_{k}_mw" for k in KINDS)} FROM hourly GROUP BY 1),
load AS (SELECT datetime, total AS total_load FROM hourly WHERE event_type = 'purchase')"""


@query(
    "job_six_signal_gold",
    f"""WITH {_SIX} SELECT {t('w.datetime + INTERVAL 7 HOUR', 'hour_ict')}, {r('w.temperature', 'temp')}, {r('l.total_load', 'total_load_mw')}, {r('l.total_load', 'price_eur_per_mwh')},
{r('l.total_load', 'carbon_intensity_gco2eq_kwh')}, {', '.join(r(f'm.mix_{k}_mw') for k in KINDS)}, {', '.join(r(f'm.mix_{k}_mw', f'flow_{k}_mw') for k in KINDS)},
{i("date_part('hour', w.datetime + INTERVAL 7 HOUR)", 'hour_of_day')}, strftime(w.datetime + INTERVAL 7 HOUR, '%m') AS month
FROM weather w LEFT JOIN load l ON l.datetime = w.datetime LEFT JOIN mix m ON m.datetime = w.datetime""",
)
def job_six_signal_gold(spark, d):
    root, lake, gold = scratch_path(spark, "bronze"), scratch_path(spark, "silver"), scratch_path(spark, "gold")
    bronze.write_bronze(weather_docs(tables.weather(spark, d), []), f"{root}/weather")
    for signal in ("total_load", "carbon_intensity", "price_day_ahead"):
        bronze.write_bronze(load_docs(spark, d, "data", signal=signal), f"{root}/electricity/{signal}")
    for signal, field in (("electricity_mix", "powerConsumptionBreakdown"), ("electricity_flows", "exchange")):
        record = F.struct(iso(), F.col("parts").alias(field))
        bronze.write_bronze(signal_docs(map_hours(spark, d), signal, record, "data", []), f"{root}/electricity/{signal}")
    names = {
        "total_load": None,
        "carbon_intensity": None,
        "price_day_ahead": None,
        "electricity_mix": KINDS,
        "electricity_flows": KINDS,
    }
    jobs.six_signal_silver(spark, root, lake, names)
    jobs.six_signal_gold(spark, lake, gold, ["weather", *names])
    measures = ["temp", "total_load_mw", "price_eur_per_mwh", "carbon_intensity_gco2eq_kwh"]
    wide = [f"{p}_{k}_mw" for p in ("mix", "flow") for k in KINDS]
    return layers.read_layer(spark, gold).select("hour_ict", *measures, *wide, "hour_of_day", "month")


@query(
    "job_daily_compaction",
    f"""WITH {WEATHER}, {LOAD} SELECT {t('w.datetime', 'datetime')}, {r('l.total_load', 'electricity_demand')}, 0::BIGINT AS hourly_rows_left
FROM weather w JOIN load l ON l.datetime = w.datetime""",
)
def job_daily_compaction(spark, d):
    root = scratch_path(spark, "lake")
    for source, rows in (("weather", tables.weather(spark, d)), ("electricity", tables.load(spark, d))):
        sinks.write_layer(rows.where(F.hour("datetime") < 12), f"{root}/silver/{source}")
        sinks.write_layer(rows.where(F.hour("datetime") >= 12), f"{root}/silver/{source}")
    hourly = quality.drop_null_critical(tables.canonical(spark, d))
    sinks.write_layer(hourly, f"{root}/hourly")
    newest = sinks.latest_partition(layers.read_layer(spark, f"{root}/hourly")).first()
    jobs.silver_to_gold(spark, f"{root}/silver", f"{root}/daily")
    days = jobs.daily_compaction(spark, f"{root}/silver", f"{root}/daily", f"{root}/hourly", "-".join(newest))
    left = days.where(~F.col("retired")).agg(F.count(F.lit(1)).alias("c"))
    gold = layers.load_canonical(spark, f"{root}/daily").select("datetime", "electricity_demand")
    return gold.withColumn("hourly_rows_left", left.scalar())


# An outage: what follows the tenth day comes thirty days later, the load of that day and of the first one after it is
# missing, and impossible values stand on either side.


def _outage_sql(source: str, value: str, out: str) -> str:
    day = "date_part('day', datetime)"
    shifted = f"datetime + CASE WHEN {day} > 10 THEN INTERVAL 30 DAY ELSE INTERVAL 0 DAY END AS datetime"
    return f"{out} AS (SELECT * REPLACE ({shifted}, {value}) FROM {source})"


_LOST = "CASE WHEN date_part('day', datetime) IN (10, 11) THEN CASE WHEN date_part('hour', datetime) = 5 THEN -50 END ELSE total_load END AS total_load"
_HOT = "CASE WHEN date_part('day', datetime) = 10 AND date_part('hour', datetime) >= 20 THEN 99 ELSE temperature END AS temperature"
_OUTAGE = f"""{WEATHER.replace('weather AS', 'w0 AS')}, {LOAD.replace('load AS', 'l0 AS')},
{_outage_sql('w0', _HOT, 'weather')}, {_outage_sql('l0', _LOST, 'load')},
canon AS (SELECT w.datetime, l.total_load AS electricity_demand, w.temperature, w.humidity, w.wind_speed, w.precipitation FROM weather w JOIN load l ON w.datetime = l.datetime)"""


def _after_outage() -> str:
    from tidegrid.plans.queries_series import _imputed_sql

    chosen = ("2024-01-09", "2024-01-10", "2024-02-10", "2024-02-11")
    days = ", ".join(f"DATE '{day}'" for day in chosen)
    sql = _imputed_sql(f"SELECT {t('datetime')}, {r('electricity_demand')}, {r('temperature')} FROM twice WHERE electricity_demand IS NOT NULL AND temperature IS NOT NULL AND datetime::DATE IN ({days})")
    return sql.replace(CANON, _OUTAGE)


@query("job_daily_compaction_outage", _after_outage())
def job_daily_compaction_outage(spark, d):
    """Days on both sides of an outage of thirty days, compacted one by one: each equals the full run."""
    root, day = scratch_path(spark, "lake"), F.day("datetime")
    shifted = F.when(day > 10, F.col("datetime") + F.expr("INTERVAL 30 DAYS")).otherwise(F.col("datetime"))
    lost = F.when(day.isin(10, 11), F.when(F.hour("datetime") == 5, F.lit(-50.0))).otherwise(F.col("total_load"))
    hot = F.when((day == 10) & (F.hour("datetime") >= 20), F.lit(99.0)).otherwise(F.col("temperature"))
    weather, load = tables.weather(spark, d).withColumn("temperature", hot), tables.load(spark, d).withColumn("total_load", lost)
    for source, rows in (("weather", weather), ("electricity", load)):
        sinks.write_layer(rows.withColumn("datetime", shifted), f"{root}/silver/{source}")
    sinks.write_layer(quality.drop_null_critical(tables.canonical(spark, d)), f"{root}/hourly")
    for on in ("2024-01-09", "2024-01-10", "2024-02-10", "2024-02-11"):
        jobs.daily_compaction(spark, f"{root}/silver", f"{root}/daily", f"{root}/hourly", on)
    return layers.load_canonical(spark, f"{root}/daily").select("datetime", "electricity_demand", "temperature")


@query(
    "silver_tables",
    f"""WITH {WEATHER}, {LOAD} SELECT 'weather' AS signal, {n('count(*)', 'rows')}, {n('count(DISTINCT datetime)', 'hours')} FROM weather
UNION ALL SELECT 'total_load', 2 * count(*)::BIGINT, count(DISTINCT datetime)::BIGINT FROM load""",
)
def silver_tables(spark, d):
    """Cleaned rows appended to a table per signal, an empty batch among them, and all tables scanned lazily."""
    root, load = scratch_path(spark, "silver"), tables.load(spark, d)
    sinks.append_silver(tables.weather(spark, d), f"{root}/weather")
    for batch in (load, load.limit(0), load):
        sinks.append_silver(batch, f"{root}/total_load")
    found = layers.read_silver(spark, root, ["weather", "total_load"])
    counts = [F.count(F.lit(1)).alias("rows"), F.countDistinct("datetime").alias("hours")]
    one, two = (df.agg(F.lit(name).alias("signal"), *counts) for name, df in found.items())
    return one.unionByName(two)


@query(
    "model_documents",
    f"""SELECT event_type AS version, {n('count(*)', 'samples')}, {r('avg(value)', 'rmse')} FROM events GROUP BY event_type""",
)
def model_documents(spark, d):
    """Model metadata kept as one indented JSON document per version, as a table."""
    root = scratch_path(spark, "documents")
    rows = tables.events(spark, d).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("v"))
    body = F.to_json(
        F.struct(
            F.lit("gbt").alias("model_type"),
            F.col("event_type").alias("version"),
            F.struct(F.col("n").alias("total_samples")).alias("training"),
            F.create_map(F.lit("rmse"), F.col("v")).alias("metrics"),
        ),
        {"pretty": "true"},
    )
    rows.select("event_type", body.alias("value")).write.partitionBy("event_type").option("lineSep", "\n\n").text(root)
    found = layers.read_model_documents(spark, root, "part-*")
    return found.select("version", F.col("training.total_samples").alias("samples"), F.col("metrics")["rmse"].alias("rmse"))
