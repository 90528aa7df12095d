"""Registered queries: joins, time parts, windows, fills, metrics, rankings."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from tidegrid.functions import errors, labels, timeparts
from tidegrid.operators import aggregates, features, joins, paging, quality, ranking, windows
from tidegrid.operators.compaction import union_dedup, union_files
from tidegrid.plans import reports, tables
from tidegrid.plans.catalog import CANON, GRID, HOURLY, KEYED_GRID, LOAD, USER_HOURLY, WEATHER, filled, i, n, query, r, t
from tidegrid.session import scratch_path
from tidegrid.sources import layers, sinks, spine

KEY = ["event_type"]
MEASURES = ["electricity_demand", "temperature", "humidity", "wind_speed", "precipitation"]


def keyed_grid(spark, d):
    """The five series on their gap-free grids."""
    return joins.regularise(tables.hourly(spark, d).select(*KEY, "datetime", "total"), KEY)


# Joins and canonical tables


@query(
    "canonical_hourly",
    f"WITH {CANON} SELECT {t('datetime')}, {', '.join(r(c) for c in MEASURES)} FROM canon WHERE temperature IS NOT NULL",
)
def canonical_hourly(spark, d):
    return quality.drop_null_critical(tables.canonical(spark, d))


def _imputed_sql(select: str) -> str:
    cols = ", ".join(c for c in MEASURES if c not in ("temperature", "electricity_demand"))
    return f"""WITH {CANON},
{filled('canon', MEASURES, out='once')},
clean AS (SELECT datetime, {cols},
  CASE WHEN temperature > 60 OR temperature < -10 THEN NULL ELSE temperature END AS temperature,
  CASE WHEN electricity_demand < 0 THEN NULL ELSE electricity_demand END AS electricity_demand FROM once),
{filled('clean', MEASURES, out='twice')}
{select}"""


@query(
    "canonical_imputed",
    _imputed_sql(f"SELECT {t('datetime')}, {', '.join(r(c) for c in MEASURES)} FROM twice "
                 "WHERE electricity_demand IS NOT NULL AND temperature IS NOT NULL"),
)
def canonical_imputed(spark, d):
    return quality.drop_null_critical(windows.impute_canonical(tables.canonical(spark, d)))


SIX = ["view", "click", "signup", "error", "purchase"]


@query(
    "six_signal_gold",
    f"""WITH {WEATHER}, {HOURLY}
SELECT {t("w.datetime + INTERVAL 7 HOUR", 'hour_ict')}, {r('w.temperature')},
  {', '.join(r(f'x{k}.total', f'{s}_mw') for k, s in enumerate(SIX))},
  {i("date_part('hour', w.datetime + INTERVAL 7 HOUR)", 'hour_of_day')},
  {i("isodow(w.datetime + INTERVAL 7 HOUR)", 'day_of_week')},
  {i("dayofyear(w.datetime + INTERVAL 7 HOUR)", 'day_of_year')},
  {i("date_part('month', w.datetime + INTERVAL 7 HOUR)", 'month')},
  {i("date_part('year', w.datetime + INTERVAL 7 HOUR)", 'year')}
FROM weather w
{' '.join(f"LEFT JOIN hourly x{k} ON x{k}.datetime = w.datetime AND x{k}.event_type = '{s}'" for k, s in enumerate(SIX))}""",
)
def six_signal_gold(spark, d):
    local = timeparts.hour_key(timeparts.to_local("datetime")).alias("hour_ict")
    spine_rows = tables.weather(spark, d).select(local, "temperature")
    hours = tables.hourly(spark, d)
    others = [hours.where(F.col("event_type") == s).select(local, F.col("total").alias(f"{s}_mw")) for s in SIX]
    return timeparts.calendar_features(joins.join_all_signals(spine_rows, others, ["hour_ict"]))


@query(
    "daily_order_canonical",
    f"""WITH o AS (SELECT date_trunc('day', o_orderdate) AS datetime, sum(o_totalprice) AS price, count(*) AS orders FROM orders GROUP BY 1),
l AS (SELECT date_trunc('day', l_shipdate) AS datetime, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1)
SELECT {t('o.datetime', 'datetime')}, round(price, 2) AS price, {n('orders')}, round(quantity, 2) AS quantity,
  strftime(o.datetime, '%Y') AS year, strftime(o.datetime, '%m') AS month, strftime(o.datetime, '%d') AS day
FROM o JOIN l ON o.datetime = l.datetime""",
)
def daily_order_canonical(spark, d):
    day = F.date_trunc("DAY", F.col("o_orderdate")).cast("timestamp_ntz").alias("datetime")
    orders = tables.table(spark, d, "orders").groupBy(day).agg(
        F.round(F.sum("o_totalprice"), 2).alias("price"), F.count(F.lit(1)).alias("orders")
    )
    ship = F.date_trunc("DAY", F.col("l_shipdate")).cast("timestamp_ntz").alias("datetime")
    items = tables.table(spark, d, "lineitem").groupBy(ship).agg(F.round(F.sum("l_quantity"), 2).alias("quantity"))
    return sinks.with_partition_cols(joins.join_signals(orders, items))


@query(
    "align_actual_predicted",
    f"""WITH {HOURLY}
SELECT a.event_type, {t('a.datetime', 'datetime')}, {r('a.total', 'actual')}, {r('b.total', 'predicted')}
FROM hourly a JOIN hourly b ON a.event_type = b.event_type AND a.datetime = b.datetime + INTERVAL 24 HOUR""",
)
def align_actual_predicted(spark, d):
    hours = tables.hourly(spark, d)
    actual = hours.select(*KEY, "datetime", F.col("total").alias("actual"))
    day_later = (F.col("datetime") + F.expr("INTERVAL 24 HOURS")).alias("datetime")
    return joins.align_actual_predicted(actual, hours.select(*KEY, day_later, F.col("total").alias("predicted")), KEY)


@query(
    "pending_units",
    f"""WITH days AS (SELECT unnest(generate_series(min(date_trunc('day', ts)), max(date_trunc('day', ts)), INTERVAL 1 DAY)) AS day FROM events),
kinds AS (SELECT DISTINCT event_type FROM events),
landed AS (SELECT DISTINCT date_trunc('day', ts) AS day, event_type FROM events WHERE date_part('hour', ts) = 0)
SELECT {t('d.day', 'day')}, k.event_type FROM days d CROSS JOIN kinds k
WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE l.day = d.day AND l.event_type = k.event_type)""",
)
def pending_units(spark, d):
    day = F.date_trunc("DAY", F.col("ts")).cast("timestamp_ntz")
    rows = tables.events(spark, d).select("event_type", "ts", day.alias("day"))
    whole = joins.with_scalars(
        rows.select("event_type").distinct(), rows.agg(F.min("day").alias("a"), F.max("day").alias("z"))
    )
    wanted = whole.select("event_type", F.explode(F.sequence("a", "z", F.expr("INTERVAL 1 DAY"))).alias("day"))
    return joins.pending_units(wanted, rows.where(F.hour("ts") == 0), ["day", "event_type"])


@query(
    "cross_units",
    f"""SELECT {t('day')}, s.signal, count(*)::BIGINT AS events FROM (SELECT DISTINCT date_trunc('day', ts) AS day FROM events) x,
(VALUES ('total_load'), ('carbon_intensity'), ('price_day_ahead'), ('electricity_mix'), ('electricity_flows')) s(signal),
events e WHERE date_trunc('day', e.ts) = day GROUP BY day, s.signal""",
)
def cross_units(spark, d):
    from tidegrid.schemas import SIGNALS

    day = F.date_trunc("DAY", F.col("ts")).cast("timestamp_ntz").alias("day")
    counted = tables.events(spark, d).groupBy(day).agg(F.count(F.lit(1)).alias("events"))
    return joins.product_with(counted, "signal", SIGNALS)


# Deduplication and quality


@query(
    "dedup_first",
    f"""SELECT {n('user_id')}, {t('hour')}, {n('event_id')}, event_type, {r('value')} FROM (
  SELECT *, date_trunc('hour', ts) AS hour,
    row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts, event_id) AS k FROM events) WHERE k = 1""",
)
def dedup_first(spark, d):
    rows = tables.events(spark, d).withColumn("hour", timeparts.hour_key("ts"))
    kept = quality.dedup_first(rows, ["user_id"], "hour", ["ts", "event_id"])
    return kept.select("user_id", "hour", "event_id", "event_type", "value")


@query(
    "null_outliers",
    f"SELECT {n('c_custkey')}, {r('CASE WHEN c_acctbal >= 0 THEN c_acctbal END', 'c_acctbal')} FROM customer",
)
def null_outliers(spark, d):
    rows = tables.table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return quality.null_outliers(rows, {"c_acctbal": (0.0, None)})


@query(
    "outlier_counts",
    f"""WITH {CANON} SELECT {n("count(*) FILTER (WHERE temperature > 60 OR temperature < -10)", 'temperature_outliers')},
{n("count(*) FILTER (WHERE electricity_demand < 0)", 'electricity_demand_outliers')} FROM canon""",
)
def outlier_counts(spark, d):
    return quality.outlier_counts(tables.canonical(spark, d), windows.PHYSICAL_LIMITS)


@query(
    "zscore_outliers",
    f"""WITH s AS (SELECT event_type, avg(value) AS m, stddev_samp(value) AS sd FROM events GROUP BY 1)
SELECT {n('event_id')}, e.event_type, {r('value')} FROM events e JOIN s USING (event_type) WHERE abs(value - m) > 3.5 * sd""",
)
def zscore_outliers(spark, d):
    rows = tables.events(spark, d).select("event_id", "event_type", "value")
    return quality.zscore_outliers(rows, ["value"], 3.5, KEY)


@query(
    "range_rules",
    f"""WITH {CANON} SELECT {t('datetime')}, concat_ws(',',
  CASE WHEN temperature < 15 OR temperature > 40 THEN 'temperature' END,
  CASE WHEN humidity < 30 OR humidity > 100 THEN 'humidity' END,
  CASE WHEN wind_speed < 0 OR wind_speed > 50 THEN 'wind_speed' END) AS violations FROM canon
WHERE temperature < 15 OR temperature > 40 OR humidity < 30 OR humidity > 100 OR wind_speed < 0 OR wind_speed > 50""",
)
def range_rules(spark, d):
    bad = quality.range_violations(tables.canonical(spark, d))
    return bad.select("datetime", F.array_join("violations", ",").alias("violations"))


@query(
    "quality_silver",
    f"WITH {WEATHER} SELECT {n('count(*)', 'row_count')}, '' AS missing_columns, true AS ts_is_timestamp, (count(*) > 0) AS valid FROM weather",
)
def quality_silver(spark, d):
    return quality.check_silver(tables.weather(spark, d), ["datetime", "temperature"])


@query(
    "quality_canonical",
    f"""WITH {CANON} SELECT {n('count(*)', 'row_count')}, {n('count(*) - count(datetime)', 'null_datetime')},
{n('count(*) - count(electricity_demand)', 'null_electricity_demand')}, {n('count(*) - count(temperature)', 'null_temperature')},
{n('count(*) - count(DISTINCT datetime)', 'repeated_slots')},
(count(*) > 0 AND count(*) = count(temperature) AND count(*) = count(electricity_demand) AND count(*) = count(DISTINCT datetime)) AS valid
FROM canon""",
)
def quality_canonical(spark, d):
    return quality.check_canonical(tables.canonical(spark, d))


@query(
    "out_of_order",
    f"""SELECT {n('o_custkey')}, {n('o_orderkey')}, {t('o_orderdate')} FROM (
  SELECT *, lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS before FROM orders) WHERE o_orderdate < before""",
)
def out_of_order(spark, d):
    rows = tables.table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return quality.out_of_order(rows, ["o_custkey"], "o_orderdate", "o_orderkey", unit=100_000)


@query(
    "missing_profile",
    f"""WITH {CANON}, x AS (SELECT count(*) AS rows, {', '.join(f'count(*) - count({c}) AS {c}' for c in ['datetime', *MEASURES])} FROM canon)
{' UNION ALL '.join(f"SELECT '{c}' AS column, {n(c, 'missing')}, {r(f'{c} * 100.0 / rows', 'missing_pct')} FROM x" for c in ['datetime', *MEASURES])}""",
)
def missing_profile(spark, d):
    return aggregates.missing_profile(tables.canonical(spark, d))


@query(
    "missing_total",
    f"""WITH {CANON} SELECT {n('sum(m)', 'missing')}, {r('sum(m) * 100.0 / (count(*) * 6)', 'missing_pct')} FROM (
  SELECT {' + '.join(f'({c} IS NULL)::INT' for c in MEASURES)} AS m FROM canon)""",
)
def missing_total(spark, d):
    return aggregates.missing_total(tables.canonical(spark, d))


@query(
    "table_profile",
    f"""WITH {CANON} SELECT {n('count(*)', 'total_rows')}, 6::INTEGER AS total_columns, 5::INTEGER AS real_columns,
{n('sum(' + ' + '.join(f'({c} IS NULL)::INT' for c in MEASURES) + ')', 'missing_values')},
{t('min(datetime)', 'start')}, {t('max(datetime)', 'end')}, {n("date_sub('day', min(datetime), max(datetime))", 'days')} FROM canon""",
)
def table_profile(spark, d):
    p = aggregates.table_profile(tables.canonical(spark, d))
    return p.withColumn("real_columns", F.col("column_types")["double"]).drop("column_types")


# Recent data, set operations


def _two_grains(spark, d):
    """The load series twice: an hourly table that lacks two of every three hours, and a whole daily one."""
    whole = tables.load(spark, d)
    hourly = whole.where(F.hour("datetime") % 3 == 0).withColumn("total_load", F.col("total_load") + 1000.0)
    return hourly, whole


_TWO = f"""{LOAD},
pieces AS (SELECT datetime, total_load + 1000.0 AS total_load, 0 AS k FROM load WHERE date_part('hour', datetime) % 3 = 0
           UNION ALL SELECT datetime, total_load, 1 FROM load),
merged AS (SELECT datetime, total_load FROM (SELECT *, row_number() OVER (PARTITION BY datetime ORDER BY k) AS j FROM pieces) WHERE j = 1)"""


@query(
    "recent_168h",
    f"""WITH {_TWO} SELECT {t('datetime')}, {r('total_load')} FROM merged, (SELECT max(datetime) AS last FROM load)
WHERE datetime BETWEEN last - INTERVAL 168 HOUR AND last""",
)
def recent_168h(spark, d):
    hourly, daily = _two_grains(spark, d)
    end = tables.load(spark, d).agg(F.max("datetime")).first()[0]
    return layers.load_recent(hourly, daily, end, 168)


@query("union_dedup", f"WITH {_TWO} SELECT {t('datetime')}, {r('total_load')} FROM merged")
def union_dedup_query(spark, d):
    return union_dedup(*_two_grains(spark, d))


@query(
    "union_files",
    f"""WITH {WEATHER}, {LOAD} SELECT {t('datetime')}, {r('temperature')}, NULL::DOUBLE AS total_load FROM weather
UNION ALL SELECT {t('datetime')}, NULL::DOUBLE, {r('total_load')} FROM load""",
)
def union_files_query(spark, d):
    return union_files([tables.weather(spark, d).select("datetime", "temperature"), tables.load(spark, d)])


@query(
    "recent_days",
    f"""SELECT {n('event_id')}, {t('ts')}, {r('value')} FROM events, (SELECT max(ts) AS last FROM events)
WHERE ts >= last - INTERVAL 7 DAY""",
)
def recent_days(spark, d):
    rows = tables.events(spark, d).select("event_id", "ts", "value")
    now = rows.agg(F.max("ts")).first()[0]
    return layers.recent_days(rows, now, 7, "ts")


@query(
    "between_dates",
    f"SELECT {n('o_orderkey')}, {t('o_orderdate')} FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1997-05-31'",
)
def between_dates(spark, d):
    rows = tables.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return quality.between_dates(rows, "o_orderdate", "1997-03-01", "1997-05-31")


@query(
    "signal_routing",
    "SELECT count(*)::BIGINT AS rows, count(*) FILTER (WHERE event_type = 'purchase')::BIGINT AS routed FROM events",
)
def signal_routing(spark, d):
    rows = tables.events(spark, d).select(
        F.when(F.col("event_type") == "purchase", "total_load").otherwise(F.col("event_type")).alias("signal")
    )
    routed = quality.only_signal(rows).agg(F.count(F.lit(1)).alias("routed"))
    return joins.with_scalars(rows.agg(F.count(F.lit(1)).alias("rows")), routed)


@query(
    "month_completeness",
    f"""SELECT {i("date_part('year', m)", 'year')}, {i("date_part('month', m)", 'month')}, {n('d', 'days_present')},
{i("date_part('day', last_day(m))", 'days_expected')}, (last_day(m) < last) AS closed,
(last_day(m) < last AND d >= date_part('day', last_day(m))) AS complete
FROM (SELECT date_trunc('month', o_orderdate) AS m, count(DISTINCT CAST(o_orderdate AS DATE)) AS d FROM orders GROUP BY 1),
(SELECT max(CAST(o_orderdate AS DATE)) AS last FROM orders)""",
)
def month_completeness(spark, d):
    rows = tables.table(spark, d, "orders").select("o_orderdate")
    now = rows.agg(F.max("o_orderdate")).first()[0]
    return aggregates.month_completeness(rows, now, "o_orderdate")


@query(
    "distinct_months",
    f"SELECT DISTINCT {i('year(o_orderdate)', 'year')}, {i('month(o_orderdate)', 'month')} FROM orders",
)
def distinct_months(spark, d):
    return aggregates.distinct_months(tables.table(spark, d, "orders"), "o_orderdate")


@query(
    "run_tally",
    f"""WITH landed AS (SELECT event_type, date_trunc('hour', ts) AS h, count(*) AS c FROM events GROUP BY 1, 2)
SELECT event_type, {n("count(*) FILTER (WHERE c BETWEEN 2 AND 4)", 'success')}, {n("count(*) FILTER (WHERE c < 2)", 'failed')},
{n("count(*) FILTER (WHERE c > 4)", 'skipped')} FROM landed GROUP BY 1""",
)
def run_tally(spark, d):
    status = F.when(F.col("n") < 2, "failed").when(F.col("n") > 4, "skipped").otherwise("success")
    return aggregates.run_tally(tables.hourly(spark, d).withColumn("status", status), KEY)


# Time parts and labels

_TF = f"""{i("date_part('hour', datetime)", 'hour')}, {i('isodow(datetime) - 1', 'day_of_week')}, {i("date_part('day', datetime)", 'day_of_month')},
{i("date_part('month', datetime)", 'month')}, {i('CASE WHEN isodow(datetime) >= 6 THEN 1 ELSE 0 END', 'is_weekend')},
{r("sin(2 * pi() * date_part('hour', datetime) / 24)", 'hour_sin')}, {r("cos(2 * pi() * date_part('hour', datetime) / 24)", 'hour_cos')}"""


@query("time_features", f"WITH {HOURLY} SELECT event_type, {t('datetime')}, {_TF} FROM hourly")
def time_features(spark, d):
    return timeparts.time_features(tables.hourly(spark, d).select(*KEY, "datetime"))


@query(
    "calendar_features",
    f"""SELECT {n('o_orderkey')}, {i("date_part('hour', o_orderdate)", 'hour_of_day')}, {i('isodow(o_orderdate)', 'day_of_week')},
{i('dayofyear(o_orderdate)', 'day_of_year')}, {i('month(o_orderdate)', 'month')}, {i('year(o_orderdate)', 'year')} FROM orders""",
)
def calendar_features(spark, d):
    rows = tables.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return timeparts.calendar_features(rows, "o_orderdate").drop("o_orderdate")


@query(
    "local_time",
    f"""SELECT {n('event_id')}, {t("date_trunc('second', ts) + INTERVAL 7 HOUR", 'local_time')}, {t("date_trunc('hour', ts + INTERVAL 7 HOUR)", 'hour_ict')},
strftime(ts, '%H') AS clock_hour, strftime(ts, '%H') AS iso_hour, {t("date_trunc('hour', ts) + INTERVAL 1 HOUR", 'next_hour')} FROM events""",
)
def local_time(spark, d):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = tables.events(spark, d).select("event_id", "ts", iso.alias("iso"), F.date_format("ts", "HH:mm:ss").alias("clock"))
    local = timeparts.to_local(timeparts.parse_utc("iso"))
    return rows.select(
        "event_id",
        local.alias("local_time"),
        timeparts.hour_key(local).alias("hour_ict"),
        timeparts.hour_of_clock("clock").alias("clock_hour"),
        timeparts.hour_of_iso("iso").alias("iso_hour"),
        timeparts.next_hour(timeparts.hour_key("ts")).alias("next_hour"),
    )


@query(
    "freshness",
    f"""SELECT {n('event_id')}, CASE WHEN age < 60 THEN 'fresh' WHEN age < 180 THEN 'stale' ELSE 'old' END AS freshness FROM (
  SELECT event_id, date_diff('microsecond', ts, last) / 60e6 AS age FROM events, (SELECT max(ts) AS last FROM events))""",
)
def freshness(spark, d):
    rows = tables.events(spark, d).select("event_id", "ts")
    both = joins.with_scalars(rows, rows.agg(F.max("ts").alias("last")))
    return both.select("event_id", timeparts.freshness("ts", F.col("last")).alias("freshness"))


@query(
    "month_closed",
    f"""SELECT {n('o_orderkey')}, (last_day(o_orderdate) < last) AS closed FROM orders, (SELECT max(CAST(o_orderdate AS DATE)) AS last FROM orders)""",
)
def month_closed(spark, d):
    rows = tables.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    both = joins.with_scalars(rows, rows.agg(F.max("o_orderdate").alias("last")))
    closed = timeparts.is_month_closed(F.year("o_orderdate"), F.month("o_orderdate"), F.col("last"))
    return both.select("o_orderkey", closed.alias("closed"))


@query(
    "interactions",
    f"""WITH {CANON} SELECT {t('datetime')}, {r("temperature * sin(2 * pi() * date_part('hour', datetime) / 24)", 'temperature_x_hour_sin')},
{r('temperature * (CASE WHEN isodow(datetime) >= 6 THEN 1 ELSE 0 END)', 'temperature_x_is_weekend')},
{r('humidity * temperature', 'humidity_x_temperature')} FROM canon""",
)
def interactions(spark, d):
    rows = labels.interactions(timeparts.time_features(tables.canonical(spark, d)))
    return rows.select("datetime", "temperature_x_hour_sin", "temperature_x_is_weekend", "humidity_x_temperature")


@query(
    "extended_features",
    f"""WITH {CANON}, holidays AS (SELECT day FROM (SELECT CAST(ts AS DATE) AS day, count(*) AS c FROM events GROUP BY 1) WHERE c % 5 = 0)
SELECT {t('datetime')}, {i('quarter(datetime)', 'quarter')}, {i('year(datetime)', 'year')}, {r('temperature * humidity', 'heat_index')},
{r('temperature - 0.5 * wind_speed', 'wind_chill')}, {i('CASE WHEN precipitation > 0 AND humidity > 80 THEN 1 ELSE 0 END', 'rain_indicator')},
{i('CASE WHEN CAST(datetime AS DATE) IN (SELECT day FROM holidays) THEN 1 ELSE 0 END', 'is_holiday')} FROM canon""",
)
def extended_features(spark, d):
    days = tables.events(spark, d).groupBy(F.to_date("ts").alias("date")).agg(F.count(F.lit(1)).alias("c"))
    rows = labels.extended_features(tables.canonical(spark, d), holidays=days.where(F.col("c") % 5 == 0).select("date"))
    return rows.select("datetime", "quarter", "year", "heat_index", "wind_chill", "rain_indicator", "is_holiday")


def _level(col: str, high: float, normal: float) -> str:
    return (
        f"CASE WHEN {col} > {high} THEN 'High' WHEN {col} > {normal} THEN 'Normal' WHEN {col} IS NOT NULL THEN 'Low' END "
        f"AS {col}_status"
    )


_LABELS = f"""{_level('temperature', 32.0, 25.0)}, {_level('humidity', 80.0, 60.0)},
CASE WHEN isodow(datetime) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS day_type"""


@query("condition_labels", f"WITH {CANON} SELECT {t('datetime')}, {_LABELS} FROM canon")
def condition_labels(spark, d):
    rows = labels.condition_labels(tables.canonical(spark, d))
    return rows.select("datetime", "temperature_status", "humidity_status", "day_type")


@query(
    "resample_hourly",
    f"WITH {HOURLY} SELECT event_type, {t('datetime')}, {r('total')}, {r('mean')} FROM hourly",
)
def resample_hourly(spark, d):
    rows = tables.events(spark, d).withColumnRenamed("ts", "datetime")
    aggs = [F.sum("value").alias("total"), F.avg("value").alias("mean")]
    return aggregates.resample(rows, KEY, "datetime", aggs)


@query("regularise", f"WITH {KEYED_GRID} SELECT event_type, {t('datetime')}, {r('total')} FROM keyed_grid")
def regularise(spark, d):
    return keyed_grid(spark, d)


@query(
    "date_spine",
    f"""WITH s AS (SELECT unnest(generate_series((SELECT min(date_trunc('hour', ts)) FROM events), (SELECT max(date_trunc('hour', ts)) FROM events), INTERVAL 1 HOUR)) AS datetime)
SELECT {t('s.datetime', 'datetime')}, {n('count(e.event_id)', 'events')} FROM s LEFT JOIN events e ON date_trunc('hour', e.ts) = s.datetime GROUP BY s.datetime""",
)
def date_spine(spark, d):
    rows = tables.events(spark, d)
    low, high = rows.agg(F.min(timeparts.hour_key("ts")), F.max(timeparts.hour_key("ts"))).first()
    counted = rows.groupBy(timeparts.hour_key("ts").alias("datetime")).agg(F.count(F.lit(1)).alias("events"))
    hours = spine.date_spine(spark, low, high, "HOUR")
    return hours.join(counted, "datetime", "left").withColumn("events", F.coalesce("events", F.lit(0)))


# Windows


def _lags(col: str, lags, part: str) -> str:
    return ", ".join(r(f"lag({col}, {k}) OVER ({part} ORDER BY datetime)", f"{col}_lag_{k}") for k in lags)


def _rolling(col: str, sizes, part: str, frame="ROWS BETWEEN {} PRECEDING AND CURRENT ROW", shift=None) -> str:
    out = []
    for w in sizes:
        over = f"({part} ORDER BY datetime {frame.format(w - 1)})"
        for name, f in (("mean", "avg"), ("std", "stddev_samp")):
            out.append(r(f"CASE WHEN count({col}) OVER {over} = {w} THEN {f}({col}) OVER {over} END", f"{col}_rolling_{name}_{w}"))
    return ", ".join(out)


@query(
    "lag_features",
    f"WITH {HOURLY} SELECT event_type, {t('datetime')}, {_lags('total', windows.LAGS, 'PARTITION BY event_type')} FROM hourly",
)
def lag_features(spark, d):
    rows = tables.hourly(spark, d).select(*KEY, "datetime", "total")
    return windows.lag_features(rows, ["total"], keys=KEY).drop("total")


@query(
    "lag_features_users",
    f"WITH {USER_HOURLY} SELECT {n('user_id')}, {t('datetime')}, {_lags('total', windows.LAGS, 'PARTITION BY user_id')} FROM user_hourly",
)
def lag_features_users(spark, d):
    rows = tables.hourly(spark, d, ["user_id"]).select("user_id", "datetime", "total")
    return windows.lag_features(rows, ["total"], keys=["user_id"]).drop("total")


@query(
    "lag_features_time",
    f"WITH {HOURLY} SELECT a.event_type, {t('a.datetime', 'datetime')}, "
    + ", ".join(r(f"l{k}.total", f"total_lag_{k}") for k in windows.LAGS)
    + " FROM hourly a "
    + " ".join(f"LEFT JOIN hourly l{k} ON l{k}.event_type = a.event_type AND l{k}.datetime = a.datetime - INTERVAL {k} HOUR" for k in windows.LAGS),
)
def lag_features_time(spark, d):
    rows = tables.hourly(spark, d).select(*KEY, "datetime", "total")
    return windows.lag_features(rows, ["total"], keys=KEY, by="time").drop("total")


@query(
    "rolling_features",
    f"WITH {KEYED_GRID} SELECT event_type, {t('datetime')}, {_rolling('total', windows.WINDOWS, 'PARTITION BY event_type')} FROM keyed_grid",
)
def rolling_features(spark, d):
    return windows.rolling_features(keyed_grid(spark, d), ["total"], keys=KEY).drop("total")


@query(
    "rolling_features_time",
    f"""WITH {HOURLY} SELECT event_type, {t('datetime')},
{_rolling('total', windows.WINDOWS, 'PARTITION BY event_type', "RANGE BETWEEN INTERVAL '{} hours' PRECEDING AND CURRENT ROW")} FROM hourly""",
)
def rolling_features_time(spark, d):
    rows = tables.hourly(spark, d).select(*KEY, "datetime", "total")
    return windows.rolling_features(rows, ["total"], keys=KEY, by="time").drop("total")


_KEYED_FILL = f"WITH {KEYED_GRID},\n{filled('keyed_grid', ['total'], 'event_type')}\n"


@query("interpolate_linear", f"{_KEYED_FILL}SELECT event_type, {t('datetime')}, {r('total')} FROM done_line")
def interpolate_linear(spark, d):
    return windows.interpolate_linear(keyed_grid(spark, d), ["total"], keys=KEY)


@query("interpolate_and_fill", f"{_KEYED_FILL}SELECT event_type, {t('datetime')}, {r('total')} FROM done")
def interpolate_and_fill(spark, d):
    return windows.interpolate_linear(keyed_grid(spark, d), ["total"], keys=KEY, fill_rest=True)


@query(
    "ffill",
    f"""WITH {GRID} SELECT {t('datetime')}, {r('last_value(total_load IGNORE NULLS) OVER (ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', 'total_load')} FROM grid""",
)
def ffill(spark, d):
    return windows.ffill(joins.regularise(tables.load(spark, d)), ["total_load"])


@query(
    "bfill",
    f"""WITH {GRID} SELECT {t('datetime')}, {r('first_value(total_load IGNORE NULLS) OVER (ORDER BY datetime ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)', 'total_load')} FROM grid""",
)
def bfill(spark, d):
    return windows.bfill(joins.regularise(tables.load(spark, d)), ["total_load"])


_SPLIT = f"""{USER_HOURLY},
placed AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY datetime) AS i, count(*) OVER (PARTITION BY user_id) AS n_rows FROM user_hourly),
splits AS (SELECT *, CASE WHEN i <= floor(n_rows * 0.7::DOUBLE) THEN 'train'
  WHEN i <= floor(n_rows * 0.7::DOUBLE) + floor(n_rows * 0.15::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM placed)"""


@query("time_split", f"WITH {_SPLIT} SELECT {n('user_id')}, {t('datetime')}, split FROM splits")
def time_split(spark, d):
    rows = tables.hourly(spark, d, ["user_id"]).select("user_id", "datetime")
    return windows.time_split(rows, keys=["user_id"])


@query(
    "split_stats",
    f"WITH {_SPLIT} SELECT split, {n('count(*)', 'samples')}, {r('avg(total)', 'target_mean')}, {r('stddev_samp(total)', 'target_std')} FROM splits GROUP BY split",
)
def split_stats(spark, d):
    rows = windows.time_split(tables.hourly(spark, d, ["user_id"]), keys=["user_id"])
    return aggregates.split_stats(rows, "total")


@query(
    "time_folds",
    f"""WITH {HOURLY}, placed AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY datetime) AS i,
  count(*) OVER (PARTITION BY event_type) AS rows_ FROM hourly),
folds AS (SELECT *, rows_ // 6 AS size, rows_ - (6 - fold) * (rows_ // 6) AS start FROM placed, (SELECT unnest([1, 2, 3, 4, 5]) AS fold))
SELECT event_type, {t('datetime')}, {i('fold')}, CASE WHEN i <= start THEN 'train' ELSE 'test' END AS role FROM folds WHERE i <= start + size AND size > 0""",
)
def time_folds(spark, d):
    return windows.time_folds(tables.hourly(spark, d).select(*KEY, "datetime"), 5, KEY)


# Forecast metrics of a persistence forecast: the value 24 rows earlier, band of 50 around it

_FORECAST = f"""{HOURLY}, forecast AS (SELECT * FROM (
  SELECT event_type, datetime, total AS y, lag(total, 24) OVER (PARTITION BY event_type ORDER BY datetime) AS p FROM hourly) WHERE p IS NOT NULL)"""

_METRICS = f"""{r('sqrt(avg((y - p) * (y - p)))', 'rmse')}, {r('avg(abs((y - p) / y)) * 100.0', 'mape')}, {r('avg(abs(y - p))', 'mae')},
{r('1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y))', 'r2')}, {r('avg(p - y)', 'forecast_bias')}"""


def forecast(spark, d):
    rows = windows.lag_features(tables.hourly(spark, d).select(*KEY, "datetime", "total"), ["total"], [24], KEY)
    named = rows.select(*KEY, "datetime", F.col("total").alias("y"), F.col("total_lag_24").alias("p"))
    return named.where(F.col("p").isNotNull()).withColumns({"low": F.col("p") - 50.0, "high": F.col("p") + 50.0})


@query("forecast_metrics", f"WITH {_FORECAST} SELECT event_type, {_METRICS} FROM forecast GROUP BY event_type")
def forecast_metrics(spark, d):
    return aggregates.forecast_metrics(forecast(spark, d), "y", "p", KEY)


@query("forecast_metrics_total", f"WITH {_FORECAST} SELECT {_METRICS} FROM forecast")
def forecast_metrics_total(spark, d):
    return aggregates.forecast_metrics(forecast(spark, d), "y", "p")


@query(
    "coverage",
    f"WITH {_FORECAST} SELECT event_type, {r('avg(CASE WHEN y BETWEEN p - 50 AND p + 50 THEN 1.0 ELSE 0.0 END) * 100', 'coverage')} FROM forecast GROUP BY 1",
)
def coverage(spark, d):
    return forecast(spark, d).groupBy(*KEY).agg(errors.coverage("y", "low", "high").alias("coverage"))


@query(
    "direction_accuracy",
    f"""WITH {_FORECAST}, s AS (SELECT event_type, y - lag(y) OVER w > 0 AS a, p - lag(p) OVER w > 0 AS b FROM forecast
  WINDOW w AS (PARTITION BY event_type ORDER BY datetime))
SELECT event_type, {r('avg(CASE WHEN a = b THEN 1.0 ELSE 0.0 END) FILTER (WHERE a IS NOT NULL) * 100', 'direction_accuracy')} FROM s GROUP BY 1""",
)
def direction_accuracy(spark, d):
    return aggregates.direction_accuracy(forecast(spark, d), "y", "p", KEY)


@query(
    "validate_predictions",
    f"""WITH {_FORECAST} SELECT {r('sqrt(avg((y - p) * (y - p)))', 'rmse')}, {r('avg(abs((y - p) / nullif(y, 0))) * 100.0', 'mape')},
{n('count(*) FILTER (WHERE y = 0)', 'mape_skipped')}, {r('avg(abs(y - p))', 'mae')},
{r('1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y))', 'r2')}, {r('avg(p - y)', 'bias')},
{r('avg(CASE WHEN y BETWEEN p - 50 AND p + 50 THEN 1.0 ELSE 0.0 END) * 100', 'coverage')} FROM forecast""",
)
def validate_predictions(spark, d):
    return aggregates.validate_predictions(forecast(spark, d), "y", "p", "low", "high")


_LONG = f"""{_FORECAST}, per AS (SELECT event_type, {_METRICS} FROM forecast GROUP BY event_type),
long AS (UNPIVOT per ON rmse, mape, mae, r2, forecast_bias INTO NAME metric VALUE value)"""


def _long(spark, d):
    per = aggregates.forecast_metrics(forecast(spark, d), "y", "p", KEY)
    names = ["rmse", "mape", "mae", "r2", "forecast_bias"]
    return aggregates.melt_metrics(per.select(*KEY, *[tables.fixed(F.col(c)).alias(c) for c in names]), names, KEY)


@query(
    "aggregate_folds",
    f"WITH {_LONG} SELECT metric, {r('avg(value)', 'mean')}, {r('stddev_pop(value)', 'std')}, {r('min(value)', 'min')}, {r('max(value)', 'max')} FROM long GROUP BY metric",
)
def aggregate_folds(spark, d):
    return aggregates.aggregate_folds(_long(spark, d))


@query(
    "grade_metrics",
    f"""WITH {_LONG} SELECT event_type, metric, {r('value')}, CASE metric
  WHEN 'mape' THEN CASE WHEN value <= 5 THEN 'Good' WHEN value <= 10 THEN 'OK' ELSE 'Poor' END
  WHEN 'rmse' THEN CASE WHEN value <= 50 THEN 'Good' WHEN value <= 100 THEN 'OK' ELSE 'Poor' END
  WHEN 'r2' THEN CASE WHEN value >= 0.85 THEN 'Good' WHEN value >= 0.7 THEN 'OK' ELSE 'Poor' END END AS grade
FROM long WHERE metric IN ('mape', 'rmse', 'r2')""",
)
def grade_metrics(spark, d):
    return reports.performance_row(_long(spark, d), KEY)


@query(
    "overfit_check",
    f"""WITH {_FORECAST}, half AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY datetime) AS i,
  count(*) OVER (PARTITION BY event_type) AS rows_ FROM forecast),
e AS (SELECT event_type, sqrt(avg((y - p) * (y - p)) FILTER (WHERE i <= floor(rows_ * 0.7::DOUBLE))) AS a,
  sqrt(avg((y - p) * (y - p)) FILTER (WHERE i > floor(rows_ * 0.7::DOUBLE) AND i <= floor(rows_ * 0.7::DOUBLE) + floor(rows_ * 0.15::DOUBLE))) AS b FROM half GROUP BY 1)
SELECT event_type, {r('a', 'train_rmse')}, {r('b', 'val_rmse')}, {r('(b - a) / a', 'relative_gap')}, coalesce((b - a) / a > 0.2, false) AS is_overfitting,
CASE WHEN (b - a) / a IS NULL THEN 'undetermined' WHEN (b - a) / a > 0.2 THEN 'overfitting' ELSE 'ok' END AS verdict FROM e""",
)
def overfit_check(spark, d):
    rows = windows.time_split(forecast(spark, d), keys=KEY).withColumn("e", (F.col("y") - F.col("p")) ** 2)

    def part(name):
        return F.sqrt(F.avg(F.when(F.col("split") == name, F.col("e")))).alias(f"{name}_rmse")

    return aggregates.overfit_check(rows.groupBy(*KEY).agg(part("train"), part("val")))


# Summaries and rankings

_STATS = f"""{r('min(total)', 'min')}, {r('max(total)', 'max')}, {r('avg(total)', 'mean')}, {r('stddev_samp(total)', 'std')}, {r('median(total)', 'median')}"""


@query("series_stats", f"WITH {HOURLY} SELECT event_type, {_STATS} FROM hourly GROUP BY event_type")
def series_stats(spark, d):
    return aggregates.series_stats(tables.hourly(spark, d), "total", KEY)


@query(
    "series_stats_events",
    f"""SELECT {r('min(value)', 'min')}, {r('max(value)', 'max')}, {r('avg(value)', 'mean')}, {r('stddev_samp(value)', 'std')}, {r('median(value)', 'median')} FROM events""",
)
def series_stats_events(spark, d):
    return aggregates.series_stats(tables.events(spark, d), "value")


@query(
    "exact_percentiles",
    f"""SELECT l_returnflag, {r('quantile_cont(l_extendedprice, 0.025)', 'p0')}, {r('quantile_cont(l_extendedprice, 0.5)', 'p1')},
{r('quantile_cont(l_extendedprice, 0.975)', 'p2')} FROM lineitem GROUP BY 1""",
)
def exact_percentiles(spark, d):
    rows = tables.table(spark, d, "lineitem")
    return aggregates.exact_percentiles(rows, "l_extendedprice", [0.025, 0.5, 0.975], ["l_returnflag"])


@query(
    "peak_load",
    f"""WITH {HOURLY} SELECT event_type, {r('total', 'peak_value')}, {t('datetime', 'peak_time')} FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY total DESC, datetime) AS k FROM hourly) WHERE k = 1""",
)
def peak_load(spark, d):
    return aggregates.peak(tables.hourly(spark, d), "total", keys=KEY)


# The last 24 rows of each series stand for the forecast, the row before them for the current value.
_AHEAD = f"""{HOURLY}, back AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY datetime DESC) AS k FROM hourly),
ahead AS (SELECT * FROM back WHERE k <= 24), past AS (SELECT * FROM back WHERE k > 24)"""


def _now_and_ahead(spark, d):
    rows = windows.with_position(tables.hourly(spark, d), KEY, "datetime")
    recent = F.col("__pos") > F.col("__total") - 24
    return rows.where(~recent).drop("__pos", "__total"), rows.where(recent).drop("__pos", "__total")


@query(
    "trend",
    f"""WITH {_AHEAD}, m AS (SELECT event_type, avg(total) AS a FROM ahead GROUP BY 1),
x AS (SELECT p.event_type, p.total AS c, m.a FROM past p JOIN m USING (event_type) WHERE p.k = 25)
SELECT event_type, {r('c', 'current_value')}, {r('a', 'avg_forecast')}, {r('a - c', 'change_abs')}, {r('(a - c) / c * 100', 'change_pct')},
CASE WHEN (a - c) / c * 100 > 1 THEN 'up' WHEN (a - c) / c * 100 < -1 THEN 'down' ELSE 'stable' END AS direction FROM x""",
)
def trend(spark, d):
    past, ahead = _now_and_ahead(spark, d)
    current = ranking.latest(past, "total", KEY).select(*KEY, F.col("total").alias("current_value"))
    return aggregates.trend(current, ahead, "total", 24, KEY)


@query(
    "latest",
    f"WITH {HOURLY} SELECT event_type, {t('max(datetime)', 'datetime')}, {r('arg_max(total, datetime)', 'total')} FROM hourly GROUP BY 1",
)
def latest(spark, d):
    return ranking.latest(tables.hourly(spark, d), "total", KEY)


@query(
    "last_row",
    f"WITH {_AHEAD} SELECT event_type, {t('datetime')}, {r('total')}, {r('mean')}, {n('n')} FROM back WHERE k = 1",
)
def last_row(spark, d):
    return ranking.last_row(tables.hourly(spark, d), KEY)


@query("tail_24", f"WITH {_AHEAD} SELECT event_type, {t('datetime')}, {r('total')} FROM ahead")
def tail_24(spark, d):
    return windows.tail_n(tables.hourly(spark, d).select(*KEY, "datetime", "total"), 24, KEY)


@query(
    "horizon",
    f"""WITH {HOURLY} SELECT event_type, {t('datetime')}, {r('total')} FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY datetime) AS k FROM hourly) WHERE k <= 24""",
)
def horizon(spark, d):
    return windows.horizon(tables.hourly(spark, d).select(*KEY, "datetime", "total"), 24, KEY)


@query(
    "page",
    f"SELECT {n('event_id')}, {t('ts')}, {r('value')} FROM events ORDER BY ts, event_id LIMIT 100 OFFSET 200",
)
def page(spark, d):
    rows = tables.events(spark, d).select("event_id", "ts", "value")
    return ranking.page(rows, 3, 100, ["ts", "event_id"])


@query(
    "page_by_fence",
    f"SELECT page::INTEGER AS page, {n('event_id')}, {t('ts')}, {r('value')} FROM (SELECT *, (row_number() OVER (ORDER BY ts, event_id) - 1) // 100 + 1 AS page FROM events) WHERE page IN (1, 4, (SELECT (count(*) + 99) // 100 FROM events))",
)
def page_by_fence(spark, d):
    """The first, the fourth and the last page of all events, each read from its own range."""
    rows, root, order = tables.events(spark, d).select("event_id", "ts", "value"), scratch_path(spark, "ranges"), ["ts", "event_id"]
    paging.write_ranges(rows, root, order, 16)
    last = -(-rows.count() // 100)
    pages = [paging.read_page(spark, root, number, 100, order).withColumn("page", F.lit(number)) for number in (1, 4, last)]
    return pages[0].unionByName(pages[1]).unionByName(pages[2])


_SHARE = """shares AS (SELECT event_type AS feature, sum(value) AS w FROM events GROUP BY 1),
importance AS (SELECT feature, w / (SELECT sum(w) FROM shares) AS importance FROM shares)"""


def _importance(spark, d):
    return tables.events(spark, d).groupBy(F.col("event_type").alias("feature")).agg(F.sum("value").alias("importance"))


@query("normalise_importance", f"WITH {_SHARE} SELECT feature, {r('importance')} FROM importance")
def normalise_importance(spark, d):
    return aggregates.normalise_importance(_importance(spark, d))


@query(
    "importance_at_least",
    f"WITH {_SHARE} SELECT feature, {r('importance')} FROM importance WHERE importance >= 0.2 ORDER BY importance DESC",
)
def importance_at_least(spark, d):
    return ranking.importance_at_least(aggregates.normalise_importance(_importance(spark, d)), 0.2)


@query(
    "top_features",
    f"WITH {_SHARE} SELECT feature, {r('importance')} FROM importance ORDER BY importance DESC LIMIT 3",
)
def top_features(spark, d):
    return ranking.top_features(aggregates.normalise_importance(_importance(spark, d)), 3)


# The feature matrix


def _matrix_sql() -> str:
    base = ["total", "mean", "n", "hour", "day_of_week", "day_of_month", "month", "is_weekend", "hour_sin", "hour_cos"]
    whole = {"n": "BIGINT", "hour": "INTEGER", "day_of_week": "INTEGER", "day_of_month": "INTEGER", "month": "INTEGER", "is_weekend": "INTEGER"}
    out = []
    for c in base:
        out.append(i(c, kind=whole[c]) if c in whole else r(c))
    inner = []
    for c in base:
        for k in windows.LAGS:
            inner.append(f"lag({c}, {k}) OVER w AS {c}_lag_{k}")
            out.append(i(f"{c}_lag_{k}", kind=whole[c]) if c in whole else r(f"{c}_lag_{k}"))
        for w in windows.WINDOWS:
            over = f"(PARTITION BY event_type ORDER BY datetime ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
            for name, f in (("mean", "avg"), ("std", "stddev_samp")):
                inner.append(f"{f}({c}) OVER {over} AS {c}_rolling_{name}_{w}")
                out.append(r(f"{c}_rolling_{name}_{w}"))
    return f"""WITH {HOURLY}, timed AS (SELECT event_type, datetime, total, mean, n, date_part('hour', datetime) AS hour,
  isodow(datetime) - 1 AS day_of_week, date_part('day', datetime) AS day_of_month, date_part('month', datetime) AS month,
  CASE WHEN isodow(datetime) >= 6 THEN 1 ELSE 0 END AS is_weekend, sin(2 * pi() * date_part('hour', datetime) / 24) AS hour_sin,
  cos(2 * pi() * date_part('hour', datetime) / 24) AS hour_cos FROM hourly),
wide AS (SELECT *, {', '.join(inner)} FROM timed WINDOW w AS (PARTITION BY event_type ORDER BY datetime))
SELECT event_type, {t('datetime')}, {', '.join(out)} FROM wide WHERE total_lag_168 IS NOT NULL"""


@query("feature_matrix", _matrix_sql())
def feature_matrix(spark, d):
    return features.build_features(tables.hourly(spark, d), keys=KEY)


# Reports


def _persistence(spark, d):
    """The forecast part of the series as a prediction table."""
    past, ahead = _now_and_ahead(spark, d)
    made = ahead.select(
        *KEY,
        "datetime",
        F.col("total").alias("predicted"),
        (F.col("total") - 50.0).alias("confidence_lower"),
        (F.col("total") + 50.0).alias("confidence_upper"),
    )
    return past, made


@query(
    "report_forecast_view",
    f"""WITH {_AHEAD} SELECT event_type, {t('datetime')}, 'actual' AS series, {r('total', 'value')}, NULL::DOUBLE AS lower, NULL::DOUBLE AS upper FROM past WHERE k <= 48
UNION ALL SELECT event_type, {t('datetime')}, 'forecast', {r('total', 'value')}, {r('total - 50', 'lower')}, {r('total + 50', 'upper')} FROM ahead""",
)
def report_forecast_view(spark, d):
    return reports.forecast_view(*_persistence(spark, d), value="total", keys=KEY)


@query(
    "report_kpi",
    f"""WITH {_AHEAD}, m AS (SELECT event_type, max(total) AS top, avg(total) AS a FROM ahead GROUP BY 1)
SELECT event_type, {r('p.total', 'current_load')}, {r('top', 'peak_load')}, {r('a', 'next_mean')}, {r('(a - p.total) / p.total * 100', 'change_pct')}
FROM past p JOIN m USING (event_type) WHERE p.k = 25""",
)
def report_kpi(spark, d):
    return reports.kpi_row(*_persistence(spark, d), value="total", keys=KEY)


@query(
    "report_key_drivers",
    f"""WITH {CANON} SELECT {t('datetime')}, {r('temperature')}, {r('humidity')}, {_LABELS}, {i("date_part('hour', datetime)", 'hour')} FROM canon
ORDER BY canon.datetime DESC LIMIT 1""",
)
def report_key_drivers(spark, d):
    return reports.key_drivers(tables.canonical(spark, d))


@query(
    "report_data_profile",
    f"""WITH {CANON} SELECT {n('count(*)', 'total_rows')}, strftime(min(datetime), '%Y-%m-%d') AS first_day, strftime(max(datetime), '%Y-%m-%d') AS last_day,
{n('sum(m)', 'missing')}, {r('sum(m) * 100.0 / (count(*) * 6)', 'missing_pct')} FROM (
  SELECT datetime, {' + '.join(f'({c} IS NULL)::INT' for c in MEASURES)} AS m FROM canon)""",
)
def report_data_profile(spark, d):
    return reports.data_profile(tables.canonical(spark, d))


@query("sort_time", f"WITH {HOURLY} SELECT row_number() OVER (ORDER BY event_type, datetime)::BIGINT AS place, event_type, {t('datetime')} FROM hourly")
def sort_time(spark, d):
    """All hours in total order, written and numbered by file and place in it: files follow each other in order."""
    root = scratch_path(spark, "sorted")
    ranking.sort_time(tables.hourly(spark, d), KEY).write.parquet(root)
    rows = spark.read.parquet(root)
    file, at = rows.metadataColumn("_metadata")["file_name"], F.monotonically_increasing_id()
    numbered = rows.select(*KEY, "datetime", file.alias("file"), at.alias("at"))
    # A file is one task here, so its rows are numbered in the order in which they are stored; files are few.
    sizes = numbered.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = numbered.join(sizes.withColumn("before", before), "file")
    return placed.select((F.col("at") - F.col("first") + F.col("before") + 1).alias("place"), *KEY, "datetime")


@query("drop_null_target", f"WITH {HOURLY} SELECT event_type, {t('datetime')}, {r('total')} FROM hourly WHERE date_part('hour', datetime) != 3")
def drop_null_target(spark, d):
    rows = tables.hourly(spark, d).withColumn("total", F.when(F.hour("datetime") != 3, F.col("total")))
    return quality.drop_null_target(rows.select(*KEY, "datetime", "total"), "total")


@query("feature_strategy", f"WITH {HOURLY} SELECT event_type, {t('datetime')}, {r('total')}, {r('total * 2', 'doubled')} FROM hourly")
def feature_strategy(spark, d):
    """A named feature builder of one's own, looked up and used; its contract is checked."""
    features.register_features("doubled", lambda df: df.withColumn("doubled", F.col("total") * 2))
    if not features.has_features("doubled") or "doubled" not in features.list_features():
        raise ValueError("the builder is not registered")
    made = tables.hourly(spark, d).select(*KEY, "datetime", "total").transform(features.features("doubled"))
    quality.check_features(made, ["total", "doubled"])
    return made
