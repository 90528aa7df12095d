"""Registration of queries with their oracle SQL, and the shared SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` it is only checked for rows here and against fixtures in the tests."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return tidy(fn(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def tidy(df: DataFrame) -> DataFrame:
    """Comparable output: reals to six decimals, times as text, whole numbers as they are."""
    cols = []
    for f in df.schema:
        c = f"`{f.name}`"
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = f"round(CAST({c} AS DOUBLE) + 1e-9D, 6) AS {c}"
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = f"date_format({c}, 'yyyy-MM-dd HH:mm:ss') AS {c}"
        elif isinstance(f.dataType, T.DateType):
            c = f"date_format({c}, 'yyyy-MM-dd') AS {c}"
        cols.append(c)
    return df.selectExpr(*cols)


# SQL text: t() prints a time, r() a real, both as tidy() does.


def t(expr: str, name: str | None = None) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S') AS {name or expr.split('.')[-1]}"


def r(expr: str, name: str | None = None) -> str:
    return f"(round(({expr}) + 1e-9, 6) + 0.0)::DOUBLE AS {name or expr.split('.')[-1]}"


def i(expr: str, name: str | None = None, kind: str = "INTEGER") -> str:
    return f"({expr})::{kind} AS {name or expr.split('.')[-1]}"


def n(expr: str, name: str | None = None) -> str:
    return i(expr, name, "BIGINT")


def _fix(expr: str) -> str:
    return f"round({expr} + 1e-9, 6)"


def _avg(kind: str) -> str:
    return _fix(f"avg(value) FILTER (WHERE event_type = '{kind}')")


HOURLY = f"""hourly AS (
  SELECT event_type, date_trunc('hour', ts) AS datetime, {_fix('sum(value)')} AS total, {_fix('avg(value)')} AS mean,
         count(*) AS n
  FROM events GROUP BY 1, 2)"""

USER_HOURLY = f"""user_hourly AS (
  SELECT user_id, date_trunc('hour', ts) AS datetime, {_fix('sum(value)')} AS total, {_fix('avg(value)')} AS mean,
         count(*) AS n
  FROM events GROUP BY 1, 2)"""

WEATHER = f"""weather AS (
  SELECT date_trunc('hour', ts) AS datetime, {_avg('view')} AS temperature, {_avg('click')} AS humidity,
         {_avg('error')} AS precipitation, {_avg('signup')} AS wind_speed,
         (count(*) FILTER (WHERE event_type = 'view'))::DOUBLE AS cloud_cover
  FROM events WHERE event_type IN ('view', 'click', 'signup', 'error') GROUP BY 1)"""

LOAD = f"""load AS (
  SELECT date_trunc('hour', ts) AS datetime, {_fix('sum(value)')} AS total_load
  FROM events WHERE event_type = 'purchase' GROUP BY 1)"""

CANON = f"""{WEATHER},
{LOAD},
canon AS (
  SELECT w.datetime, l.total_load AS electricity_demand, w.temperature, w.humidity, w.wind_speed, w.precipitation
  FROM weather w JOIN load l ON w.datetime = l.datetime)"""

# The load series on its full hourly grid: missing hours are NULL rows.
GRID = f"""{LOAD},
grid AS (
  SELECT g.datetime, l.total_load
  FROM (SELECT unnest(generate_series(min(datetime), max(datetime), INTERVAL 1 HOUR)) AS datetime FROM load) g
  LEFT JOIN load l ON l.datetime = g.datetime)"""

KEYED_GRID = f"""{HOURLY},
keyed_grid AS (
  SELECT g.event_type, g.datetime, h.total
  FROM (SELECT event_type, unnest(generate_series(min(datetime), max(datetime), INTERVAL 1 HOUR)) AS datetime
        FROM hourly GROUP BY event_type) g
  LEFT JOIN hourly h ON h.event_type = g.event_type AND h.datetime = g.datetime)"""


def filled(source: str, cols: list[str], keys: str = "", out: str = "done", keep: list[str] | None = None) -> str:
    """CTEs applying, one after the other, interpolation (3 rows in from each side), forward and backward fill."""
    part = f"PARTITION BY {keys} " if keys else ""
    over = f"({part}ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    ahead = f"({part}ORDER BY datetime ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    id_cols = ", ".join([*([keys] if keys else []), "datetime", *(keep or [])])
    known = ", ".join(f"CASE WHEN {c} IS NOT NULL THEN i END AS at_{c}" for c in cols)
    near = ", ".join(
        f"last_value({c} IGNORE NULLS) OVER {over} AS pv_{c}, last_value(at_{c} IGNORE NULLS) OVER {over} AS pi_{c}, "
        f"first_value({c} IGNORE NULLS) OVER {ahead} AS nv_{c}, first_value(at_{c} IGNORE NULLS) OVER {ahead} AS ni_{c}"
        for c in cols
    )
    step = ", ".join(
        f"""CASE WHEN {c} IS NOT NULL THEN {c}
      WHEN pi_{c} IS NOT NULL AND ni_{c} IS NOT NULL THEN
        CASE WHEN i - pi_{c} <= 3 OR ni_{c} - i <= 3
             THEN pv_{c} + (nv_{c} - pv_{c}) * (i - pi_{c}) / (ni_{c} - pi_{c}) END
      WHEN ni_{c} - i <= 3 THEN nv_{c}
      WHEN i - pi_{c} <= 3 THEN pv_{c} END AS {c}"""
        for c in cols
    )
    forward = ", ".join(f"last_value({c} IGNORE NULLS) OVER {over} AS {c}" for c in cols)
    backward = ", ".join(f"first_value({c} IGNORE NULLS) OVER {ahead} AS {c}" for c in cols)
    return f"""{out}_a AS (SELECT *, row_number() OVER ({part}ORDER BY datetime) AS i FROM {source}),
{out}_b AS (SELECT *, {known} FROM {out}_a),
{out}_c AS (SELECT *, {near} FROM {out}_b),
{out}_line AS (SELECT {id_cols}, {step} FROM {out}_c),
{out}_d AS (SELECT {id_cols}, {forward} FROM {out}_line),
{out} AS (SELECT {id_cols}, {backward} FROM {out}_d)"""
