"""Nested documents to rows, documents cut to one hour, typed projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidegrid.functions.timeparts import (
    LOCAL_ZONE,
    hour_key,
    hour_of_clock,
    hour_of_iso,
    parse_iso_utc,
    parse_utc,
    to_local,
)
from tidegrid.schemas import CANONICAL_COLUMNS

# Fixed names of the measures.
WEATHER_NAMES = {
    "temp": "temperature",
    "humidity": "humidity",
    "precip": "precipitation",
    "windspeed": "wind_speed",
    "cloudcover": "cloud_cover",
}
SIGNAL_MEASURES = {
    "total_load": "total_load_mw",
    "carbon_intensity": "carbon_intensity_gco2eq_kwh",
    "price_day_ahead": "price_eur_per_mwh",
}
POSITION = "position"


def _first_day(field: str) -> Column:
    return F.try_element_at(F.col("days"), F.lit(1))[field]


def records() -> Column:
    """``data`` when the key is there, even if empty, else ``history``."""
    return F.coalesce("data", "history")


def _exploded(df: DataFrame, items: Column, keep: Sequence[str]) -> DataFrame:
    return df.select(*keep, F.posexplode(items).alias(POSITION, "r")).select(*keep, POSITION, "r.*")


def _kept(df: DataFrame, keep: Sequence[str]) -> list[str]:
    return [c for c in keep if c in df.columns]


KEEP = ("zone", "signal", "query_date", "file_name")


def flatten_weather(df: DataFrame, keep: Sequence[str] = KEEP) -> DataFrame:
    """One row per hour of the first day; datetime = document date + hour (minutes are dropped), already local."""
    rows = _exploded(df, _first_day("hours"), _kept(df, keep))
    hour = hour_of_clock("datetime").try_cast("int")
    day = F.col("query_date").cast("timestamp_ntz")
    return rows.withColumn("datetime", day + F.make_dt_interval(F.lit(0), hour))


def flatten_electricity(df: DataFrame, zone: str = LOCAL_ZONE, keep: Sequence[str] = KEEP) -> DataFrame:
    """One row per record, datetime shifted from UTC to local wall clock."""
    rows = _exploded(df, records(), _kept(df, keep))
    return rows.withColumn("datetime", to_local(parse_iso_utc("datetime"), zone))


def parse_signal(df: DataFrame, measure: str, keep: Sequence[str] = KEEP) -> DataFrame:
    """Records of a scalar signal with ``value`` renamed to the measure; strict UTC text."""
    rows = _exploded(df, records(), _kept(df, keep))
    return rows.withColumn("value", F.col("value").try_cast("double")).withColumnRenamed("value", measure)


def _parse_map(df, field, prefix, names, keep):
    kept = _kept(df, keep)
    rows = df.select(*kept, F.explode(records()).alias("r")).select(*kept, "r.datetime", f"r.{field}")
    if names is None:
        # Open key list: the distinct keys are a small set, read once.
        found = rows.select(F.explode(F.map_keys(field)).alias("k")).distinct()
        names = [r["k"] for r in found.orderBy("k").collect()]
    return rows.select(*kept, "datetime", *[F.col(field)[n].alias(f"{prefix}_{n}_mw") for n in names])


def parse_mix(df: DataFrame, sources: Sequence[str] | None = None, keep: Sequence[str] = KEEP) -> DataFrame:
    """Generation by source as columns ``mix_{source}_mw``."""
    return _parse_map(df, "powerConsumptionBreakdown", "mix", sources, keep)


def parse_flows(df: DataFrame, zones: Sequence[str] | None = None, keep: Sequence[str] = KEEP) -> DataFrame:
    """Cross-border flow by zone as columns ``flow_{zone}_mw``."""
    return _parse_map(df, "exchange", "flow", zones, keep)


def parse_weather_utc(df: DataFrame, keep: Sequence[str] = KEEP) -> DataFrame:
    """Weather hours with ``datetime`` as UTC text built from the document's own day."""
    kept = _kept(df, keep)
    rows = df.select(*kept, _first_day("datetime").alias("__day"), F.explode(_first_day("hours")).alias("r"))
    stamp = F.concat("__day", F.lit("T"), F.col("r.datetime"), F.lit("Z"))
    measures = [F.col(f"r.{c}").try_cast("double").alias(c) for c in WEATHER_NAMES]
    return rows.select(*kept, stamp.alias("datetime"), *measures)


def align_hours(df: DataFrame, source_tz: str = "UTC", zone: str = LOCAL_ZONE) -> DataFrame:
    """Add datetime_utc, datetime_ict and the join key hour_ict from strict UTC text.

    ``source_tz`` equal to ``zone`` treats the text as local wall clock instead, without a shift.
    """
    parsed = parse_utc("datetime")
    local = to_local(parsed, zone) if source_tz == "UTC" else parsed
    utc = parsed if source_tz == "UTC" else F.convert_timezone(F.lit(source_tz), F.lit("UTC"), parsed)
    return df.withColumns({"datetime_utc": utc, "datetime_ict": local, "hour_ict": hour_key(local)})


def slice_hour_weather(df: DataFrame, hour: Column | str) -> DataFrame:
    """Documents cut to their first record of one hour; documents without it are left out."""
    wanted = F.lit(hour) if isinstance(hour, str) else hour
    hit = F.filter(_first_day("hours"), lambda h: hour_of_clock(h["datetime"]) == wanted)
    day = F.col("days")[0]
    one = F.array(day.withField("hours", F.slice(hit, 1, 1)))
    return df.where(F.size(hit) > 0).withColumn("days", one)


def slice_hour_electricity(df: DataFrame, hour: Column | str, signal: str, zone: str = LOCAL_ZONE) -> DataFrame:
    """Documents cut to the first record of one *local* hour, kept under ``history`` with new provenance."""
    wanted = F.lit(hour) if isinstance(hour, str) else hour
    local = lambda r: F.lpad(F.hour(to_local(parse_iso_utc(r["datetime"]), zone)).cast("string"), 2, "0")
    hit = F.filter(records(), lambda r: local(r) == wanted)
    kind = df.schema["data"].dataType
    tag = F.struct(
        F.lit(signal).alias("signal"),
        F.col("query_date").cast("string").alias("query_date"),
        F.col("zone").alias("zone"),
        wanted.alias("hour"),
    )
    return (
        df.where(F.size(hit) > 0)
        .withColumn("history", F.slice(hit, 1, 1))
        .withColumns({"data": F.lit(None).cast(kind), "_metadata": tag})
    )


def payload_hour(df: DataFrame) -> Column:
    """Hour of a one-hour document: weather hours, else history, else metadata. NULL when none has it."""
    places = []
    if "days" in df.columns:
        places.append(hour_of_clock(F.try_element_at(_first_day("hours"), F.lit(1))["datetime"]))
    if "history" in df.columns:
        places.append(hour_of_iso(F.try_element_at("history", F.lit(1))["datetime"]))
    if "_metadata" in df.columns:
        places.append(F.col("_metadata.hour"))
    return F.coalesce(*places)


def coerce_numeric(df: DataFrame, cols: Sequence[str], kind: str = "float") -> DataFrame:
    """Cast; text that is no number becomes NULL, NaN too."""
    def cast(c: str) -> Column:
        value = F.col(c).try_cast(kind)
        return F.when(~F.isnan(value), value)

    return df.withColumns({c: cast(c) for c in cols if c in df.columns})


def _or_null(df: DataFrame, source: str, name: str, kind: str) -> Column:
    value = F.col(source).try_cast(kind) if source in df.columns else F.lit(None).cast(kind)
    return value.alias(name)


def select_weather(df: DataFrame, keys: Sequence[str] = (), kind: str = "float") -> DataFrame:
    """Standard names; a measure that never arrived is a NULL column, so the layout is stable."""
    return df.select(*keys, "datetime", *[_or_null(df, s, n, kind) for s, n in WEATHER_NAMES.items()])


def select_electricity(df: DataFrame, keys: Sequence[str] = (), kind: str = "float") -> DataFrame:
    return df.select(*keys, "datetime", _or_null(df, "value", "total_load", kind))


def to_canonical_columns(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """total_load becomes electricity_demand; final column order; absent measures as NULL."""
    named = df.withColumnsRenamed({"total_load": "electricity_demand"})
    have = set(named.columns)
    cols = [F.col(c) if c in have else F.lit(None).cast(T.DoubleType()).alias(c) for c in CANONICAL_COLUMNS]
    return named.select(*keys, *cols)


_PARSERS: dict = {
    "weather": (None, parse_weather_utc),
    **{s: (s, (lambda m: lambda df: parse_signal(df, m))(m)) for s, m in SIGNAL_MEASURES.items()},
    "electricity_mix": ("electricity_mix", parse_mix),
    "electricity_flows": ("electricity_flows", parse_flows),
}


def register_signal(name: str, path: str | None, parser) -> None:
    """Name a signal's directory and its parser ``DataFrame -> DataFrame``."""
    if not callable(parser):
        raise TypeError(f"parser of {name} must be callable")
    _PARSERS[name] = (path, parser)


def signal_parser(name: str):
    if name not in _PARSERS:
        raise ValueError(f"unknown signal {name}, available: {sorted(_PARSERS)}")
    return _PARSERS[name][1]


def list_signals() -> list[str]:
    return sorted(_PARSERS)
