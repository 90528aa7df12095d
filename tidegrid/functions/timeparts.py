"""Time expressions on naive local timestamps (TIMESTAMP_NTZ)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LOCAL_ZONE = "Asia/Ho_Chi_Minh"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ntz(col: Column | str) -> Column:
    return _c(col).cast("timestamp_ntz")


def hour_key(col: Column | str) -> Column:
    """Truncate to the hour; date_trunc yields TIMESTAMP, so go back to naive time."""
    return ntz(F.date_trunc("HOUR", _c(col)))


def parse_utc(col: Column | str) -> Column:
    """Strict ``YYYY-MM-DDTHH:MM:SSZ``; anything else is NULL."""
    return F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), ntz(F.try_to_timestamp(_c(col), F.lit("yyyy-MM-dd'T'HH:mm:ssX")))
    )


def parse_iso_utc(col: Column | str) -> Column:
    """ISO text to naive UTC: with an offset it is converted, without one it is taken as UTC."""
    text = _c(col)
    zoned = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    converted = F.convert_timezone(F.current_timezone(), F.lit("UTC"), ntz(F.try_to_timestamp(text)))
    return F.when(zoned, converted).otherwise(text.try_cast("timestamp_ntz"))


def to_local(col: Column | str, zone: str = LOCAL_ZONE) -> Column:
    """Naive UTC to naive local wall clock."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ntz(col))


def as_local(col: Column | str) -> Column:
    """Already local wall clock: only the zone is dropped, no shift."""
    return ntz(col)


def hour_of_clock(col: Column | str) -> Column:
    """``HH`` of ``HH:MM:SS``."""
    return F.substring_index(_c(col), ":", 1)


def hour_of_iso(col: Column | str) -> Column:
    """``HH`` of ``YYYY-MM-DDTHH:MM:SSZ``."""
    return F.substring_index(F.split_part(_c(col), F.lit("T"), F.lit(2)), ":", 1)


def next_hour(col: Column | str) -> Column:
    return _c(col) + F.expr("INTERVAL 1 HOUR")


def is_weekend(col: Column | str) -> Column:
    return (F.weekday(_c(col)) >= 5).cast("int")


def time_features(df: DataFrame, ts: str = "datetime") -> DataFrame:
    """hour, day_of_week (Monday 0), day_of_month, month, is_weekend and the hour on a circle."""
    t = F.col(ts)
    angle = F.lit(2.0) * F.pi() * F.hour(t) / F.lit(24.0)
    return df.withColumns(
        {
            "hour": F.hour(t),
            "day_of_week": F.weekday(t),
            "day_of_month": F.dayofmonth(t),
            "month": F.month(t),
            "is_weekend": is_weekend(t),
            "hour_sin": F.sin(angle),
            "hour_cos": F.cos(angle),
        }
    )


TIME_FEATURES = ("hour", "day_of_week", "day_of_month", "month", "is_weekend", "hour_sin", "hour_cos")


def calendar_features(df: DataFrame, ts: str = "hour_ict") -> DataFrame:
    """hour_of_day, day_of_week (Monday 1), day_of_year, month, year."""
    t = F.col(ts)
    return df.withColumns(
        {
            "hour_of_day": F.hour(t),
            "day_of_week": F.weekday(t) + 1,
            "day_of_year": F.dayofyear(t),
            "month": F.month(t),
            "year": F.year(t),
        }
    )


def freshness(generated_at: Column | str, now: Column) -> Column:
    """fresh below 60 minutes of age, stale below 180, else old."""
    age = age_minutes(generated_at, now)
    return F.when(age.isNull(), None).when(age < 60, "fresh").when(age < 180, "stale").otherwise("old")


def age_minutes(generated_at: Column | str, now: Column) -> Column:
    seconds = F.timestamp_diff("MICROSECOND", ntz(generated_at), ntz(now)) / 1e6
    return seconds / 60.0


def is_month_closed(year: Column, month: Column, now: Column) -> Column:
    """True once the last day of the month lies before ``now``'s date."""
    return F.last_day(F.make_date(year, month, F.lit(1))) < F.to_date(now)
