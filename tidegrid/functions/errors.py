"""Forecast error aggregates: plain aggregate columns for ``groupBy(...).agg(...)``, one pass each."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _pair(y: str, p: str) -> tuple[Column, Column]:
    # A row counts only when both values are known.
    both = F.col(y).isNotNull() & F.col(p).isNotNull()
    return F.when(both, F.col(y)), F.when(both, F.col(p))


def rmse(y: str, p: str) -> Column:
    return F.sqrt(F.avg(_square(F.col(y) - F.col(p))))


def _square(c: Column) -> Column:
    return c * c


def mape(y: str, p: str) -> Column:
    """Percent; rows with an actual of zero have no percentage error and are skipped (see ``mape_skipped``)."""
    return F.avg(F.abs(F.try_divide(F.col(y) - F.col(p), F.col(y)))) * 100.0


def mape_skipped(y: str) -> Column:
    return F.count_if(F.col(y) == 0)


def mae(y: str, p: str) -> Column:
    return F.avg(F.abs(F.col(y) - F.col(p)))


def r2(y: str, p: str) -> Column:
    """1 - SSres / SStot; NULL when the actual values do not vary."""
    known, _ = _pair(y, p)
    total = F.var_pop(known) * F.count(known)
    return F.lit(1.0) - F.try_divide(F.sum(_square(F.col(y) - F.col(p))), total)


def bias(y: str, p: str) -> Column:
    return F.avg(F.col(p) - F.col(y))


def coverage(y: str, low: str, high: str) -> Column:
    """Percent of actual values inside the closed interval."""
    return F.avg(F.col(y).between(F.col(low), F.col(high)).cast("int")) * 100.0
