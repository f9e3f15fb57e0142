"""Column expressions shared by the operators. All are JVM built-ins (codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_month(epoch_seconds: str | Column) -> Column:
    """Epoch seconds -> yyyyMM as bigint, in UTC whatever the session zone is."""
    day = F.date_from_unix_date(F.floor(_col(epoch_seconds) / 86400).cast("int"))
    return (F.year(day) * 100 + F.month(day)).cast("bigint")


def epoch_seconds(ts: str | Column) -> Column:
    """timestamp / timestamp_ntz -> whole epoch seconds (bigint)."""
    return F.unix_timestamp(_col(ts)).cast("bigint")


def cooccurrence_sim(n12: str | Column, n1: str | Column, n2: str | Column) -> Column:
    """n12 / sqrt(n1 * n2) in doubles: one multiply, one sqrt, one divide, and no overflow."""
    return _col(n12).cast("double") / F.sqrt(_col(n1).cast("double") * _col(n2).cast("double"))


def above(value: str | Column, threshold: float) -> Column:
    """Strict ``value > threshold`` that is false for NaN (Spark orders NaN above all)."""
    v = _col(value)
    return ~F.isnan(v) & (v > F.lit(threshold))


def log10_count(n: str | Column) -> Column:
    """log10 of a count where a missing count (or 0) counts as 1, so its log is 0."""
    return F.log10(F.greatest(F.lit(1), F.coalesce(_col(n), F.lit(1))).cast("double"))
