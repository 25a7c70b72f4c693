"""Column expressions used by more than one job; all stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(price: Column | str, quantity: Column | str) -> Column:
    """Price times quantity in double; text that is no number counts as NULL."""
    return _column(price).try_cast("double") * _column(quantity).try_cast("double")


def day_of(moment: Column | str) -> Column:
    """Calendar day of a text, date or timestamp; unreadable text gives NULL under ANSI too."""
    return _column(moment).try_cast("date")


def month_of(day: Column | str) -> Column:
    """Month of a day as yyyy-MM; ``undated`` without one."""
    return F.coalesce(F.date_format(_column(day), "yyyy-MM"), F.lit("undated"))


def instant_of(moment: Column | str) -> Column:
    return _column(moment).try_cast("timestamp")


def guarded_ratio(numerator: Column, denominator: Column, otherwise: float | None = None) -> Column:
    """Quotient where the denominator is positive, else ``otherwise``."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(otherwise).cast("double"))
