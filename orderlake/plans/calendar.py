"""Generated calendar with holiday flags."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import day_of, without_load_metadata


def days(spark: SparkSession, start: date, end: date) -> DataFrame:
    """``date_key`` for each day of the closed interval.

    Built on ``range``, whose size Spark knows, so joins to it are broadcast when small
    and shuffled when not, with no hint.
    """
    return spark.range((end - start).days + 1).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date_key"))


def date_bounds(df: DataFrame, moment: str) -> DataFrame:
    """One row: first and last calendar day in a column."""
    return df.agg(F.min(day_of(moment)).alias("first_day"), F.max(day_of(moment)).alias("last_day"))


def whole_years(bounds: DataFrame, start: str | None = None, end: str | None = None) -> tuple[date, date]:
    """Jan 1 of the first year to Dec 31 of the last, each replaceable."""
    if start and end:
        return date.fromisoformat(start), date.fromisoformat(end)
    first, last = bounds.first()
    if first is None:
        raise ValueError("no readable order date to derive the calendar from")
    return (
        date.fromisoformat(start) if start else date(first.year, 1, 1),
        date.fromisoformat(end) if end else date(last.year, 12, 31),
    )


def typed_holidays(snapshot: DataFrame) -> DataFrame:
    """Holiday columns of the all-text source calendar, one row per day.

    If a day is listed twice, a holiday beats a normal day, then the greater name wins.
    """
    src = without_load_metadata(snapshot)
    typed = src.select(
        day_of("date_key").alias("date_key"),
        F.struct(F.col("is_holiday").try_cast("boolean").alias("flag"), F.col("holiday_name").cast("string").alias("name")).alias("h"),
    )
    best = typed.groupBy("date_key").agg(F.max("h").alias("h"))
    return best.select("date_key", F.col("h.flag").alias("is_holiday"), F.col("h.name").alias("holiday_name"))


def with_date_attributes(calendar: DataFrame) -> DataFrame:
    """Year, month, ISO week, English day name and weekend flag of ``date_key``."""
    d = F.col("date_key")
    return calendar.select(
        "*",
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.weekofyear(d).alias("week"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        (F.weekday(d) >= 5).alias("is_weekend"),
    )


def date_dim(calendar: DataFrame, holidays: DataFrame) -> DataFrame:
    flagged = with_date_attributes(calendar).join(holidays, "date_key", "left")
    return flagged.select(
        "date_key", "year", "month", "week", "day_of_week", "is_weekend",
        F.coalesce("is_holiday", F.lit(False)).alias("is_holiday"),
        "holiday_name",
    )


def require_every_day(calendar: DataFrame, start: date, end: date) -> None:
    """Refuse a calendar that lacks a day of the closed interval; its revenue would go missing unseen."""
    inside = calendar.filter(F.col("date_key").between(F.lit(start), F.lit(end)))
    found = inside.agg(F.count_distinct("date_key")).first()[0]
    wanted = max((end - start).days + 1, 0)
    if found != wanted:
        raise ValueError(f"calendar has {found} of the {wanted} days from {start} to {end}")
