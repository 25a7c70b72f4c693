from datetime import date

import pytest
from helpers import by, rows

from orderlake.plans import calendar as cal


def test_attributes(spark):
    out = by(cal.with_date_attributes(cal.days(spark, date(2023, 1, 1), date(2023, 7, 3))), "date_key")
    assert len(out) == 184
    new_year = out[date(2023, 1, 1)]
    # the ISO week belongs to 2022 while the year column is the calendar year
    assert (new_year.year, new_year.month, new_year.week, new_year.day_of_week, new_year.is_weekend) == (2023, 1, 52, "Sunday", True)
    monday = out[date(2023, 7, 3)]
    assert (monday.week, monday.day_of_week, monday.is_weekend) == (27, "Monday", False)


def test_holidays_default_to_false(spark):
    holidays = spark.createDataFrame([(date(2023, 7, 4), True, "Independence Day")], "date_key date, is_holiday boolean, holiday_name string")
    out = by(cal.date_dim(cal.days(spark, date(2023, 7, 3), date(2023, 7, 5)), holidays), "date_key")
    assert out[date(2023, 7, 4)].is_holiday is True and out[date(2023, 7, 4)].holiday_name == "Independence Day"
    assert out[date(2023, 7, 5)].is_holiday is False and out[date(2023, 7, 5)].holiday_name is None


def test_source_calendar_is_typed_and_deduplicated(spark):
    columns = "Op string, ingested_at string, DATE_KEY string, year string, IS_HOLIDAY string, holiday_name string"
    landed = spark.createDataFrame([
        ("I", "t", "2023-12-25", "2023", "true", "Christmas"), ("I", "t", "2023-12-25", "2023", "false", None),
        ("I", "t", "2023-12-26", "2023", "FALSE", None), ("I", "t", "soon", "2023", "maybe", None)], columns)
    out = cal.typed_holidays(landed)
    assert dict(out.dtypes) == {"date_key": "date", "is_holiday": "boolean", "holiday_name": "string"}
    assert rows(out.filter("date_key is not null")) == [(date(2023, 12, 25), True, "Christmas"), (date(2023, 12, 26), False, None)]


def test_whole_years_and_overrides(spark):
    orders = spark.createDataFrame([("2020-04-03 10:00:00",), ("2024-02-01",), ("nonsense",)], "t string")
    bounds = cal.date_bounds(orders, "t")
    assert cal.whole_years(bounds) == (date(2020, 1, 1), date(2024, 12, 31))
    assert cal.whole_years(bounds, end="2025-06-30") == (date(2020, 1, 1), date(2025, 6, 30))
    with pytest.raises(ValueError):
        cal.whole_years(cal.date_bounds(orders.filter("t = 'nonsense'"), "t"))


def test_missing_days_are_refused(spark):
    days = cal.days(spark, date(2023, 1, 1), date(2023, 1, 31))
    cal.require_every_day(days, date(2023, 1, 5), date(2023, 1, 31))
    with pytest.raises(ValueError, match="30 of the 31"):
        cal.require_every_day(days.filter("date_key <> date'2023-01-09'"), date(2023, 1, 1), date(2023, 1, 31))
