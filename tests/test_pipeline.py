"""Storage behaviour: snapshot discovery, log batches, month refresh, whole runs."""

from datetime import date, timedelta
from pathlib import Path

import pytest
from helpers import rows
from pyspark.sql import functions as F

from orderlake.contract import ORDER_ITEMS, Layout, TableContract
from orderlake.plans import pipeline
from orderlake.plans.calendar import days
from orderlake.plans.customers import daily_value
from orderlake.sources import (
    logged_dates, mart_months, pending_pairs, read_log, read_table, resolve_pair, snapshot_dates, table_exists, write_log, write_table,
)
from orderlake.streaming import affected_since, recompute_floor, refresh_daily_value

D = date


@pytest.fixture
def layout(tmp_path):
    return Layout(str(tmp_path / "lake"))


# --- snapshot dates ----------------------------------------------------------------
def test_dates_are_listed_in_order(spark, layout):
    assert snapshot_dates(spark, layout) == []
    for dt in ("2026-02-01", "2026-01-01"):
        spark.range(1).write.parquet(layout.snapshot(dt, "t"))
    spark.range(1).write.parquet(f"{layout.snapshots}/other")
    assert snapshot_dates(spark, layout) == ["2026-01-01", "2026-02-01"]


def test_pairs():
    dates = ["d1", "d2", "d3"]
    assert resolve_pair(dates) == ("d3", "d2")
    assert resolve_pair(dates, "d1") == ("d1", None)
    assert resolve_pair(dates, "d9") == ("d9", None)
    assert resolve_pair(dates, "d3", "d1") == ("d3", "d1")
    with pytest.raises(FileNotFoundError):
        resolve_pair([])
    assert pending_pairs(dates, []) == [("d1", None), ("d2", "d1"), ("d3", "d2")]
    assert pending_pairs(dates, ["d1"]) == [("d2", "d1"), ("d3", "d2")]
    assert pending_pairs(dates, dates) == []
    # a gap and all after it, since those steps started from another snapshot
    assert pending_pairs(dates, ["d1", "d3"]) == [("d2", "d1"), ("d3", "d2")]
    assert pending_pairs(dates, ["d2", "d3"]) == [("d1", None), ("d2", "d1"), ("d3", "d2")]
    # old snapshots may go once they are logged, but not the one that the next step starts from
    assert pending_pairs(dates[1:], ["d0", "d1", "d2"]) == [("d3", "d2")]
    with pytest.raises(ValueError):
        pending_pairs(dates[1:], ["d1"])


# --- log -----------------------------------------------------------------------------
def log_rows(spark, *ops):
    return spark.createDataFrame([("a", op) for op in ops], "k string, Op string")


def test_log_batches_are_replaced_and_counted(spark, layout):
    assert write_log(log_rows(spark, "I", "I", "D"), layout, "t", "2026-01-01") == {"I": 2, "D": 1}
    assert write_log(log_rows(spark, "U"), layout, "t", "2026-01-02") == {"U": 1}
    assert write_log(log_rows(spark, "I"), layout, "t", "2026-01-01") == {"I": 1}
    assert write_log(log_rows(spark), layout, "t", "2026-01-03") == {}
    assert rows(read_log(spark, layout, "t")) == [("a", "I"), ("a", "U")]
    assert rows(read_log(spark, layout, "t", after="2026-01-01")) == [("a", "U")]
    assert rows(read_log(spark, layout, "t", until="2026-01-01")) == [("a", "I")]


def test_only_finished_batches_are_logged(spark, layout):
    with pytest.raises(FileNotFoundError):
        read_log(spark, layout, "t")
    write_log(log_rows(spark, "I"), layout, "t", "2026-01-01")
    Path(layout.log("t"), "dt=2026-01-02").mkdir()
    Path(layout.log("t"), "dt=2026-01-03", "_temporary", "0").mkdir(parents=True)
    assert logged_dates(spark, layout, "t") == ["2026-01-01"]
    assert rows(read_log(spark, layout, "t")) == [("a", "I")]
    assert read_log(spark, layout, "t", after="2026-01-01").count() == 0
    write_log(log_rows(spark, "U"), layout, "t", "2026-01-02")
    assert rows(read_log(spark, layout, "t")) == [("a", "I"), ("a", "U")]


@pytest.mark.parametrize("left", ["dt=2023-05-02", "dt=2023-05-02/_temporary/0"])
def test_a_batch_that_broke_off_in_the_middle_is_logged_again(spark, layout, tmp_path, left):
    land(spark, layout, "2023-05-01", keep=lambda i: i < 50)
    land(spark, layout, "2023-05-02", keep=lambda i: i < 55)
    pipeline.log_pair(spark, layout, "2023-05-01")
    for table in ("order_items", "order_item_options"):
        Path(layout.log(table), left).mkdir(parents=True)
    land(spark, layout, "2023-05-03", keep=lambda i: i != 20)
    assert pipeline.log_pending(spark, layout)["order_items"] == {"2023-05-02": {"I": 10}, "2023-05-03": {"I": 10, "D": 2}}
    assert pipeline.refresh_current(spark, layout) == {"order_items": 118, "order_item_options": 236}


def test_table_count_comes_from_the_write(spark, layout):
    assert write_table(spark.range(7), layout.mart("m")) == 7
    assert write_table(spark.range(3).filter("id > 5"), layout.mart("m")) == 0
    assert table_exists(spark, layout.mart("m")) and not table_exists(spark, layout.mart("n"))


# --- daily value mart ------------------------------------------------------------------
def orders(spark, data):
    return spark.createDataFrame(data, "user_id string, order_revenue double, order_date date")


DATA = [(f"u{i % 11}", float(i), D(2023, 1, 1) + timedelta(days=(i * 29) % 150)) for i in range(120)]


def expected(spark, data, as_of):
    return rows(daily_value(orders(spark, data), min(d for _, _, d in data), as_of))


def stored(spark, location):
    mart = read_table(spark, location)
    columns = ["user_id", "clv_date", "clv_month", "first_order_date", "daily_revenue", "daily_order_count", "cumulative_clv", "cumulative_order_count"]
    return rows(mart.withColumn("clv_month", F.col("clv_month").cast("string")).select(*columns))


def month_files(spark, location, month):
    return sorted(spark.read.parquet(f"{location}/clv_month={month}").inputFiles())


@pytest.mark.parametrize("known, batch_min, floor", [
    # late orders
    (lambda u, r, d: not (d >= D(2023, 3, 10) and r % 3 == 0), D(2023, 3, 10), D(2023, 3, 1)),
    # only new days
    (lambda u, r, d: d < D(2023, 4, 1), D(2023, 4, 1), D(2023, 4, 1)),
    # the batch starts after days the mart never covered
    (lambda u, r, d: d < D(2023, 2, 5), D(2023, 5, 1), D(2023, 2, 1)),
])
def test_incremental_equals_full(spark, layout, known, batch_min, floor):
    location = layout.mart("clv")
    calendar = days(spark, D(2023, 1, 1), D(2023, 12, 31))
    refresh_daily_value(spark, location, orders(spark, [o for o in DATA if known(*o)]), calendar)
    january = month_files(spark, location, "2023-01")
    # the third batch says May although it also brings earlier orders: the mart's own end decides
    result = refresh_daily_value(spark, location, orders(spark, DATA), calendar, batch_min)
    assert result["floor"] <= floor and result["floor"].day == 1
    assert stored(spark, location) == expected(spark, DATA, max(d for _, _, d in DATA))
    assert month_files(spark, location, "2023-01") == january


def test_earlier_as_of_cuts_the_mart_back(spark, layout):
    location, calendar = layout.mart("clv"), days(spark, D(2023, 1, 1), D(2023, 12, 31))
    refresh_daily_value(spark, location, orders(spark, DATA), calendar)
    refresh_daily_value(spark, location, orders(spark, DATA), calendar, D(2023, 5, 20), as_of=D(2023, 3, 20))
    assert mart_months(spark, location, "clv_month")[-1] == "2023-03"
    assert stored(spark, location) == expected(spark, DATA, D(2023, 3, 20))


def test_first_customers_removed_empties_their_months(spark, layout):
    location, calendar = layout.mart("clv"), days(spark, D(2023, 1, 1), D(2023, 12, 31))
    refresh_daily_value(spark, location, orders(spark, DATA), calendar)
    left = [o for o in DATA if o[2] >= D(2023, 3, 5)]
    refresh_daily_value(spark, location, orders(spark, left), calendar, D(2023, 1, 1))
    assert mart_months(spark, location, "clv_month")[0] == "2023-03"
    assert stored(spark, location) == expected(spark, left, max(d for _, _, d in DATA))


def test_floor_and_gaps(spark, layout):
    assert recompute_floor(D(2023, 6, 14), D(2023, 7, 3), D(2023, 8, 1)) == D(2023, 6, 1)
    assert recompute_floor(D(2023, 6, 14), D(2023, 4, 30), D(2023, 8, 1)) == D(2023, 5, 1)
    assert recompute_floor(D(2023, 6, 14), D(2023, 7, 3), D(2023, 5, 2)) == D(2023, 5, 1)
    with pytest.raises(ValueError, match="calendar has"):
        refresh_daily_value(spark, layout.mart("clv"), orders(spark, DATA), days(spark, D(2023, 1, 2), D(2023, 12, 31)))


def test_affected_since_looks_at_old_and_new_dates(spark):
    old = spark.createDataFrame([("o1", D(2023, 1, 5)), ("o2", D(2023, 2, 5))], "order_id string, order_date date")
    new = spark.createDataFrame([("o2", D(2023, 2, 1)), ("o3", D(2023, 3, 5))], "order_id string, order_date date")

    def changed(*ids):
        return spark.createDataFrame([(i,) for i in ids], "order_id string")

    assert affected_since(changed("o1"), [old, new]) == D(2023, 1, 5)  # deleted
    assert affected_since(changed("o2"), [old, new]) == D(2023, 2, 1)  # re-dated
    assert affected_since(changed("o3"), [old, new]) == D(2023, 3, 5)  # new
    assert affected_since(changed("o9"), [old, new]) is None


# --- whole runs --------------------------------------------------------------------------
ITEM = ("ORDER_ID string, LINEITEM_ID string, USER_ID string, RESTAURANT_ID string, APP_NAME string, CURRENCY string, "
        "IS_LOYALTY boolean, CREATION_TIME_UTC string, ITEM_CATEGORY string, ITEM_NAME string, ITEM_PRICE double, ITEM_QUANTITY int, op string, ingested_at string")
OPTION = ("ORDER_ID string, LINEITEM_ID string, OPTION_GROUP_NAME string, OPTION_NAME string, OPTION_PRICE double, "
          "OPTION_QUANTITY int, op string, ingested_at string")
HOLIDAY = "date_key string, year string, is_holiday string, holiday_name string, op string, ingested_at string"


def land(spark, layout, dt, keep=lambda i: True, price=lambda i: 10.0 + i, when=lambda i: D(2023, 1, 3) + timedelta(days=i * 2)):
    items = [(f"o{i}", str(line), None if i % 6 == 5 else f"u{i % 7}", f"r{i % 3}", "web", "USD", i % 4 == 0,
              f"{when(i)} 12:00:00", "Food" if line else "Drink", "x", price(i), 1 + line, "I", dt)
             for i in range(60) if keep(i) for line in range(2)]
    options = [(o, n, "g", "cheese", 0.5, 1, "I", dt) for o, n, *_ in items] * 2
    spark.createDataFrame(items, ITEM).write.parquet(layout.snapshot(dt, "order_items"))
    spark.createDataFrame(options, OPTION).write.parquet(layout.snapshot(dt, "order_item_options"))
    spark.createDataFrame([("2023-01-01", "2023", "true", "New Year", "I", dt)], HOLIDAY).write.parquet(layout.snapshot(dt, "date_dim"))


MARTS = ["customer_clv_daily", "clv_trends", "customer_clv_tiers", "customer_rfm", "churn_indicators", "sales_daily",
         "loyalty_impact", "location_performance", "discount_effectiveness"]


def contents(spark, layout):
    return {m: rows(read_table(spark, layout.mart(m))) for m in MARTS}


def test_run_by_run_equals_one_run_over_the_last_snapshot(spark, layout, tmp_path):
    steps = {
        "2023-05-01": {"keep": lambda i: i < 50},
        "2023-05-02": {"keep": lambda i: i < 55},
        "2023-05-03": {"keep": lambda i: i not in (20, 41), "price": lambda i: 10.0 + i + (i == 30), "when": lambda i: D(2023, 1, 3) + timedelta(days=i * 2 - (i == 45) * 40)},
    }
    land(spark, layout, "2023-05-01", **steps["2023-05-01"])
    first = pipeline.run_pipeline(spark, layout)
    assert first["log"]["order_items"] == {"2023-05-01": {"I": 100}}
    assert first["log"]["order_item_options"] == {"2023-05-01": {"I": 200}}
    assert first["current"] == {"order_items": 100, "order_item_options": 200}
    assert first["facts"] == {"order_line_items": 100, "orders": 50} and first["date_dim"] == 365
    assert first["marts"].keys() == set(MARTS)

    # two snapshots arrive before the next run; none is skipped
    land(spark, layout, "2023-05-02", **steps["2023-05-02"])
    land(spark, layout, "2023-05-03", **steps["2023-05-03"])
    january = month_files(spark, layout.mart("customer_clv_daily"), "2023-01")
    second = pipeline.run_pipeline(spark, layout)
    assert second["log"]["order_items"] == {"2023-05-02": {"I": 10}, "2023-05-03": {"I": 10, "U": 4, "D": 4}}
    assert month_files(spark, layout.mart("customer_clv_daily"), "2023-01") == january

    alone = Layout(str(tmp_path / "alone"))
    land(spark, alone, "2023-05-03", **steps["2023-05-03"])
    pipeline.run_pipeline(spark, alone)
    assert contents(spark, layout) == contents(spark, alone)

    # nothing new: nothing changes
    third = pipeline.run_pipeline(spark, layout)
    assert third["log"] == {"order_items": {}, "order_item_options": {}}
    assert contents(spark, layout) == contents(spark, alone)


def test_chosen_marts_are_those_of_a_whole_run(spark, layout, tmp_path):
    land(spark, layout, "2023-05-01", keep=lambda i: i < 50)
    only = ["clv_trends", "sales_daily"]
    assert pipeline.run_pipeline(spark, layout, marts=only)["marts"].keys() == set(only)
    land(spark, layout, "2023-05-02", keep=lambda i: i not in (20, 41))
    pipeline.run_pipeline(spark, layout, marts=only)
    assert not table_exists(spark, layout.mart("customer_clv_daily"))

    alone = Layout(str(tmp_path / "alone"))
    land(spark, alone, "2023-05-02", keep=lambda i: i not in (20, 41))
    pipeline.run_pipeline(spark, alone)
    for mart in only:
        assert rows(read_table(spark, layout.mart(mart))) == rows(read_table(spark, alone.mart(mart)))
    # the others were never made, so the next whole run starts from the whole log
    pipeline.run_pipeline(spark, layout)
    assert contents(spark, layout) == contents(spark, alone)
    with pytest.raises(ValueError, match="no such marts"):
        pipeline.run_pipeline(spark, layout, marts=["sales"])


def test_a_run_that_broke_off_is_followed_by_a_full_one(spark, layout, tmp_path, monkeypatch):
    land(spark, layout, "2023-05-01", keep=lambda i: True)
    pipeline.run_pipeline(spark, layout)
    land(spark, layout, "2023-05-02", keep=lambda i: i != 3)  # an old order is deleted
    with monkeypatch.context() as broken:
        broken.setattr(pipeline, "refresh_marts", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            pipeline.run_pipeline(spark, layout)
    pipeline.run_pipeline(spark, layout)

    alone = Layout(str(tmp_path / "alone"))
    land(spark, alone, "2023-05-02", keep=lambda i: i != 3)
    pipeline.run_pipeline(spark, alone)
    assert contents(spark, layout) == contents(spark, alone)


def test_other_thresholds_rebuild_everything(spark, layout, tmp_path):
    land(spark, layout, "2023-05-01")
    pipeline.run_pipeline(spark, layout, outlier_threshold=120.0)
    land(spark, layout, "2023-05-02", keep=lambda i: i != 58)
    pipeline.run_pipeline(spark, layout, outlier_threshold=60.0)

    alone = Layout(str(tmp_path / "alone"))
    land(spark, alone, "2023-05-02", keep=lambda i: i != 58)
    pipeline.run_pipeline(spark, alone, outlier_threshold=60.0)
    assert contents(spark, layout) == contents(spark, alone)


def test_undated_orders_come_out_the_same_in_steps(spark, layout):
    location, calendar = layout.mart("clv"), days(spark, D(2023, 1, 1), D(2023, 12, 31))
    known = [("a", 1.0, D(2023, 1, 5)), ("b", 2.0, None), ("c", 3.0, D(2023, 4, 2))]
    added = [*known, ("d", 4.0, None), ("b", 5.0, D(2023, 4, 9)), ("c", 6.0, None)]
    refresh_daily_value(spark, location, orders(spark, known), calendar)
    refresh_daily_value(spark, location, orders(spark, added), calendar, D(2023, 4, 9))
    whole = Layout(f"{layout.root}-whole").mart("clv")
    refresh_daily_value(spark, whole, orders(spark, added), calendar)
    assert stored(spark, location) == stored(spark, whole)


def test_single_jobs_between_runs_lose_no_deletion(spark, layout, tmp_path):
    land(spark, layout, "2023-05-01")
    pipeline.run_pipeline(spark, layout)
    land(spark, layout, "2023-05-02", keep=lambda i: i != 3)
    pipeline.log_pending(spark, layout)
    pipeline.refresh_current(spark, layout)
    pipeline.refresh_facts(spark, layout)  # the facts no longer say when order 3 was
    pipeline.run_pipeline(spark, layout)

    alone = Layout(str(tmp_path / "alone"))
    land(spark, alone, "2023-05-02", keep=lambda i: i != 3)
    pipeline.run_pipeline(spark, alone)
    assert contents(spark, layout) == contents(spark, alone)


def test_one_chosen_pair(spark, layout):
    land(spark, layout, "2023-05-01", keep=lambda i: i < 50)
    land(spark, layout, "2023-05-02")
    land(spark, layout, "2023-05-03", keep=lambda i: i < 59)
    assert pipeline.log_pair(spark, layout, tables=["order_items", "date_dim"]) == {"order_items": {"D": 2}}
    assert pipeline.log_pair(spark, layout, "2023-05-03", "2023-05-01", ["order_items"]) == {"order_items": {"I": 18}}
    assert read_log(spark, layout, "order_items").count() == 18


def test_snapshot_schema_can_be_given(spark, layout):
    from orderlake.sources import read_snapshot
    from orderlake.schemas import SNAPSHOTS
    land(spark, layout, "2023-05-01")
    df = read_snapshot(spark, layout, "2023-05-01", ORDER_ITEMS.name, SNAPSHOTS[ORDER_ITEMS.name])
    assert df.count() == 120 and df.schema["item_price"].dataType.simpleString() == "double"
    assert isinstance(TableContract("x").keys, tuple)


def test_jobs_one_by_one_equal_the_pipeline(spark, layout, tmp_path):
    from orderlake.__main__ import arguments, run
    land(spark, layout, "2023-05-01")
    for job in ("log", "current", "calendar", "facts", "marts"):
        run(spark, arguments([layout.root, "--job", job, "--start", "2022-01-01", "--end", "2023-12-31", "--unknown", "x"]))
    alone = Layout(str(tmp_path / "alone"))
    land(spark, alone, "2023-05-01")
    run(spark, arguments([alone.root, "--start", "2022-01-01", "--end", "2023-12-31"]))
    assert contents(spark, layout) == contents(spark, alone)
    assert read_table(spark, layout.current("date_dim")).count() == 730
