"""Tables in buckets: what a write replaces, what it leaves, and what readers see when it breaks off."""

from dataclasses import replace
from datetime import date, timedelta
from pathlib import Path

import pytest
from helpers import rows
from pyspark.sql import functions as F
from test_pipeline import MARTS, contents, land

from orderlake.contract import ORDER_ITEM_OPTIONS, ORDER_ITEMS, Layout
from orderlake.plans import pipeline
from orderlake.plans.calendar import days
from orderlake.plans.current_state import collapse
from orderlake.sources import (
    BUCKET, buckets, names, new_bucket, place, pointer, read_buckets, read_log, read_table, replace_keys, rows_of, table_exists,
    with_bucket, write_buckets, write_table,
)
from orderlake.streaming import refresh_daily_value

D = date


def table(spark, *data):
    return spark.createDataFrame(data, f"k string, v int, {BUCKET} string")


def files(location):
    return {str(p.relative_to(location)) for p in Path(location).rglob("*.parquet")}


@pytest.fixture
def location(tmp_path):
    return str(tmp_path / "t")


def test_only_the_named_buckets_are_replaced(spark, location):
    assert pointer(spark, location) is None
    assert write_buckets(table(spark, ("a", 1, "x"), ("b", 2, "y"), ("c", 3, "y")), location).rows == 3
    before = files(location)
    now = write_buckets(table(spark, ("b", 5, "y"), ("d", 6, "z")), location, ["y"])
    assert now.buckets == {"x": (1, 1), "y": (2, 1), "z": (2, 1)}
    assert rows(read_table(spark, location)) == [("a", 1), ("b", 5), ("d", 6)]
    assert before < files(location)  # the buckets of the pointer before are still there for its readers
    assert rows(read_buckets(spark, location, at=buckets.read_pointer(spark, location, 1)).drop(BUCKET)) == [("a", 1), ("b", 2), ("c", 3)]
    write_buckets(table(spark), location, ["z"])
    assert rows(read_table(spark, location)) == [("a", 1), ("b", 5)]
    assert not any("orderlake_version=1/orderlake_bucket=y" in f for f in files(location))  # two pointers later it is gone
    assert any("orderlake_version=1/orderlake_bucket=x" in f for f in files(location))
    assert write_buckets(table(spark), location).rows == 0
    assert read_table(spark, location).columns == ["k", "v"] and read_table(spark, location).count() == 0


def test_a_table_of_plain_files_becomes_one_in_buckets(spark, location):
    write_table(table(spark, ("a", 1, "x")).drop(BUCKET), location)
    assert rows(read_table(spark, location)) == [("a", 1)]
    plain = files(location)
    write_buckets(read_table(spark, location).withColumn(BUCKET, F.lit("x")), location)
    assert rows(read_table(spark, location)) == [("a", 1)] and not plain & files(location)


STEPS = ["data", "half data", "pointer", "half pointer", "clean"]


@pytest.mark.parametrize("step", STEPS)
def test_a_write_that_breaks_off_leaves_a_whole_table(spark, location, monkeypatch, step):
    old, new = [("a", 1), ("b", 2), ("c", 3)], [("a", 1), ("b", 9), ("e", 4)]
    write_buckets(table(spark, ("z", 0, "x")), location)
    write_buckets(table(spark, ("a", 1, "x"), ("b", 2, "y"), ("c", 3, "y")), location)
    change = table(spark, ("b", 9, "y"), ("e", 4, "y"))

    def fail(*args, **kwargs):
        raise RuntimeError(step)

    with monkeypatch.context() as broken:
        if step == "data":
            change = change.withColumn("v", F.raise_error(F.lit(step)).cast("int"))
        elif step == "half data":
            change = change.withColumn("v", F.when(F.col("k") == "e", F.raise_error(F.lit(step)).cast("int")).otherwise(F.col("v"))).repartition(2, "k")
        elif step == "pointer":
            broken.setattr(buckets, "create_text", fail)
        elif step == "half pointer":
            create = buckets.create_text

            def half(spark, path, text):
                create(spark, path, text[: len(text) // 2])
                fail()

            broken.setattr(buckets, "create_text", half)
        else:
            broken.setattr(buckets, "remove", fail)
        with pytest.raises(Exception, match=step):
            write_buckets(change, location, ["y"])
    assert rows(read_table(spark, location)) == (new if step == "clean" else old)
    # the next write succeeds, whatever was left, and so does one after it
    for _ in range(2):
        write_buckets(table(spark, ("b", 9, "y"), ("e", 4, "y")), location, ["y"])
        assert rows(read_table(spark, location)) == new


def test_two_writers_cannot_both_succeed(spark, location, monkeypatch):
    write_buckets(table(spark, ("a", 1, "x")), location)
    first = pointer(spark, location)
    write_buckets(table(spark, ("a", 2, "x")), location)
    with monkeypatch.context() as late:
        late.setattr(buckets, "pointer", lambda *a: first)  # a writer that started before the other one ended
        with pytest.raises(Exception, match="(?i)exist"):
            write_buckets(table(spark, ("a", 3, "x")), location)
    assert rows(read_table(spark, location).select("k")) == [("a",)]


def test_keys_keep_their_bucket_and_new_ones_get_one(spark, location):
    write_buckets(table(spark, ("a", 1, "x"), ("b", 2, "y"), (None, 3, "y")), location)
    keys = spark.createDataFrame([("a",), (None,), ("n",), ("m",)], "k string")
    placed = place(read_buckets(spark, location), keys, new_bucket("2023-01-01 x/y", ["k"], 10, 5))
    found = dict(rows(placed.select("k", BUCKET)))
    assert found["a"] == "x" and found[None] == "y" and {found["n"], found["m"]} <= {"2023-01-01.x.y-0", "2023-01-01.x.y-1"}
    assert sorted(names(placed)) == sorted(set(found.values()))
    assert rows(rows_of(spark, location, keys)) == [("a", 1, "x"), (None, 3, "y")]
    tagged = with_bucket(spark.createDataFrame([("n", 7), (None, 8), ("other", 9)], "k string, v int"), placed)
    assert rows(tagged) == sorted([("n", 7, found["n"]), (None, 8, "y")], key=repr)
    before = files(location)
    replace_keys(tagged, location, keys)
    assert rows(read_table(spark, location)) == sorted([("b", 2), ("n", 7), (None, 8)], key=repr)
    assert before < files(location)


# --- the pipeline on them ---------------------------------------------------------------
@pytest.fixture
def layout(tmp_path):
    return Layout(str(tmp_path / "lake"), bucket_rows=25)


def bucket_files(spark, location):
    now = pointer(spark, location)
    return {b: sorted(p.name for p in Path(now.path(location, b)).glob("*.parquet")) for b in now.buckets}


def test_a_batch_rewrites_the_buckets_of_its_orders(spark, layout, tmp_path):
    land(spark, layout, "2023-05-01", keep=lambda i: i < 55)
    pipeline.run_pipeline(spark, layout)
    tables = [layout.current("order_items"), layout.current("order_item_options"), layout.fact("order_line_items"), layout.fact("orders")]
    before = [bucket_files(spark, t) for t in tables]
    assert all(len(b) >= 4 for b in before)
    # new orders, one corrected, one gone
    land(spark, layout, "2023-05-02", keep=lambda i: i != 20, price=lambda i: 10.0 + i + (i == 30))
    report = pipeline.run_pipeline(spark, layout)
    assert report["facts"] == {"order_line_items": 118, "orders": 59} and report["current"]["order_items"] == 118
    for location, old in zip(tables, before):
        new = bucket_files(spark, location)
        same = [b for b in old if new.get(b) == old[b]]
        assert len(old) - 2 <= len(same) < len(old) or location == tables[1] and len(same) == len(old) - 1, location
        assert set(new) - set(old) and all(b.startswith("2023-05-02") for b in set(new) - set(old))
        assert sum(rows for _, rows in pointer(spark, location).buckets.values()) == read_table(spark, location).count()
    alone = Layout(str(tmp_path / "alone"))
    land(spark, alone, "2023-05-02", keep=lambda i: i != 20, price=lambda i: 10.0 + i + (i == 30))
    pipeline.run_pipeline(spark, alone)
    assert contents(spark, layout) == contents(spark, alone)
    for one, other in ((layout, alone),):
        for name in ("order_line_items", "orders"):
            assert rows(read_table(spark, one.fact(name))) == rows(read_table(spark, other.fact(name)))


def test_two_batches_of_one_hot_order(spark, layout):
    """A third of all rows, and of each batch, belong to one order."""
    for step, lines in (("2023-01-01", 40), ("2023-01-02", 50), ("2023-01-03", 30)):
        price = float(step[-1])
        items = [("hot", f"h{i}", "u", "r", "a", "c", False, "2023-01-05", "x", "n", price, 1) for i in range(lines)]
        items += [(f"o{i}", "1", "u", "r", "a", "c", False, "2023-01-06", "x", "n", price if i < 1 else 1.0, 1) for i in range(80)] + [(None, "1", *items[0][2:])]
        options = [(o, n, "g", "cheese", 0.5, 1) for o, n, *_ in items] * 2 + [("hot", "h0", "g", "same", 1.0, 1)] * lines
        spark.createDataFrame(items, "order_id string, lineitem_id string, user_id string, restaurant_id string, app_name string, currency string, is_loyalty boolean, "
                              "creation_time_utc string, item_category string, item_name string, item_price double, item_quantity int").write.parquet(layout.snapshot(step, "order_items"))
        spark.createDataFrame(options, "order_id string, lineitem_id string, option_group_name string, option_name string, option_price double, option_quantity int").write.parquet(
            layout.snapshot(step, "order_item_options"))
        pipeline.log_pending(spark, layout)
        if step == "2023-01-01":
            pipeline.refresh_current(spark, layout)
            pipeline.refresh_facts(spark, layout)
        else:
            last = f"2023-01-0{int(step[-1]) - 1}"
            kept = bucket_files(spark, layout.current("order_items"))
            pipeline.refresh_current(spark, layout, after=last)
            counts, touched = pipeline.update_facts(spark, layout, last)
            assert touched.first_day == D(2023, 1, 5) and touched.months == {"2023-01"}
            now = bucket_files(spark, layout.current("order_items"))
            assert any(now.get(b) == f for b, f in kept.items())
            assert counts == {"order_line_items": lines + 81, "orders": 82}
        for contract in (ORDER_ITEMS, ORDER_ITEM_OPTIONS):
            expected = rows(collapse(read_log(spark, layout, contract.name), contract))
            assert rows(read_table(spark, layout.current(contract.name))) == expected
        whole = Layout(layout.root, bucket_rows=10**6)
        facts = {n: rows(read_table(spark, layout.fact(n))) for n in ("order_line_items", "orders")}
        pipeline.refresh_facts(spark, replace(whole))
        assert facts == {n: rows(read_table(spark, layout.fact(n))) for n in facts}


def test_marts_by_month_replace_the_months_of_a_batch(spark, layout, tmp_path):
    when = lambda i: D(2023, 1, 3) + timedelta(days=i * 2)
    moved = lambda i: when(i) - timedelta(days=(i == 45) * 30)
    land(spark, layout, "2023-05-01", keep=lambda i: i < 50)
    pipeline.run_pipeline(spark, layout)
    sales, trends = layout.mart("sales_daily"), layout.mart("clv_trends")
    before = bucket_files(spark, sales), bucket_files(spark, trends)
    assert len(before[0]) == 4
    # re-dated from April to March, deleted in March, new in April
    land(spark, layout, "2023-05-02", keep=lambda i: i != 31, when=moved)
    pipeline.run_pipeline(spark, layout)
    for location, old in zip((sales, trends), before):
        new = bucket_files(spark, location)
        assert [new[m] == old[m] for m in ("2023-01", "2023-02", "2023-03", "2023-04")] == [True, True, False, False]
    alone = Layout(str(tmp_path / "alone"))
    land(spark, alone, "2023-05-02", keep=lambda i: i != 31, when=moved)
    pipeline.run_pipeline(spark, alone)
    assert contents(spark, layout) == contents(spark, alone)
    # another holiday: its month follows, though no order changed
    land(spark, layout, "2023-05-03", keep=lambda i: i != 31, when=moved)
    land(spark, alone, "2023-05-03", keep=lambda i: i != 31, when=moved)
    holidays = "date_key string, year string, is_holiday string, holiday_name string, op string, ingested_at string"
    for where in (layout, alone):
        spark.createDataFrame([("2023-02-10", "2023", "true", "Fair", "I", "x")], holidays).write.mode("overwrite").parquet(where.snapshot("2023-05-03", "date_dim"))
    pipeline.run_pipeline(spark, layout)
    pipeline.run_pipeline(spark, alone, full=True)
    assert contents(spark, layout) == contents(spark, alone)
    assert read_table(spark, sales).filter("holiday_name = 'Fair'").count() > 0
    assert set(MARTS) == {p.name for p in Path(layout.root, "gold").iterdir()} and table_exists(spark, trends)


def test_undated_orders_in_every_batch(spark, layout):
    location, calendar = layout.mart("clv"), days(spark, D(2023, 1, 1), D(2023, 12, 31))
    data = [("a", 1.0, D(2023, 1, 5)), ("b", 2.0, None), ("c", 3.0, D(2023, 4, 2))]
    batches = [
        # (new orders, batch_min, whether earlier months keep their files)
        ([("c", 4.0, None), ("b", 1.0, None), ("a", 2.0, D(2023, 4, 9))], D(2023, 4, 9), True),  # only known accounts
        ([("a", 5.0, None), ("e", 1.0, D(2023, 5, 1))], D(2023, 5, 1), True),
        ([("d", 4.0, None)], D(2023, 5, 2), False),  # opens one on the first day
        ([("b", 5.0, D(2023, 5, 9)), ("c", 6.0, None)], D(2023, 5, 9), False),  # an undated account gets a date
        ([("f", 9.0, D(2023, 5, 10)), ("d", 1.0, None)], D(2023, 5, 10), True),
    ]

    def orders(rows):
        return spark.createDataFrame(rows, "user_id string, order_revenue double, order_date date")

    refresh_daily_value(spark, location, orders(data), calendar)
    for n, (added, batch_min, kept) in enumerate(batches):
        january = files(f"{location}/clv_month=2023-01")
        data += added
        result = refresh_daily_value(spark, location, orders(data), calendar, batch_min)
        assert result["whole"] is not kept and (files(f"{location}/clv_month=2023-01") == january) is kept
        whole = f"{location}-{n}"
        refresh_daily_value(spark, whole, orders(data), calendar)
        assert rows(read_table(spark, location)) == rows(read_table(spark, whole))
    # the undated orders of d are taken back
    data = [o for o in data if o[0] != "d"]
    assert refresh_daily_value(spark, location, orders(data), calendar, date.max)["whole"]
    refresh_daily_value(spark, f"{location}-last", orders(data), calendar)
    assert rows(read_table(spark, location)) == rows(read_table(spark, f"{location}-last"))


def test_large_months_are_dealt_over_several_tasks(spark, layout, monkeypatch):
    from orderlake.plans.customers import daily_from_spans, value_spans
    from orderlake.streaming import late_orders

    data = [(f"u{i}", 1.0, D(2023, 1, 1) + timedelta(days=i % 70)) for i in range(60)]
    orders = spark.createDataFrame(data, "user_id string, order_revenue double, order_date date")
    spans = late_orders.dealt_by_month(value_spans(orders, D(2023, 1, 1), D(2023, 3, 31)), part_rows=300)
    parts = spans.select("clv_month", F.spark_partition_id().alias("part"), "user_id").distinct().groupBy("part").agg(
        F.count_distinct("clv_month").alias("months"), F.first("clv_month").alias("month")).collect()
    assert all(r.months == 1 for r in parts) and len(parts) >= 10
    per_month = {m: sum(r.month == m for r in parts) for m in {r.month for r in parts}}
    assert per_month["2023-03"] > per_month["2023-01"] >= 2
    assert daily_from_spans(spans).count() == daily_from_spans(value_spans(orders, D(2023, 1, 1), D(2023, 3, 31))).count()
    assert late_orders.dealt_by_month(value_spans(orders.limit(0), D(2023, 1, 1), D(2023, 3, 31))).count() == 0
