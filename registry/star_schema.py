"""The given star-schema tables seen as the order model.

Plain projections and joins: no row is left out. Orders of priority 4 have no customer
(guests), priority 1 carries the loyalty flag, PROMO parts carry a discount option.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.plans import calendar as cal
from orderlake.plans.revenue import known_customers, line_item_facts, order_facts

ORDER_OUTLIER = 250000.0
LINE_OUTLIER = 45000.0
# month-day and name of the holidays in the source calendar
HOLIDAYS = {"01-01": "New Year", "07-04": "Independence Day", "12-25": "Christmas"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _line_id():
    return F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey").alias("lineitem_id")


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    # texts of an order or customer are formed before the join: once each, not once per line
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        "o_custkey",
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_custkey").cast("string")).alias("user_id"),
        (F.col("o_orderpriority") == "1-URGENT").alias("is_loyalty"),
        F.col("o_orderdate").cast("string").alias("creation_time_utc"),
    )
    people = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.col("c_nationkey").cast("string").alias("restaurant_id"),
        F.col("c_mktsegment").alias("app_name"),
    )
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.col("p_type").alias("item_category"),
        F.col("p_name").alias("item_name"),
        F.col("p_retailprice").alias("item_price"),
    )
    joined = table(spark, sf_dir, "lineitem").join(parts, "l_partkey").join(orders.join(people, "o_custkey"), "l_orderkey")
    return joined.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        _line_id(),
        "user_id", "restaurant_id", "app_name",
        F.lit("USD").alias("currency"),
        "is_loyalty", "creation_time_utc", "item_category", "item_name", "item_price",
        F.col("l_quantity").cast("int").alias("item_quantity"),
    )


def order_item_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An add-on for every line, and a discount for lines of PROMO parts."""
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )

    def option(group: str, name: str, price):
        return F.struct(
            F.lit(group).alias("option_group_name"), F.lit(name).alias("option_name"), price.alias("option_price")
        )

    extra = option("extra", "service", F.col("l_tax"))
    promo = F.when(F.col("p_type") == "PROMO", option("promo", "deal", -F.col("l_discount")))
    return lines.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        _line_id(),
        F.inline(F.array_compact(F.array(extra, promo))),
        F.col("l_quantity").cast("int").alias("option_quantity"),
    )


def line_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_item_facts(order_items(spark, sf_dir), order_item_options(spark, sf_dir), LINE_OUTLIER)


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_facts(line_facts(spark, sf_dir), ORDER_OUTLIER)


def named_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return known_customers(facts(spark, sf_dir))


def order_days(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    """First and last order date: two values from the column's statistics."""
    return tuple(cal.date_bounds(table(spark, sf_dir, "orders"), "o_orderdate").first())


def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source calendar as landed: upper-case names, all text, load metadata.

    It lists the days that have orders, once per order status; only the rows of finished
    orders know the holidays, so most days are repeated with different flags.
    """
    day = F.col("o_orderdate").cast("date")
    listed = table(spark, sf_dir, "orders").select(day.cast("string").alias("DATE_KEY"), "o_orderstatus").distinct()
    name = F.lit(None).cast("string")
    for month_day, text in HOLIDAYS.items():
        name = F.when(F.col("DATE_KEY").endswith(month_day) & (F.col("o_orderstatus") == "F"), text).otherwise(name)
    return listed.select(
        F.lit("I").alias("Op"), F.lit("2026-01-01 00:00:00").alias("ingested_at"), "DATE_KEY",
        name.isNotNull().cast("string").alias("IS_HOLIDAY"), name.alias("HOLIDAY_NAME"),
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, last = order_days(spark, sf_dir)
    days = cal.days(spark, date(first.year, 1, 1), date(last.year, 12, 31))
    return cal.date_dim(days, cal.typed_holidays(holidays(spark, sf_dir)))


# Snapshots as of a day. Rows appear on their date, are archived four years later from the
# second snapshot on, and an order stays open ("O") for its first sixty days. The first
# snapshot has all rows up to its day and the last one all later ones, so each row is in one at least.
SNAPSHOT_DAYS = ("1999-06-30", "1999-09-30", "2002-12-31")


def landed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as landed: upper-case names and load metadata."""
    orders = table(spark, sf_dir, "orders")
    upper = orders.toDF(*(c.upper() for c in orders.columns))
    return upper.select(F.lit("I").alias("Op"), F.lit("2003-01-01 02:00:00").alias("ingested_at"), "*")


def in_snapshot(event_day, day: str):
    archived = F.add_months(F.lit(day).cast("date"), -48)
    present = event_day <= F.lit(day).cast("date")
    return present if day == SNAPSHOT_DAYS[0] else present & (event_day > archived)


def orders_as_of(spark: SparkSession, sf_dir: str, day: str) -> DataFrame:
    placed = F.col("O_ORDERDATE").cast("date")
    day_lit = F.lit(day).cast("date")
    upper = table(spark, sf_dir, "orders")
    upper = upper.toDF(*(c.upper() for c in upper.columns))
    kept = upper.filter(in_snapshot(placed, day))
    status = F.when(placed > F.date_sub(day_lit, 60), "O").otherwise(F.col("O_ORDERSTATUS"))
    return kept.select(
        F.lit("I").alias("Op"), F.lit(f"{day} 02:00:00").alias("ingested_at"),
        "O_ORDERKEY", "O_CUSTKEY", status.alias("O_ORDERSTATUS"), "O_TOTALPRICE",
        placed.alias("O_ORDERDATE"), "O_ORDERPRIORITY",
    )


def shipments_as_of(spark: SparkSession, sf_dir: str, day: str) -> DataFrame:
    """Shipped lines without any identifier: many rows are equal."""
    kept = table(spark, sf_dir, "lineitem").filter(in_snapshot(F.col("l_shipdate").cast("date"), day))
    return kept.select(
        F.lit("I").alias("op"), F.lit(f"{day} 02:00:00").alias("ingested_at"),
        "l_linenumber", "l_returnflag", "l_linestatus", F.col("l_quantity").cast("int").alias("l_quantity"),
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase events as customer orders."""
    return (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type") == "purchase")
        .select(
            F.col("user_id").cast("string").alias("user_id"),
            F.col("value").alias("order_revenue"),
            F.col("ts").cast("date").alias("order_date"),
        )
    )
