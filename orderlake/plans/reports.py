"""Report roll-ups over the marts; every result is small enough to show."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contract import AT_RISK_COLUMNS, CHURN_STATES, LOYALTY_SEGMENTS, TIERS
from ..operators import median


def _in_domain(summary: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    """``summary`` in the fixed order of ``domain``, members without rows included."""
    frame = summary.sparkSession.range(1).select(F.posexplode(F.lit(list(domain))).alias("place", column))
    return frame.join(summary, column, "left").orderBy("place").drop("place")


# overview ------------------------------------------------------------------
def clv_kpis(tiers: DataFrame) -> DataFrame:
    # the mart has one row per customer, so counting rows counts customers
    return tiers.agg(
        F.count("user_id").alias("customers"),
        F.sum("total_clv").alias("total_clv"),
        F.avg("total_clv").alias("avg_clv"),
        F.sum("total_orders").alias("orders"),
    )


def tier_rollup(tiers: DataFrame) -> DataFrame:
    summary = tiers.groupBy("clv_tier").agg(F.count("user_id").alias("customers"), F.sum("total_clv").alias("revenue"))
    return _in_domain(summary, "clv_tier", TIERS)


# segmentation --------------------------------------------------------------
def segment_counts(rfm: DataFrame) -> DataFrame:
    counts = rfm.groupBy(F.col("rfm_segment").alias("segment")).agg(F.count(F.lit(1)).alias("customers"))
    return counts.orderBy(F.desc("customers"), "segment")


def rfm_kpis(rfm: DataFrame) -> DataFrame:
    return rfm.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col("rfm_segment") == "VIP").alias("vips"),
        F.count_if(F.col("rfm_segment") == "Churn Risk").alias("churn_risk"),
        F.avg("rfm_score").alias("avg_rfm_score"),
    )


def rfm_sample(rfm: DataFrame, size: int, seed: str = "1") -> DataFrame:
    """A repeatable sample: the customers whose seeded digest is smallest."""
    digest = F.md5(F.concat(F.lit(seed), F.col("user_id")))
    return rfm.orderBy(digest, "user_id").limit(size).select("user_id", "frequency", "monetary", "rfm_segment")


# churn ---------------------------------------------------------------------
def churn_kpis(churn: DataFrame) -> DataFrame:
    """Customers per state (zero if none), each with the median silence of all customers.

    One pass. The exact median keeps a count per distinct number of days, which the
    length of the order history bounds.
    """
    counts = {state: F.count_if(F.col("churn_status") == state) for state in CHURN_STATES}
    totals = churn.agg(*(c.alias(s) for s, c in counts.items()), F.median("days_since_last_order").alias("median"))
    states = (
        F.struct(F.lit(s).alias("status"), F.col(s).alias("customers"), F.col("median").alias("median_days_since_order"))
        for s in CHURN_STATES
    )
    return totals.select(F.inline(F.array(*states)))


def churn_histogram(churn: DataFrame, bins: int = 52, longest: int = 365) -> DataFrame:
    """Customers per equal-width bin of days since the last order; the bin above the last has all from ``longest`` on."""
    days = F.col("days_since_last_order")
    bin_no = F.width_bucket(days.cast("double"), F.lit(0.0), F.lit(float(longest)), F.lit(bins))
    return (
        churn.filter(days.isNotNull())
        .groupBy(bin_no.cast("int").alias("bin"))
        .agg(F.min(days).alias("first_days"), F.max(days).alias("last_days"), F.count(F.lit(1)).alias("customers"))
        .orderBy("bin")
    )


def at_risk_customers(churn: DataFrame, limit: int | None = None) -> DataFrame:
    """All customers at risk, the longest silent first; a page of the list is the caller's ``limit``."""
    longest_first = churn.filter("at_risk").orderBy(F.desc("days_since_last_order"), "user_id").select(*AT_RISK_COLUMNS)
    return longest_first if limit is None else longest_first.limit(limit)


def at_risk_total(churn: DataFrame) -> DataFrame:
    return churn.agg(F.count_if("at_risk").alias("customers"))


# sales ---------------------------------------------------------------------
def monthly_revenue(daily: DataFrame) -> DataFrame:
    month = F.trunc("order_date", "month").alias("month")
    return daily.groupBy(month).agg(F.sum("revenue").alias("revenue")).orderBy("month")


def sales_kpis(daily: DataFrame) -> DataFrame:
    return daily.agg(
        F.sum("revenue").alias("total_revenue"),
        F.count_distinct("item_category").alias("categories"),
        F.count_distinct("restaurant_id").alias("locations"),
        F.count_distinct("order_date").alias("days_covered"),
    )


def top_categories(daily: DataFrame, limit: int = 10) -> DataFrame:
    revenue = daily.groupBy("item_category").agg(F.sum("revenue").alias("revenue"))
    return revenue.orderBy(F.desc("revenue"), "item_category").limit(limit)


def holiday_effect(daily: DataFrame) -> DataFrame:
    """Mean of the daily totals, holidays against other days."""
    per_day = daily.groupBy("order_date", "is_holiday").agg(F.sum("revenue").alias("revenue"))
    effect = per_day.filter(F.col("is_holiday").isNotNull()).groupBy("is_holiday").agg(F.avg("revenue").alias("revenue"))
    return effect.select(F.expr("if(is_holiday, 'Holiday', 'Non-holiday')").alias("kind"), "is_holiday", "revenue")


# loyalty -------------------------------------------------------------------
def loyalty_comparison(loyalty: DataFrame) -> DataFrame:
    shown = loyalty.select("segment", "customers", "avg_clv", "avg_order_value", "repeat_rate")
    return _in_domain(shown, "segment", LOYALTY_SEGMENTS)


# locations -----------------------------------------------------------------
def location_kpis(locations: DataFrame) -> DataFrame:
    totals = locations.agg(
        F.count(F.lit(1)).alias("locations"),
        F.max("total_revenue").alias("top_revenue"),
        F.sum("total_revenue").alias("total_revenue"),
    )
    middle = median(locations, "avg_order_value").scalar().alias("median_order_value")
    return totals.select("locations", "top_revenue", middle, "total_revenue")


def top_locations(locations: DataFrame, limit: int = 15) -> DataFrame:
    best = locations.orderBy("revenue_rank", "restaurant_id").limit(limit)
    return best.withColumn("label", F.substring("restaurant_id", 1, 8))


# discounts -----------------------------------------------------------------
def discount_kpis(discounts: DataFrame) -> DataFrame:
    def orders_where(flag):
        return F.coalesce(F.sum(F.when(flag, F.col("orders"))), F.lit(0))

    return discounts.agg(
        orders_where(F.col("is_discounted")).alias("discounted_orders"),
        orders_where(~F.col("is_discounted")).alias("full_price_orders"),
        (F.lit(0.0) - F.sum("total_discount")).alias("discount_given"),
    )


def gross_and_net(discounts: DataFrame) -> DataFrame:
    """Long form: a Gross and a Net row per segment."""
    wide = discounts.select(
        "segment", F.col("total_gross_revenue").alias("Gross"), F.col("total_net_revenue").alias("Net")
    )
    return wide.unpivot("segment", ["Gross", "Net"], "measure", "amount")
