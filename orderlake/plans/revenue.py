"""Revenue facts at line and order grain."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import OUTLIER_REVENUE
from ..functions import day_of, instant_of, money

LINE_KEY = ["order_id", "lineitem_id"]
# attributes an order takes from its lines
ORDER_ATTRIBUTES = ["user_id", "restaurant_id", "app_name", "currency", "is_loyalty", "creation_time_utc"]
# those that travel together behind one line id; few, as who needs one of a group carries them all
TOGETHER = [["user_id"], ["creation_time_utc", "is_loyalty"], ["restaurant_id", "app_name", "currency"]]


def line_item_facts(items: DataFrame, options: DataFrame, outlier_threshold: float = OUTLIER_REVENUE) -> DataFrame:
    """Every item column plus the line's revenue split.

    Options are summed per line before the join, so a line stays one row and a line
    with very many options meets the join as one. A NULL price or quantity makes the
    line's revenue and its outlier flag NULL; options of no known line are left out.
    """
    amount = money("option_price", "option_quantity")
    per_line = options.groupBy(*LINE_KEY).agg(
        F.sum(amount).alias("opt_total"),
        F.sum(F.least(amount, F.lit(0.0))).alias("opt_minus"),
        F.sum(F.greatest(amount, F.lit(0.0))).alias("opt_plus"),
    )
    # one row per line at most, so no key is hot: hashed, neither side is sorted by its texts
    joined = items.join(per_line.hint("shuffle_hash"), LINE_KEY, "left")
    item = money("item_price", "item_quantity")
    minus = F.coalesce("opt_minus", F.lit(0.0))
    net = item + F.coalesce("opt_total", F.lit(0.0))
    return joined.select(
        *items.columns,
        item.alias("item_amount"),
        minus.alias("options_discount"),
        (item + F.coalesce("opt_plus", F.lit(0.0))).alias("gross_revenue"),
        minus.alias("discount_amount"),
        net.alias("net_revenue"),
        (minus < 0).alias("is_discounted"),
        (net > outlier_threshold).alias("is_outlier"),
    )


def order_facts(lines: DataFrame, outlier_threshold: float = OUTLIER_REVENUE, carried: Sequence[str] = ()) -> DataFrame:
    """One row per order, with columns ``carried`` that all lines of an order share.

    Each attribute is its first non-NULL value by ``lineitem_id``; of several lines with the same id, attributes
    that travel together come from one. Outliers are flagged, never dropped.
    """

    def earliest(lines_with: Column, *names: str) -> Column:
        return F.min(F.when(lines_with, F.struct("lineitem_id", *names)))

    def first_known(names: list[str]) -> list[Column]:
        """Lines that know all of ``names`` send them behind one line id, only the others each by itself."""
        known = [F.col(n).isNotNull() for n in names]
        if len(names) == 1:
            return [earliest(known[0], *names).getField(names[0]).alias(names[0])]
        all_known = reduce(Column.__and__, known)
        first = earliest(all_known, *names)

        def of(name: str, is_known: Column) -> Column:
            whole = F.when(first.isNotNull(), F.struct(first["lineitem_id"].alias("lineitem_id"), first[name].alias(name)))
            return F.least(whole, earliest(is_known & ~all_known, name)).getField(name).alias(name)

        return [of(n, k) for n, k in zip(names, known)]

    attributes = {n: c for names in TOGETHER for n, c in zip(names, first_known(names))}
    rolled = lines.groupBy("order_id", *carried).agg(
        *(attributes[a] for a in ORDER_ATTRIBUTES),
        F.sum("net_revenue").alias("order_revenue"),
        F.sum("gross_revenue").alias("order_gross_revenue"),
        F.sum("discount_amount").alias("order_discount_amount"),
        F.count(F.lit(1)).alias("line_item_count"),
        F.sum(F.col("item_quantity").try_cast("double")).alias("total_item_quantity"),
    )
    return rolled.select(
        "*",
        instant_of("creation_time_utc").alias("order_ts"),
        day_of("creation_time_utc").alias("order_date"),
        (F.col("order_discount_amount") < 0).alias("is_discounted"),
        (F.col("order_revenue") > outlier_threshold).alias("is_outlier"),
    )


def regular(facts: DataFrame) -> DataFrame:
    """Rows not flagged as outliers. An unknown flag counts as flagged."""
    return facts.filter(~F.col("is_outlier"))


def known_customers(orders: DataFrame) -> DataFrame:
    """Regular orders that name a customer; guests would otherwise form one giant customer."""
    return regular(orders).filter(F.col("user_id").isNotNull())
