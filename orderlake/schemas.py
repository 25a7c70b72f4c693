"""Declared schemas, for readers that should not open footers to infer them."""

from __future__ import annotations

from pyspark.sql.types import StructType

from .contract import DATE_DIM, ORDER_ITEM_OPTIONS, ORDER_ITEMS

_LANDED = "op string, ingested_at string"

# Landed snapshots; column names match files of any case.
SNAPSHOTS: dict[str, StructType] = {
    name: StructType.fromDDL(f"{columns}, {_LANDED}")
    for name, columns in {
        ORDER_ITEMS.name: """order_id string, lineitem_id string, user_id string, restaurant_id string, app_name string,
            currency string, is_loyalty boolean, creation_time_utc string, item_category string, item_name string,
            item_price double, item_quantity int""",
        ORDER_ITEM_OPTIONS.name: """order_id string, lineitem_id string, option_group_name string, option_name string,
            option_price double, option_quantity int""",
        DATE_DIM.name: """date_key string, year string, month string, week string, day_of_week string,
            is_weekend string, is_holiday string, holiday_name string""",
    }.items()
}
