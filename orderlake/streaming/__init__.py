"""Changes arriving over time: the feed contract and the recompute after late orders."""

from .feed import adapt_change_feed
from .late_orders import affected_since, recompute_floor, refresh_daily_value

__all__ = ["adapt_change_feed", "affected_since", "recompute_floor", "refresh_daily_value"]
