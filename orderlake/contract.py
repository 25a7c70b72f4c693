"""Names, keys and storage layout shared by every job.

The values in the first block are fixed: data written by existing producers and
read by existing consumers uses exactly these names.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values -----------------------------------------------------------
# Columns the landing process adds to every snapshot row.
LOAD_METADATA = ("op", "ingested_at")
# Header columns of a change-log row, in stored order.
CHANGE_HEADERS = ("Op", "cdc_seq", "cdc_commit_ts", "cdc_snapshot_dt", "cdc_processed_at")
# Directory column of the change log.
LOG_PARTITIONS = ("dt",)
# Text used by the plain row fingerprint.
FINGERPRINT_NULL = "__NULL__"
FINGERPRINT_SEPARATOR = "||"
# Header names of a log-based replication feed and the log column each one feeds.
FEED_HEADERS = {
    "AR_H_OPERATION": "Op",
    "AR_H_CHANGE_SEQ": "cdc_seq",
    "AR_H_COMMIT_TIMESTAMP": "cdc_commit_ts",
}
# Calendar columns copied onto the daily sales mart.
CALENDAR_COLUMNS = ("year", "month", "week", "day_of_week", "is_weekend", "is_holiday", "holiday_name")
# Domains that reports always show in full, in display order.
TIERS = ("High", "Medium", "Low")
CHURN_STATES = ("Active", "At Risk", "Dormant")
LOYALTY_SEGMENTS = ("Loyalty", "Non-Loyalty")
# Columns of the daily value mart and of the list of customers at risk.
DAILY_COLUMNS = (
    "user_id", "clv_date", "clv_month", "first_order_date",
    "daily_revenue", "daily_order_count", "cumulative_clv", "cumulative_order_count",
)
AT_RISK_COLUMNS = (
    "user_id", "last_order_date", "days_since_last_order", "total_orders",
    "avg_gap_days", "spend_change_pct", "churn_status",
)
# Segments of customers, the first that applies; R, F, M are scores from 1 to 5.
SEGMENT_RULE = """CASE
    WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'VIP'
    WHEN r_score >= 4 AND f_score <= 2 THEN 'New'
    WHEN r_score <= 2 AND f_score <= 2 THEN 'Churn Risk'
    ELSE 'Regular' END"""
# Default thresholds.
OUTLIER_REVENUE = 10000.0
LOOKBACK_MONTHS = 12
AT_RISK_DAYS, DORMANT_DAYS, PERIOD_DAYS = 45, 90, 30
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class TableContract:
    """How rows of a source table are identified.

    ``keys`` empty means the table is a multiset: duplicates are meaningful and a
    row has no identity beyond its values. ``static`` tables are reloaded whole
    and have no change log. Rows that agree in ``together`` are stored in one bucket;
    it is part of the keys, if there are any.
    """

    name: str
    keys: tuple[str, ...] = ()
    static: bool = False
    together: tuple[str, ...] = ()


ORDER_ITEMS = TableContract("order_items", ("order_id", "lineitem_id"), together=("order_id",))
ORDER_ITEM_OPTIONS = TableContract("order_item_options", together=("order_id",))
DATE_DIM = TableContract("date_dim", ("date_key",), static=True)

CONTRACTS = {c.name: c for c in (ORDER_ITEMS, ORDER_ITEM_OPTIONS, DATE_DIM)}
LOGGED = {n: c for n, c in CONTRACTS.items() if not c.static}


@dataclass(frozen=True)
class Layout:
    """Where each kind of table lives under one root (any Hadoop path)."""

    root: str
    source_schema: str = "source"
    #: About how many rows a bucket of a current or fact table gets.
    bucket_rows: int = 1_000_000

    @property
    def snapshots(self) -> str:
        return f"{self.root}/snapshots"

    def snapshot(self, dt: str, table: str) -> str:
        return f"{self.snapshots}/dt={dt}/{self.source_schema}/{table}"

    def log(self, table: str) -> str:
        return f"{self.root}/cdc/{table}"

    def log_base(self, table: str) -> str:
        return f"{self.root}/cdc_base/{table}"

    def current(self, table: str) -> str:
        return f"{self.root}/silver/current/{table}"

    def fact(self, name: str) -> str:
        return f"{self.root}/silver/facts/{name}"

    def mart(self, name: str) -> str:
        return f"{self.root}/gold/{name}"

    @property
    def progress(self) -> str:
        return f"{self.root}/state/progress"
