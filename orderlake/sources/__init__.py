from .buckets import (
    BUCKET, Pointer, in_buckets, is_bucketed, names, new_bucket, place, pointer, read_buckets, replace_keys, round_rows, rounds, rows_of, sizes,
    with_bucket, write_buckets,
)
from .changelog import base_date, logged_dates, read_history, read_log, write_base, write_log
from .snapshots import pending_pairs, read_snapshot, resolve_pair, snapshot_dates
from .staging import Staging
from .tables import (
    mart_months, read_table, remove_months, table_exists, write_months, write_table,
)

__all__ = [
    "BUCKET", "Pointer", "Staging", "base_date", "in_buckets", "is_bucketed", "logged_dates", "mart_months", "names", "new_bucket",
    "pending_pairs", "place", "pointer", "read_buckets", "read_history", "read_log", "read_snapshot", "read_table", "remove_months",
    "replace_keys", "resolve_pair", "round_rows", "rounds", "rows_of", "sizes", "snapshot_dates", "table_exists", "with_bucket", "write_base", "write_buckets", "write_log", "write_months", "write_table",
]
