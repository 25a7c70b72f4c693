from .columns import day_of, guarded_ratio, instant_of, money, month_of
from .fingerprint import row_fingerprint, row_fingerprint_exact
from .naming import columns_without, lower_case_names, without_load_metadata

__all__ = [
    "columns_without", "day_of", "guarded_ratio", "instant_of", "lower_case_names", "money", "month_of",
    "row_fingerprint", "row_fingerprint_exact", "without_load_metadata",
]
