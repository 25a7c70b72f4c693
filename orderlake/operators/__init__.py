from .densify import each_day, month_spans
from .latest import latest_per_key
from .multiset import matching, net_rows, replicate
from .ranking import dense_rank, median, ntiles

__all__ = ["dense_rank", "each_day", "latest_per_key", "matching", "median", "month_spans", "net_rows", "ntiles", "replicate"]
