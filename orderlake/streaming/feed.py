"""A log-based replication feed in place of compared snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contract import CHANGE_HEADERS, FEED_HEADERS
from ..functions import columns_without


def adapt_change_feed(feed: DataFrame) -> DataFrame:
    """Rename the feed's headers to the log's and lower-case the source columns.

    A pure projection, so it serves batch and streaming frames. Sequences become text;
    the feed may hold many changes per key, which the collapse already allows.
    """
    by_upper = {c.upper(): c for c in feed.columns}
    headers = {by_upper[h]: ours for h, ours in FEED_HEADERS.items() if h in by_upper}
    source = columns_without(feed, (*headers, *CHANGE_HEADERS))
    kept = [c for c in CHANGE_HEADERS if c in feed.columns and c not in headers.values()]
    renamed = {ours: F.col(c) for c, ours in headers.items()}
    if "cdc_seq" in renamed:
        renamed["cdc_seq"] = renamed["cdc_seq"].cast("string")
    return feed.select(
        *(F.col(c).alias(c.lower()) for c in source),
        *(c.alias(ours) for ours, c in renamed.items()),
        *kept,
    )
