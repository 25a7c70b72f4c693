"""Row fingerprints.

Neither is used to find changes (see ``plans.change_capture``, which compares typed
values); they are offered for consumers that store one.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..contract import FINGERPRINT_NULL, FINGERPRINT_SEPARATOR


def row_fingerprint(columns: Iterable[str]) -> Column:
    """SHA-256 of the text forms in column-name order, joined with the fixed separator.

    Kept for parity with stored hashes. Different rows can share it: the separator is
    not escaped and the NULL text is a legal value.
    """
    texts = (F.col(name).cast("string") for name in sorted(columns))
    return F.sha2(F.concat_ws(FINGERPRINT_SEPARATOR, *(F.coalesce(t, F.lit(FINGERPRINT_NULL)) for t in texts)), 256)


def row_fingerprint_exact(columns: Iterable[str]) -> Column:
    """Same, but each value carries its length, so unequal rows never build equal text."""

    def tagged(name: str) -> Column:
        text = F.col(name).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("n"))

    return F.sha2(F.concat(*(tagged(name) for name in sorted(columns))), 256)
