"""Column-name handling on the way in."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from ..contract import LOAD_METADATA


def lower_case_names(df: DataFrame) -> DataFrame:
    """One spelling for sources that differ in case."""
    return df.withColumnsRenamed({c: c.lower() for c in df.columns if c != c.lower()})


def columns_without(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Columns of ``df`` in order, minus ``names`` (exact, case-sensitive match)."""
    excluded = frozenset(names)
    return [c for c in df.columns if c not in excluded]


def without_load_metadata(df: DataFrame, metadata: Iterable[str] = LOAD_METADATA) -> DataFrame:
    """Lower-cased business columns of a landed snapshot."""
    lowered = lower_case_names(df)
    return lowered.select(*columns_without(lowered, metadata))
