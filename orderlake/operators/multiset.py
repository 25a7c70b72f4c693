"""Multisets as signed counts: union the sides, add up the signs, keep what is left.

One shuffle on the whole row, NULL-safe because grouping treats NULLs as equal, and
partial sums on the map side, so a row repeated in a third of the input travels as
one record per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Reserved prefix: cannot meet a source column called "count" or the like.
NET = "__orderlake_net"
_RUN_NO = "__orderlake_run"
_COPY = "__orderlake_copy"

# length of the arrays from which copies are made
_RUN = 4096


def matching(df: DataFrame, other: DataFrame, how: str) -> DataFrame:
    """Semi or anti join on all columns of ``other``, NULLs matching."""
    renamed = other.toDF(*(f"__orderlake_{c}" for c in other.columns))
    same = [F.col(c).eqNullSafe(F.col(f"__orderlake_{c}")) for c in other.columns]
    return df.join(renamed, same, how)


def net_rows(sides: Sequence[tuple[DataFrame, Column]], columns: Sequence[str]) -> DataFrame:
    """``columns`` plus NET, the sum of the weights of equal rows, where it is not zero."""
    weighted = [df.select(*columns, weight.cast("bigint").alias(NET)) for df, weight in sides]
    return (
        reduce(DataFrame.unionAll, weighted)
        .groupBy(*columns)
        .agg(F.sum(NET).alias(NET))
        .filter(F.col(NET) != 0)
    )


def replicate(df: DataFrame, copies: Column) -> DataFrame:
    """Repeat every row ``copies`` times (a positive count).

    Copies are made in runs, so that no array grows with the count. Writers spread the
    result by its size (rebalance), in case one row has most of the copies.
    """
    columns = df.columns
    counted = df.withColumn(_COPY, copies.cast("bigint"))
    runs = F.sequence(F.lit(0).cast("bigint"), F.expr(f"({_COPY} - 1) div {_RUN}"))
    cut = counted.select(*columns, _COPY, F.explode(runs).alias(_RUN_NO))
    left = F.least(F.lit(_RUN).cast("bigint"), F.col(_COPY) - F.col(_RUN_NO) * _RUN)
    return cut.select(*columns, F.explode(F.sequence(F.lit(1).cast("bigint"), left)).alias(_COPY)).drop(_COPY)
