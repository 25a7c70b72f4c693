"""Ranks over a whole table.

A window without PARTITION BY would sort every row in one task. Instead the values that
are ranked, and nothing else, are range-partitioned and sorted, and
``monotonically_increasing_id`` numbers them as (partition number, row number in the
partition). Those ids grow with the global order, so the driver only needs the size of
each partition, one number per partition, to say at which id every bucket starts. The rows at
these few places are the boundaries, and the table is scored by comparing each row with them.

The sorted values are made durable first: range bounds come from sampling, and every pass
must see the same ones even if an executor is lost in between.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable

_ID = "__orderlake_id"
_PARTITION = "__orderlake_partition"
# monotonically_increasing_id keeps the row number in its low 33 bits
_ROW_BITS = 33


class _Numbered:
    """Rows in a global order plus what is needed to turn a position into an id."""

    def __init__(self, df: DataFrame, order: Sequence[Column]) -> None:
        self.rows = durable(
            df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(_ID, F.monotonically_increasing_id())
        )
        sizes = self.rows.groupBy(F.shiftright(_ID, _ROW_BITS).alias(_PARTITION)).count().collect()
        sizes = sorted((int(p), int(n)) for p, n in sizes)
        self.partitions = [p for p, _ in sizes]
        self.starts = [0, *accumulate(n for _, n in sizes)]
        self.total = self.starts.pop()

    def id_at(self, position: int) -> int:
        slot = bisect_right(self.starts, position) - 1
        return (self.partitions[slot] << _ROW_BITS) + position - self.starts[slot]

    def with_position(self, name: str) -> DataFrame:
        """0-based global position; the joined side has one row per partition."""
        shift = [s - (p << _ROW_BITS) for p, s in zip(self.partitions, self.starts)]
        table = pa.table({_PARTITION: pa.array(self.partitions, pa.int64()), name: pa.array(shift, pa.int64())})
        shifts = self.rows.sparkSession.createDataFrame(table)
        return (
            self.rows.withColumn(_PARTITION, F.shiftright(_ID, _ROW_BITS))
            .join(shifts, _PARTITION)
            .withColumn(name, F.col(name) + F.col(_ID))
            .drop(_ID, _PARTITION)
        )


_PLACE = ("null", "value", "key")


def _sort_key(value: str, descending: bool, key: str) -> Column:
    """What orders rows by ``value``, then ``key``, under plain ascending comparison; NULL is the smallest value."""
    v = F.col(value).cast("double")
    return F.struct(
        (v.isNull() if descending else v.isNotNull()).alias("null"), (-v if descending else v).alias("value"), F.col(key).alias("key")
    )


def ntiles(df: DataFrame, buckets: int, orders: Mapping[str, tuple[str, bool]], key: str) -> DataFrame:
    """SQL ``ntile(buckets)`` over each order, given as (number column, descending); ``key`` is unique and settles ties.

    One sort serves all orders: each brings its own copy of (value, key), set apart by its number.
    """
    rows = durable(df)  # a sum of doubles must be the same bits in the sort and in the comparison
    places = [_sort_key(value, descending, key) for value, descending in orders.values()]
    keyed = reduce(DataFrame.unionAll, (rows.select(F.lit(i).alias("which"), p.alias("place")).select("which", "place.*") for i, p in enumerate(places)))
    numbered = _Numbered(keyed, [F.col(c) for c in ("which", *_PLACE)])
    total = numbered.total // len(places)
    size, larger = divmod(total, buckets)
    starts = [start for b in range(1, buckets) if (start := b * size + min(b, larger)) < total]
    ids = [numbered.id_at(i * total + start) for i in range(len(places)) for start in starts]
    found = numbered.rows.filter(F.col(_ID).isin(ids)).collect()  # buckets - 1 rows for each order
    kinds = {f.name: f.dataType for f in numbered.rows.schema}

    def score(which: int) -> Column:
        boundaries = (F.struct(*(F.lit(r[c]).cast(kinds[c]).alias(c) for c in _PLACE)) for r in found if r["which"] == which)
        return sum(((places[which] >= boundary).cast("int") for boundary in boundaries), F.lit(1))

    return rows.withColumns({name: score(i) for i, name in enumerate(orders)})


def dense_rank(df: DataFrame, value: str, name: str) -> DataFrame:
    """SQL ``dense_rank`` by ``value`` descending: the place of the value among the distinct ones."""
    rows = durable(df)  # the values must be the same bits on both sides of the join
    ranked = _Numbered(rows.select(value).distinct(), [F.col(value).desc()]).with_position(name)
    places = ranked.select(F.col(value).alias("__orderlake_value"), (F.col(name) + 1).cast("int").alias(name))
    return rows.join(places, F.col(value).eqNullSafe(F.col("__orderlake_value")), "left").drop("__orderlake_value")


#: A sketch of ranks is off by at most one in so many rows.
_SKETCH = 100_000


def median(df: DataFrame, value: str) -> DataFrame:
    """One row ``median``: the exact median of the non-NULL values, the mean of the one or two in the middle; NULL without any.

    A plan like any other, nothing runs before it does. A sketch gives two values between which the middle must lie, a few rows in a
    hundred thousand apart. One pass counts what is below them and, by value, what is between: that short list holds the
    answer. Ties are one entry of it, however many. Only sums per value and the sketch are gathered. A middle outside the bracket, which
    the sketch's bound excludes, would fail the query.
    """
    numbers = df.select(F.col(value).cast("double").alias("v")).dropna()
    off = 4 / _SKETCH
    ends = numbers.agg(F.percentile_approx("v", [0.5 - off, 0.5 + off], _SKETCH).alias("ends"))
    low, high = (ends.select(F.col("ends")[i]).scalar() for i in (0, 1))
    # what is outside counts on its side, what is between by its value
    place = F.when(F.col("v") < low, 0).when(F.col("v") > high, 2).otherwise(1)
    cells = numbers.groupBy(place.alias("place"), F.when(place == 1, F.col("v")).alias("v")).agg(F.count("*").alias("n"))
    listed = cells.agg(F.array_sort(F.collect_list(F.struct("place", "v", "n"))).alias("cells"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))

    def at(position: Column) -> Column:
        """The cell that holds a 0-based position."""
        kind = "struct<seen: bigint, cell: struct<place: int, v: double, n: bigint>>"
        start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).alias("cell")).cast(kind)

        def pass_by(so_far: Column, cell: Column) -> Column:
            seen = so_far["seen"] + cell["n"]
            return F.struct(seen.alias("seen"), F.coalesce(so_far["cell"], F.when(seen > position, cell)).alias("cell")).cast(kind)

        cell = F.aggregate("cells", start, pass_by)["cell"]
        missed = F.raise_error(F.lit("the median is not between the bounds of the sketch")).cast("double")
        return F.when(cell["place"] == 1, cell["v"]).otherwise(F.when(cell.isNotNull(), missed))

    middle = at(F.expr("(n - 1) div 2")) * 0.5 + at(F.expr("n div 2")) * 0.5
    return listed.select(F.when(F.col("n") > 0, middle).alias("median"))
