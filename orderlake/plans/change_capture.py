"""Change log from consecutive full snapshots.

A multiset counts current rows as +1 and previous rows as -1 and keeps the rows whose sum
is not zero. A keyed table is grouped by key once, both sides together: each side has at
most one row for a key, which is checked, and the two images are compared NULL-safe. Either way
the snapshots are shuffled once and nothing can fan out. The first snapshot of a keyed table has nothing
to be compared with: only its keys are shuffled, for the check.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import LOAD_METADATA, TableContract
from ..functions import without_load_metadata
from ..operators import net_rows, replicate
from ..operators.multiset import NET

NOW, BEFORE = "__orderlake_now", "__orderlake_before"
COPIES = "__orderlake_copies"


def capture_changes(
    current: DataFrame,
    previous: DataFrame | None,
    contract: TableContract,
    snapshot_dt: str,
    batch_ts: str | None = None,
    metadata: Iterable[str] = LOAD_METADATA,
    part: tuple[int, int] = (0, 1),
) -> DataFrame:
    """Log rows (source columns, Op, headers) that turn ``previous`` into ``current``.

    Without a previous snapshot every row is an insert, duplicates of a multiset included.
    A snapshot that repeats a key of a keyed table fails, the first one too. ``part`` (number, of how many) takes
    the changes of a part of the keys by their hash, so that a large step can be logged in parts that shuffle less at a time.
    """
    now = without_load_metadata(current, metadata)
    columns = now.columns
    before = None if previous is None else without_load_metadata(previous, metadata).select(*columns)
    if contract.keys:
        changes = keyed_changes(now, before, contract.keys, part)
    elif before is None:
        changes = _of_part(now, contract.together or columns, part).withColumn("Op", F.lit("I"))
    else:
        net = net_rows([(now, F.lit(1)), (before, F.lit(-1))], columns)
        changes = multiset_changes(_of_part(net, contract.together or columns, part))
    return with_change_headers(changes, snapshot_dt, batch_ts or snapshot_dt, part)


def _of_part(rows: DataFrame, keys: Sequence[str], part: tuple[int, int]) -> DataFrame:
    number, parts = part
    return rows if parts == 1 else rows.filter(F.pmod(F.xxhash64(*keys), F.lit(parts)) == number)


def keyed_changes(now: DataFrame, before: DataFrame | None, keys: Sequence[str], part: tuple[int, int] = (0, 1)) -> DataFrame:
    """One I, U or D per key whose row differs between two snapshots.

    U and I carry the new row, D the last known one. A key with more than one row in a
    snapshot breaks the table's contract and fails the job, whether it changed or not: which of
    its rows would be the current one is unknown.
    """
    if before is None:
        return _of_part(_first_rows(now, keys), keys, part)
    row, is_now = F.struct(*now.columns), F.col(NOW)
    # cut after both sides have the same types, so that equal keys are in one part
    sides = _of_part(now.withColumn(NOW, F.lit(True)).unionAll(before.withColumn(NOW, F.lit(False))), keys, part)
    # dealt by key first: keys do not repeat, so sorting the rows in the map tasks to reduce them there would be in vain
    paired = sides.repartition(*keys).groupBy(*(F.col(k).alias(f"__orderlake_key{i}") for i, k in enumerate(keys))).agg(
        F.count_if(is_now).alias(COPIES),
        F.count_if(~is_now).alias(f"{COPIES}_before"),
        F.max(F.when(is_now, row)).alias(NOW),
        F.max(F.when(~is_now, row)).alias(BEFORE),
    )
    copies, copies_before = F.col(COPIES), F.col(f"{COPIES}_before")
    repeated = _refused(_key_text([f"__orderlake_key{i}" for i in range(len(keys))]))
    op = (
        F.when((copies > 1) | (copies_before > 1), repeated.cast("string"))
        .when(copies_before == 0, "I")
        .when(copies == 0, "D")
        .when(~F.col(NOW).eqNullSafe(F.col(BEFORE)), "U")
    )
    image = F.coalesce(F.col(NOW), F.col(BEFORE))
    return paired.select(op.alias("Op"), image.alias(NOW)).filter(F.col("Op").isNotNull()).select(f"{NOW}.*", "Op")


def _key_text(keys: Sequence[str]) -> Column:
    return F.concat_ws(", ", *(F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys))


def _refused(key: Column) -> Column:
    return F.raise_error(F.concat(F.lit("key is not unique in a snapshot: "), key))


def _first_rows(now: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row as an insert, unless a key is repeated."""
    repeated = repeated_keys(now, keys).agg(F.min(_key_text(keys))).scalar()
    op = F.when(repeated.isNotNull(), _refused(repeated).cast("string")).otherwise("I")
    return now.withColumn("Op", op)


def repeated_keys(snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row, and how many: what makes a keyed snapshot fail."""
    return snapshot.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def multiset_changes(net: DataFrame) -> DataFrame:
    """As many I (or D) rows as copies were gained (or lost); there is no U."""
    op = F.when(F.col(NET) > 0, "I").otherwise("D")
    return replicate(net.withColumn("Op", op), F.abs(NET)).drop(NET)


def with_change_headers(changes: DataFrame, snapshot_dt: str, batch_ts: str, part: tuple[int, int] = (0, 1)) -> DataFrame:
    """Append the log headers.

    ``cdc_seq`` is 15 digits of batch time and 20 digits that are unique in the batch,
    so as text every later batch sorts after every earlier one. The batch time is read
    as UTC here, not by the session, so no time zone setting can reorder batches.
    """
    moment = datetime.fromisoformat(batch_ts)
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    seconds = int(moment.timestamp())
    number, parts = part  # the ids of one part must not be those of another
    unique = F.lpad((F.monotonically_increasing_id() * parts + number).cast("string"), 20, "0")
    return changes.select(
        "*",
        F.concat(F.lit(f"{seconds:015d}"), unique).alias("cdc_seq"),
        F.timestamp_seconds(F.lit(seconds)).alias("cdc_commit_ts"),
        F.lit(snapshot_dt).alias("cdc_snapshot_dt"),
        F.current_timestamp().alias("cdc_processed_at"),
    )


def op_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("Op").agg(F.count(F.lit(1)).alias("n"))
