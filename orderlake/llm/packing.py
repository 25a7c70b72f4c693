"""Best-fit packing of token sequences by exact complements.

Only lengths decide how sequences are filled, and there are at most ``capacity`` different
ones. So the plan is made from a histogram: single lengths, pair sums and triple sums are looked up for the exact
complement of the longest length left, and each hit is taken as often as its counts allow; what has no
exact complement is placed best fit, also in bulk. The plan has a few thousand ranges however many documents there
are. Pieces are numbered within their length in Spark, salted so that no length is one
task's work, and find their range by binary search.

Defined results: a null or empty text is one piece that holds the end token alone; a very long one is as many full pieces as it fills and one for the rest; each of several equal
rows is packed by itself; a null doc_id is packed like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .common import durable

CAPACITY = 2048
END = (0).to_bytes(4, "little")
#: Parts into which the pieces of one length are dealt for numbering.
SALTS = 1024

PIECES = "doc_id string, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: each text's ids and the end token, cut only beyond ``capacity``."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = tokens.load(tokenizer_path)
        for frame in frames:
            rows = []
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                ids = encoder.text(text or "") + END
                n = len(ids) // 4
                rows += [
                    (doc_id, at // capacity, at, min(capacity, n - at), zlib.crc32(ids[4 * at : 4 * (at + capacity)]))
                    for at in range(0, n, capacity)
                ]
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    narrow = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return narrow.mapInPandas(batches, PIECES).withColumn("doc_id", F.col("doc_id").cast("long"))


def _exact(left: np.ndarray, gap: int) -> tuple[int, ...] | None:
    """One, two or three lengths that are left and fill ``gap`` exactly, the longest first."""
    if left[gap]:
        return (gap,)
    have = np.flatnonzero(left[:gap])
    other = gap - have
    pair = (have <= other) & (left[other] > (have == other))
    if pair.any():
        small = int(have[pair][0])
        return (gap - small, small)
    for a in have[::-1].tolist():
        rest = gap - a
        b = have[have < rest]
        c = rest - b
        # each of the three must be there as often as it is used
        uses_b = 1 + (b == a) + (b == c)
        uses_c = 1 + (c == a) + (c == b)
        triple = (b <= c) & (c <= a) & (left[b] >= uses_b) & (left[c] >= uses_c)
        if triple.any():
            second = int(c[triple][-1])
            return (a, second, rest - second)
    return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Fillings with how often each is used; every piece of the histogram is in one."""
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    made: list[tuple[tuple[int, ...], int]] = []
    hopeless: list[tuple[int, int]] = []
    for length in range(capacity, 0, -1):
        while left[length]:
            left[length] -= 1  # the piece itself is not its own complement
            rest = _exact(left, capacity - length) if length < capacity else ()
            left[length] += 1
            if rest is None:
                hopeless.append((length, int(left[length])))
                left[length] = 0
                break
            filling = (length, *rest)
            times = min(int(left[x]) // n for x, n in Counter(filling).items())
            for x in filling:
                left[x] -= times
            made.append((filling, times))
    # best fit, longest first: open fillings by the gap that is left
    gaps: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for length, count in hopeless:
        while count:
            gap = min((g for g in gaps if g >= length), default=None)
            if gap is None:
                each = min(capacity // length, count)  # as many of one kind as a new sequence takes
                times = count // each
                filling, gap_left = (length,) * each, capacity - length * each
            else:
                filling, times = gaps[gap].pop()
                if times > count:
                    gaps[gap].append((filling, times - count))
                    times = count
                if not gaps[gap]:
                    del gaps[gap]
                filling, gap_left, each = (*filling, length), gap - length, 1
            count -= times * each
            if gap_left:
                gaps[gap_left].append((filling, times))
            else:
                made.append((filling, times))
    return made + [x for group in gaps.values() for x in group]


def slots(made: list[tuple[tuple[int, ...], int]], capacity: int = CAPACITY) -> pd.DataFrame:
    """Ranges of (length, number within length) with the sequence and offset of their first piece."""
    used: Counter[int] = Counter()
    rows, sequence = [], 0
    for filling, times in made:
        offset = 0
        for length in filling:
            rows.append((length, used[length], sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    frame = pd.DataFrame(rows, columns=["length", "number", "sequence", "offset"], dtype="int64")
    return frame.sort_values(["length", "number"], ignore_index=True)


def numbered(found: DataFrame) -> DataFrame:
    """``number``: 0, 1, ... within each length, by salt, doc_id and piece."""
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SALTS)))
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    first = sizes.select("length", "salt", F.coalesce(before, F.lit(0)).alias("first"))
    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece"))
    return salted.withColumn("within", within).join(first, ["length", "salt"]).withColumn("number", F.col("first") + F.col("within") - 1)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; see the module."""
    found = durable(pieces(docs, tokenizer_path, capacity))
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    ranges = slots(plan(counts, capacity), capacity)
    length, number = ranges["length"].to_numpy(), ranges["number"].to_numpy()
    sequence, offset = ranges["sequence"].to_numpy(), ranges["offset"].to_numpy()
    of_length = np.searchsorted(length, np.arange(capacity + 2))

    def placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = frame[["doc_id", "piece", "start", "length", "ids_crc32"]].copy()
            at = np.empty(len(frame), np.int64)
            for size, group in frame.groupby("length").groups.items():
                low, high = of_length[size], of_length[size + 1]
                at[group] = low + np.searchsorted(number[low:high], frame["number"].to_numpy()[group], "right") - 1
            out["sequence_id"] = sequence[at] + frame["number"].to_numpy() - number[at]
            out["offset"] = offset[at]
            yield out

    rows = numbered(found).withColumn("doc_id", F.col("doc_id").cast("string"))
    placed_rows = rows.select("doc_id", "piece", "start", "length", "ids_crc32", "number").mapInPandas(
        placed, PIECES + ", sequence_id long, offset long"
    )
    return placed_rows.withColumn("doc_id", F.col("doc_id").cast("long"))
