"""Context-triggered piecewise hashing: a short fingerprint of a text that stays alike where the text does.

A rolling hash over the last WINDOW bytes ends a chunk wherever its low ``level`` bits are zero, so borders
depend on what stands around them and not on what stands before. A chunk's letter comes from the sum of the rolling hashes
in it. ``level`` follows from the length, so that CHUNKS/2 to CHUNKS chunks are expected; all of them count, except that a chunk is listed
REPEATS times at most, as a line or table cell that comes again and again would drown the rest. The fingerprint holds the
letters at that level and at the next one, whose chunks are twice as long: ``level:letters:letters``.

Two fingerprints are compared at the levels that both have. Their likeness is 1 less their edit distance (insertions and
deletions) over the letters of both, and 0 where they share no run of RUN letters (of half the shorter one, if that is less),
since single letters agree by chance.

Defined results: a null text is empty, an empty text has the fingerprint ``0::``; equal texts have equal fingerprints and
equal fingerprints have likeness 1; a short text has a chunk for each byte. Texts are never cut: a task holds
two texts at a time, about 10 bytes for each of theirs. Columns beyond those named are not read; an empty
table gives an empty result.

``next_in_order`` puts each row beside the one that follows it. Rows are dealt to ranges of the order, each of which also gets the
first row of the range after it; what goes through the driver is one key for each range. Ties in doc_id are ordered by the text, nulls
come last, equal rows follow one another.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

WINDOW = 7
CHUNKS = 64
REPEATS = 2
RUN = 7

_LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_BASE = 0x01000193
_POWERS = [np.uint32(pow(_BASE, k, 1 << 32)) for k in range(WINDOW)]
_SPREAD = np.uint32(0x85EBCA6B)
_FOLD = np.uint64(0x9E3779B97F4A7C15)
#: Bytes hashed at a time, so that the arrays stay in the processor's cache.
_STRETCH = 1 << 16


def rolling(data: bytes, before: bytes = b"") -> np.ndarray:
    """A hash of the WINDOW bytes that end at each place of ``data``; ``before`` is what stands in front of it."""
    lead = before[-(WINDOW - 1) :].rjust(WINDOW - 1, b"\0")
    padded = np.frombuffer(lead + data, np.uint8)
    out = np.empty(len(data), np.uint32)
    for at in range(0, len(data), _STRETCH):
        c = padded[at : at + _STRETCH + WINDOW - 1].astype(np.uint32)
        two = c[1:] + c[:-1] * _POWERS[1]
        four = two[2:] + two[:-2] * _POWERS[2]
        h = four[3:] + two[1:-4] * _POWERS[4] + c[:-6] * _POWERS[6]
        h ^= h >> np.uint32(15)
        h *= _SPREAD
        h ^= h >> np.uint32(13)
        out[at : at + _STRETCH] = h
    return out


def _signature(hashes: np.ndarray, ends: np.ndarray) -> str:
    if not len(hashes):
        return ""
    starts = np.concatenate(([0], ends + 1))
    sums = np.add.reduceat(hashes, starts[starts < len(hashes)], dtype=np.uint64)
    order = np.argsort(sums, kind="stable")
    equal = sums[order]
    # among equal chunks, in order of the text, those that have REPEATS before them go
    again = np.zeros(len(sums), bool)
    again[order[REPEATS:]] = equal[REPEATS:] == equal[:-REPEATS]
    return _LETTERS[((sums[~again] * _FOLD) >> np.uint64(58)).astype(np.intp)].tobytes().decode()


def of_hashes(hashes: np.ndarray) -> str:
    """Fingerprint of a text from the rolling hash of its bytes."""
    level = (len(hashes) // CHUNKS).bit_length()
    ends = np.flatnonzero((hashes & np.uint32((1 << level) - 1)) == 0)
    longer = ends[(hashes[ends] & np.uint32((2 << level) - 1)) == 0]
    return f"{level}:{_signature(hashes, ends)}:{_signature(hashes, longer)}"


def fingerprint(text: str) -> str:
    return of_hashes(rolling(text.encode()))


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of the table as the bits of one number."""
    places: dict[str, int] = {}
    for i, letter in enumerate(a):
        places[letter] = places.get(letter, 0) | 1 << i
    whole = (1 << len(a)) - 1
    row = whole
    for letter in b:
        hit = row & places.get(letter, 0)
        row = (row + hit | row - hit) & whole
    return len(a) - row.bit_count()


def _alike(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    run = min(RUN, (min(len(a), len(b)) + 1) // 2)
    runs = {a[i : i + run] for i in range(len(a) - run + 1)}
    if not any(b[i : i + run] in runs for i in range(len(b) - run + 1)):
        return 0.0
    distance = len(a) + len(b) - 2 * _common(a, b)
    return 1.0 - distance / (len(a) + len(b))


def likeness(a: str, b: str) -> float:
    """0 to 1, the same in both directions."""
    if a == b:
        return 1.0
    (x, *ours), (y, *theirs) = a.split(":"), b.split(":")
    apart = int(y) - int(x)
    pairs = [(ours[i], theirs[i - apart]) for i in range(2) if 0 <= i - apart < 2]
    return max((_alike(one, other) for one, other in pairs), default=0.0)


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of ``text`` in a further column."""

    @F.pandas_udf("string")
    def of(texts):
        return texts.map(fingerprint)

    return docs.withColumn(name, of(F.coalesce(F.col(text), F.lit(""))))


def _place(doc_id: Column, text: Column) -> Column:
    """Text that sorts like doc_id descending, nulls last, then by a hash of the text."""
    falling = F.coalesce(doc_id.cast("long"), F.lit(0)).bitwiseXOR(F.lit(2**63 - 1))
    return F.concat(
        F.when(doc_id.isNull(), "1").otherwise("0"),
        F.lpad(F.hex(falling), 16, "0"), F.lpad(F.hex(F.xxhash64(text)), 16, "0"),
    )


def _first_places(keys: DataFrame, ranges: int) -> list[str]:
    """The first place of each of at most ``ranges`` ranges, ascending; all are places of rows."""
    dealt = keys.repartitionByRange(ranges, "place").groupBy(F.spark_partition_id().alias("range")).agg(F.min("place").alias("first"))
    return sorted(r["first"] for r in dealt.collect())


def next_in_order(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``range, closing, place, doc_id, text`` by descending doc_id, each range sorted in one partition.

    A ``closing`` row ends a range: it is the first row of the next one (of the first, after the last). Where several rows
    could be that one, all are there and the first counts.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("place", _place(F.col("doc_id"), F.col("text")))
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    firsts = _first_places(rows.select("place"), ranges)
    if not firsts:
        return rows.select(F.lit(0).alias("range"), F.lit(False).alias("closing"), "place", "doc_id", "text")
    # a search in two steps, each over about the root of the number of ranges
    step = math.isqrt(len(firsts)) + 1
    blocks = [firsts[i : i + step] for i in range(0, len(firsts), step)]
    place = F.col("place")

    def passed(list_of_places: Column) -> Column:
        return F.size(F.filter(list_of_places, lambda first: first <= place))

    block = passed(F.array(*(F.lit(b[0]) for b in blocks))) - 1
    table = F.array(*(F.array(*(F.lit(x) for x in b)) for b in blocks))
    found = rows.withColumn("block", block)
    found = found.withColumn("range", F.col("block") * step + passed(F.get(table, F.col("block"))) - 1)
    begins = F.get(F.get(table, F.col("block")), F.col("range") - F.col("block") * step) == place
    own = F.struct(F.col("range").alias("range"), F.lit(False).alias("closing"))
    before = F.struct(F.pmod(F.col("range") - 1, F.lit(len(firsts))).alias("range"), F.lit(True).alias("closing"))
    dealt = found.withColumn("to", F.explode(F.when(begins, F.array(own, before)).otherwise(F.array(own))))
    return (
        dealt.select("to.*", "place", "doc_id", "text")
        .repartition(len(firsts), "range")
        .sortWithinPartitions("range", "closing", "place", "text")
    )


def with_next(docs: DataFrame, columns: str, prepare: Callable[[str], Any], make: Callable[..., tuple]) -> DataFrame:
    """One row ``make(doc_id, text, prepared, text of the next, its prepared)`` for every row, with the given ``columns``.

    ``prepare`` is called once for each text.
    """
    ordered = next_in_order(docs)
    schema = ordered.sparkSession.createDataFrame([], columns).schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            out: list[tuple] = []
            fields = (batch.column(n).to_pylist() for n in ("range", "closing", "doc_id", "text"))
            for number, closing, doc_id, text in zip(*fields):
                expected = waiting and waiting[0] == number
                here = (text, prepare(text)) if expected or not closing else ()
                if expected:
                    out.append(make(*waiting[1:], *here))
                waiting = None if closing else (number, doc_id, *here)
            arrays = zip(*out) if out else [[]] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(a, f.type) for a, f in zip(arrays, arrow)], schema=arrow)

    return ordered.mapInArrow(run, schema)


EDITED_COLUMNS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _hashed(text: str) -> tuple[np.ndarray, str]:
    hashes = rolling(text.encode())
    return hashes, of_hashes(hashes)


def _edited(doc_id: int | None, text: str, own: tuple[np.ndarray, str], following: str, other: tuple[np.ndarray, str]) -> tuple:
    given = len(text) // 3
    start, end = text[: len(text) - given].encode(), following[:given].encode()
    # the edit leaves the hashes of all places before it as they are
    edited = of_hashes(np.concatenate((own[0][: len(start)], rolling(end, start))))
    digest = hashlib.sha256(start + end).hexdigest()
    return doc_id, len(text), digest, own[1], edited, likeness(own[1], edited), likeness(own[1], other[1])


def against_edits(docs: DataFrame) -> DataFrame:
    """EDITED_COLUMNS for every row: its text against itself with the last third replaced by the start of the next document, and against that one."""
    return with_next(docs, EDITED_COLUMNS, _hashed, _edited)
