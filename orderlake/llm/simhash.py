"""SimHash near-duplicates by a self-join of the binary trie of fingerprints.

Equal fingerprints are folded first, so a group of copies is one leaf however large it is. The trie
is walked in pairs of nodes: a pair holds the fingerprints under two prefixes that differ in
``spent`` bits, and is dropped as soon as that exceeds the budget or one side is empty. The upper levels are walked
as a table, a few bits at a time, and only where a pair still holds too many
fingerprints for one task; the rest of each pair is walked inside a task on sorted arrays. A
task reports a spanning forest of the links that it finds, which joins the same fingerprints as all links do.

Defined results: a null or empty text has fingerprint zero, linked like any other; a very long text has one fingerprint of all its shingles; a null
doc_id is never the smallest unless its whole component has none; equal rows get equal results; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, forget
from .components import components

BITS, BUDGET, SHINGLE, SEED = 64, 2, 3, 42
#: Bits of the first step from the root and of each further step.
FIRST_BITS, STEP_BITS = 6, 4
#: Fingerprints of a node pair that one task walks by itself.
TASK_PAIR = 100_000
#: Pairs of so few leaves are compared directly; so many node pairs are held at once.
LEAF_PAIRS, NODE_CHUNK = 64, 200_000


def shingle_hashes(text: str | None) -> np.ndarray:
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: only A-Z and ASCII white space
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE))))
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(words) - SHINGLE + 1)


def fingerprint(text: str | None, block: int = 1 << 16) -> int:
    """64 majority votes over the hashes of a text's shingles, as an unsigned number."""
    hashes = shingle_hashes(text)
    votes = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), block):
        part = hashes[start : start + block]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, content, fp`` (a hash of the text, and the fingerprint's bits as a bigint) of each row of ``docs`` (doc_id, text)."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        for frame in frames:
            prints = np.fromiter(map(fingerprint, frame["text"]), np.uint64, len(frame))
            yield pd.DataFrame({"doc_id": frame["doc_id"], "content": frame["content"], "fp": prints.view(np.int64)})

    # doc_id goes through as text: a null stays a null, and no id is rounded to a float
    narrow = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.xxhash64("text").alias("content"), "text")
    return narrow.mapInPandas(batches, "doc_id string, content long, fp long").select(F.col("doc_id").cast("long").alias("doc_id"), "content", "fp")


def _split(values: np.ndarray, first: np.ndarray, last: np.ndarray, bit: int) -> np.ndarray:
    """Where, in each sorted range, the values with ``bit`` set begin."""
    upper = np.uint64(((1 << BITS) - 1) ^ ((1 << (bit + 1)) - 1))
    return np.clip(np.searchsorted(values, (values[first] & upper) | np.uint64(1 << bit)), first, last)


def near_pairs(a: np.ndarray, b: np.ndarray, depth: int, spent: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices of pairs within the budget, walking two sorted subtrees together."""
    stack = [(depth, np.array([[0, len(a), 0, len(b), spent]], np.int64))]
    while stack:
        depth, nodes = stack.pop()
        if len(nodes) > NODE_CHUNK:
            half = len(nodes) // 2
            stack += [(depth, nodes[:half]), (depth, nodes[half:])]
            continue
        small = ((nodes[:, 1] - nodes[:, 0]) * (nodes[:, 3] - nodes[:, 2]) <= LEAF_PAIRS) | (depth == BITS)
        if small.any():
            a0, a1, b0, b1, _ = nodes[small].T
            wide, pairs = b1 - b0, (a1 - a0) * (b1 - b0)
            number = np.arange(pairs.sum()) - np.repeat(np.cumsum(pairs) - pairs, pairs)
            wide = np.repeat(wide, pairs)
            i, j = np.repeat(a0, pairs) + number // wide, np.repeat(b0, pairs) + number % wide
            near = np.bitwise_count(a[i] ^ b[j]) <= BUDGET
            near &= (i < j) | (not same)
            yield i[near], j[near]
        nodes = nodes[~small]
        if not len(nodes):
            continue
        a0, a1, b0, b1, e = nodes.T
        am, bm = _split(a, a0, a1, BITS - 1 - depth), _split(b, b0, b1, BITS - 1 - depth)
        below = np.concatenate([
            np.stack(x, 1)
            for x in ((a0, am, b0, bm, e), (am, a1, bm, b1, e), (a0, am, bm, b1, e + 1), (am, a1, b0, bm, e + 1))
        ])
        live = (below[:, 0] < below[:, 1]) & (below[:, 2] < below[:, 3]) & (below[:, 4] <= BUDGET)
        if same:
            live &= below[:, 0] <= below[:, 2]  # the mirrored half of a node with itself
        stack.append((depth + 1, below[live]))


def forest(pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """The pairs that join two trees, one after the other."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    kept = []
    for left, right in pairs:
        for x, y in zip(left.tolist(), right.tolist()):
            rx, ry = root(x), root(y)
            if rx != ry:
                parent[max(rx, ry)] = min(rx, ry)
                kept.append((x, y))
    return kept


def _masks(bits: int) -> list[tuple[int, int]]:
    """Differences of at most ``BUDGET`` bits, with their weight."""
    return [(m, m.bit_count()) for m in range(1 << bits) if m.bit_count() <= BUDGET]


def _descend(rows: DataFrame, depth: int, bits: int) -> DataFrame:
    """Every fingerprint under each pair of its children that the budget allows; lo <= hi are prefixes."""
    steps = F.array(*(F.struct(F.lit(m).cast("long").alias("mask"), F.lit(w).alias("weight")) for m, w in _masks(bits)))
    left = BITS - depth - bits  # bits still below
    child = F.shiftrightunsigned("fp", left).bitwiseAND((1 << bits) - 1)
    rows = rows.withColumn("child", child).withColumn("step", F.explode(steps))
    rows = rows.filter(F.col("spent") + F.col("step.weight") <= BUDGET)
    own, other = F.col("child"), F.col("child").bitwiseXOR(F.col("step.mask"))
    lo, hi = F.shiftleft("lo", bits), F.shiftleft("hi", bits)
    same = F.col("lo") == F.col("hi")
    return rows.select(
        "fp",
        F.when(same, lo + F.least(own, other)).when(F.col("low_side"), lo + own).otherwise(lo + other).alias("lo"),
        F.when(same, hi + F.greatest(own, other)).when(F.col("low_side"), hi + other).otherwise(hi + own).alias("hi"),
        F.when(same, own <= other).otherwise(F.col("low_side")).alias("low_side"),
        (F.col("spent") + F.col("step.weight")).alias("spent"),
    )


def trie_links(prints: DataFrame, task_pair: int = TASK_PAIR) -> DataFrame:
    """Links ``u, v`` that join all fingerprints (distinct ``fp``) within the budget of each other."""

    def walk_from(depth: int):
        return lambda frame: walk(frame, depth)

    def walk(frame: pd.DataFrame, depth: int) -> pd.DataFrame:
        values, low = frame["fp"].to_numpy(np.int64).view(np.uint64), frame["low_side"].to_numpy(bool)
        same = frame["lo"].iat[0] == frame["hi"].iat[0]
        a = np.sort(values[low])
        b = a if same else np.sort(values[~low])
        nodes = a if same else np.concatenate([a, b])
        shift = 0 if same else len(a)
        found = forest((i, j + shift) for i, j in near_pairs(a, b, depth, int(frame["spent"].iat[0]), same))
        ends = np.array(found, np.int64).reshape(-1, 2)
        return pd.DataFrame({"u": nodes[ends[:, 0]].view(np.int64), "v": nodes[ends[:, 1]].view(np.int64)})

    rows = prints.select(
        "fp", F.lit(0).cast("long").alias("lo"), F.lit(0).cast("long").alias("hi"), F.lit(True).alias("low_side"), F.lit(0).alias("spent")
    )
    links, depth, bits = None, 0, FIRST_BITS
    while True:
        rows = _descend(rows, depth, bits)
        depth += bits
        sides = rows.groupBy("lo", "hi").agg(
            F.sum(F.col("low_side").cast("long")).alias("low"), F.sum((~F.col("low_side")).cast("long")).alias("high")
        )
        live = sides.filter(((F.col("lo") == F.col("hi")) & (F.col("low") > 1)) | ((F.col("low") > 0) & (F.col("high") > 0)))
        live = durable(live.withColumn("large", F.col("low") + F.col("high") > task_pair))
        more = depth < BITS and not live.filter("large").isEmpty()
        pairs = rows.join(live.select("lo", "hi", "large"), ["lo", "hi"])
        done = pairs.filter(~F.col("large")) if more else pairs
        found = done.groupBy("lo", "hi").applyInPandas(walk_from(depth), "u long, v long")
        links = found if links is None else links.unionByName(found)
        if not more:
            return links
        rows = durable(pairs.filter("large").drop("large"))
        bits = min(STEP_BITS, BITS - depth)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fp, component_id`` for each row of ``docs`` (doc_id, text)."""
    return _rooted(docs).select("doc_id", "fp", "component_id")


def _rooted(docs: DataFrame) -> DataFrame:
    """``doc_id, content, fp, root, component_id``; ``root`` names the component, also where no row of it has a doc_id."""
    prints = durable(fingerprints(docs))
    leaves = durable(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(trie_links(leaves.select("fp")))
    rooted = leaves.join(roots, leaves["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return prints.join(rooted.join(smallest, "root").select("fp", "root", "component_id"), "fp")


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row of each component, that with the smallest doc_id, with the columns it came with.

    A row is its doc_id and text: of different texts under the smallest doc_id of a component, or without any, that with the
    smallest hash stays, and of equal rows one.
    """
    content = F.xxhash64("text")
    found = _rooted(docs.select("doc_id", "text"))
    rows = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root", "doc_id", "content").agg(F.count("*").alias("rows"))
    first = rows.groupBy("root", F.col("doc_id").alias("__keep")).agg(F.min(F.struct("content", "rows")).alias("first"))
    stay = durable(first.select("__keep", F.col("first.content").alias("__content"), F.col("first.rows").alias("__rows")))
    kept = docs.join(stay.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(stay["__keep"]) & (content == stay["__content"]))
    if stay.filter("__rows > 1").isEmpty():
        return kept.select(*docs.columns)
    once = kept.filter("__rows = 1").select(*docs.columns)
    return once.unionByName(kept.filter("__rows > 1").select(*docs.columns, "__content").dropDuplicates(["doc_id", "__content"]).select(*docs.columns))
