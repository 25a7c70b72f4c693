"""Exact removal of byte strings that occur earlier, by merged Burrows-Wheeler transforms.

A string of ``length`` bytes that occurs twice has its anchor (see ``winnow``) at the same offset in
both places, so only places with an equal anchor are looked at together:

1. Anchors of all texts, with a hash of all bytes that a string with this anchor can cover. An
   occurrence whose surroundings occurred earlier is covered as a whole. Repetitions within a batch are settled
   before the shuffle, so copies and common passages send one row per batch.
2. Where an anchor has several different surroundings, the first occurrence of each is read
   from its text, and bundles of them are made into shard transforms and merged. Rows that share
   ``length`` bytes are neighbours; all but the earliest of them are covered.
3. An anchor with more surroundings than a bundle holds is dealt over several; the earliest
   string of each interval then meets those of the other bundles by its digest.

Defined results: a null or empty text has nothing to remove; a very long one is read whole, in chunks that overlap (see ``winnow``); a row is
its doc_id and text: equal rows are one document, different texts under one doc_id, or without one, are several and stand in
the order of their hashes; a null doc_id stands after all others; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bwt, winnow
from .common import durable, forget, release

LENGTH = 100
#: Surroundings in a bundle, and in each of its shards.
BUNDLE, SHARD = 8_000, 4_000
#: How finely agreement is probed when surroundings are trimmed.
STEP = 8
LAST = (1 << 63) - 1


def _first_of_each(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by ``keys``, and which rows begin a new value of the first two."""
    order = np.lexsort(keys[::-1])
    a, b = keys[0][order], keys[1][order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, fresh


def occurrences(docs: DataFrame, length: int) -> DataFrame:
    """``group`` (the anchor's hash), ``around, key, sub, at, covered``; within a batch all but the first of equal surroundings are covered."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        for frame in frames:
            texts = [(t or "").encode("utf-8", "replace") for t in frame["text"]]
            number, at, gram, around = winnow.anchors(texts, length)
            key, sub = (frame[c].to_numpy(np.int64)[number] for c in ("key", "sub"))
            order, fresh = _first_of_each(gram, around, key, sub, at)
            gram, around, key, sub, at = (x[order] for x in (gram, around, key, sub, at))
            first = np.maximum.accumulate(np.where(fresh, np.arange(len(fresh)), 0))
            again = ~fresh & ((key != key[first]) | (sub != sub[first]) | (at != at[first]))  # the same place of a repeated row is no repetition
            gram = np.where(again, gram ^ np.arange(len(gram), dtype=np.uint64), gram)  # spreads settled rows
            around = np.where(again, 0, around.view(np.int64))
            yield pd.DataFrame({"group": gram.view(np.int64), "around": around, "key": key, "sub": sub, "at": at.astype(np.int32), "covered": again})

    return docs.select("key", "sub", "text").mapInPandas(batches, "group long, around long, key long, sub long, at int, covered boolean")


def places(docs: DataFrame, length: int) -> DataFrame:
    """Per document: ``covered`` (anchors covered with all their surroundings) and ``open`` (anchor, place, its surroundings in number)."""
    found = occurrences(docs, length).repartition("group")  # one shuffle for both windows
    same = Window.partitionBy("group", "around").orderBy("key", "sub", "at")
    ranked = found.withColumn("rank", F.when(F.col("covered"), F.lit(2)).otherwise(F.rank().over(same)))
    group = Window.partitionBy("group")
    kinds = ranked.withColumn("kinds", F.sum((F.col("rank") == 1).cast("long")).over(group))
    told = kinds.filter((F.col("rank") > 1) | (F.col("kinds") > 1))
    return told.groupBy("key", "sub").agg(
        F.collect_list(F.when(F.col("rank") > 1, F.col("at"))).alias("covered"),
        F.collect_set(F.when(F.col("rank") == 1, F.struct("group", "at", "kinds"))).alias("open"),
    )


def surroundings(docs: DataFrame, found: DataFrame, length: int) -> DataFrame:
    """``gram, kinds, key, sub, start, anchor, bytes`` of every open anchor; ``anchor``: its place in ``bytes``."""
    reach = length - winnow.GRAM

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for key, sub, text, places in zip(frame["key"], frame["sub"], frame["text"], frame["open"]):
                data = (text or "").encode("utf-8", "replace")
                for place in places:
                    start = max(0, place["at"] - reach)
                    rows.append((place["group"], place["kinds"], key, sub, start, place["at"] - start, data[start : place["at"] + length]))
            yield pd.DataFrame(rows, columns=["gram", "kinds", "key", "sub", "start", "anchor", "bytes"])

    opened = found.filter(F.size("open") > 0).select(F.col("key").alias("__key"), F.col("sub").alias("__sub"), "open").hint("shuffle_hash")
    joined = docs.join(opened, (docs["key"] == opened["__key"]) & (docs["sub"] == opened["__sub"])).select("key", "sub", "text", "open")
    return joined.mapInPandas(batches, "gram long, kinds long, key long, sub long, start int, anchor int, bytes binary")


FOUND = "key long, sub long, start int, h1 long, h2 long, dealt boolean"


def _agreeing(pieces: Callable[[int, int], tuple | None], n: int, reach: int) -> list[int]:
    """Upper bound of how far each of ``n`` surroundings agrees with another one of its anchor, in one direction."""
    bound, alive, least = [0] * n, list(range(n)), 0
    for far in [*range(STEP, reach, STEP), reach]:
        keys = {i: k for i in alive if (k := pieces(i, far)) is not None}
        seen = Counter(keys.values())
        for i in alive:
            bound[i] = far - 1
        alive = [i for i, k in keys.items() if seen[k] > 1]
        if not alive:
            return bound
    for i in alive:
        bound[i] = reach
    return bound


def trimmed(frame: pd.DataFrame, length: int) -> pd.DataFrame:
    """Surroundings cut to what can be in a repeated string, without those that have none.

    Not those dealt over several bundles, whose equals may be elsewhere.
    """
    data, anchor, gram, dealt = (frame[c].tolist() for c in ("bytes", "anchor", "gram", "dealt"))
    reach, n = length - winnow.GRAM, len(frame)

    def left(i: int, far: int) -> tuple | None:
        return (gram[i], data[i][anchor[i] - far : anchor[i]]) if far <= anchor[i] else None

    def right(i: int, far: int) -> tuple | None:
        end = anchor[i] + winnow.GRAM + far
        return (gram[i], data[i][anchor[i] : end]) if end <= len(data[i]) else None

    rows = []
    for i, (before, after) in enumerate(zip(_agreeing(left, n, reach), _agreeing(right, n, reach))):
        low, high = max(0, anchor[i] - before), anchor[i] + winnow.GRAM + after
        if dealt[i]:
            rows.append((i, 0, data[i]))
        elif before + after >= reach:
            rows.append((i, low, data[i][low:high]))
    kept = frame.iloc[[r[0] for r in rows]][["key", "sub", "start", "dealt"]].reset_index(drop=True)
    kept["start"] += np.array([r[1] for r in rows], kept["start"].dtype)
    kept["bytes"] = [r[2] for r in rows]
    return kept


def repeats_in_bundle(frame: pd.DataFrame, length: int, shard_size: int) -> pd.DataFrame:
    """Starts of covered strings (``dealt`` false); where the anchor is dealt over bundles, also digests of the earliest ones."""
    frame = trimmed(frame, length).sort_values(["key", "sub", "start", "bytes"], ignore_index=True)
    if frame.empty:
        return pd.DataFrame({"key": [], "sub": [], "start": [], "h1": [], "h2": [], "dealt": []})
    strings = frame["bytes"].tolist()
    parts = [bwt.shard(strings[i : i + shard_size]) for i in range(0, len(strings), shard_size)]
    merged = bwt.merge_all(parts, length)
    rows, interval = bwt.repeated(merged, length)
    lengths = np.array([len(s) + 1 for s in strings])
    first = np.cumsum(lengths) - lengths
    string = np.searchsorted(first, rows, "right") - 1
    key, sub = (frame[c].to_numpy(np.int64)[string] for c in ("key", "sub"))
    start = frame["start"].to_numpy(np.int64)[string] + rows - first[string]
    order = np.lexsort((start, sub, key, interval))
    interval, key, sub, start, rows, string = (x[order] for x in (interval, key, sub, start, rows, string))
    head = np.ones(len(order), bool)
    head[1:] = interval[1:] != interval[:-1]
    earliest = np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))
    covered = (key != key[earliest]) | (sub != sub[earliest]) | (start != start[earliest])
    out = pd.DataFrame({"key": key[covered], "sub": sub[covered], "start": start[covered], "h1": 0, "h2": 0, "dealt": False})
    if not frame["dealt"].any():
        return out
    top = np.flatnonzero(head & frame["dealt"].to_numpy(bool)[string])
    digests = [hashlib.blake2b(strings[s][r : r + length], digest_size=16).digest() for s, r in zip(string[top], rows[top] - first[string[top]])]
    halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    dealt = pd.DataFrame({"key": key[top], "sub": sub[top], "start": start[top], "h1": halves[:, 0], "h2": halves[:, 1], "dealt": True})
    return pd.concat([out, dealt], ignore_index=True)


def repeated_strings(around: DataFrame, length: int, bundle: int = BUNDLE, shard_size: int = SHARD) -> DataFrame:
    """``key, sub, start`` of strings that occur earlier, among the open surroundings."""
    total = around.count()
    bundles = max(1, -(-total // bundle))
    dealt = F.col("kinds") > bundle
    whole = F.pmod(F.xxhash64("gram"), F.lit(bundles))
    part = F.pmod(F.xxhash64("gram", F.pmod(F.xxhash64("key", "sub", "start"), F.ceil(F.col("kinds") / bundle))), F.lit(bundles * 16)) + bundles
    placed = around.withColumn("dealt", dealt).withColumn("bundle", F.when(dealt, part).otherwise(whole))
    found = placed.groupBy("bundle").applyInPandas(lambda frame: repeats_in_bundle(frame, length, shard_size), FOUND)
    if around.filter(dealt).isEmpty():
        return found.select("key", "sub", "start")
    found = durable(found)
    across = found.filter("dealt")
    earliest = across.groupBy("h1", "h2").agg(F.min(F.struct("key", "sub", "start")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    later = across.join(earliest, ["h1", "h2"]).filter(F.struct("key", "sub", "start") != F.col("first"))
    return found.filter("NOT dealt").select("key", "sub", "start").unionByName(later.select("key", "sub", "start"))


def spans(covered: list[int], starts: list[int], size: int, length: int) -> list[tuple[int, int]]:
    """Maximal runs of removed bytes: all around the covered anchors, and ``length`` bytes from each start."""
    reach = length - winnow.GRAM
    pieces = sorted([(max(0, at - reach), min(size, at + length)) for at in covered] + [(s, s + length) for s in starts])
    runs: list[tuple[int, int]] = []
    for low, high in pieces:
        if runs and low <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], high))
        else:
            runs.append((low, high))
    return runs


def marked(docs: DataFrame, length: int = LENGTH, bundle: int = BUNDLE, shard_size: int = SHARD) -> DataFrame:
    """``docs`` with ``__covered`` and ``__starts``, from which ``spans`` makes the removed runs of a row."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    # where every doc_id has one text alone, the doc_id says it all
    texts = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("low"), F.max(F.xxhash64("text")).alias("high"))
    sub = F.lit(0).cast("long") if texts.filter("low <> high").isEmpty() else F.xxhash64("text")
    # a null doc_id is no doc_id, not even the largest
    sub = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(sub)
    narrow = docs.select(key.alias("key"), sub.alias("sub"), "text")
    found = durable(places(narrow, length))
    release(docs.sparkSession)
    around = durable(surroundings(narrow, found, length))
    release(docs.sparkSession)
    starts = repeated_strings(around, length, bundle, shard_size).groupBy("key", "sub").agg(F.collect_set("start").alias("__starts"))
    told = found.select("key", "sub", F.col("covered").alias("__covered")).join(starts, ["key", "sub"], "full")
    told = told.withColumnsRenamed({"key": "__key", "sub": "__sub"})
    return docs.join(told.hint("shuffle_hash"), (key == F.col("__key")) & (sub == F.col("__sub")), "left").drop("__key", "__sub")


def remaining(text: str | None, covered, starts, length: int = LENGTH) -> tuple[bytes, bytes, list[tuple[int, int]]]:
    """The text's bytes, what is left of them, and the removed runs."""
    data = (text or "").encode("utf-8", "replace")
    runs = spans([] if covered is None else list(covered), [] if starts is None else list(starts), len(data), length)
    left, at = [], 0
    for low, high in runs:
        left.append(data[at:low])
        at = high
    return data, b"".join([*left, data[at:]]), runs


def digest(docs: DataFrame, length: int = LENGTH, **sizes: int) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of each row of ``docs`` (doc_id, text)."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for doc_id, text, covered, starts in zip(frame["doc_id"], frame["text"], frame["__covered"], frame["__starts"]):
                data, left, runs = remaining(text, covered, starts, length)
                rows.append((doc_id, len(data), len(data) - len(left), len(runs), hashlib.sha256(left).hexdigest()))
            yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    found = marked(docs.select("doc_id", "text"), length, **sizes).withColumn("doc_id", F.col("doc_id").cast("string"))
    out = found.mapInPandas(batches, "doc_id string, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def without_repeats(docs: DataFrame, length: int = LENGTH, **sizes: int) -> DataFrame:
    """``docs`` with repeated strings cut out of ``text`` and ``n_chars`` counted anew where it exists.

    Bytes that no longer form a character after a cut are dropped. A text of which nothing is left stays as an empty one.
    """

    @F.pandas_udf("string")
    def cut(text: pd.Series, covered: pd.Series, starts: pd.Series) -> pd.Series:
        return pd.Series([
            t if c is None and s is None else remaining(t, c, s, length)[1].decode("utf-8", "ignore") for t, c, s in zip(text, covered, starts)
        ], dtype=object)

    found = marked(docs, length, **sizes)
    found = found.withColumn("text", F.when(F.col("__covered").isNull() & F.col("__starts").isNull(), F.col("text")).otherwise(cut("text", "__covered", "__starts")))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found.select(*docs.columns)
