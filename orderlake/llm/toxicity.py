"""Toxicity by logistic regression with FTRL-proximal steps over hashed words, word pairs and skip-grams.

Training takes a bounded sample of labelled rows in shards. Each shard makes its pass from the shared
state and the states are averaged between rounds. Every coordinate has its own rate, and the L1 term leaves most weights
at exactly zero, so the model that goes to the tasks is a sparse vector of bounded size. Scoring reads each whole text once.

Defined results: a null or empty text gets the score of the bias alone; a very long one is scored by all its words, each feature once; a row without doc_id or
label teaches nothing; several labels of one doc_id count as toxic if one of them says so; without training
rows every score is 0.5 less a hair, so nothing is predicted toxic; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, release
from .language import FOLD, held_out

#: Size of the hashed space; its first coordinate is the bias.
DIMENSIONS = 1 << 20
#: Labelled rows learned from: the documented bound of the sample.
MAX_ROWS = 20_000
SHARDS, ROUNDS = 4, 5
#: A word also counts by its first bytes, so that its inflections and compounds learn together.
STEM = 5
# rates and penalties of the updates
ALPHA, BETA, L1, L2 = 2.0, 1.0, 4.0, 0.003
HELD_OUT = 5, 0


def features(text: str | None) -> np.ndarray:
    """Coordinates of a text's words, their stems, neighbours and words one apart, repeats included."""
    words = FOLD[np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)].tobytes().split()
    one = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))

    def mixed(a: np.ndarray, b: np.ndarray, kind: int) -> np.ndarray:
        x = (a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(kind)) * np.uint64(0xFF51AFD7ED558CCD)
        return (x >> np.uint64(32)) % np.uint64(DIMENSIONS - 1) + np.uint64(1)

    zero = np.zeros_like(one)
    stem = np.fromiter((zlib.crc32(w[:STEM]) for w in words), np.uint64, len(words))
    parts = [mixed(one, zero, 1), mixed(stem, zero, 4), mixed(one[:-1], one[1:], 2), mixed(one[:-2], one[2:], 3)]
    return np.concatenate(parts).astype(np.int64)


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The sparse weights that a state stands for."""
    small = np.abs(z) <= L1
    return np.where(small, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))


def pass_over(rows: list[tuple[np.ndarray, int]], z: np.ndarray, n: np.ndarray) -> None:
    """One pass in the given order; ``z`` and ``n`` are moved."""
    for at, label in rows:
        w = weights(z[at], n[at])
        g = sigmoid(float(w.sum())) - label
        old = n[at]
        new = old + g * g
        z[at] += g - (np.sqrt(new) - np.sqrt(old)) / ALPHA * w
        n[at] = new


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """``text, toxic`` of at most about ``max_rows`` labelled rows outside the held-out part, by a hash of doc_id."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.filter(~held_out(F.col("doc_id"), *HELD_OUT))
    share = min(1.0, max_rows / max(1, known.count()))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_000)) < int(share * 1_000_000))
    chosen = chosen.withColumnRenamed("doc_id", "__id")
    # the sample's bound makes it small enough to send to every task
    return docs.join(F.broadcast(chosen), docs["doc_id"] == chosen["__id"]).select("text", "toxic", "__id")


def learn(rows: DataFrame) -> np.ndarray:
    """Dense view of the sparse weights."""
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("__id"), F.lit(SHARDS))).repartition(SHARDS, "shard").sortWithinPartitions("shard", F.xxhash64("__id", F.lit(1)))
    # a stored partition is a shard: the rounds read it where it is and shuffle nothing
    vectors = durable(dealt.mapInPandas(_vectors, "coordinates binary, toxic int"))
    z, n = np.zeros(DIMENSIONS, np.float32), np.zeros(DIMENSIONS, np.float32)
    for _ in range(ROUNDS):
        states = vectors.mapInPandas(_shard_pass(z, n), "z binary, n binary").collect()  # at most SHARDS rows of a fixed size
        if not states:
            break
        z, n = (sum(np.frombuffer(s[part], np.float32) for s in states) / np.float32(len(states)) for part in ("z", "n"))
        release(rows.sparkSession)  # or the states of all rounds stay on every executor's disk
    return weights(z.astype(float), n.astype(float))


def _shard_pass(start_z: np.ndarray, start_n: np.ndarray):
    """Each partition's own pass from the shared state."""

    def train(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        z, n = start_z.astype(float), start_n.astype(float)
        trained = False
        for frame in frames:
            trained = trained or len(frame) > 0
            pass_over([(np.frombuffer(c, np.int32), y) for c, y in zip(frame["coordinates"], frame["toxic"])], z, n)
        if trained:
            yield pd.DataFrame([[z.astype(np.float32).tobytes(), n.astype(np.float32).tobytes()]], columns=["z", "n"])

    return train


def _vectors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        found = [np.append(0, np.unique(features(t))).astype(np.int32).tobytes() for t in frame["text"]]
        yield pd.DataFrame({"coordinates": found, "toxic": frame["toxic"]})


def score(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs`` (doc_id, text)."""
    at = np.flatnonzero(model)
    sparse = (at.astype(np.int32), model[at].astype(np.float32))
    bias = float(model[0]) if len(at) else -1e-9

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        dense = np.zeros(DIMENSIONS, np.float32)
        dense[sparse[0]] = sparse[1]
        dense[0] = 0
        for frame in frames:
            scores = []
            for text in frame["text"]:
                found = features(text)
                found = np.unique(found[dense[found] != 0])
                scores.append(sigmoid(bias + float(dense[found].sum())))
            scores = np.array(scores, float)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "held_out": frame["held_out"], "score": scores, "predicted": (scores >= 0.5).astype(np.int32)})

    narrow = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text", held_out(F.col("doc_id"), *HELD_OUT).alias("held_out"))
    found = narrow.mapInPandas(batches, "doc_id string, held_out boolean, score double, predicted int")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))
