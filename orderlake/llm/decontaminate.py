"""Benchmark decontamination by latent semantic retrieval.

Benchmark texts are cut into passages, taken in blocks of a fixed size. A block's terms are weighted by
their document frequency over the whole corpus, and a randomised SVD of its TF-IDF matrix,
whose products are summed over partitions, gives the latent space, with a direction for each passage. Every
document is then read in overlapping windows, about as wide as the passage, each window is projected and compared with all passages of the block, and
all candidates by cosine, or by how much of the passage's weight they hold, whose own words are enough, are checked word by word: a longest common subsequence that covers the
passage, or half of it with the passage's last sentence (the answer) intact.

Documents are never joined with each other or shuffled. What is shipped to the tasks is bounded
by the block size: its terms, their latent vectors and its words.

Defined results: a null or empty text is clean, and so is everything under an empty
benchmark; benchmark rows without words are skipped; each of several equal rows is judged by
itself; a text of any length is searched whole, ``CHUNK`` steps at a time; of an item's passages and a passage's windows the one
that covers most is told, ties by cosine; other columns pass untouched.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import cached_property
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of a benchmark passage and of the widest document window, and how far apart they start.
PASSAGE, PASSAGE_STEP = 64, 32
WINDOW, WINDOW_STEP = 64, 16
#: Longest passage, in words, that windows of so many steps are compared with: a short one would drown in a wide window.
WIDTHS = ((16, 2), (32, 3), (PASSAGE, WINDOW // WINDOW_STEP))
#: Steps whose windows are projected at once.
CHUNK = 2048
#: Passages compared in one reading of the documents. The space has a direction for each, or those beyond its rank would be lost.
BLOCK = 512
#: Candidates whose words are counted at once.
SPANS = 4096
OVERSAMPLE, POWER = 16, 2
COSINE = 0.35
#: A window that holds so much of a passage's weight is a candidate too, whatever else stands in it.
HELD = 0.7
SAME, PARAPHRASE = 0.8, 0.5
#: Rows in which the partial products of the SVD are summed.
PARTS = 64


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def answer_of(words: list[bytes]) -> list[bytes]:
    """The last sentence, or the last five words where that is shorter than three."""
    ends = [i for i, w in enumerate(words[:-1]) if w.endswith((b".", b"!", b"?"))]
    last = words[ends[-1] + 1 :] if ends else words
    return last if 3 <= len(last) <= len(words) // 2 else words[-5:]


def places(a: list) -> dict:
    """The places of each word in ``a``, as bits of a number."""
    where: dict = {}
    for i, w in enumerate(a):
        where[w] = where.get(w, 0) | (1 << i)
    return where


def lcs(a: list, b: list, where: dict | None = None) -> int:
    """Length of the longest common subsequence, a machine word of ``a`` at a time; ``where``: ``places(a)``."""
    where = places(a) if where is None else where
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        hit = row & where.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _contains(words: list, part: list) -> bool:
    n = len(part)
    return any(words[i] == part[0] and words[i : i + n] == part for i in range(len(words) - n + 1))


def passages(benchmark: DataFrame) -> Iterator[tuple[int, list[bytes]]]:
    """(item_id, words) of every passage, one partition of the benchmark at a time."""
    for row in benchmark.select("item_id", "text").toLocalIterator():
        words = words_of(row["text"])
        for start in range(0, max(1, len(words) - PASSAGE + PASSAGE_STEP), PASSAGE_STEP):
            if part := words[start : start + PASSAGE]:
                yield row["item_id"], part


def document_frequencies(docs: DataFrame, terms: dict[bytes, int]) -> tuple[np.ndarray, int]:
    """In how many documents each term is, and the number of documents; counted over all of them."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, rows = np.zeros(len(terms), np.int64), 0
        known = set(terms)
        for frame in frames:
            rows += len(frame)
            for text in frame["text"]:
                for term in known.intersection(words_of(text)):
                    seen[terms[term]] += 1
        yield pd.DataFrame({"term": np.append(np.flatnonzero(seen), -1), "n": np.append(seen[seen > 0], rows)})

    total = docs.select("text").mapInPandas(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts, rows = np.zeros(len(terms), np.int64), 0
    for r in total:
        if r["term"] < 0:
            rows = r["n"]
        else:
            counts[r["term"]] = r["n"]
    return counts, rows


def vector(words: list[bytes], terms: dict[bytes, int], weight: np.ndarray) -> tuple[list[int], list[float]]:
    tf = Counter(terms[w] for w in words if w in terms)
    return list(tf), [float((1 + math.log(n)) * weight[t]) for t, n in tf.items()]


def latent_space(spark: SparkSession, vectors: list[tuple[list[int], list[float]]], n_terms: int, rank: int) -> np.ndarray:
    """Term vectors (n_terms, rank) of a randomised SVD; each product is summed over the partitions of the passages."""
    table = pa.table({"terms": pa.array([t for t, _ in vectors], pa.list_(pa.int32())), "weights": pa.array([w for _, w in vectors], pa.list_(pa.float64()))})
    rows = spark.createDataFrame(table).repartition(8)  # from Arrow: a list would start Python workers of another kind, which stay
    width = min(rank + OVERSAMPLE, n_terms)

    def product(basis: np.ndarray) -> np.ndarray:
        def part(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            out = np.zeros((n_terms, width))
            for frame in frames:
                for terms, weights in zip(frame["terms"], frame["weights"]):
                    out[terms] += np.outer(weights, weights @ basis[terms])
            for k in range(PARTS):
                yield pd.DataFrame({"part": [k], "sums": [out[k::PARTS].ravel().tobytes()]})

        def add(frame: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"part": frame["part"][:1], "sums": [sum(np.frombuffer(x) for x in frame["sums"]).tobytes()]})

        summed = rows.mapInPandas(part, "part int, sums binary").groupBy("part").applyInPandas(add, "part int, sums binary")
        out = np.zeros((n_terms, width))
        for r in summed.collect():  # block-bounded: n_terms * width numbers
            out[r["part"] :: PARTS] = np.frombuffer(r["sums"]).reshape(-1, width)
        return out

    basis = np.linalg.qr(np.random.default_rng(11).standard_normal((n_terms, width)))[0]
    for _ in range(POWER):
        basis = np.linalg.qr(product(basis))[0]
    gram = basis.T @ product(basis)
    values, turn = np.linalg.eigh((gram + gram.T) / 2)
    best = np.argsort(-values)[:rank]
    return (basis @ turn[:, best[values[best] > 1e-9]]).astype(np.float32)


class Block:
    """Everything a task needs to find a block's passages in a text."""

    def __init__(self, items: list[int], parts: list[list[bytes]], terms: dict[bytes, int], weight: np.ndarray, space: np.ndarray):
        self.items, self.parts = items, parts
        self.terms = terms
        # words as their terms: every word of a passage is one
        self.numbers = [[terms[w] for w in p] for p in parts]
        self.answers = [[terms[w] for w in answer_of(p)] for p in parts]
        self.latent = np.ascontiguousarray(space * weight[:, None].astype(np.float32))
        queries = np.stack([self._project(*vector(p, terms, weight), space) for p in parts])
        norm = np.linalg.norm(queries, axis=1, keepdims=True)
        self.queries = np.divide(queries, norm, out=np.zeros_like(queries), where=norm > 0).T.copy()
        sizes, low = np.array([len(p) for p in parts]), 0
        self.sizes = sizes
        self.widths: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []  # steps of a window, its passages, their vectors and lengths
        for high, steps in WIDTHS:
            of = np.flatnonzero((sizes > low) & (sizes <= high))
            if len(of):
                self.widths.append((steps, of, self.queries[:, of].copy(), norm[of, 0]))
            low = high

    @staticmethod
    def _project(terms: list[int], weights: list[float], space: np.ndarray) -> np.ndarray:
        return np.asarray(weights, np.float32) @ space[terms] if terms else np.zeros(space.shape[1], np.float32)

    @cached_property
    def times(self) -> np.ndarray:
        """How often a passage has each term; the last column is for words that are no term. Made where it is used, never sent."""
        out = np.zeros((len(self.parts), len(self.terms) + 1), np.uint8)
        for k, numbers in enumerate(self.numbers):
            np.add.at(out[k], numbers, 1)
        return out

    @cached_property
    def members(self) -> np.ndarray:
        return self.times > 0

    @cached_property
    def places(self) -> list[tuple[dict[int, int], dict[int, int]]]:
        """Of each passage: the places of its terms, and how many they are."""
        return [(places(numbers), Counter(numbers)) for numbers in self.numbers]

    def _in_order(self, k: int, near: np.ndarray, above: float) -> float:
        """Share of passage ``k`` that stands in ``near`` in order, or 0 where it is surely below ``PARAPHRASE`` or ``above``.

        Words that the passage lacks take no part in a common subsequence, so it is no longer than the passage's own words
        found here, nor than their places in the passage.
        """
        (where, times), size = self.places[k], len(self.numbers[k])
        own = near[self.members[k][near]].tolist()
        enough = max(PARAPHRASE, above)
        if len(own) < enough * size or sum(map(times.__getitem__, set(own))) < enough * size:
            return 0.0
        return lcs(self.numbers[k], own, where) / size

    def find(self, texts: list[str | None]) -> list[list[tuple[int, int, float, float, bool]]]:
        """For each text (item_id, first word of the window, cosine, share of the passage found in order, answer found) of verified passages.

        The texts are laid on one axis of steps, a window apart, so that a batch is a few matrix products.
        """
        if not texts:
            return []
        wide, unknown = WINDOW // WINDOW_STEP, len(self.terms)
        split = [words_of(text) for text in texts]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        room = -(-sizes // WINDOW_STEP) + wide
        bases = np.cumsum(room) - room + wide
        ends = np.cumsum(sizes)
        found = map(self.terms.get, chain.from_iterable(split), repeat(unknown))
        words = np.fromiter(found, np.min_scalar_type(unknown), ends[-1])  # the texts one after the other
        at = np.flatnonzero(words != unknown)
        text = np.searchsorted(ends, at, "right")
        steps = bases[text] + (at - (ends - sizes)[text]) // WINDOW_STEP
        hits = self._windows(steps, words[at], bases, words, ends, sizes)
        numbers = np.split(words, ends[:-1])
        out: list[list[tuple[int, int, float, float, bool]]] = [[] for _ in texts]
        for (text, k), windows in hits.items():
            size, best = len(self.parts[k]), None
            for cosine, step in sorted(windows, reverse=True):
                start = max(0, step - int(bases[text])) * WINDOW_STEP
                near = numbers[text][max(0, start - size) : start + WINDOW + size]
                share = self._in_order(k, near, best[3] if best else 0.0)
                if share >= PARAPHRASE and (best is None or share > best[3]):
                    answered = _contains(near.tolist(), self.answers[k])
                    if share >= SAME or answered:
                        best = (self.items[k], start, cosine, share, answered)
                        if share == 1:
                            break
            if best:
                out[text].append(best)
        return out

    def _sums(self, own: np.ndarray, term: np.ndarray, rows: int) -> np.ndarray:
        """The vectors of each step's terms added up, in the terms' order; ``own``: the step of each, ascending.

        The first terms of all steps are added at once, then the second ones, and so on; steps with most terms stand first.
        """
        first = np.flatnonzero(np.diff(own, prepend=-1))
        count = np.diff(first, append=len(own))
        order = np.argsort(-count, kind="stable")
        first, count = first[order], count[order]
        total = self.latent[term[first]]
        more = np.empty_like(total)
        for nth in range(1, count[0]):
            n = np.searchsorted(-count, -nth)
            np.take(self.latent, term[first[:n] + nth], axis=0, out=more[:n], mode="clip")
            total[:n] += more[:n]
        out = np.zeros((rows, self.latent.shape[1]), np.float32)
        out[own[first]] = total
        return out

    def _enough(self, k: np.ndarray, low: np.ndarray, high: np.ndarray, words: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Whether ``words[low:high]`` may hold ``PARAPHRASE`` of passage ``k``: the bounds of ``_in_order``, for ``SPANS`` candidates at once.

        ``before``: where each word stood last, so that a term's places in the passage count once in a span.
        """
        out = np.zeros(len(k), bool)
        flat, columns = self.times.ravel(), self.times.shape[1]
        for i in range(0, len(k), SPANS):
            of, start, width = k[i : i + SPANS], low[i : i + SPANS], (high - low)[i : i + SPANS]
            cut = np.cumsum(width) - width
            at = np.arange(width.sum()) + np.repeat(start - cut, width)
            times = flat[words[at] + np.repeat(of * columns, width)]
            own = np.add.reduceat(times > 0, cut, dtype=np.int32)
            placed = np.add.reduceat(times * (before[at] < np.repeat(start, width)), cut, dtype=np.int32)
            out[i : i + SPANS] = np.minimum(own, placed) >= PARAPHRASE * self.sizes[of]
        return out

    def _windows(
        self, step: np.ndarray, term: np.ndarray, bases: np.ndarray, words: np.ndarray, ends: np.ndarray, lengths: np.ndarray
    ) -> dict[tuple[int, int], list[tuple[float, int]]]:
        """(cosine, first step) of every window that reaches ``COSINE`` or ``HELD`` and may hold enough, by text and passage; ``CHUNK`` steps at once."""
        wide = WINDOW // WINDOW_STEP
        hits: dict[tuple[int, int], list[tuple[float, int]]] = {}
        alike = np.argsort(words, kind="stable")
        before = np.full(len(words), -1)
        again = np.flatnonzero(words[alike[1:]] == words[alike[:-1]])
        before[alike[again + 1]] = alike[again]
        for base in range(0, int(step[-1]) + 1 if len(step) else 0, CHUNK):
            low, high = np.searchsorted(step, (base, base + CHUNK + wide - 1))
            if low == high:
                continue
            sums = self._sums(step[low:high] - base, term[low:high], CHUNK + wide - 1)
            windows, added = sums[:CHUNK].copy(), 1
            for steps, of, queries, length in self.widths:
                for i in range(added, steps):
                    windows += sums[i : i + CHUNK]
                added = steps
                norm = np.sqrt(np.einsum("ij,ij->i", windows, windows))
                live = np.flatnonzero(norm > 0)
                cosine = windows[live] @ queries
                rows, passages = np.nonzero((cosine >= COSINE * norm[live, None]) | (cosine >= HELD * length))
                starts = live[rows] + base
                texts = np.searchsorted(bases, starts + wide - 1, "right") - 1
                first = np.maximum(starts - bases[texts], 0) * WINDOW_STEP
                k, begin = of[passages], (ends - lengths)[texts]
                start, end = begin + np.maximum(first - self.sizes[k], 0), np.minimum(begin + first + WINDOW + self.sizes[k], ends[texts])
                may = np.flatnonzero(self._enough(k, start, end, words, before))
                values = cosine[rows[may], passages[may]] / norm[live[rows[may]]]
                for text, passage, value, begun in zip(texts[may].tolist(), k[may].tolist(), values.tolist(), starts[may].tolist()):
                    hits.setdefault((text, passage), []).append((value, begun))
        return hits


def blocks(docs: DataFrame, benchmark: DataFrame) -> Iterator[Block]:
    spark = docs.sparkSession
    taken: list[tuple[int, list[bytes]]] = []
    source = passages(benchmark)
    while True:
        taken = [x for x, _ in zip(source, range(BLOCK))]
        if not taken:
            return
        parts = [p for _, p in taken]
        terms = {w: t for t, w in enumerate(sorted({w for p in parts for w in p}))}
        seen, rows = document_frequencies(docs, terms)
        # above zero for every term: a passage that most documents hold is a leak in all of them
        weight = np.log((1 + rows) / (1 + seen)) + 0.1
        space = latent_space(spark, [vector(p, terms, weight) for p in parts], len(terms), len(parts))
        yield Block([i for i, _ in taken], parts, terms, weight, space)


FOUND = "doc_id string, item_id long, first_word long, cosine double, lcs_share double, answer_found boolean"


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document (doc_id, text) and benchmark item found in it."""
    out = docs.sparkSession.createDataFrame([], FOUND)
    narrow = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    for block in blocks(docs, benchmark):

        def search(frames: Iterator[pd.DataFrame], block: Block = block) -> Iterator[pd.DataFrame]:
            for frame in frames:
                rows = []
                for doc_id, found in zip(frame["doc_id"], block.find(frame["text"].tolist())):
                    items: dict[int, tuple] = {}
                    for item, *rest in found:  # the best passage of an item
                        if item not in items or rest[2] > items[item][2]:
                            items[item] = tuple(rest)
                    rows += [(doc_id, item, *rest) for item, rest in sorted(items.items())]
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "first_word", "cosine", "lcs_share", "answer_found"])

        out = out.unionByName(narrow.mapInPandas(search, FOUND))
    best = F.max_by(F.struct("first_word", "cosine", "lcs_share", "answer_found"), F.struct("lcs_share", "cosine"))
    found = out.groupBy(F.col("doc_id").cast("long").alias("doc_id"), "item_id").agg(best.alias("best"))
    return found.select("doc_id", "item_id", "best.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows in whose text no benchmark passage is found, with the columns they came with."""
    for block in blocks(docs, benchmark):

        def clean(batches: Iterator[pa.RecordBatch], block: Block = block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
                yield batch.filter(pa.array([not found for found in block.find(texts)], pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
