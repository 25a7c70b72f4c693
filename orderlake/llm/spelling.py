"""Spelling variants of words: all pairs one edit apart, by pivotal grams, and each word's more frequent form.

Bigrams have one order for all words, rare ones first. A word's gram prefix is its three first bigrams in that
order, with all others that equal the third: ``last`` is the place of that third one. Its pivots are the
two disjoint bigrams of the prefix that promise the fewest candidates, chosen by dynamic programming over positions.

Let r and s be one edit apart and last(r) <= last(s). Left and right of the edit both read the same. Disjoint
pivots of r at p1 < p2 cannot both be touched, so either s starts with all of r through the first pivot, or s ends
with all of r from the second one on. The surviving pivot is a bigram of s that is no later than last(r),
hence in the prefix of s. So each word looks up its first pivot among words that have it in their prefix at the
same place from the start, and its second pivot at the same place from the end, with lengths that differ by one at
most. What lies beyond the pivot is halved: the edit is in one half, so the other half reads the same too and belongs to the
key. Each pair is met once: in the direction of the order, at the second pivot only where the first one does not
show it, at the second half only where the first does not. What is met is verified by edit distance inside the join.

Defined results: a null or empty text has no words, whole texts of any length count; repeated rows count as often
as they stand there; a null doc_id is an id of its own; columns beyond those named are not read; an empty table gives
an empty result. Words are runs of WORD in lower case, so there are at most 90 * 90 bigrams: that bounds the table
of their counts, the only thing that goes through the driver. Counts, pairs and links stay distributed; a frequent word is summed
in the map tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, durable, word_list

WORD = "[A-Za-zÀ-ÿ]+"
#: Words shorter than this, or rarer, are not grouped.
MIN_LENGTH, MIN_COUNT = 6, 5
#: A form is at least so many times as frequent as its variant.
RATIO = 5
#: By how much one more equal letter beside a pivot thins out the candidates, for choosing pivots; no result depends on it.
SPREAD = 4.0

#: ``first`` and ``second``: beginnings of r that s must not have here, since the pair is met elsewhere if it has them.
_ENTRY_DDL = "key string, word string, n long, last int, first string, second string"
_ENTRY = pa.schema([("key", pa.string()), ("word", pa.string()), ("n", pa.int64()), ("last", pa.int32()), ("first", pa.string()), ("second", pa.string())])


def runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, word`` for every run of WORD, A-Z in lower case; too short ones are left out."""
    found = F.filter(word_list(F.col(text), WORD), lambda w: F.length(w) >= MIN_LENGTH)
    return docs.select(F.col(doc_id).alias("doc_id"), F.explode(found).alias("word")).withColumn("word", ascii_lower(F.col("word")))


def vocabulary(words: DataFrame) -> DataFrame:
    """``word, n`` of every word that is long and frequent enough."""
    return words.groupBy("word").agg(F.count("*").alias("n")).filter((F.length("word") >= MIN_LENGTH) & (F.col("n") >= MIN_COUNT))


def gram_counts(vocab: DataFrame) -> dict[str, int]:
    """In how many places of the vocabulary each bigram stands; at most 90 * 90 of them."""
    at = F.sequence(F.lit(1), F.length("word") - 1)
    grams = vocab.select(F.explode(F.transform(at, lambda i: F.substring(F.col("word"), i, F.lit(2)))).alias("gram"))
    return {r["gram"]: r["n"] for r in grams.groupBy("gram").agg(F.count("*").alias("n")).collect()}


class Grams:
    """The order of bigrams and what follows from it for a word."""

    def __init__(self, counts: dict[str, int]) -> None:
        self.counts = counts
        self.place = {g: i for i, g in enumerate(sorted(counts, key=lambda g: (counts[g], g)))}

    def prefix(self, word: str) -> tuple[int, list[int]]:
        """``last`` and the positions of the gram prefix, ascending."""
        places = [self.place[word[i : i + 2]] for i in range(len(word) - 1)]
        last = sorted(places)[2]
        return last, [i for i, place in enumerate(places) if place <= last]

    def pivots(self, word: str, prefix: list[int]) -> tuple[int, int]:
        """Two disjoint positions of the prefix with the least expected candidates.

        ``left`` is the best first pivot that ends before the position looked at, so one pass decides; three positions always
        hold two that do not touch.
        """
        best, chosen, left = math.inf, (0, 0), (math.inf, 0)
        waiting: list[tuple[float, int]] = []
        for at in prefix:
            while waiting and waiting[0][1] + 2 <= at:
                left = min(left, waiting.pop(0))
            count = self.counts[word[at : at + 2]]
            total = left[0] + count / SPREAD ** (len(word) - 2 - at)
            if total < best:
                best, chosen = total, (left[1], at)
            waiting.append((count / SPREAD**at, at))
        return chosen


def _after(at: int, length: int) -> int:
    """Middle of what follows the bigram at ``at`` in a word of ``length``."""
    return (at + 2 + length + 1) // 2


def _lookups(word: str, first: int, second: int) -> Iterator[tuple[str, str | None, str | None]]:
    """Keys under which words one edit away are found, each with the beginnings that rule it out."""
    head, tail = word[: first + 2], word[second:]
    for length in range(len(word) - 1, len(word) + 2):
        middle = _after(first, length)
        yield f"{length}<{first}|{word[:middle]}", None, None
        yield f"{length}<{first}|{head}|{word[len(word) - length + middle :]}", word[:middle], None
        middle = (length - len(tail)) // 2
        yield f"{length}>{len(tail)}|{word[:middle]}|{tail}", head, None
        yield f"{length}>{len(tail)}||{word[len(word) - length + middle :]}", head, word[:middle]


def _places(word: str, prefix: list[int]) -> Iterator[str]:
    """Keys under which ``word`` is found by each bigram of its prefix, as a first and as a second pivot."""
    length = len(word)
    for at in prefix:
        middle = _after(at, length)
        yield f"{length}<{at}|{word[:middle]}"
        yield f"{length}<{at}|{word[: at + 2]}|{word[middle:]}"
        middle = at // 2
        yield f"{length}>{length - at}|{word[:middle]}|{word[at:]}"
        yield f"{length}>{length - at}||{word[middle:]}"


def _entries(grams: Grams, probe: bool):
    """Rows under which words are looked up (``probe``) or found."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                last, prefix = grams.prefix(word)
                if probe:
                    out += [(key, word, n, last, one, two) for key, one, two in _lookups(word, *grams.pivots(word, prefix))]
                else:
                    out += [(key, word, n, last, None, None) for key in _places(word, prefix)]
            columns = zip(*out) if out else [[]] * len(_ENTRY)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ENTRY)], schema=_ENTRY)

    return rows


def near_pairs(vocab: DataFrame) -> DataFrame:
    """``word, n, other, other_n`` for every two words one edit apart, in one of the two directions."""
    grams = Grams(gram_counts(vocab))
    words = vocab.select("word", "n")
    probes = words.mapInArrow(_entries(grams, True), _ENTRY_DDL).alias("r")
    index = words.mapInArrow(_entries(grams, False), _ENTRY_DDL).drop("first", "second").alias("s")
    r, s = F.col("r.word"), F.col("s.word")
    ordered = (F.col("r.last") < F.col("s.last")) | ((F.col("r.last") == F.col("s.last")) & (r < s))
    met_elsewhere = [F.coalesce(F.startswith(s, F.col(f"r.{beginning}")), F.lit(False)) for beginning in ("first", "second")]
    near = ordered & ~met_elsewhere[0] & ~met_elsewhere[1] & (F.levenshtein(r, s, 1) == 1)
    met = probes.join(index, (F.col("r.key") == F.col("s.key")) & near)
    return met.select(r.alias("word"), F.col("r.n").alias("n"), s.alias("other"), F.col("s.n").alias("other_n"))


def _roots(links: DataFrame, most: int) -> DataFrame:
    """``word, root`` of every ``word, form``: the end of its chain of forms.

    Each form is RATIO times as frequent, so the largest count ``most`` bounds the length of a chain and, since every round doubles what a
    row has passed, the number of rounds.
    """
    longest = 1 + int(math.log(max(most / MIN_COUNT, 1.0), RATIO))
    roots = durable(links.select("word", F.col("form").alias("root")))
    for _ in range(max(1, longest.bit_length())):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = durable(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
    return roots


def variants(vocab: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every row of ``word, n`` (distinct words of a vocabulary).

    ``form`` is the most frequent near word (ties: the smallest) if RATIO times as frequent, else null; ``root`` is
    where following forms ends.
    """
    # few bytes but much work a row, so not merged into few partitions
    vocab = durable(vocab.repartition(int(vocab.sparkSession.conf.get("spark.sql.shuffle.partitions")), "word"))
    pairs = durable(near_pairs(vocab))
    swapped = pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    other: Column = F.struct((-F.col("other_n")).alias("rank"), F.col("other").alias("form"))
    found = (
        pairs.unionByName(swapped)
        .groupBy("word")
        .agg(F.count("*").alias("n_near"), F.min(F.when(F.col("other_n") >= RATIO * F.col("n"), other)).alias("best"))
    )
    formed = durable(vocab.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.col("best.form").alias("form"), (-F.col("best.rank")).alias("form_n"),
    ))
    most = formed.agg(F.max("n")).first()[0] or 0
    roots = _roots(formed.filter(F.col("form").isNotNull()), most)
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
