"""Language identification as a mixture: expectation-maximisation over the words of a text.

Letter trigrams of labelled texts are counted for each language, over all training rows. A
text is a mixture of languages, each word of one of them; expectation-maximisation estimates the
proportions. From the set of all languages the weakest is dropped as long as the penalised
likelihood gains by it; the text gets the language with the largest proportion in the set that is left.

Defined results: ``und`` with score 0 for a null text, a text without a letter, or where nothing
could be learned; all words of a very long text count, so it takes a row of numbers for each of them in its task; rows with a null language or doc_id teach nothing; equal rows get equal results; among equal
proportions the first language by name wins; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Trigrams are hashed to so many buckets: the model's size for a language.
BUCKETS = 1 << 16
SMOOTHING = 0.5
ROUNDS = 8
#: A language must raise the log likelihood by so much times log(words).
PENALTY = 2.0
#: Least likelihood of a word against its best language: names and noise stay harmless.
FLOOR = 1e-6
#: Words handled at once.
WORDS = 200_000

#: Letters in lower case; all that is not an ASCII letter or part of another character becomes a space.
FOLD = np.array([b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)], np.uint8)


def held_out(doc_id: Column, parts: int, remainder: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == remainder, F.lit(False))


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each trigram (words with a space on either side) and the number of its word."""
    data = FOLD[np.frombuffer(b" %b " % (text or "").lower().encode("utf-8", "replace"), np.uint8)]
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    middle = data[1:-1] != 32
    wide = data.astype(np.uint32)
    code = (wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:])[middle] * np.uint32(0x9E3779B1)
    first = middle & (data[:-2] == 32)
    return (code >> np.uint32(16)).astype(np.int64), np.cumsum(first)[middle] - 1


def counts(docs: DataFrame) -> DataFrame:
    """``lang, bucket, n`` over the rows of ``docs`` (text, lang); one row per partition, language and bucket is shuffled."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, np.ndarray] = {}
        for frame in frames:
            for text, lang in zip(frame["text"], frame["lang"]):
                table = seen.setdefault(lang, np.zeros(BUCKETS, np.int64))
                table += np.bincount(trigrams(text)[0], minlength=BUCKETS)
        for lang, table in seen.items():
            at = np.flatnonzero(table)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": table[at]})

    return docs.select("text", "lang").mapInPandas(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order of name and log P(trigram | language), (BUCKETS, languages)."""
    found = counts(docs).toPandas()  # at most BUCKETS rows for each language
    langs = sorted(found["lang"].unique())
    table = np.zeros((BUCKETS, len(langs)))
    for k, lang in enumerate(langs):
        own = found[found["lang"] == lang]
        table[own["bucket"], k] = own["n"]
    table += SMOOTHING
    return langs, np.log(table / table.sum(axis=0)).astype(np.float32)


def mixtures(likelihood: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Proportions for each document; ``likelihood``: (words, languages), the words of document i begin at ``starts[i]``."""
    words, langs = likelihood.shape
    sizes = np.diff(starts, append=words)
    document = np.repeat(np.arange(len(starts)), sizes)

    def fit(active: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Proportions within ``active`` languages and the log likelihood, for the documents ``among``."""
        inside = np.isin(document, among) if len(among) < len(starts) else np.ones(words, bool)
        place = np.cumsum(np.isin(np.arange(len(starts)), among)) - 1
        own, part = place[document[inside]], likelihood[inside]
        begins = np.flatnonzero(np.diff(own, prepend=-1))
        share = active[among] / active[among].sum(axis=1, keepdims=True)
        for _ in range(ROUNDS):
            joint = part * share[own]
            total = joint.sum(axis=1)
            share = np.add.reduceat(joint / total[:, None], begins) / sizes[among][:, None]
        return share, np.add.reduceat(np.log((part * share[own]).sum(axis=1)), begins)

    every = np.arange(len(starts))
    active = np.ones((len(starts), langs))
    share, value = fit(active, every)
    open_ = every
    for _ in range(langs - 1):
        tried = active.copy()
        weakest = np.where(active[open_] > 0, share[open_], 2.0).argmin(axis=1)
        tried[open_, weakest] = 0
        new_share, new_value = fit(tried, open_)
        gain = new_value - value[open_] + PENALTY * np.log(np.maximum(sizes[open_], 2)) > 0
        chosen = open_[gain]
        active[chosen], share[chosen], value[chosen] = tried[chosen], new_share[gain], new_value[gain]
        open_ = chosen
        if not len(open_):
            break
    return share


def identify(docs: DataFrame, langs: list[str], model: np.ndarray) -> DataFrame:
    """``doc_id, lang_pred, score, held_out`` for each row of ``docs`` (doc_id, text, held_out)."""

    def predict(texts: list[str | None]) -> list[tuple[str, float]]:
        out = [("und", 0.0)] * len(texts)
        group: list[int] = []
        held: list[np.ndarray] = []

        def flush() -> None:
            if group:
                sizes = np.array([len(x) for x in held])
                share = mixtures(np.concatenate(held), np.cumsum(sizes) - sizes)
                best = share.argmax(axis=1)
                for i, k, p in zip(group, best, share[np.arange(len(best)), best]):
                    out[i] = (langs[k], float(min(1.0, max(0.0, p))))
                group.clear()
                held.clear()

        for i, text in enumerate(texts):
            if not langs or not has_letter(text):
                continue
            bucket, word = trigrams(text)
            begins = np.flatnonzero(np.diff(word, prepend=-1))
            logs = np.add.reduceat(model[bucket], begins)
            held.append(np.exp(np.maximum(logs - logs.max(axis=1, keepdims=True), np.log(FLOOR))).astype(np.float64))
            group.append(i)
            if sum(map(len, held)) > WORDS:
                flush()
        flush()
        return out

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = predict(frame["text"].tolist())
            yield pd.DataFrame({
                "doc_id": frame["doc_id"], "held_out": frame["held_out"],
                "lang_pred": [x[0] for x in found], "score": np.array([x[1] for x in found], float),
            })

    narrow = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "held_out")
    found = narrow.mapInPandas(batches, "doc_id string, held_out boolean, lang_pred string, score double")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))
