"""Quality rules as a short-circuit cascade, in DataFrame functions alone.

Every row gets base counts. The method adds further rules. How long each takes and how much
it rejects is measured on a sample; the rules then stand in one CASE in order of rejections per
cost, so that a row pays for rules only up to the first that rejects it. The order never changes
a verdict: a row is kept if no rule rejects it.

Defined results: a null or empty text has no words and fails; a very long one is judged whole, like any other; other columns are
carried along untouched, nulls included; each of several equal rows is judged alike; an empty table
gives an empty result.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, durable, word_list

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Rows on which cost and selectivity are measured, and how often each is judged for its time to show.
SAMPLE_ROWS, REPEATED = 2_000, 5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``fails`` judges a row by its text and counts."""

    name: str
    fails: Column


def _occurrences(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def rules(text: Column) -> list[Rule]:
    """Rules beyond the base ones."""
    letters, capitals = F.regexp_count(text, F.lit(r"\p{L}")), F.regexp_count(text, F.lit(r"\p{Lu}"))
    lines = F.size(F.split(text, "\n", -1))
    plain_words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]*\p{L}[^\x20\x09-\x0D]*"))
    words = F.col("n_words")
    return [
        Rule("symbols", F.col("n_symbols") * 10 > words),
        Rule("word length", (F.col("word_chars") < words * 2) | (F.col("word_chars") > words * 20)),
        Rule("exclamations", _occurrences(text, "!") * 2 > words),
        Rule("repeated lines", F.col("n_dup_lines") * 2 > lines),
        Rule("words without letters", plain_words * 2 < words),
        Rule("capitals", capitals * 10 > letters * 7),
    ]


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``ROW`` (the whole row), ``__text``, the base counts and ``base_failed``."""
    df = docs.select(F.struct("*").alias(ROW), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    df = df.withColumn("__words", word_list(F.col("__text")))
    word = F.col("__words")
    df = df.withColumn("__lines", F.filter(F.split("__text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    df = df.withColumn(
        "__grams",
        F.when(
            F.size("__words") >= 3,
            F.transform(
                F.sequence(F.lit(0), F.size("__words") - 3),
                lambda i: F.xxhash64(F.get(word, i), F.get(word, i + 1), F.get(word, i + 2)),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    # only texts with a repeated window pay for the sort
    df = df.withColumn(
        "__sorted",
        F.when(
            F.size(F.array_distinct("__grams")) < F.size("__grams"),
            F.sort_array(F.transform("__grams", lambda gram, i: F.struct(gram.alias("gram"), i.alias("at")))),
        ).otherwise(F.array().cast("array<struct<gram:bigint,at:int>>")),
    )
    ordered = F.col("__sorted")

    def repeated(here, i):
        """Start of a window that has an equal one beside it in sorted order, else null."""
        before, after = F.get(ordered, i - 1)["gram"], F.get(ordered, i + 1)["gram"]
        return F.when(F.coalesce(here["gram"] == before, F.lit(False)) | F.coalesce(here["gram"] == after, F.lit(False)), here["at"])

    df = df.withColumn("__starts", F.sort_array(F.filter(F.transform("__sorted", repeated), F.isnotnull)))
    starts = F.col("__starts")
    covered = F.aggregate(
        F.transform("__starts", lambda at, j: F.least(F.lit(3), F.coalesce(F.get(starts, j + 1) - at, F.lit(3)))),
        F.lit(0), lambda total, width: total + width,
    )
    df = df.select(
        ROW,
        "__text",
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("__text", r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        _occurrences(F.col("__text"), "#*$%&|<>").cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return df.withColumn("base_failed", failed)


def _seconds(sample: DataFrame, fails: Column) -> float:
    """How long judging the sample REPEATED times takes, after a first time that also compiles."""
    for times in (1, REPEATED):
        often = sample.withColumn("__nth", F.explode(F.sequence(F.lit(1), F.lit(times)))).agg(F.count_if(fails))
        began = time.perf_counter()
        often.collect()
    return time.perf_counter() - began


def cascade_order(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> list[Rule]:
    """Rules by rejection per cost on a sample of about ``sample_rows`` rows, best first.

    The sample holds rows that the base rules leave. A cost is the time that a rule takes on it beyond that of a rule without work.
    """
    known = rules(F.col("__text"))
    total = docs.count()
    if not total:
        return known
    picked = docs.select(F.col(text).alias("text")).sample(min(1.0, sample_rows / total), seed)
    sample = durable(with_counts(picked).drop(ROW)).filter(~F.col("base_failed"))
    rejected = sample.agg(*(F.avg(F.coalesce(rule.fails, F.lit(False)).cast("double")).alias(f"r{i}") for i, rule in enumerate(known))).first()
    idle = _seconds(sample, F.lit(False))
    worth = {rule.name: (rejected[f"r{i}"] or 0.0) / max(_seconds(sample, rule.fails) - idle, 1e-3) for i, rule in enumerate(known)}
    return sorted(known, key=lambda rule: -worth[rule.name])


def judge(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``ROW``, the base counts, ``base_failed`` and ``kept`` for each row."""
    ordered = cascade_order(docs, text, sample_rows)
    kept = F.when(F.col("base_failed"), F.lit(False))
    for rule in ordered:
        kept = kept.when(rule.fails, F.lit(False))
    # a filter moves below what it filters by, which would copy the counts into it many times; not so past a row number
    kept = kept.otherwise(F.lit(True)) & (F.monotonically_increasing_id() >= 0)
    return with_counts(docs, text).select(ROW, *COUNTS, "base_failed", kept.alias("kept"))


def quality_filter(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows that no rule rejects, with the columns they came with."""
    return judge(docs, text).filter("kept").select(f"{ROW}.*")
