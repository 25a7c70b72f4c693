"""One query per operator: ``name -> f(spark, sf_dir)``, with SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversations, decontaminate, fingerprints, html, language, licenses, packing, quality, shards, simhash, spelling, suffix, toxicity
from .common import ROW, read, shared_directory

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op3_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(read(spark, sf_dir, "documents", "doc_id", "text"))
    return judged.select(F.col(f"{ROW}.doc_id").alias("doc_id"), *quality.COUNTS, "base_failed", "kept")


ORACLES["op3_quality_cascade"] = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM texts
), places AS (
  SELECT r, unnest(range(1, len(words) - 1)) AS i, words FROM split WHERE len(words) >= 3
), grams AS (
  SELECT r, i, struct_pack(a := words[i], b := words[i + 1], c := words[i + 2]) AS gram FROM places
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM grams) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT i + step) AS n FROM twice, range(3) AS s(step) GROUP BY r
), counts AS (
  SELECT s.r, doc_id, text, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         length(regexp_replace(text, '[^!]', '', 'g')) AS bangs,
         length(regexp_replace(text, '[^\p{L}]', '', 'g')) AS letters,
         length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) AS capitals,
         len(string_split(text, chr(10))) AS all_lines,
         len(list_filter(words, lambda w: regexp_matches(w, '\p{L}'))) AS plain_words
  FROM split s LEFT JOIN covered c ON s.r = c.r
), based AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR n_symbols * 10 > n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR bangs * 2 > n_words OR n_dup_lines * 2 > all_lines OR plain_words * 2 < n_words
            OR capitals * 10 > letters * 7) AS kept
FROM based
"""


@query
def op2_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op7_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return decontaminate.contaminated(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


@query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digest(read(spark, sf_dir, "documents", "doc_id", "text"))


ORACLES["op5_suffix_dedup"] = """
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, lower(hex(encode(coalesce(text, '')))) AS bytes FROM documents
), cut AS (
  SELECT r, doc_id, unnest(regexp_extract_all(bytes, '.{1,400}')) AS part, unnest(range(len(regexp_extract_all(bytes, '.{1,400}')))) AS number FROM texts
), parts AS (
  SELECT r, doc_id, number, part || coalesce(substr(lead(part) OVER (PARTITION BY r ORDER BY number), 1, 198), '') AS part FROM cut
), strings AS (
  SELECT r, doc_id, number * 200 + i AS start, md5_number(substr(part, 2 * i + 1, 200)) AS string
  FROM (SELECT *, unnest(range(least(200, len(part) // 2 - 99))) AS i FROM parts)
), repeats AS (
  SELECT r, start FROM strings QUALIFY row_number() OVER (PARTITION BY string ORDER BY doc_id, start) > 1
), runs AS (
  SELECT r, run, min(start) AS low, max(start) + 100 AS high
  FROM (SELECT r, start, sum(fresh) OVER (PARTITION BY r ORDER BY start) AS run
        FROM (SELECT r, start, CASE WHEN start - lag(start) OVER (PARTITION BY r ORDER BY start) <= 100 THEN 0 ELSE 1 END AS fresh FROM repeats))
  GROUP BY r, run
), removed AS (
  SELECT r, sum(high - low) AS n_removed, count(*) AS n_spans FROM runs GROUP BY r
), gaps AS (
  SELECT r, low AS until, coalesce(lag(high) OVER (PARTITION BY r ORDER BY low), 0) AS since FROM runs
  UNION ALL SELECT r, len(bytes) // 2, coalesce(max(high), 0) FROM texts LEFT JOIN runs USING (r) GROUP BY r, bytes
), kept AS (
  SELECT r, string_agg(substr(bytes, 2 * since + 1, 2 * (until - since)), '' ORDER BY since) AS kept FROM gaps JOIN texts USING (r) GROUP BY r
)
SELECT doc_id, (len(bytes) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(kept)) AS kept_sha256
FROM texts JOIN kept USING (r) LEFT JOIN removed USING (r)
"""


@query
def op1_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents", "doc_id", "text"))


ORACLES["op1_license_diagonals"] = licenses.oracle()


@query
def op10_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    docs = docs.withColumn("held_out", language.held_out(F.col("doc_id"), 3, 1))
    langs, model = language.learn(docs.filter("NOT held_out AND lang IS NOT NULL AND doc_id IS NOT NULL"))
    return language.identify(docs, langs, model)


@query
def op6_toxicity_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.learn(toxicity.training_rows(docs, read(spark, sf_dir, "labels", "doc_id", "toxic")))
    return toxicity.score(docs, model)


@query
def op8_host_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(read(spark, sf_dir, "pages", "page_id", "url", "html"))


@query
def op4_training_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = f"{shared_directory(spark)}/shards-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return shards.write_shards(docs, root, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


#: CRC-32 of a text in SQL: a table for one byte, and the expression over the text ``{0}``.
CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
           lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_of
)"""
CRC = """xor(list_reduce(
  list_prepend(4294967295, list_transform(range(0, length(hex(encode({0}))), 2), lambda p: ('0x' || substr(hex(encode({0})), p + 1, 2))::BIGINT)),
  lambda c, b: xor(c >> 8, crc_of[(xor(c, b) & 255) + 1])), 4294967295)"""


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    found = conversations.repair(conversations.damaged(turns)).withColumnRenamed("conv_id", "c")
    counts = [F.coalesce(n, F.lit(0)).alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    joined = turns.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    return joined.select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(conversations.EMPTY_SHA256)).alias("repaired_sha256"),
    )


def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _step(state: str, cost: str, edit: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}'}}"


_DELETED = {s: _step(s, "2", "D") for s in ("s0", "s1", "s2", "s3")}
_TAKEN = {
    s: f"{{'c': {s}.c + surplus + CASE WHEN gone THEN 1000000000 WHEN role_initial = '{r}' THEN 0 ELSE 1 END, "
    f"'a': {s}.a || CASE WHEN role_initial = '{r}' THEN 'K' ELSE 'R' END}}"
    for s, r in (("s0", "u"), ("s1", "u"), ("s2", "a"), ("s3", "u"))
}
_LED = "{'c': s0.c + surplus + CASE WHEN role_initial = 's' AND NOT gone THEN 0 ELSE 1000000000 END, 'a': s0.a || 'K'}"
ORACLES["op11_conversation_repair"] = rf"""
WITH RECURSIVE {CRC_TABLE}, keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
  FROM conversations
), kinds AS (
  SELECT *, {CRC.format('name')} % 20 AS kind FROM keyed, crc_table
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, range(2) AS c(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged
), marked AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS is_blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut_off,
         lead(role) OVER (PARTITION BY conv_id ORDER BY i) AS next_role
  FROM placed
), faults AS (
  SELECT *, is_blank OR again AS gone, NOT (is_blank OR again) AND cut_off AS truncated, left(role, 1) AS role_initial,
         CASE WHEN NOT (is_blank OR again) AND cut_off THEN 5 ELSE 0 END AS surplus
  FROM marked
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(is_blank) AS blank,
         count_if(again AND NOT is_blank) AS duplicate, count_if(truncated) AS truncated,
         count_if(next_role IS NOT NULL AND left(role, 1) || left(next_role, 1) NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faults GROUP BY conv_id
), steps AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': ''}} AS s0, {{'c': 1000000000::BIGINT, 'a': ''}} AS s1,
         {{'c': 5::BIGINT, 'a': 'I'}} AS s2, {{'c': 10::BIGINT, 'a': 'II'}} AS s3 FROM counts
  UNION ALL
  SELECT conv_id, i, s0, s1, s2, {_least('t3', _step('s2', '5', 'I'))} AS s3 FROM (
    SELECT conv_id, i, s0, s1, t3, {_least('t2', *(_step(s, '5', 'I') for s in ('s0', 's1', 't3')))} AS s2 FROM (
      SELECT f.conv_id, f.i, {_DELETED['s0']} AS s0, {_least(_DELETED['s1'], _LED)} AS s1,
             {_least(_DELETED['s2'], _TAKEN['s0'], _TAKEN['s1'], _TAKEN['s3'])} AS t2, {_least(_DELETED['s3'], _TAKEN['s2'])} AS t3
      FROM steps JOIN faults f ON f.conv_id IS NOT DISTINCT FROM steps.conv_id AND f.i = steps.i + 1
    )
  )
), best AS (
  SELECT counts.*, {_least('s0', 's3')} AS b FROM steps JOIN counts ON counts.conv_id IS NOT DISTINCT FROM steps.conv_id AND n = i
), letters AS (
  SELECT conv_id, b.a AS audit, unnest(range(1, length(b.a) + 1)) AS p FROM best
), edits AS (
  SELECT conv_id, p, substr(audit, p, 1) AS edit, length(replace(substr(audit, 1, p), 'I', '')) AS i FROM letters
), kept AS (
  SELECT e.conv_id, e.p, edit, role, text, edit = 'K' AND role_initial = 's' AS leads, row_number() OVER (PARTITION BY e.conv_id ORDER BY p) AS m
  FROM edits e LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND edit <> 'I' AND f.i = e.i
  WHERE edit <> 'D'
), named AS (
  SELECT *, CASE WHEN edit = 'K' THEN role WHEN (m - (max(leads::INT) OVER (PARTITION BY conv_id))) % 2 = 1 THEN 'user' ELSE 'assistant' END
              || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END AS line
  FROM kept
), texts AS (
  SELECT conv_id, string_agg(line, chr(10) ORDER BY p) AS repaired FROM named GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.c, 0)::BIGINT AS cost,
       coalesce(b.a, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN texts ON texts.conv_id IS NOT DISTINCT FROM o.conv_id
"""


#: Of how many words one has a letter taken out.
MISSPELT = 199


@query
def op12_spelling_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spelling.runs(read(spark, sf_dir, "documents", "doc_id", "text"))
    word = F.col("word")
    checksum = F.crc32(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), word))
    at = (checksum % F.length(word)).cast("int")
    shorter = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    return spelling.variants(spelling.vocabulary(runs.select(F.when(checksum % MISSPELT == 0, shorter).otherwise(word).alias("word"))))


#: As many steps along a chain of forms as the counts of any table allow.
_CHAINS = ", ".join(
    f"chain{k} AS (SELECT c.* EXCLUDE (root), coalesce(f.form, c.root) AS root FROM chain{k - 1} c LEFT JOIN formed f ON f.word = c.root)"
    for k in range(1, 13)
)
ORACLES["op12_spelling_pivots"] = rf"""
WITH {CRC_TABLE}, found AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents
), runs AS (
  SELECT doc_id, run, count(*) AS times FROM found WHERE length(run) >= 6 GROUP BY ALL
), sums AS (
  SELECT run, times, {CRC.format("(coalesce(doc_id::VARCHAR, '') || ':' || run)")}::BIGINT AS h FROM runs, crc_table
), words AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM sums
), vocab AS (
  SELECT word, sum(times)::BIGINT AS n FROM words GROUP BY word HAVING length(word) >= 6 AND sum(times) >= 5
), shorter AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocab)
), near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM shorter a JOIN vocab b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM shorter a JOIN vocab b ON a.rest = b.word
), counted AS (
  SELECT word, count(*) AS n_near, list_min(list({{'rank': -other_n, 'form': other}}) FILTER (other_n >= 5 * n)) AS best FROM near GROUP BY word
), formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, best.form AS form, -best.rank AS form_n FROM vocab v LEFT JOIN counted c ON c.word = v.word
), chain0 AS (
  SELECT *, coalesce(form, word) AS root FROM formed
), {_CHAINS}
SELECT word, form, root, n, n_near, form_n::BIGINT AS form_n FROM chain12
"""


@query
def op13_piecewise_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.against_edits(read(spark, sf_dir, "documents", "doc_id", "text"))
