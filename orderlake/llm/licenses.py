"""License scan by diagonal voting.

Every run of three words is hashed and joined with the places of the same run in the templates (a
fixed list, so the joined side has a fixed size). A hit votes for a diagonal: place in the text minus
place in the template. Votes are combined per diagonal before they are shuffled, neighbouring diagonals (a word put in or
left out) are merged, and a merged span is verified by the share of the template's words that its votes confirm in order.
A phrase stands in a text exactly where one diagonal has all votes of its template.

The places that a span's votes confirm are bits of as many 64-bit numbers as the longest template needs.

Defined results: a null or empty text has no words, no labels and score 0; a very long text gives one vote for each of its
runs that a template holds, combined per diagonal in the map tasks, so a phrase may stand in it any number of times; equal rows get equal
results, rows that share a doc_id but not the text are judged apart; a null doc_id is kept; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, word_list

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 3
#: Diagonals at most so far apart are one span; a span with this share of a template's words carries its label.
NEAR, SHARE = 2, 0.9

# fixed values: the phrases of the base rule
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
# fixed values: usual notices
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl-2", "licensed under the gnu general public license version 2"),
    ("lgpl", "gnu lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("all-rights-reserved", "all rights reserved no part of this publication may be reproduced"),
)
# fixed values: whole licences and notices, without the lines that name a holder
WHOLE_TEXTS = (
    ("mit", """
        permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation
        files the software to deal in the software without restriction including without limitation the rights to use copy modify
        merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is
        furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be
        included in all copies or substantial portions of the software the software is provided as is without warranty of any kind
        express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and
        noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether
        in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other
        dealings in the software"""),
    ("bsd-2", """
        redistribution and use in source and binary forms with or without modification are permitted provided that the following
        conditions are met 1 redistributions of source code must retain the above copyright notice this list of conditions and the
        following disclaimer 2 redistributions in binary form must reproduce the above copyright notice this list of conditions and
        the following disclaimer in the documentation and or other materials provided with the distribution this software is
        provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to
        the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright
        holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but
        not limited to procurement of substitute goods or services loss of use data or profits or business interruption however
        caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising
        in any way out of the use of this software even if advised of the possibility of such damage"""),
    ("bsd-3", """
        redistribution and use in source and binary forms with or without modification are permitted provided that the following
        conditions are met 1 redistributions of source code must retain the above copyright notice this list of conditions and the
        following disclaimer 2 redistributions in binary form must reproduce the above copyright notice this list of conditions and
        the following disclaimer in the documentation and or other materials provided with the distribution 3 neither the name of
        the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software
        without specific prior written permission this software is provided by the copyright holders and contributors as is and any
        express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a
        particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect
        incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or
        services loss of use data or profits or business interruption however caused and on any theory of liability whether in
        contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even
        if advised of the possibility of such damage"""),
    ("isc", """
        permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided
        that the above copyright notice and this permission notice appear in all copies the software is provided as is and the author
        disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no
        event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting
        from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in
        connection with the use or performance of this software"""),
    ("zlib", """
        this software is provided as is without any express or implied warranty in no event will the authors be held liable for any
        damages arising from the use of this software permission is granted to anyone to use this software for any purpose including
        commercial applications and to alter it and redistribute it freely subject to the following restrictions 1 the origin of this
        software must not be misrepresented you must not claim that you wrote the original software if you use this software in a
        product an acknowledgment in the product documentation would be appreciated but is not required 2 altered source versions
        must be plainly marked as such and must not be misrepresented as being the original software 3 this notice may not be removed
        or altered from any source distribution"""),
    ("apache-2", """
        licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you
        may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in
        writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind
        either express or implied see the license for the specific language governing permissions and limitations under the license"""),
    ("unlicense", """
        this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell
        or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial
        and by any means"""),
    ("mpl-2", """
        this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed
        with this file you can obtain one at https mozilla org mpl 2 0"""),
)
TEMPLATES = tuple((i, label, tuple(text.split()), i < len(PHRASES)) for i, (label, text) in enumerate(PHRASES + NOTICES + WHOLE_TEXTS))
#: Words of a template in one number, and the columns of numbers that hold the longest one.
BITS = 64
PLACES = tuple(f"places{k}" for k in range(-(-max(len(words) for _, _, words, _ in TEMPLATES) // BITS)))


def place_bits(place: int) -> list[int]:
    """The ``GRAM`` words from ``place`` on as bits of signed 64-bit numbers, one for each of ``PLACES``."""
    whole = ((1 << GRAM) - 1) << place
    parts = [whole >> BITS * k & (1 << BITS) - 1 for k in range(len(PLACES))]
    return [part - (1 << BITS) if part >> BITS - 1 else part for part in parts]


def template_places(spark: SparkSession) -> DataFrame:
    """One row for each run of three words of each template: about a thousand rows in all."""
    rows = [
        (number, label, place, len(words), base, *place_bits(place), *words[place : place + GRAM])
        for number, label, words, base in TEMPLATES
        for place in range(len(words) - GRAM + 1)
    ]
    bits = ", ".join(f"{name} long" for name in PLACES)
    names = f"template int, label string, place int, n_template int, base boolean, {bits}, w0 string, w1 string, w2 string"
    return spark.createDataFrame(rows, names).withColumn("gram", F.xxhash64("w0", "w1", "w2")).drop("w0", "w1", "w2")


def words(text: Column) -> Column:
    return word_list(ascii_lower(text), WORD)


def spans(docs: DataFrame) -> DataFrame:
    """Merged spans: ``doc_id, digest, template, label, base, first, last, share`` (words from 0; ``share`` of the template confirmed)."""
    split = docs.select("doc_id", F.xxhash64("text").alias("digest"), words(F.col("text")).alias("words"))
    word = F.col("words")
    grams = F.when(
        F.size("words") >= GRAM,
        F.transform(F.sequence(F.lit(0), F.size("words") - GRAM), lambda i: F.xxhash64(F.get(word, i), F.get(word, i + 1), F.get(word, i + 2))),
    )
    runs = split.select("doc_id", "digest", F.posexplode(grams).alias("at", "gram"))
    hits = runs.join(F.broadcast(template_places(docs.sparkSession)), "gram")
    votes = hits.groupBy("doc_id", "digest", "template", "label", "base", "n_template", (F.col("at") - F.col("place")).alias("diagonal")).agg(
        *(F.bit_or(name).alias(name) for name in PLACES)
    )
    line = Window.partitionBy("doc_id", "digest", "template").orderBy("diagonal")
    # a phrase is never merged: it stands on one diagonal or not at all
    apart = F.col("base") | (F.col("diagonal") - F.lag("diagonal", 1, -10_000_000).over(line) > NEAR)
    numbered = votes.withColumn("span", F.sum(apart.cast("long")).over(line))
    merged = numbered.groupBy("doc_id", "digest", "template", "label", "base", "n_template", "span").agg(
        *(F.bit_or(name).alias(name) for name in PLACES), F.min("diagonal").alias("first"), F.max("diagonal").alias("low_end")
    )
    confirmed = F.expr(" + ".join(f"bit_count({name})" for name in PLACES))
    return merged.select(
        "doc_id", "digest", "template", "label", "base", "first",
        (F.col("low_end") + F.col("n_template") - 1).alias("last"), (confirmed / F.col("n_template")).alias("share"),
    )


def scan(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text), as the contract names its columns."""
    stands = F.col("base") & (F.col("share") == 1)
    verified = stands | (~F.col("base") & (F.col("share") >= SHARE))
    listed = lambda label: F.array_join(F.array_sort(F.collect_set(label)), ",")
    found = spans(docs).groupBy("doc_id", "digest").agg(
        F.count(F.when(stands, 1)).alias("n_base"),
        F.min(F.when(stands, F.col("first").cast("long"))).alias("first_word"),
        F.max(F.when(stands, F.col("first").cast("long"))).alias("last_word"),
        listed(F.when(stands, F.col("label"))).alias("base_labels"),
        listed(F.when(verified, F.col("label"))).alias("labels"),
        F.max("share").alias("score"),
    )
    rows = docs.select("doc_id", F.xxhash64("text").alias("digest"), F.size(words(F.col("text"))).cast("long").alias("n_words")).alias("d")
    f = found.alias("f")
    joined = rows.join(f, F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.digest") == F.col("f.digest")), "left")
    return joined.select(
        "d.doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def oracle() -> str:
    """The same in SQL, on words instead of hashes."""
    rows = ", ".join(
        f"({number}, '{label}', {len(w)}, {str(base).lower()}, {p}, '{w[p]}', '{w[p + 1]}', '{w[p + 2]}')"
        for number, label, w, base in TEMPLATES for p in range(len(w) - GRAM + 1)
    )
    return rf"""
WITH places(template, label, n_template, base, place, a, b, c) AS (VALUES {rows}),
texts AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), runs AS (
  SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM texts WHERE len(words) >= 3
), hits AS (
  SELECT r, template, label, n_template, base, i - 1 - place AS diagonal, place
  FROM runs JOIN places ON words[i] = a AND words[i + 1] = b AND words[i + 2] = c
), diagonals AS (
  SELECT DISTINCT r, template, base, diagonal FROM hits
), numbered AS (
  SELECT *, sum(CASE WHEN base OR apart IS NULL OR apart > {NEAR} THEN 1 ELSE 0 END)
              OVER (PARTITION BY r, template ORDER BY diagonal) AS span
  FROM (SELECT *, diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) AS apart FROM diagonals)
), spans AS (
  SELECT r, template, label, base, span, min(h.diagonal) AS first,
         count(DISTINCT place + step) / any_value(n_template)::DOUBLE AS share
  FROM hits h JOIN numbered n USING (r, template, base, diagonal), range({GRAM}) AS s(step)
  GROUP BY r, template, label, base, span
), found AS (
  SELECT r, count(*) FILTER (base AND share = 1) AS n_base,
         min(first) FILTER (base AND share = 1) AS first_word, max(first) FILTER (base AND share = 1) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base AND share = 1) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (CASE WHEN base THEN share = 1 ELSE share >= {SHARE} END) AS labels,
         max(share) AS score
  FROM spans GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0)::DOUBLE AS score
FROM texts LEFT JOIN found USING (r)
"""
