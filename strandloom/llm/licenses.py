"""Licence scans: normalised segments of a text against licence templates by the Dice coefficient of word bigrams.

Segments are a whole text, its lines, its paragraphs of several lines (parted by blank lines), and, with line breaks as spaces, its runs of one to RUN
sentences, so that a notice is found wherever its lines are wrapped and whatever stands before and behind it. Segments that are normalised alike count once.
Normalised means lower case with everything but letters and digits as one space. Bigrams are counted
with repeats: dice = 2 * common / (a + b), where a and b are the numbers of bigrams. So a segment
can only reach THRESHOLD with a template if its own size lies within [b * t / (2 - t), b * (2 - t) / t]:
segments meet templates in an equi-join on the sizes that these bounds leave. Before that, a text must hold
at least one of a few words without which no template can reach the threshold; that set follows from
the templates.

All of it is DataFrame operations. Null and empty texts, and segments of fewer than two words, match nothing.
A licence has one row a document, with its best segment's coefficient and the number of segments that match.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.llm import common

THRESHOLD = 0.8
RUN = 3  # sentences; no template of a notice has more
SHORT, LONG = 3, 7  # letters

#: Paragraphs that whole licences are made of.
MIT_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
MIT_NOTICE = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
MIT_WARRANTY = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
ISC_WARRANTY = "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."

#: Notices, paragraphs and whole texts of public licences.
TEMPLATES = (
    ("MIT", f"{MIT_GRANT} {MIT_NOTICE} {MIT_WARRANTY}"),
    ("ISC", f"{ISC_GRANT} {ISC_WARRANTY}"),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", MIT_WARRANTY),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", MIT_GRANT),
    ("MIT", MIT_NOTICE),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-2-Clause", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("ISC", ISC_GRANT),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

_WORDS = r"[\p{L}\p{N}]+"
_PARAGRAPHS = r"\n[ \t\r]*\n"


def bounds(size: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """The sizes that can reach the threshold with a template of ``size`` bigrams."""
    return math.ceil(size * threshold / (2 - threshold) - 1e-9), math.floor(size * (2 - threshold) / threshold + 1e-9)


def normalised(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def gate_words(templates=TEMPLATES, threshold: float = THRESHOLD) -> list[str]:
    """Words of which every segment that reaches the threshold has at least one: without them each template
    would lack so many bigrams that even the best segment stays below. Words are taken greedily by
    how much of what still has to be ruled out they cover, long words first. Words of more than SHORT letters
    are looked for anywhere, and so cover the words that contain them."""
    sets = []
    for _, text in templates:
        words = normalised(text)
        b = len(words) - 1
        # Over all sizes a, common >= threshold * (a + b) / 2, least at the smallest a.
        need = math.ceil(threshold * (bounds(b, threshold)[0] + b) / 2 - 1e-9)
        sets.append([list(zip(words, words[1:], strict=False)), b - need + 1])
    covers = lambda w, pair: any(w in x if len(w) > SHORT else w == x for x in pair)
    chosen: list[str] = []
    while any(lack > 0 for _, lack in sets):
        gain: dict[str, int] = {}
        for pairs, lack in sets:
            if lack > 0:
                for w in {w for p in pairs for w in p}:
                    gain[w] = gain.get(w, 0) + min(lack, sum(covers(w, p) for p in pairs))
        best = max(gain, key=lambda w: (len(w) >= LONG, gain[w], len(w), w))
        chosen.append(best)
        for s in sets:
            kept = [p for p in s[0] if not covers(best, p)]
            s[1] -= len(s[0]) - len(kept)
            s[0] = kept
    return chosen


def template_sizes(spark, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(size, license, b, template, repeats): a row a template and size that its bounds allow. repeats are the bigrams
    that stand more than once in the template, with their counts."""
    rows = []
    for name, text in templates:
        words = normalised(text)
        grams = [f"{x} {y}" for x, y in zip(words, words[1:], strict=False)]
        repeats = [(g, grams.count(g)) for g in sorted(set(grams)) if grams.count(g) > 1]
        low, high = bounds(len(grams), threshold)
        rows += [(a, name, len(grams), sorted(set(grams)), repeats) for a in range(max(1, low), high + 1)]
    return spark.createDataFrame(rows, "size int, license string, b int, template array<string>, repeats array<struct<gram:string,n:int>>")


def _words(low: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(low, r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")


def _bigrams(words: Column) -> Column:
    return F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1), lambda a, b: F.concat_ws(" ", a, b))


def common_bigrams(grams: Column, template: Column, repeats: Column) -> Column:
    """Bigrams in common, counted with repeats: each shared one once, and again as often as both repeat it."""
    more = F.aggregate(repeats, F.lit(0), lambda acc, r: acc + F.greatest(F.lit(0), F.least(r["n"], F.size(F.filter(grams, lambda g: g == r["gram"]))) - 1))
    return F.size(F.array_intersect(grams, template)) + more


def pinned(df: DataFrame, value: Column, name: str) -> DataFrame:
    """df with a column that is computed once a row, however often filters after it name it."""
    return df.select(*df.columns, F.explode(F.array(value)).alias(name))


def holds_any(low: Column, words: list[str]) -> Column:
    """Whether a lower-case text may hold one of the words; short ones are looked for as whole words."""
    found = F.lit(False)
    for w in sorted(words, key=len, reverse=True):
        has = low.contains(w)
        found = found | (has if len(w) > SHORT else has & low.rlike(rf"(?<![\p{{L}}\p{{N}}]){w}(?![\p{{L}}\p{{N}}])"))
    return found


def _segments(low: DataFrame, gate: list[str]) -> DataFrame:
    """(id, segment) of lower-case texts (id, low): the segments that may hold a gate word. Sentences are computed once a row and numbered; a run is put together at
    each of its sentences that may hold such a word."""
    paragraphs = F.filter(F.split("low", _PARAGRAPHS), lambda p: F.trim(p, F.lit("\n")).contains("\n"))
    pieces = low.select("id", F.explode(F.concat(F.array("low"), F.split("low", "\n"), paragraphs)).alias("segment")).where(holds_any(F.col("segment"), gate))
    sentences = F.split(F.regexp_replace(F.regexp_replace("low", r"[ \t\r\n]+", " "), "([.!?]) ", "$1\n"), "\n")
    listed = pinned(low.select("id", "low"), sentences, "sentences").select("id", "sentences")
    found = listed.select("id", "sentences", F.posexplode("sentences").alias("at", "sentence")).where(holds_any(F.col("sentence"), gate)).select("id", "sentences", "at")
    runs = [(first, n) for n in range(1, RUN + 1) for first in range(1 - n, 1)]  # where a run of n begins, seen from a sentence in it
    whole = lambda first, n: (F.col("at") + first >= 0) & (F.col("at") + first + n <= F.size("sentences"))
    run = lambda first, n: F.when(whole(first, n), F.array_join(F.slice("sentences", F.col("at") + (first + 1), F.lit(n)), " "))
    joined = found.select("id", F.explode(F.array(*[run(*r) for r in runs])).alias("segment")).where("segment IS NOT NULL")
    return pieces.unionByName(joined)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(id, license, dice, n_segments) of every licence found."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), common.text_or_empty(text_col).alias("text"))
    gate = gate_words(templates, threshold)
    low = pinned(texts, F.lower("text"), "low").where(holds_any(F.col("low"), gate)).select("id", "low")
    segments = _segments(low, gate)
    sized = segments.withColumn("size", F.regexp_count("segment", F.lit(_WORDS)) - 1).where("size > 0")
    sizes = F.broadcast(template_sizes(spark, templates, threshold))
    grams = pinned(sized.join(sizes.select("size").distinct(), "size", "left_semi"), _words(F.col("segment")), "words")
    grams = grams.select("id", "size", "words", F.xxhash64("words").alias("segment"))
    grams = pinned(grams, _bigrams(F.col("words")), "grams").select("id", "size", "segment", "grams")
    dice = 2 * common_bigrams(F.col("grams"), F.col("template"), F.col("repeats")) / (F.col("size") + F.col("b"))
    met = pinned(grams.join(sizes, "size"), dice, "dice").where(F.col("dice") >= threshold)
    best = met.groupBy("id", "license").agg(F.round(F.max("dice"), 6).alias("dice"), F.count_distinct("segment").alias("n_segments"))
    return best.withColumnRenamed("id", id_col)


def op2(spark, sf_dir: str) -> DataFrame:
    """Licences in every text of documents."""
    return scan(common.table(spark, sf_dir, "documents"))


def _sql() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ", ".join(f"({k}, {quoted(n)}, {quoted(' '.join(normalised(t)))})" for k, (n, t) in enumerate(TEMPLATES))
    numbered = lambda src, key: f"SELECT {key}, pair, row_number() OVER (PARTITION BY {key}, pair ORDER BY i) AS nth FROM (SELECT {key}, i, w[i] || ' ' || w[i + 1] AS pair FROM (SELECT {key}, w, unnest(range(1, len(w))) AS i FROM {src}))"
    return f"""
WITH t AS (SELECT t, license, string_split(words, ' ') AS w FROM (VALUES {rows}) AS v(t, license, words)),
tg AS ({numbered("t", "t")}),
sent AS (SELECT doc_id, text, string_split(regexp_replace(regexp_replace(text, '[ \\t\\r\\n]+', ' ', 'g'), '([.!?]) ', '\\1' || chr(10), 'g'), chr(10)) AS st FROM documents WHERE text IS NOT NULL),
parts AS (SELECT doc_id, unnest(list_concat([text], string_split(text, chr(10)), list_filter(regexp_split_to_array(text, '\\n[ \\t\\r]*\\n'), lambda p: contains(trim(p, chr(10)), chr(10))), st, {", ".join(f"list_transform(range(1, len(st) - {n} + 2), lambda i: array_to_string(st[i:i + {n - 1}], ' '))" for n in range(2, RUN + 1))})) AS segment FROM sent),
seg AS (SELECT doc_id, w, row_number() OVER () AS s FROM (SELECT DISTINCT doc_id, regexp_extract_all(lower(segment), '[\\p{{L}}\\p{{N}}]+') AS w FROM parts) d),
sg AS ({numbered("seg", "s")}),
hit AS (SELECT s, t, count(*) AS common FROM sg JOIN tg USING (pair, nth) GROUP BY s, t),
met AS (SELECT doc_id, license, s, 2 * common / (len(seg.w) + len(t.w) - 2) AS dice FROM hit JOIN seg USING (s) JOIN t USING (t))
SELECT doc_id, license, round(max(dice), 6) AS dice, count(DISTINCT s) AS n_segments FROM met WHERE dice >= {THRESHOLD} GROUP BY doc_id, license
"""


OP2_SQL = _sql()
