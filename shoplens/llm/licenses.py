"""License notices in texts: MinHash bands retrieve templates, shingles verify them.

Texts are cut into words (letters and digits, lower-cased) and overlapping windows
twice as long as a template's length class, half a window apart, so any occurrence of
a template lies whole in one window. A window's MinHash values are bands of one row
each; a shared band makes a candidate. A window that holds 80 % of a template's
shingles has Jaccard similarity s with it, and is missed with probability
(1 - s) ^ BANDS only: for the worst length below 1e-9. Candidates are verified by
exact containment of their five-word shingles.

A window without any template shingle shares no band with a template, so bands are
made only where a shingle's hash occurs among the templates of that length class. All work is DataFrame
functions on whole texts; texts are not shuffled, only windows that hold a notice
meet the templates (broadcast by Spark's own size threshold, else joined).

A template of fewer than five words is one shingle of its own word count; it is looked up
among the texts' shingles of that count (made only for counts that the list holds).

Defined results: null and empty texts hold nothing; a text of fewer than five words is
one shingle; of windows that hold a template equally, the first is reported; repeated rows
are reported each; extra columns are ignored; no templates give no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import doc_columns, with_uid, written

SHINGLE, CONTAINMENT, BANDS = 5, 0.8, 128

# Public notices, as their licences word them; pass others as ``templates``.
LONG_TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                      "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-file": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                       "in compliance with the License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-file": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                    "General Public License as published by the Free Software Foundation",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                          "provided that the following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
# Whole texts of short public licences, and notices to be put at the head of files.
FULL_TEXTS = {
    "MIT-text": """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions of
        the Software.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
        THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
        AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
        CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
        IN THE SOFTWARE.""",
    "ISC-text": """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
        ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
        DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
        WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
        USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-3-Clause-text": """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met:
        1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
        following disclaimer.
        2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
        following disclaimer in the documentation and/or other materials provided with the distribution.
        3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
        products derived from this software without specific prior written permission.
        THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
        INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
        DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
        SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
        SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
        WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE
        USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Zlib-text": """
        This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software.
        Permission is granted to anyone to use this software for any purpose, including commercial applications, and to
        alter it and redistribute it freely, subject to the following restrictions:
        1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
        software. If you use this software in a product, an acknowledgment in the product documentation would be
        appreciated but is not required.
        2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
        software.
        3. This notice may not be removed or altered from any source distribution.""",
    "Unlicense-text": """
        This is free and unencumbered software released into the public domain.
        Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code
        form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
        In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all
        copyright interest in the software to the public domain. We make this dedication for the benefit of the public at
        large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of
        relinquishment in perpetuity of all present and future rights to this software under copyright law.""",
    "Apache-2.0-header": """
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
        the specific language governing permissions and limitations under the License.""",
    "GPL-3.0-header": """
        This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version.
        This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
        warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details.""",
    "MPL-2.0-header": """
        This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
}
# Notices of fewer than five words.
SHORT_TEMPLATES = {
    "rights-reserved": "All rights reserved.",
    "Apache-2.0-name": "Apache License 2.0",
    **{f"SPDX-{x}": f"SPDX-License-Identifier: {x}" for x in ("MIT", "Unlicense", "ISC")},
}
TEMPLATES = LONG_TEMPLATES | FULL_TEXTS | SHORT_TEMPLATES


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def length_class(n_words: int) -> int:
    """Template lengths in steps of a quarter, five words at least."""
    size = SHINGLE
    while size < n_words:
        size = max(size + 1, size * 5 // 4)
    return size


def template_rows(templates: dict[str, str]) -> list[tuple[str, int, list[str]]]:
    """(name, length class, distinct shingles) of templates that have words."""
    out = []
    for name, text in templates.items():
        w = words_of(text)
        if w:
            shingles = [" ".join(w[i:i + SHINGLE]) for i in range(max(1, len(w) - SHINGLE + 1))]
            out.append((name, length_class(len(w)), list(dict.fromkeys(shingles))))
    return out


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _starts(words: Column) -> Column:
    return F.sequence(F.lit(0), F.greatest(F.size(words) - SHINGLE, F.lit(0)))


def _shingle_texts(words: Column) -> Column:
    """The shingles of a short list of words, as text."""
    return F.transform(_starts(words), lambda i: F.array_join(F.slice(words, i + 1, F.lit(SHINGLE)), " "))


def _shingle_hashes(words: Column) -> Column:
    """Hash of each shingle; places beyond the last word are null and hash as such."""
    return F.transform(_starts(words), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)]))


def _short_hits(words: Column, wanted: Column, size: int) -> Column:
    """Place and text of each shingle of ``size`` words whose hash is wanted."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - size, F.lit(0)))
    places = F.filter(starts, lambda i: F.array_contains(wanted, F.xxhash64(*[F.get(words, i + k) for k in range(size)])))
    return F.transform(places, lambda i: F.struct(
        i.alias("p"), F.array_join(F.slice(words, i + 1, F.lit(size)), " ").alias("shingle")))


def _min_hashes(hashes: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)),
                       lambda b: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, b))))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, license, containment, first_word, window_words: the best window of every
    text and template it holds at least ``containment`` of."""
    rows = template_rows(templates)
    d = doc_columns(docs, {"doc_id": "doc_id", "text": "text"})
    if not rows:
        return d.limit(0).select("doc_id", F.lit("").alias("license"), F.lit(0.0).alias("containment"),
                                 F.lit(0).cast("long").alias("first_word"), F.lit(0).alias("window_words"))
    # one shingle is a whole template of fewer than five words
    short = [(name, s[0]) for name, _, s in rows if s[0].count(" ") < SHINGLE - 1]
    rows = [r for r in rows if r[2][0].count(" ") >= SHINGLE - 1]
    if short and not rows:
        return _scan_short(d, short, containment)
    if short:
        return _scan_long(d, rows, containment).unionByName(_scan_short(d, short, containment))
    return _scan_long(d, rows, containment)


def _scan_short(d: DataFrame, short: list[tuple[str, str]], containment: float) -> DataFrame:
    """``scan`` for templates of one shingle: the first window that holds it whole."""
    known = d.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("license"), F.lit(s).alias("shingle"), F.lit(s.count(" ") + 1).alias("size"))
        for name, s in short])))
    words = F.split("shingle", " ")
    hashes = known.select(F.xxhash64(*[F.get(words, F.lit(k)) for k in range(SHINGLE)])).distinct().collect()
    wanted = F.array(*[F.lit(r[0]) for r in hashes])
    hits = F.concat(*[_short_hits(F.col("words"), wanted, n) for n in sorted({s.count(" ") + 1 for _, s in short})])
    held = with_uid(d.select("doc_id", _words(F.col("text").cast("string")).alias("words")).withColumn("hits", hits)) \
        .filter((F.size("words") > 0) & (F.size("hits") > 0))
    found = held.select("_uid", "doc_id", F.size("words").alias("n"), F.inline("hits")).join(known, "shingle")
    best = found.groupBy("_uid", "license").agg(F.min(F.struct("p", "n", "size", "doc_id")).alias("b"))
    # windows are twice SHINGLE long, SHINGLE apart
    first = F.greatest(F.ceil((F.col("b.p") + F.col("b.size") - 2 * SHINGLE) / SHINGLE).cast("int"), F.lit(0)) * SHINGLE
    return best.filter(F.lit(containment) <= 1).select(
        "b.doc_id", "license", F.lit(1.0).alias("containment"), first.cast("long").alias("first_word"),
        F.least(F.lit(2 * SHINGLE), F.col("b.n") - first).alias("window_words"))


def _scan_long(d: DataFrame, rows: list[tuple[str, int, list[str]]], containment: float) -> DataFrame:
    """``scan`` for templates of five words or more."""
    spark = d.sparkSession
    # the templates are a parameter: their table is as large as the caller's list
    known = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("license"), F.lit(c).alias("class"), F.array(*map(F.lit, s)).alias("t_shingles"))
        for name, c, s in rows])))
    known = known.withColumn("t_hashes", F.transform("t_shingles", lambda s: F.xxhash64(
        *[F.get(F.split(s, " "), F.lit(k)) for k in range(SHINGLE)])))
    of_class: dict[int, set[int]] = {}
    for r in known.select("class", "t_hashes").collect():
        of_class.setdefault(r[0], set()).update(r[1])
    hashes = sorted(set().union(*of_class.values()))
    t_bands = known.select("license", "class", F.posexplode(_min_hashes(F.col("t_hashes"))).alias("band", "value"))

    # places of wanted hashes; Spark looks them up in one set, however long the list is
    hits = F.filter(F.transform("hashes", lambda h, i: F.when(h.isin(hashes), i)), lambda i: i.isNotNull())
    # the row id stands above the hits: a filter doesn't sink below it, so words and
    # hashes are made once for each text
    held = with_uid(d.select("doc_id", _words(F.col("text").cast("string")).alias("words"))
                    .withColumn("hashes", _shingle_hashes(F.col("words")))
                    .withColumn("hits", hits)) \
        .filter((F.size("words") > 0) & (F.size("hits") > 0))
    # windows that cover a hit, of the classes whose templates hold its shingle: two at most
    # of a class, as they overlap by half
    def covering(p: Column, c: int, mine: set[int]) -> Column:
        k = F.floor(p / c).cast("int")
        ours = F.get("hashes", p).isin(sorted(mine))
        return F.filter(F.array(*[F.struct(F.lit(c).alias("class"), x.alias("k")) for x in (k, k - 1)]),
                        lambda w: ours & (w.k >= 0) & (p <= w.k * c + 2 * c - SHINGLE))

    windows = F.array_distinct(F.flatten(F.transform("hits", lambda p: F.concat(
        *[covering(p, c, mine) for c, mine in sorted(of_class.items())]))))
    windows = written(held.select("_uid", "doc_id", "words", "hashes", F.explode(windows).alias("w")).select(
        "_uid", "doc_id", "w.class", (F.col("w.k") * F.col("w.class")).alias("first_word"),
        F.expr("slice(words, w.k * w.class + 1, 2 * w.class)").alias("words"),
        F.expr(f"slice(hashes, w.k * w.class + 1, greatest(2 * w.class - {SHINGLE - 1}, 1))").alias("hashes")))
    bands = windows.select("_uid", "class", "first_word", F.posexplode(_min_hashes(F.col("hashes"))).alias("band", "value"))
    candidates = bands.join(t_bands, ["class", "band", "value"]).select("_uid", "class", "first_word", "license").distinct()
    shared = F.size(F.array_intersect(_shingle_texts(F.col("words")), F.col("t_shingles"))) / F.size("t_shingles")
    verified = windows.join(candidates, ["_uid", "class", "first_word"]).join(known, ["license", "class"]) \
        .withColumn("containment", shared).filter(F.col("containment") >= containment)
    best = verified.groupBy("_uid", "license").agg(F.max(F.struct(
        "containment", (-F.col("first_word")).alias("_first"), F.size("words").alias("n"), "doc_id")).alias("b"))
    return best.select("b.doc_id", "license", "b.containment", (-F.col("b._first")).cast("long").alias("first_word"),
                       F.col("b.n").alias("window_words"))


def oracle_sql(templates: dict[str, str] = TEMPLATES, containment: float = CONTAINMENT) -> str:
    """DuckDB SQL for ``scan``: containment in every window, by exact shingles; a template of fewer
    than five words is one shingle of its own word count."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    rows = template_rows(templates)
    size = lambda s: s.count(" ") + 1
    values = ", ".join(f"({quote(name)}, {c}, {quote(s)}, {len(all_)})" for name, c, all_ in rows
                       for s in all_ if size(s) >= SHINGLE)
    short = ", ".join(f"({quote(name)}, {quote(s)}, {size(s)})" for name, _, (s, *_) in rows if size(s) < SHINGLE)
    return f"""
        WITH t(license, class, shingle, n) AS (VALUES {values}),
        u(license, shingle, size) AS (VALUES {short}),
        w AS (SELECT row_number() OVER () AS uid, doc_id,
                     list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS words
              FROM documents),
        p AS (SELECT uid, doc_id, words, unnest(range(0, greatest(len(words) - {SHINGLE - 1}, 1)::BIGINT)) AS p
              FROM w WHERE len(words) > 0),
        s AS (SELECT uid, doc_id, len(words) AS n_words, p, array_to_string(words[p + 1:p + {SHINGLE}], ' ') AS shingle FROM p),
        h AS (SELECT uid, doc_id, n_words, license, class, n, shingle, p, unnest([p // class, p // class - 1]) AS k
              FROM s JOIN t USING (shingle)),
        c AS (SELECT uid, doc_id, license, class * k AS first_word, least(2 * class, n_words - class * k) AS window_words,
                     count(DISTINCT shingle) / max(n)::DOUBLE AS containment
              FROM h WHERE k >= 0 AND p <= class * k + 2 * class - {SHINGLE} GROUP BY ALL),
        b AS (SELECT *, row_number() OVER (PARTITION BY uid, license ORDER BY containment DESC, first_word) AS r
              FROM c WHERE containment >= {containment}),
        z AS (SELECT DISTINCT size FROM u),
        y AS (SELECT uid, doc_id, words, size, unnest(range(0, len(words) - size + 1)) AS p FROM w, z WHERE len(words) >= size),
        x AS (SELECT uid, doc_id, len(words) AS n_words, size, p, array_to_string(words[p + 1:p + size], ' ') AS shingle FROM y),
        m AS (SELECT uid, doc_id, n_words, license, size, min(p) AS p FROM x JOIN u USING (shingle, size) GROUP BY ALL),
        f AS (SELECT *, greatest(ceil((p + size - {2 * SHINGLE}) / {SHINGLE}.0), 0)::BIGINT * {SHINGLE} AS first FROM m)
        SELECT doc_id, license, containment, first_word::BIGINT AS first_word, window_words::INTEGER AS window_words
        FROM b WHERE r = 1
        UNION ALL
        SELECT doc_id, license, 1.0::DOUBLE, first, least({2 * SHINGLE}, n_words - first)::INTEGER FROM f"""
