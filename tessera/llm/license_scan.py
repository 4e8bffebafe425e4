"""License scans: every line, whole text and window of words compared with licence templates.

Text is normalised (A-Z lower-cased, ``licence`` spelled ``license``, every run
of other characters than letters and digits one space) and becomes its set of
word bigrams.  The Dice coefficient of two sets is 2 |A and B| / (|A| + |B|);
it can only reach ``least`` when |A| lies between least / (2 - least) and
(2 - least) / least times |B|, so templates of other sizes are never compared.
All of it is DataFrame functions on the row itself: no shuffle, no Python.

A notice that is wrapped over lines or stands beside other words is found by
windows of the text's words.  A window of a template goes from the start of one
run of shared bigrams to the end of the same or a later run, and is no longer than
its edges lie apart in the template and the size bound lets words come in; so the
end of one notice and the beginning of the next make no window.  What a window
repeats of a bigram more often than its template does counts once more each in |A|:
so two notices one after the other, whose sets complete each other, are no better
window than each alone.  A window is a hit of its own unless a line that hits holds
it or lies across its edge, a better one of the others overlaps it, or the whole
text hits with the same licence (a text of few notices alone is one hit).

Defined cases: a null or empty text has no hit; equal scores go to the earlier
template and line, of windows to the longer one; rows that repeat an id each get a row; a unit of fewer than
two words has no bigram and never hits; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ascii_lower

#: Fixed values: (licence, template), one-line notices and standard texts of the public licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                   "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                   "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions: The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
            "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
            "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
            "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
            "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
                "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                    "provided that the following conditions are met: 1. Redistributions of source code must retain the "
                    "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
                    "binary form must reproduce the above copyright notice, this list of conditions and the following "
                    "disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE "
                    "IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
                    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
                    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE "
                    "FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT "
                    "NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
                    "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
                    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
                    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                    "provided that the following conditions are met: 1. Redistributions of source code must retain the "
                    "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
                    "binary form must reproduce the above copyright notice, this list of conditions and the following "
                    "disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither "
                    "the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                    "products derived from this software without specific prior written permission. THIS SOFTWARE IS "
                    "PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
                    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
                    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE "
                    "FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT "
                    "NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
                    "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
                    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
                    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
           "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
           "copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
           "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
           "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
           "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE "
           "OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
           "SOFTWARE."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH "
            "REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
            "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
            "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
            "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
            "THIS SOFTWARE."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the "
            "authors be held liable for any damages arising from the use of this software. Permission is granted "
            "to anyone to use this software for any purpose, including commercial applications, and to alter it "
            "and redistribute it freely, subject to the following restrictions: 1. The origin of this software "
            "must not be misrepresented; you must not claim that you wrote the original software. If you use this "
            "software in a product, an acknowledgment in the product documentation would be appreciated but is "
            "not required. 2. Altered source versions must be plainly marked as such, and must not be "
            "misrepresented as being the original software. 3. This notice may not be removed or altered from any "
            "source distribution."),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the "
               "software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, "
               "display, distribute, execute, and transmit the Software, and to prepare derivative works of the "
               "Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the "
               "following: The copyright notices in the Software and this entire statement, including the above "
               "license grant, this restriction and the following disclaimer, must be included in all copies of the "
               "Software, in whole or in part, and all derivative works of the Software, unless such copies or "
               "derivative works are solely in the form of machine-executable object code generated by a source "
               "language processor. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR "
               "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
               "PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING "
               "THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, "
               "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
               "SOFTWARE."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
                 "modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
                 "compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("GPL-2.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
               "General Public License as published by the Free Software Foundation, either version 2 of the "
               "License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "Lesser General Public License as published by the Free Software Foundation, either version 2.1 of "
                "the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "Lesser General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
               "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and "
               "neighboring rights to this software to the public domain worldwide. This software is distributed "
               "without any warranty."),
)


@dataclass(frozen=True)
class Template:
    name: str
    bigrams: tuple[str, ...]
    low: int
    high: int
    first: tuple[int, ...]  # place of each bigram in the template
    last: tuple[int, ...]  # its last place, if it comes again
    repeats: tuple[tuple[str, int], ...]  # bigrams that come again, and how often
    reach: int  # bigrams of a window at most, with repeated ones


def prepare(templates, least: float) -> list[Template]:
    """Bigram sets and size bounds; counts are whole, so the bounds are rounded inwards."""
    out = []
    for name, text in templates:
        words = re.sub(r"[\W_]+", " ", text.lower().replace("licence", "license")).split()
        pairs = tuple(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))
        n = len(pairs)
        low = next(s for s in range(1, n + 1) if 2.0 * s / (s + n) >= least)
        high = next(s for s in range(8 * n + 8, n - 1, -1) if 2.0 * n / (s + n) >= least)
        places = [f"{a} {b}" for a, b in zip(words, words[1:])]
        again, last = Counter(places) - Counter(pairs), {b: i for i, b in enumerate(places)}
        out.append(Template(name, pairs, low, high, tuple(map(places.index, pairs)), tuple(last[b] for b in pairs), tuple(again.items()), high + again.total()))
    return out


def words_of(unit: Column) -> Column:
    text = F.regexp_replace(ascii_lower(unit), r"[^\p{L}\p{N}]+", " ")
    return F.split(F.btrim(F.replace(text, F.lit("licence"), F.lit("license"))), " ", -1)


def _pairs(w: Column) -> Column:
    return F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))),
                      lambda a, b: F.concat(a, F.lit(" "), b))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def bigrams(unit: Column) -> Column:
    return _let(words_of(unit), lambda w: F.array_distinct(_pairs(w)))


def _windows(lines: Column, whole: Column, known: list[Template], least: float) -> Column:
    """Windows that reach ``least``: dice, size, template, line (both negative), from and to (places of bigrams), first and
    last line, and whether the window begins and ends with a line."""
    templates = F.array(*[F.struct(F.lit(-n).alias("template"), F.array(*map(F.lit, t.bigrams)).alias("bigrams"), F.lit(t.low).alias("low"),
                                   F.lit(t.high - len(t.bigrams)).alias("spare"), F.array(*map(F.lit, t.first)).alias("first"),
                                   F.array(*map(F.lit, t.last)).alias("last"), F.array(*[F.struct(F.lit(b).alias("b"), F.lit(c).alias("c")) for b, c in t.repeats]).cast(
                                       "array<struct<b:string,c:int>>").alias("repeats"), F.lit(t.reach).alias("reach")) for n, t in enumerate(known)])
    every = list(dict.fromkeys(b for t in known for b in t.bigrams))
    none = F.lit(False)

    def of(t: Column, g: Column, at: Column) -> Column:
        def window(s: Column, e: Column) -> Column:
            places = F.slice(g, s + 1, e - s + 1)
            own = F.array_distinct(places)
            again = F.aggregate(t["repeats"], e - s + 1 - F.size(own), lambda n, r: n - F.least(
                r["c"], F.greatest(F.size(F.filter(places, lambda b: b == r["b"])) - 1, F.lit(0))))
            score = F.lit(2.0) * F.size(F.array_intersect(own, t["bigrams"])) / (F.size(own) + again + F.size(t["bigrams"]))
            first, last = F.get(at, s), F.get(at, e + 1)
            return F.struct(score.alias("dice"), (e - s).alias("size"), t["template"].alias("template"), (-first).alias("line"), (-s).alias("from"),
                            (-e).alias("to"), first.alias("first"), last.alias("last"),
                            F.coalesce(F.get(at, s - 1) != first, ~none).alias("opens"),
                            F.coalesce(F.get(at, e + 2) != last, ~none).alias("closes"))

        def place(which: str, i: Column) -> Column:
            return F.get(t[which], F.array_position(t["bigrams"], F.get(g, i)).cast("int") - 1)

        def runs(shared: Column) -> Column:
            def edge(step: int) -> Column:
                return F.filter(F.transform(shared, lambda x, i: F.when(x & ~F.coalesce(F.get(shared, i + step), none), i)),
                                lambda i: i.isNotNull())

            starts = F.filter(edge(-1), lambda s: F.size(F.filter(F.slice(shared, s + 1, t["reach"]), lambda x: x)) >= t["low"])
            return F.when(F.size(starts) > 0, _let(edge(1), lambda ends: F.flatten(F.transform(starts, lambda s: F.transform(
                F.filter(ends, lambda e: (e - s + 1).between(t["low"], t["reach"]) & (
                    e - s <= place("last", e) - place("first", s) + t["spare"])), lambda e: window(s, e))))))

        found = _let(F.transform(g, lambda b: F.array_contains(t["bigrams"], b)), runs)
        return F.filter(F.coalesce(found, F.array().cast(WINDOWS)), lambda x: x["dice"] >= least)

    def all_of(fit: Column) -> Column:
        words = F.transform(lines, lambda x: F.filter(words_of(x), lambda w: w != ""))
        return F.when(F.size(fit) > 0, _let(words, lambda ws: _let(
            F.flatten(F.transform(ws, lambda w, i: F.transform(w, lambda _: i))),
            lambda at: _let(_pairs(F.flatten(ws)), lambda g: F.flatten(F.transform(fit, lambda t: of(t, g, at)))))))

    shared = F.filter(whole, lambda b: b.isin(every))  # seldom enough for any template
    fit = _let(shared, lambda x: F.filter(templates, lambda t: F.size(F.array_intersect(x, t["bigrams"])) >= t["low"]))
    return F.coalesce(_let(fit, all_of), F.array().cast(WINDOWS))


WINDOWS = "array<struct<dice:double,size:int,template:int,line:int,from:int,to:int,first:int,last:int,opens:boolean,closes:boolean>>"


def _own_hits(windows: Column, hits: Column, lines: Column, names: Column) -> Column:
    """The windows that are hits of their own, as (dice, template, line)."""
    def by_line(x: Column) -> Column:
        def by(h: Column) -> Column:
            line = -h["line"]
            cut = ((x["first"] == line) & ~x["opens"]) | ((x["last"] == line) & ~x["closes"])
            return (line < F.size(lines)) & (((x["first"] == line) & (x["last"] == line)) | cut)
        return F.exists(hits, by)

    def by_whole(x: Column) -> Column:
        return F.exists(hits, lambda h: (-h["line"] == F.size(lines)) & (F.get(names, -h["template"]) == F.get(names, -x["template"])))

    def add(kept: Column, x: Column) -> Column:
        over = F.exists(kept, lambda k: (-k["from"] <= -x["to"]) & (-x["from"] <= -k["to"]))
        return F.when(over, kept).otherwise(F.concat(kept, F.array(x)))

    best = F.reverse(F.array_sort(F.filter(windows, lambda x: ~by_line(x))))
    return F.transform(F.filter(F.aggregate(best, F.array().cast(WINDOWS), add), lambda x: ~by_whole(x)),
                       lambda x: F.struct(x["dice"].alias("dice"), x["template"].alias("template"), x["line"].alias("line")))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES,
         least: float = 0.8) -> DataFrame:
    """Per row: ``id_col``, n_lines, n_hits, licenses (sorted, comma-joined), and of the best hit license, line, dice.

    A line counts from 0; the whole text is the unit after the last line, and a window counts by the line it begins in.
    Without a hit: "", -1, 0.
    """
    known = prepare(templates, least)
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.split(text, "\n", -1)
    rows = df.select(F.col(id_col), F.size(lines).cast("long").alias("n_lines"),
                     F.transform(F.when(F.size(lines) > 1, F.concat(lines, F.array(text))).otherwise(lines), bigrams).alias("units"),
                     lines.alias("lines"))

    every = list(dict.fromkeys(b for t in known for b in t.bigrams))
    fewest = min((t.low for t in known), default=1)
    spans: list[tuple[int, int]] = []
    for t in sorted(known, key=lambda t: t.low):
        if spans and t.low <= spans[-1][1] + 1:
            spans[-1] = spans[-1][0], max(spans[-1][1], t.high)
        else:
            spans.append((t.low, t.high))

    def dice(b: Column, t: Template) -> Column:
        return F.when(F.size(b).between(t.low, t.high),
                      F.lit(2.0) * F.size(F.filter(b, lambda x: x.isin(list(t.bigrams)))) / (F.size(b) + len(t.bigrams))
                      ).otherwise(0.0)

    def best(b: Column, i: Column) -> Column:
        sized = F.lit(False)
        for low, high in spans:
            sized |= F.size(b).between(low, high)
        sized &= F.size(F.filter(b, lambda x: x.isin(every))) >= fewest  # no template can reach `least` with fewer
        scores = F.array_max(F.array(*[F.struct(dice(b, t).alias("dice"), F.lit(-n).alias("template"), (-i).alias("line"))
                                       for n, t in enumerate(known)]))
        return F.when(sized, scores)

    hits = F.filter(F.transform("units", best), lambda s: s["dice"] >= least)
    names = F.array(*[F.lit(t.name) for t in known])
    found = rows.select(id_col, "n_lines", "lines", hits.alias("hits"),
                        _windows(F.col("lines"), F.element_at("units", -1), known, least).alias("windows"))
    found = found.select(id_col, "n_lines", F.when(F.size("windows") > 0, F.concat(
        "hits", _own_hits(F.col("windows"), F.col("hits"), F.col("lines"), names))).otherwise(F.col("hits")).alias("hits"))
    found = found.withColumn("best", F.array_max("hits"))
    return found.select(
        id_col, "n_lines", F.size("hits").cast("long").alias("n_hits"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("hits", lambda s: F.get(names, -s["template"])))), ",").alias("licenses"),
        F.coalesce(F.get(names, -F.col("best.template")), F.lit("")).alias("license"),
        F.coalesce((-F.col("best.line")).cast("long"), F.lit(-1).cast("long")).alias("line"),
        F.coalesce(F.col("best.dice"), F.lit(0.0)).alias("dice"))


def oracle(templates=TEMPLATES, least: float = 0.8) -> str:
    """The same in DuckDB SQL."""
    rows = ",\n".join("({}, '{}', [{}])".format(n, t.name, ", ".join(f"'{b}'" for b in t.bigrams))
                      for n, t in enumerate(prepare(templates, least)))
    return rf"""
WITH t(tid, name, tb) AS (VALUES {rows}),
l AS (SELECT doc_id, coalesce(text, '') AS txt, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
u AS (SELECT doc_id, unnest(us) AS unit, generate_subscripts(us, 1) - 1 AS line
      FROM (SELECT doc_id, CASE WHEN len(ls) > 1 THEN list_append(ls, txt) ELSE ls END AS us FROM l)),
w AS (SELECT doc_id, line, string_split(trim(replace(regexp_replace(
        translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\p{{L}}\p{{N}}]+', ' ', 'g'),
        'licence', 'license')), ' ') AS ws FROM u),
b AS (SELECT doc_id, line, list_distinct([ws[i] || ' ' || ws[i + 1] for i in range(1, len(ws))]) AS bs FROM w),
s AS (SELECT doc_id, line, tid, name, 2.0::DOUBLE * len(list_intersect(bs, tb)) / (len(bs) + len(tb)) AS dice FROM b, t),
h AS (SELECT * FROM s WHERE dice >= {least}
      QUALIFY row_number() OVER (PARTITION BY doc_id, line ORDER BY dice DESC, tid) = 1),
best AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, tid, line) = 1),
g AS (SELECT doc_id, count(*) AS n_hits, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses FROM h GROUP BY doc_id)
SELECT l.doc_id, CAST(len(ls) AS BIGINT) AS n_lines, coalesce(n_hits, 0) AS n_hits, coalesce(licenses, '') AS licenses,
       coalesce(best.name, '') AS license, coalesce(CAST(best.line AS BIGINT), -1) AS line, coalesce(best.dice, 0) AS dice
FROM l LEFT JOIN g ON l.doc_id = g.doc_id LEFT JOIN best ON l.doc_id = best.doc_id
"""
