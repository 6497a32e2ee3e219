"""Licence scan: Dice coefficient over word bigrams against licence templates, in DataFrame functions only.

A text is scanned by lines, by paragraphs (lines up to a blank one) and as a whole.  Each segment is normalised (lower
case, runs of other characters than letters and digits as one space) and becomes its set of word bigrams.  With a
threshold t, only templates whose number of bigrams lies between t / (2 - t) and (2 - t) / t of the segment's can
reach it; the others are pruned before any comparison.

``running`` also compares windows of each template's number of words, at every place of the whole normalised text.  To
reach t, a segment or window must hold at least t / (2 - t) of a template's n bigrams, so it holds one of any
n - ceil(n * t / (2 - t)) + 1 of them: the longest ones serve as anchors.  A text without any anchor has no match, and
only windows over an anchor are scored; neither leaves out a match.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
#: Notices and grants as the licences or their authors word them.
TEMPLATES = {
    "Apache-2.0 header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0 notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0 header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "ISC grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "MIT notice": "Released under the MIT License.",
    "MPL-2.0 header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
}
_CC = "This work is licensed under a Creative Commons Attribution-{} 4.0 International License."
_GNU = "This work is licensed under the GNU {} License, version {}."
_GNU_HEADER = "This {} is free software: you can redistribute it and/or modify it under the terms of the GNU {} License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
_BSD = TEMPLATES["BSD-2-Clause grant"] + " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. {}Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
#: Licences worded so much like one of ``TEMPLATES`` that they would be taken for it.
SIBLINGS = {
    "AGPL-3.0 header": _GNU_HEADER.format("program", "Affero General Public", "3"),
    "AGPL-3.0 notice": _GNU.format("Affero General Public", "3"),
    "BSD-3-Clause text": _BSD.format("3. "),
    "BSD-4-Clause text": _BSD.format("3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the copyright holder. 4. "),
    "CC-BY-4.0 short notice": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0 long notice": _CC.format("NonCommercial"),
    "CC-BY-NC-ND-4.0 notice": _CC.format("NonCommercial-NoDerivatives"),
    "CC-BY-NC-ND-4.0 short notice": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-NC-SA-4.0 notice": _CC.format("NonCommercial-ShareAlike"),
    "CC-BY-NC-SA-4.0 short notice": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-ND-4.0 notice": _CC.format("NoDerivatives"),
    "CC-BY-ND-4.0 short notice": "Licensed under CC BY-ND 4.0.",
    "CC-BY-SA-4.0 short notice": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0 header": _GNU_HEADER.format("program", "General Public", "2"),
    "GPL-2.0 notice": _GNU.format("General Public", "2"),
    "LGPL-2.0 header": _GNU_HEADER.format("library", "Library General Public", "2"),
    "LGPL-2.0 notice": _GNU.format("Library General Public", "2"),
    "LGPL-2.1 header": _GNU_HEADER.format("library", "Lesser General Public", "2.1"),
    "LGPL-2.1 notice": _GNU.format("Lesser General Public", "2.1"),
    "LGPL-3.0 header": _GNU_HEADER.format("program", "Lesser General Public", "3"),
    "LGPL-3.0 notice": _GNU.format("Lesser General Public", "3"),
}
_BSD_GRANT, _BSD_DISCLAIMER = _BSD.split(" {}Neither")[0], "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_GNU_OPENING = "GNU {} LICENSE Version {} Copyright (C) {} Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."
_CC_OPENING = "Creative Commons {0} 4.0 International Public License By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this Creative Commons {0} 4.0 International Public License (\"Public License\")."
#: Whole licence texts, and of the long ones how they open, as licence files hold them.
TEXTS = {
    "AGPL-3.0 text": _GNU_OPENING.format("AFFERO GENERAL PUBLIC", "3, 19 November 2007", "2007"),
    "Apache-2.0 text": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. \"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document. \"Licensor\" shall mean the copyright owner or entity authorized by the copyright owner that is granting the License.",
    "BSD-2-Clause full text": f"{_BSD_GRANT} {_BSD_DISCLAIMER}",
    "BSD-3-Clause full text": f"{_BSD.format('3. ')} {_BSD_DISCLAIMER}",
    "CC-BY-4.0 text": _CC_OPENING.format("Attribution"),
    "CC-BY-NC-4.0 text": _CC_OPENING.format("Attribution-NonCommercial"),
    "CC-BY-NC-ND-4.0 text": _CC_OPENING.format("Attribution-NonCommercial-NoDerivatives"),
    "CC-BY-NC-SA-4.0 text": _CC_OPENING.format("Attribution-NonCommercial-ShareAlike"),
    "CC-BY-ND-4.0 text": _CC_OPENING.format("Attribution-NoDerivatives"),
    "CC-BY-SA-4.0 text": _CC_OPENING.format("Attribution-ShareAlike"),
    "GPL-2.0 text": _GNU_OPENING.format("GENERAL PUBLIC", "2, June 1991", "1989, 1991"),
    "GPL-3.0 text": _GNU_OPENING.format("GENERAL PUBLIC", "3, 29 June 2007", "2007"),
    "ISC text": TEMPLATES["ISC grant"] + " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "LGPL-2.1 text": _GNU_OPENING.format("LESSER GENERAL PUBLIC", "2.1, February 1999", "1991, 1999"),
    "LGPL-3.0 text": _GNU_OPENING.format("LESSER GENERAL PUBLIC", "3, 29 June 2007", "2007"),
    "MIT text": TEMPLATES["MIT grant"] + " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "MPL-2.0 text": "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software. 1.2. \"Contributor Version\" means the combination of the Contributions of others (if any) used by a Contributor and that particular Contributor's Contribution.",
    "Zlib text": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
}
ALL = TEMPLATES | SIBLINGS | TEXTS
NOT_WORD = r"[^\p{L}\p{N}]+"


def _words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), NOT_WORD, " ")), " ")


def _pairs(words: Column) -> Column:
    """64-bit hashes of the pairs of neighbouring words."""
    pairs = F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1)))
    return F.when(F.size(words) > 1, pairs).otherwise(F.array().cast("array<bigint>"))


def _bigrams(words: Column) -> Column:
    return F.array_distinct(_pairs(words))


def _anchors(words: list[str], threshold: float) -> list[tuple[str, str]]:
    """The bigrams of which every segment or window in reach of a template holds one."""
    pairs = sorted(set(zip(words, words[1:])), key=lambda p: (-len(p[0]) - len(p[1]), p))
    return pairs[:len(pairs) - math.ceil(len(pairs) * threshold / (2 - threshold) - 1e-9) + 1]


def _one_of(anchors: set[tuple[str, str]]) -> str:
    """Pattern that finds one of ``anchors`` in a lower-case text; common beginnings are tried once."""
    trie: dict[str, dict] = {}
    for a, b in anchors:
        node = trie
        for letter in (*a, " ", *b, ""):  # "" ends a pair
            node = node.setdefault(letter, {})

    def pattern(node: dict[str, dict]) -> str:
        parts = [(NOT_WORD if x == " " else re.escape(x)) + pattern(child) for x, child in sorted(node.items()) if x]
        body = parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})" if parts else ""
        return f"(?:{body})?" if "" in node and body else body

    return r"(?<![\p{L}\p{N}])" + pattern(trie) + r"(?![\p{L}\p{N}])"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once for each row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD, running: bool = False) -> DataFrame:
    """(doc_id, n_segments, n_matches, license, dice) for each row of ``docs`` (``doc_id``, ``text``).

    ``n_matches``: segments that reach the threshold with some template; ``license`` and ``dice``: the best of those
    (ties to the first name), else null.  Null or empty text has no segment.  Repeated rows give a row each.  An empty
    table gives an empty result.  Other columns are ignored.

    ``running``: a template also matches inside a segment or across several; such a match counts for ``license`` and
    ``dice`` like any other, and for ``n_matches`` as one if no segment reaches the threshold.  A match is set aside if
    its template is a part of a much longer one that matches too (the grant that BSD licences share).
    """
    spark = docs.sparkSession
    names = sorted(templates)
    grams = spark.createDataFrame([(n, templates[n]) for n in names], "name string, text string").select("name", _words(F.col("text")).alias("words")) \
        .select("name", "words", _bigrams(F.col("words")).alias("grams"), _pairs(F.col("words")).alias("pairs")).orderBy("name").collect()  # one row for each template
    first = [_anchors(r["words"], threshold) for r in grams]
    hashes = [dict(zip(zip(r["words"], r["words"][1:]), r["pairs"])) for r in grams]
    known = F.array(*(F.struct(F.lit(r["name"]).alias("name"), F.lit(len(r["grams"])).alias("n"), F.array(*map(F.lit, r["grams"])).alias("grams"),
                               F.lit(len(r["pairs"])).alias("wide"), F.array(*(F.lit(h[p]) for p in a)).cast("array<bigint>").alias("anchors")) for r, a, h in zip(grams, first, hashes)))
    anchored = F.array(*map(F.lit, sorted({h[p] for a, h in zip(first, hashes) for p in a}))).cast("array<bigint>")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.split(text, "\n")
    paragraphs = F.filter(F.split(text, r"\n[ \t\r]*\n\s*"), lambda x: F.contains(x, F.lit("\n")))
    whole = F.when(text.rlike(r"\n[ \t\r]*\n"), F.array(text)).otherwise(F.array().cast("array<string>"))
    reachable = F.lower(text).rlike(_one_of({p for a in first for p in a})) if running else F.lit(True)
    segments = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.concat(lines, paragraphs, whole).alias("segments"), F.when(reachable, text).alias("text"))
    words = segments.select("doc_id", "text", F.filter(F.transform("segments", _words), lambda w: F.get(w, F.lit(0)) != "").alias("words"))
    sets = words.select("doc_id", "text", F.size("words").alias("n_segments"), F.when(F.col("text").isNotNull(), F.transform("words", _bigrams)).otherwise(F.array().cast("array<array<bigint>>")).alias("sets"))

    def matches(own: Column) -> Column:
        """(dice, name) of the templates in reach of a segment."""
        n = F.size(own)
        near = F.filter(F.col("known"), lambda t: (n * (2 - threshold) >= t["n"] * threshold) & (t["n"] * (2 - threshold) >= n * threshold))
        return F.filter(F.transform(near, lambda t: F.struct((-2.0 * F.size(F.array_intersect(own, t["grams"])) / (n + t["n"])).alias("minus"), t["name"].alias("name"))),
                        lambda m: m["minus"] <= -threshold)

    def windows(pairs: Column) -> Column:
        """(dice, name) of the best window of each template that reaches the threshold, over all pairs of a text."""
        places = F.filter(F.sequence(F.lit(0), F.size(pairs) - 1), lambda i: F.array_contains(anchored, F.get(pairs, i)))

        def best(t: Column, at: Column) -> Column:
            wide = F.least(t["wide"], F.size(pairs))
            over = F.filter(at, lambda i: F.array_contains(t["anchors"], F.get(pairs, i)))
            begins = F.array_distinct(F.flatten(F.transform(over, lambda i: F.sequence(F.greatest(F.lit(0), i - wide + 1), F.least(i, F.size(pairs) - wide)))))
            minus = F.transform(begins, lambda b: _let(F.array_distinct(F.slice(pairs, b + 1, wide)), lambda own: -2.0 * F.size(F.array_intersect(own, t["grams"])) / (F.size(own) + t["n"])))
            return F.struct(F.array_min(minus).alias("minus"), t["name"].alias("name"))

        found = _let(places, lambda at: F.transform(F.col("known"), lambda t: best(t, at)))
        return F.when(F.size(pairs) > 0, F.filter(found, lambda m: m["minus"] <= -threshold))

    by_segment = F.filter(F.transform("sets", lambda s: F.array_min(matches(s))), lambda m: m.isNotNull())
    by_window = F.when(F.col("text").isNotNull(), _let(_words(F.col("text")), lambda w: _let(_pairs(w), windows))) if running else F.lit(None)
    none = F.array().cast("array<struct<minus: double, name: string>>")
    found = sets.withColumn("known", known).select("doc_id", "n_segments", by_segment.alias("found"), F.coalesce(by_window, none).alias("passages"))
    own = [set(r["grams"]) for r in grams]
    parts = [f"{names[k]}\n{names[j]}" for j, part in enumerate(own) for k, large in enumerate(own)
             if len(large) * threshold > len(part) * (2 - threshold) and len(part & large) >= threshold * len(part)]
    parts = F.array(*map(F.lit, parts)).cast("array<string>")
    every = F.concat("found", "passages")
    alone = _let(every, lambda x: F.filter(x, lambda m: ~F.exists(x, lambda o: F.array_contains(parts, F.concat(o["name"], F.lit("\n"), m["name"])))))
    best = F.array_min(alone if running else every)
    n_matches = F.greatest(F.size("found"), F.least(F.size("passages"), F.lit(1)))
    return found.select("doc_id", F.col("n_segments").cast("long").alias("n_segments"), n_matches.cast("long").alias("n_matches"), best["name"].alias("license"), (-best["minus"]).alias("dice"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


#: What ``scan_licenses`` gives for all templates with ``running``, by comparing sets of pairs as texts.
ORACLE = """
WITH t(name, text) AS (VALUES """ + ", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in sorted(ALL.items())) + """),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
s AS (SELECT r, unnest(string_split(text, chr(10))
             || list_filter(string_split_regex(text, '\\n[ \\t\\r]*\\n\\s*'), lambda x: contains(x, chr(10)))
             || CASE WHEN regexp_matches(text, '\\n[ \\t\\r]*\\n') THEN [text] ELSE [] END) AS text FROM d),
a AS (SELECT row_number() OVER () AS k, r, words FROM (
      SELECT r, string_split(trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' ') AS words FROM s) WHERE words[1] <> ''),
ag AS (SELECT k, r, list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS g FROM a),
tp AS (SELECT name, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) AS pairs FROM (
       SELECT name, string_split(trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' ') AS words FROM t)),
tg AS (SELECT name, list_distinct(pairs) AS g, len(pairs) AS wide FROM tp),
m AS (SELECT k, r, name, 2.0::DOUBLE * len(list_intersect(ag.g, tg.g)) / (len(ag.g) + len(tg.g)) AS dice
      FROM ag JOIN tg ON len(ag.g) * 1.2 >= len(tg.g) * 0.8 AND len(tg.g) * 1.2 >= len(ag.g) * 0.8),
by_segment AS (SELECT r, first(name ORDER BY dice DESC, name) AS name, max(dice) AS dice FROM m WHERE dice >= 0.8 GROUP BY r, k),
-- windows: only of templates of which the text holds as many pairs as a window in reach must
x AS (SELECT r, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) AS pairs FROM (
      SELECT r, string_split(trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' ') AS words FROM d)),
held AS (SELECT DISTINCT r, p FROM (SELECT r, unnest(pairs) AS p FROM x)),
likely AS (SELECT r, name FROM held JOIN (SELECT name, unnest(g) AS p FROM tg) USING (p) JOIN tg USING (name)
           GROUP BY r, name HAVING count(*) * 1.2 >= any_value(len(g)) * 0.8),
w AS (SELECT r, name, g, list_distinct(list_slice(pairs, b, b + least(wide, len(pairs)) - 1)) AS own FROM (
      SELECT r, name, g, wide, pairs, unnest(range(1, len(pairs) - least(wide, len(pairs)) + 2)) AS b FROM likely JOIN x USING (r) JOIN tg USING (name))),
by_window AS (SELECT r, name, max(dice) AS dice FROM (SELECT r, name, 2.0::DOUBLE * len(list_intersect(own, g)) / (len(own) + len(g)) AS dice FROM w) WHERE dice >= 0.8 GROUP BY r, name),
every_match AS (SELECT r, name, dice FROM by_segment UNION ALL SELECT r, name, dice FROM by_window),
part_of AS (SELECT p.name AS part, l.name AS large FROM tg p JOIN tg l ON len(l.g) * 0.8 > len(p.g) * 1.2 AND len(list_intersect(p.g, l.g)) >= 0.8 * len(p.g)),
aside AS (SELECT DISTINCT e.r, e.name FROM every_match e JOIN part_of ON part = e.name JOIN every_match o ON o.r = e.r AND o.name = large),
best AS (SELECT r, first(e.name ORDER BY e.dice DESC, e.name) AS name, max(e.dice) AS dice FROM every_match e ANTI JOIN aside ON aside.r = e.r AND aside.name = e.name GROUP BY r),
n AS (SELECT r, count(*) AS n FROM a GROUP BY r),
ns AS (SELECT r, count(*) AS n FROM by_segment GROUP BY r),
nw AS (SELECT DISTINCT r, 1 AS n FROM by_window)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_segments, greatest(coalesce(ns.n, 0), coalesce(nw.n, 0))::BIGINT AS n_matches, name AS license, dice
FROM d LEFT JOIN n ON d.r = n.r LEFT JOIN ns ON d.r = ns.r LEFT JOIN nw ON d.r = nw.r LEFT JOIN best ON d.r = best.r
"""
