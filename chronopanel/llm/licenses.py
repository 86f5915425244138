"""License scans: normalised text against license templates by Dice coefficient over word bigrams.

A text is normalised (lower case, runs of other characters than letters and digits become one space), so notices match
across line breaks, comment marks and inside longer lines. A template of m bigram places is compared with windows of m places of the
text: every window that starts at one of the template's bigrams, cut at the end of the text. The coefficient is that of the sets of
bigrams. Two of size a and b can reach t only if they share t*a/(2-t) bigrams or more. So a template is a candidate for a
text only if the text has that many of its bigrams, and a window is opened only if that many of them stand in its places.

Templates are short notices, file headers and whole license texts. Only DataFrame functions are used; a row's matches are made in the row, without a
join or shuffle, so repeated rows, null ids, common words and large groups of copies need no care. The library is part of the plan;
`MAX_TEMPLATE_BIGRAMS` bounds it.

Defined results: null and empty texts and those with fewer than two words match nothing; of the windows of a template the best
counts, of equal ones the first; ties between templates go to the alphabetically first name; repeated rows are scanned each; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents

_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
)
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
_BSD_1 = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
_BSD_2 = (
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution. "
)
_BSD_3 = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission. "
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED '
    "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
    "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)


def _gpl(name: str, either: str) -> str:
    """The file header that the GNU licenses recommend."""
    return (
        f"This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation, either {either} of the "
        f"License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        f"implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details."
    )


#: Notices, headers and texts of public licenses: (license, text). Fixed values.
TEMPLATES: list[tuple[str, str]] = [
    ("AGPL-3.0", _gpl("GNU Affero General Public License", "version 3")),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at '
     "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
     '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and '
     "limitations under the License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-2-Clause", _BSD + "1. " + _BSD_1 + "2. " + _BSD_2 + _BSD_END),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", _BSD + "1. " + _BSD_1 + "2. " + _BSD_2 + "3. " + _BSD_3 + _BSD_END),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", _gpl("GNU General Public License", "version 2")),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", _gpl("GNU General Public License", "version 3")),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this "
     'permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
     "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
     "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
     "USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", _gpl("GNU Lesser General Public License", "version 3")),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software '
     "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
     "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included "
     "in all copies or substantial portions of the Software. " + _WARRANTY + "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
     "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at "
     "https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this "
     "software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to "
     "the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software "
     "in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must "
     "not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
]
THRESHOLD = 0.8
#: Bigrams of all templates are part of the plan; a larger library raises an error.
MAX_TEMPLATE_BIGRAMS = 200_000


def bigrams_of(text: Column) -> Column:
    """Pairs of neighbouring words of a normalised text, in order; one pass of a pattern with look-ahead."""
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.regexp_extract_all(plain, F.lit(r"(?<![^ ])(?=([^ ]+ [^ ]+))"), F.lit(1))


def plain_bigrams(text: str) -> list[str]:
    words = [w for w in re.sub(r"[^\w]+|_", " ", text.lower()).split(" ") if w]
    return [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def _least(a: int, threshold: float) -> int:
    """Common bigrams without which a template of a bigrams can't reach the threshold."""
    return max(1, math.ceil(threshold * a / (2 - threshold) - 1e-9))


def scan(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id, and `matches`: (license, start, dice) of each license that reaches the threshold, by name; start is the
    window's first word."""
    grams = [(name, plain_bigrams(t)) for name, t in templates]
    grams = [(name, len(g), sorted(set(g))) for name, g in grams if g]
    if sum(len(g) for _, _, g in grams) > MAX_TEMPLATE_BIGRAMS:
        raise ValueError("too many template bigrams")
    quoted = {x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'" for _, _, g in grams for x in g}
    shortest = min((_least(len(g), threshold) for _, _, g in grams), default=1)

    def best(m: int, a: list[str]) -> str:
        """The best window of a template, or NULL. Places and windows are array elements first, so that lambdas compute them once."""
        need, listed = _least(len(a), threshold), ", ".join(quoted[x] for x in a)
        # a window holds enough places of the template only if the need-th place from its first is inside
        firsts = f"filter(p, (i, k) -> coalesce(get(p, k + {need - 1}) < i + {m}, false))"
        dice = f"2.0D * size(array_intersect(part, array({listed}))) / ({len(a)} + size(array_distinct(part)))"
        windows = f"transform({firsts}, i -> transform(array(slice(__g, i + 1, {m})), part -> named_struct('dice', {dice}, 'before', -i))[0])"
        return f"transform(array(filter(__hit, i -> __g[i] IN ({listed}))), p -> CASE WHEN size(array_distinct(transform(p, i -> __g[i]))) >= {need} THEN array_max({windows}) END)[0]"

    by_name: dict[str, list[str]] = {}
    for name, m, a in sorted(grams):
        by_name.setdefault(name, []).append(best(m, a))
    kind = "array<struct<license:string,start:int,dice:double>>"
    of_name = "transform(array(array_max(array({of}))), t -> CASE WHEN t.dice >= {t} THEN named_struct('license', '{name}', 'start', -t.before, 'dice', t.dice) END)[0]"
    every = ", ".join(of_name.format(name=name.replace("'", "\\'"), t=f"{threshold!r}D", of=", ".join(of)) for name, of in by_name.items())
    # the bigrams come out of a generator, so that no later expression computes them again
    rows = docs.select(F.col(id_col), F.explode(F.array(bigrams_of(F.coalesce(F.col(text_col), F.lit(""))))).alias("__g"))
    hits = f"CASE WHEN size(__g) >= {shortest} THEN filter(sequence(0, size(__g) - 1), i -> __g[i] IN ({', '.join(sorted(quoted.values())) or 'NULL'})) ELSE array() END"
    rows = rows.select(id_col, "__g", F.explode(F.array(F.expr(hits).cast("array<int>"))).alias("__hit"))
    return rows.select(id_col, F.when(F.size("__hit") >= shortest, F.expr(f"array_compact(array({every}))").cast(kind)).otherwise(F.array().cast(kind)).alias("matches"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: the best license, its coefficient and first word, and how many licenses match."""
    found = scan(documents(spark, sf_dir, "doc_id", "text"))
    best = F.array_max(F.transform("matches", lambda x, k: F.struct(x["dice"].alias("dice"), (-k).alias("k"), x["license"].alias("license"), x["start"].alias("start"))))
    return found.withColumn("__best", best).select(
        "doc_id", F.col("__best.license").alias("license"), F.coalesce("__best.dice", F.lit(0.0)).alias("dice"), F.col("__best.start").cast("long").alias("start"),
        F.size("matches").cast("long").alias("n_licenses"),
    )


def _oracle() -> str:
    values = ", ".join(f"({k}, '{n}', '" + t.replace("'", "''") + "')" for k, (n, t) in enumerate(TEMPLATES))
    words = "list_filter(string_split(trim(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' '), lambda w: w <> '')"
    grams = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
    t = f"CAST({THRESHOLD} AS DOUBLE)"
    return f"""
WITH t(k, license, body) AS (VALUES {values}),
ta AS (SELECT k, license, {grams} AS g FROM (SELECT k, license, {words.format('body')} AS w FROM t)),
tg AS (SELECT k, license, len(g) AS m, list_distinct(g) AS own, len(list_distinct(g)) AS a FROM ta),
tx AS (SELECT k, license, m, own, a, unnest(own) AS x FROM tg),
d AS (SELECT row_number() OVER () AS rid, doc_id, {grams} AS g FROM (SELECT doc_id, {words.format("coalesce(text, '')")} AS w FROM documents)),
p AS (SELECT rid, unnest(g) AS x, generate_subscripts(g, 1) AS place FROM d),
h AS (SELECT p.rid, tx.k, tx.license, tx.m, tx.own, tx.a, p.place FROM p JOIN tx USING (x)),
c AS (SELECT p.rid, tx.k FROM p JOIN tx USING (x) GROUP BY 1, 2 HAVING count(DISTINCT p.x) >= ceil({t} * any_value(tx.a) / (2 - {t}) - CAST(1e-9 AS DOUBLE))),
w AS (SELECT h.rid, h.license, h.place, h.own, h.a, list_slice(d.g, h.place, h.place + h.m - 1) AS part FROM h JOIN c ON c.rid = h.rid AND c.k = h.k JOIN d ON d.rid = h.rid),
v AS (SELECT rid, license, place, CAST(2 * len(list_intersect(list_distinct(part), own)) AS DOUBLE) / CAST(a + len(list_distinct(part)) AS DOUBLE) AS dice FROM w),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rid, license ORDER BY dice DESC, place) AS rn FROM v WHERE dice >= {t}) WHERE rn = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY dice DESC, license) AS nth, count(*) OVER (PARTITION BY rid) AS n FROM b)
SELECT d.doc_id, r.license, coalesce(r.dice, CAST(0 AS DOUBLE)) AS dice, CAST(r.place - 1 AS BIGINT) AS start, CAST(coalesce(r.n, 0) AS BIGINT) AS n_licenses
FROM d LEFT JOIN r ON r.rid = d.rid AND r.nth = 1
"""


QUERIES = {"op8_license_scan": op8_license_scan}
SQL = {"op8_license_scan": _oracle()}
