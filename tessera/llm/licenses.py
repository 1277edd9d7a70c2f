"""Licence scans: Dice coefficient over word bigrams against licence templates. DataFrame operations only.

A document is compared whole, line by line, and by runs of words, so a notice may be wrapped over lines and have other
words around it. Texts are normalised (lower case; runs of other characters than letters and digits are one space), and
cut to their distinct word bigrams. A Dice coefficient of t needs sizes within the ratio t / (2 - t): a list by size tells
which templates a line or text is held against, and runs are as long as that allows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common

# Notices and texts of public licences, by SPDX identifier.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
)


# Fixed values, too: notices that differ by a name, and SPDX tags.
_GNU = "This {0} is free software{1} you can redistribute it and/or modify it under the terms of the GNU {2} as published by the Free Software Foundation, either version {3} of the License, or (at your option) any later version. This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {2} for more details."
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. {} THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_TAGS = ("ISC", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-or-later", "LGPL-3.0-or-later", "AGPL-3.0-or-later", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "Unlicense")
NOTICES: tuple[tuple[str, str], ...] = (
    *TEMPLATES,
    ("GPL-2.0-or-later", _GNU.format("program", ";", "General Public License", "2")),
    ("LGPL-2.1-or-later", _GNU.format("library", ";", "Lesser General Public License", "2.1")),
    ("LGPL-3.0-or-later", _GNU.format("program", ":", "Lesser General Public License", "3")),
    ("AGPL-3.0-or-later", _GNU.format("program", ":", "Affero General Public License", "3")),
    ("BSD-2-Clause", _BSD.format("")),
    ("BSD-3-Clause", _BSD.format("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.")),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("CC-BY-SA-4.0", "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License."),
    *((tag, f"SPDX-License-Identifier: {tag}") for tag in _TAGS),
)


@dataclass(frozen=True)
class LicenseScan:
    #: Least Dice coefficient, in hundredths.
    percent: int = 80
    templates: tuple[tuple[str, str], ...] = field(default=NOTICES)


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _once(value: Column, use) -> Column:
    """use(value), with value worked out one time only."""
    return F.transform(F.array(value), use)[0]


def _hashes(text: Column) -> Column:
    """Hashes of the word bigrams, in order."""
    of = lambda w: F.transform(F.slice(w, 1, F.size(w) - 1), lambda x, i: F.xxhash64(x, F.get(w, i + 1)))
    return _once(F.split(normal(text), " "), lambda w: F.when(F.size(w) >= 2, of(w)).otherwise(F.array().cast("array<bigint>")))


def _hashed(spark: SparkSession, p: LicenseScan) -> tuple[Column, Column, Column, int]:
    """The templates as one constant array of (rank, license, t, m, lo, hi, length, longest): m distinct hashes t, the sizes of
    sets that can match them, their number of bigrams and that of their longest run; all hashes; the places of the
    templates by the sizes that can match them; and the longest run of all. The templates are parameters, so they are few and small."""
    rows = spark.createDataFrame([(k, name, text) for k, (name, text) in enumerate(p.templates)], "rank int, license string, text string")
    longs = lambda x: F.expr(f"array({', '.join(f'{v}L' if v > -(2**63) else 'cast(-9223372036854775808 as bigint)' for v in x)})")
    each, known, sizes, most = [], set(), [], 1
    for r in rows.select("rank", "license", _hashes(F.col("text")).alias("h")).where(F.size("h") > 0).orderBy("rank").collect():
        t = sorted(set(r["h"]))
        m, length = len(t), len(r["h"])
        lo, hi = -(-m * p.percent // (200 - p.percent)), m * (200 - p.percent) // p.percent
        values = (("rank", F.lit(r["rank"])), ("license", F.lit(r["license"])), ("t", longs(t)), ("m", F.lit(m)), ("lo", F.lit(lo)), ("hi", F.lit(hi)), ("length", F.lit(length)), ("longest", F.lit(hi + length - m)))
        each.append(F.struct(*[v.alias(n) for n, v in values]))
        known.update(t)
        most = max(most, hi + length - m)
        sizes += [[] for _ in range(hi + 1 - len(sizes))]
        for size in range(lo, hi + 1):
            sizes[size].append(len(each) - 1)
    empty = "array<struct<rank: int, license: string, t: array<bigint>, m: int, lo: int, hi: int, length: int, longest: int>>"
    by_size = F.expr(f"array({', '.join('array({})'.format(', '.join(map(str, x))) if x else 'cast(array() as array<int>)' for x in sizes)})") if sizes else F.array().cast("array<array<int>>")
    return F.array(*each) if each else F.array().cast(empty), longs(sorted(known)) if known else F.array().cast("array<bigint>"), by_size, most


def scan(docs: DataFrame, p: LicenseScan = LicenseScan()) -> DataFrame:
    """doc_id, license, dice, licenses, n_licenses of each row of docs(doc_id, text): the best licence and its Dice (ties:
    the earlier template), and all licences found, the best first, with commas.

    Beside lines and the whole text, each run of words is compared that starts with a bigram of the template and is as
    long as the template to half as long again (or ends with the text). Of runs that lie by more than half in a better
    run of another licence, that one alone counts; the best line or whole text always does. Null or empty text has no
    match. Repeated rows and null ids stay. An empty table gives an empty one. Other columns of docs are not read.
    Nothing is shuffled.
    """
    templates, known, by_size, longest = _hashed(docs.sparkSession, p)

    def of_segment(g: Column) -> Column:
        near = F.transform(F.coalesce(F.get(by_size, F.size(g)), F.array().cast("array<int>")), lambda k: F.get(templates, k))
        dice = lambda t: 2.0 * F.size(F.array_intersect(g, t["t"])) / (F.size(g) + t["m"])
        return F.filter(F.transform(near, lambda t: F.struct(dice(t).alias("dice"), (-t["rank"]).alias("r"), t["license"].alias("license"))), lambda x: x["dice"] >= p.percent / 100)

    def placed(g: Column) -> Column:
        """(i, h, prev) of each bigram: its place, its hash, and the place before that has the same, or -1."""
        of = lambda s: F.transform(s, lambda x, k: F.struct(x["i"].alias("i"), x["h"].alias("h"), F.coalesce(F.when(F.get(s, k - 1)["h"] == x["h"], F.get(s, k - 1)["i"]), F.lit(-1)).alias("prev")))
        return F.sort_array(_once(F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), of))

    def runs(a: Column, t: Column) -> Column:
        """The best run of each start that reaches the limit."""

        def best(b: Column, s: Column) -> Column:
            def step(acc: Column, x: Column) -> Column:
                new = (x["prev"] < s["i"]).cast("int")
                n, both = acc["n"] + new, acc["both"] + new * x["hit"]
                long = (x["i"] - s["i"] + 1 >= t["length"]) | (x["i"] == F.size(b) - 1)
                dice = F.when(long, 2.0 * both / (n + t["m"])).otherwise(0.0)
                more = dice > acc["dice"]
                return F.struct(n.alias("n"), both.alias("both"), F.when(more, dice).otherwise(acc["dice"]).alias("dice"), F.when(more, x["i"]).otherwise(acc["end"]).alias("end"))

            start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("both"), F.lit(0.0).alias("dice"), F.lit(-1).alias("end"))
            done = lambda acc: F.struct(acc["dice"].alias("dice"), (-t["rank"]).alias("r"), t["license"].alias("license"), s["i"].alias("start"), acc["end"].alias("end"))
            return F.aggregate(F.slice(b, s["i"] + 1, t["longest"]), start, step, done)

        marked = F.transform(a, lambda x: F.struct(x["i"].alias("i"), x["prev"].alias("prev"), F.array_contains(t["t"], x["h"]).cast("int").alias("hit")))
        return _once(marked, lambda b: F.filter(F.transform(F.filter(b, lambda s: s["hit"] == 1), lambda s: best(b, s)), lambda x: x["dice"] >= p.percent / 100))

    def alone(found: Column) -> Column:
        """Runs that no better run covers by more than half. A run is longest places long at most, so in the order of their
        starts, cut into stretches of that many places, those that overlap lie in one stretch or in the next."""
        shared = lambda a, b: F.least(a["end"], b["end"]) - F.greatest(a["start"], b["start"]) + 1
        better = lambda a, b: (b["license"] != a["license"]) & ((b["dice"] > a["dice"]) | ((b["dice"] == a["dice"]) & (b["r"] > a["r"]))) & (2 * shared(a, b) > a["end"] - a["start"] + 1)
        at = lambda x: F.floor(x["start"] / longest)

        def within(runs: Column) -> Column:
            marked = F.transform(runs, lambda x, i: F.struct(at(x).alias("at"), i.alias("i"), ((i == 0) | (at(x) != at(F.get(runs, i - 1)))).alias("first")))
            n = F.size(runs)

            def of_stretch(firsts: Column):
                def kept(f: Column, j: Column) -> Column:
                    before, after = F.get(firsts, j - 1), F.get(firsts, j + 1)
                    to = F.coalesce(after["i"], n)
                    lo = F.when((j > 0) & (before["at"] == f["at"] - 1), before["i"]).otherwise(f["i"])
                    hi = F.when(after["at"] == f["at"] + 1, F.coalesce(F.get(firsts, j + 2)["i"], n)).otherwise(to)
                    own = lambda near: F.filter(F.slice(runs, f["i"] + 1, to - f["i"]), lambda a: ~F.exists(near, lambda b: better(a, b)))
                    return _once(F.slice(runs, lo + 1, hi - lo), own)

                return F.flatten(F.transform(firsts, kept))

            return _once(F.filter(marked, lambda x: x["first"]), of_stretch)

        by_start = F.transform(found, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["dice"].alias("dice"), x["r"].alias("r"), x["license"].alias("license")))
        return F.transform(_once(F.sort_array(by_start), within), lambda x: F.struct(x["dice"].alias("dice"), x["r"].alias("r"), x["license"].alias("license")))

    def of_text(g: Column) -> Column:
        near = _once(F.array_intersect(g, known), lambda own: F.filter(templates, lambda t: F.size(F.array_intersect(own, t["t"])) >= t["lo"]))
        spans = lambda ts: F.when(F.size(ts) > 0, _once(_once(placed(g), lambda a: F.flatten(F.transform(ts, lambda t: runs(a, t)))), alone))
        return _once(near, spans)

    text = F.coalesce("text", F.lit(""))
    lines = F.split(text, "\n")
    of_lines = F.flatten(F.transform(lines, lambda s: _once(F.array_distinct(_hashes(s)), of_segment)))
    whole = lambda g: F.struct(F.array_max(F.concat(of_lines, _once(F.array_distinct(g), of_segment))).alias("best"), F.coalesce(of_text(g), F.array().cast("array<struct<dice: double, r: int, license: string>>")).alias("runs"))
    rows = common.slim(docs, "doc_id", "text").select("doc_id", _once(_hashes(text), whole).alias("x"))
    each = rows.select("doc_id", F.sort_array(F.array_compact(F.concat("x.runs", F.array("x.best"))), asc=False).alias("found"))
    best, names = F.get("found", F.lit(0)), F.array_distinct(F.transform("found", lambda m: m["license"]))
    return each.select("doc_id", best["license"].alias("license"), best["dice"].alias("dice"), F.array_join(names, ",").alias("licenses"), F.size(names).cast("long").alias("n_licenses"))


def scan_sql(p: LicenseScan = LicenseScan()) -> str:
    """The same scan for DuckDB."""
    quoted = ",\n  ".join("({}, '{}', '{}')".format(k, name, text.replace("'", "''")) for k, (name, text) in enumerate(p.templates))
    norm = r"trim(regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), templates(rank, license, text) AS (VALUES
  {quoted}
), twords AS (
  SELECT rank, license, string_split({norm.format('text')}, ' ') AS w FROM templates
), tall AS (
  SELECT rank, license, w[i] || ' ' || w[i + 1] AS g FROM (SELECT *, unnest(range(1, len(w))) AS i FROM twords)
), tgrams AS (
  SELECT DISTINCT rank, license, g FROM tall
), tsizes AS (
  SELECT rank, license, count(DISTINCT g) AS m, count(*) AS length FROM tall GROUP BY ALL
), bounds AS (
  SELECT *, (m * {p.percent} + {199 - p.percent}) // {200 - p.percent} AS lo, m * {200 - p.percent} // {p.percent} AS hi FROM tsizes
), parts AS (
  SELECT r, 0 AS segment, text AS s FROM docs
  UNION ALL SELECT r, unnest(range(1, len(l) + 1)), unnest(l) FROM (SELECT r, string_split(text, chr(10)) AS l FROM docs)
), words AS (
  SELECT r, segment, string_split({norm.format('s')}, ' ') AS w FROM parts
), every AS (
  SELECT r, segment, i, w[i] || ' ' || w[i + 1] AS g FROM (SELECT *, unnest(range(1, len(w))) AS i FROM words)
), grams AS (
  SELECT DISTINCT r, segment, g FROM every
), sizes AS (
  SELECT r, segment, count(*) AS n FROM grams GROUP BY ALL
), shared AS (
  SELECT r, segment, rank, license, count(*) AS hits FROM grams JOIN tgrams USING (g) GROUP BY ALL
), segments AS (
  SELECT r, s.rank, s.license, 2.0::DOUBLE * hits / (n + m) AS dice
  FROM shared s JOIN sizes USING (r, segment) JOIN bounds b ON b.rank = s.rank WHERE n BETWEEN lo AND hi
), best AS (
  SELECT r, arg_max(struct_pack(license := license, rank := rank, dice := dice), struct_pack(d := dice, k := -rank)) AS x FROM segments WHERE dice >= {p.percent / 100}::DOUBLE GROUP BY r
), near AS (
  SELECT s.r, s.rank, s.license, m, lo, length, hi + length - m AS longest FROM shared s JOIN bounds b ON b.rank = s.rank WHERE segment = 0 AND hits >= lo
), placed AS (
  SELECT r, i, g, coalesce(lag(i) OVER (PARTITION BY r, g ORDER BY i), 0) AS prev, max(i) OVER (PARTITION BY r) AS last
  FROM every WHERE segment = 0 AND r IN (SELECT r FROM near)
), marked AS (
  SELECT p.*, n.rank, n.license, n.m, n.length, n.longest, t.g IS NOT NULL AS hit
  FROM placed p JOIN near n USING (r) LEFT JOIN tgrams t ON t.rank = n.rank AND t.g = p.g
), windows AS (
  SELECT r, rank, license, a.i AS s, x.i AS e, (x.i - a.i + 1 >= a.length OR x.i = x.last) AS long, a.m,
         sum(CAST(x.prev < a.i AS INTEGER)) OVER w AS n, sum(CAST(x.prev < a.i AND x.hit AS INTEGER)) OVER w AS hits
  FROM marked a JOIN marked x USING (r, rank, license) WHERE a.hit AND x.i BETWEEN a.i AND a.i + a.longest - 1
  WINDOW w AS (PARTITION BY r, rank, license, a.i ORDER BY x.i)
), runs AS (
  SELECT r, rank, license, s, max(dice) AS dice, arg_max(e, struct_pack(d := dice, k := -e)) AS e
  FROM (SELECT *, 2.0::DOUBLE * hits / (n + m) AS dice FROM windows WHERE long) WHERE dice >= {p.percent / 100}::DOUBLE GROUP BY ALL
), alone AS (
  SELECT r, rank, license, dice FROM runs a WHERE NOT EXISTS (
    SELECT 1 FROM runs b WHERE b.r = a.r AND b.license <> a.license AND (b.dice > a.dice OR b.dice = a.dice AND b.rank < a.rank)
    AND 2 * (least(a.e, b.e) - greatest(a.s, b.s) + 1) > a.e - a.s + 1)
), found AS (
  SELECT r, rank, license, dice FROM alone UNION ALL SELECT r, x.rank, x.license, x.dice FROM best
), named AS (
  SELECT r, license, min(place) AS place, max(dice) AS dice FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY dice DESC, rank) AS place FROM found) GROUP BY r, license
), joined AS (
  SELECT r, arg_min(license, place) AS license, arg_min(dice, place) AS dice, string_agg(license, ',' ORDER BY place) AS licenses, count(*) AS n FROM named GROUP BY r
)
SELECT doc_id, license, dice, coalesce(licenses, '') AS licenses, CAST(coalesce(n, 0) AS BIGINT) AS n_licenses FROM docs LEFT JOIN joined USING (r)
"""
