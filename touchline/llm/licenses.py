"""Licence notices in documents, by Dice coefficients of word bigrams against templates."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# Wordings of public licence notices, by SPDX name; a paragraph is a template of its own.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

# Further paragraphs of the same licences. They are looked for in passages only; units go by TEMPLATES.
PARAGRAPHS: list[tuple[str, str]] = [
    ("BSD-2-Clause", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("BSD-2-Clause", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-2-Clause", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
    ("ISC", "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
]

WORD = "[a-z0-9]+"
#: Comment leaders that are words; all others have no letter or digit.
LEADER = r"(?m)^(?:c|[ \t]*@?rem|[ \t]*dnl)(?![a-z0-9])"


def bigrams_of(text: str) -> list[str]:
    """The distinct word bigrams of a template, in order."""
    words = re.findall(WORD, text.lower())
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


def bounds(size: int, threshold: float) -> tuple[int, int]:
    """The set sizes at which a Dice coefficient with a set of ``size`` can reach the threshold.

    At best the smaller set lies in the larger: 2 min / (min + max) >= threshold.
    """
    ratio = threshold / (2 - threshold)
    return math.ceil(round(size * ratio, 9)), math.floor(round(size / ratio, 9))


def pairs_of(words: Column) -> Column:
    """The bigrams of neighbouring words, in order and with repeats."""
    return F.transform(F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda x, i: F.concat(words[i], F.lit(" "), x))


def anchors(templates: Sequence[tuple[str, str]], threshold: float) -> list[str]:
    """Bigrams of which every text with a matching passage has at least one.

    A match has the lower bound of a template's bigrams in common, so it has one of any set that is larger than
    what may be missing. The longest ones are the rarest in other texts.
    """
    found = set()
    for _, text in templates:
        grams = bigrams_of(text)
        least = bounds(len(grams), threshold)[0]
        found |= set(sorted(grams, key=lambda g: (-len(g), g))[:len(grams) - least + 1])
    return sorted(found)


def passages(pairs: Column, templates: Sequence[tuple[str, str]], threshold: float) -> Column:
    """The templates found in runs of neighbouring words: structs of dice and name, each with its best run.

    ``pairs`` are the bigrams of a whole text, across lines and comment leaders. The best run begins and ends
    with a bigram of the template, as any other at its ends only adds to its size. Its length lies within the
    template's bounds, plus the template's own repeats. Only such runs are scored.
    """
    known = []
    for name, text in templates:
        grams = bigrams_of(text)
        low, high = bounds(len(grams), threshold)
        repeats = len(re.findall(WORD, text.lower())) - 1 - len(grams)
        known.append(F.struct(F.lit(name).alias("name"), F.array(*map(F.lit, grams)).alias("grams"), F.lit(len(grams)).alias("n"),
                              F.lit(low).alias("low"), F.lit(high + repeats).alias("longest")))
    near = F.filter(F.array(*known), lambda t: F.size(F.array_intersect(t["grams"], pairs)) >= t["low"])
    placed = F.transform(near, lambda t: F.struct(t.alias("t"), F.filter(
        F.transform(pairs, lambda g, i: F.when(F.array_contains(t["grams"], g), i)), lambda i: i.isNotNull()).alias("at")))

    def best(x: Column) -> Column:
        t, at = x["t"], x["at"]
        last = F.size(at) - 1

        def from_start(start: Column, k: Column) -> Column:
            ends = F.when(k + t["low"] - 1 <= last, F.slice(at, k + t["low"], t["longest"]))
            inside = F.filter(ends, lambda end: end - start < t["longest"])
            runs = F.transform(inside, lambda end: F.array_distinct(F.slice(pairs, start + 1, end - start + 1)))
            return F.array_max(F.transform(runs, lambda g: F.lit(2.0) * F.size(F.array_intersect(g, t["grams"])) / (F.size(g) + t["n"])))

        return F.struct(F.array_max(F.transform(at, from_start)).alias("dice"), t["name"].alias("name"))

    return F.filter(F.transform(placed, best), lambda s: s["dice"] >= threshold)


def scan_licenses(
    docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD,
    id_column: str = "doc_id", text_column: str = "text",
    paragraphs: Sequence[tuple[str, str]] = PARAGRAPHS,
) -> DataFrame:
    """Per row: doc_id, n_units, n_matches, license, dice and licenses.

    A unit is a line, or a paragraph of several lines (blank lines part paragraphs). Its words are runs of
    a-z and 0-9 after lower-casing; its set holds the distinct bigrams of neighbouring words. A unit
    matches a template if twice the common bigrams over both sizes is at least ``threshold``. A template
    is compared only with sets whose size lets it get there. n_units counts the units, n_matches those that match something as a whole.

    A notice may also be a part of its unit, or run over several: a comment, a sentence of a line, a header with its
    copyright line. Every run of neighbouring words of the text is a passage, whatever lines and comment leaders it
    crosses, and is compared in the same way with ``templates`` and ``paragraphs``. dice
    is the best coefficient of a unit or passage and license its template's name (the first by name if several are as
    good), both null without a match; licenses lists all matching names, sorted and comma-joined.
    :func:`licenses_sql` has the units only.

    One narrow pass of SQL functions: no shuffle, no Python, and nothing is kept between rows. Null text
    has no units, an empty text one. A unit of one word matches nothing. Repeated rows count each.
    """
    known = []
    for name, text in templates:
        grams = bigrams_of(text)
        low, high = bounds(len(grams), threshold)
        known.append(F.struct(F.lit(name).alias("name"), F.array(*map(F.lit, grams)).alias("grams"), F.lit(len(grams)).alias("n"),
                              F.lit(low).alias("low"), F.lit(high).alias("high")))
    least = min(bounds(len(bigrams_of(text)), threshold)[0] for _, text in templates)
    table = F.array(*known)
    text = F.col(f"`{text_column}`")

    def words(unit: Column) -> Column:
        return F.regexp_extract_all(F.lower(unit), F.lit(f"({WORD})"), F.lit(1))

    def bigrams(w: Column) -> Column:
        return F.array_distinct(pairs_of(w))

    def matches(grams: Column) -> Column:
        near = F.filter(table, lambda t: F.size(grams).between(t["low"], t["high"]))
        scored = F.transform(near, lambda t: F.struct(
            (F.lit(2.0) * F.size(F.array_intersect(grams, t["grams"])) / (F.size(grams) + t["n"])).alias("dice"), t["name"].alias("name")))
        return F.filter(scored, lambda s: s["dice"] >= threshold)

    blocks = F.filter(F.split(text, "\n[ \t\r]*\n"), lambda p: F.contains(p, F.lit("\n")))
    units = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.concat(F.split(text, "\n"), blocks).alias("units"),
                        words(F.regexp_replace(F.lower(text), LEADER, " ")).alias("words"))
    # every step binds its value once, as the variable of the next
    sets = units.select("doc_id", F.coalesce(F.size("units"), F.lit(0)).alias("n_units"), F.filter(
        F.transform(F.filter(F.transform("units", words), lambda w: F.size(w) > least), bigrams),
        lambda g: F.size(g) >= least).alias("sets"), pairs_of(F.col("words")).alias("pairs"))
    wanted = [*templates, *paragraphs]
    marks = F.array(*map(F.lit, anchors(wanted, threshold)))
    inside = F.when(F.arrays_overlap("pairs", marks), passages(F.col("pairs"), wanted, threshold))
    found = sets.select("doc_id", "n_units", F.filter(F.transform("sets", matches), lambda m: F.size(m) > 0).alias("found"), inside.alias("inside"))
    flat = F.concat(F.flatten("found"), F.coalesce("inside", F.array()))
    best = F.array_min(F.transform(flat, lambda s: F.struct((-s["dice"]).alias("d"), s["name"].alias("name"))))
    out = found.select("doc_id", F.greatest("n_units", F.lit(0)).cast("long").alias("n_units"),
                       F.coalesce(F.greatest(F.size("found"), F.lit(0)), F.lit(0)).cast("long").alias("n_matches"),
                       best.alias("best"), F.array_sort(F.array_distinct(F.transform(flat, lambda s: s["name"]))).alias("names"))
    return out.select("doc_id", "n_units", "n_matches", F.col("best.name").alias("license"), (-F.col("best.d")).alias("dice"),
                      F.coalesce(F.array_join("names", ","), F.lit("")).alias("licenses"))


def licenses_sql(templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same over a table ``documents`` in DuckDB, every unit against every template."""
    rows = ", ".join(f"({k}, '{name}', [{', '.join(repr(g) for g in bigrams_of(text))}])" for k, (name, text) in enumerate(templates))
    return rf"""
WITH t(k, name, grams) AS (VALUES {rows}),
u AS (
  SELECT doc_id, row_number() OVER () AS r,
         list_concat(string_split(text, chr(10)), list_filter(regexp_split_to_array(text, '\n[ \t\r]*\n'), lambda p: contains(p, chr(10)))) AS units
  FROM documents
),
w AS (SELECT r, i, regexp_extract_all(lower(units[i]), '{WORD}') AS w FROM (SELECT r, units, unnest(range(1, len(units) + 1)) AS i FROM u)),
g AS (SELECT r, i, list_distinct(list_transform(range(1, len(w)), lambda j: w[j] || ' ' || w[j + 1])) AS g FROM w WHERE len(w) > 1),
s AS (SELECT r, i, name, 2.0::DOUBLE * len(list_intersect(g.g, t.grams)) / (len(g.g) + len(t.grams)) AS dice FROM g, t),
m AS (SELECT * FROM s WHERE dice >= {threshold}),
a AS (SELECT r, count(DISTINCT i) AS n, max(dice) AS dice, list_sort(list(DISTINCT name)) AS names FROM m GROUP BY r),
b AS (SELECT m.r, min(m.name) AS license FROM m JOIN a ON m.r = a.r AND m.dice = a.dice GROUP BY m.r)
SELECT u.doc_id, CAST(coalesce(len(units), 0) AS BIGINT) AS n_units, CAST(coalesce(a.n, 0) AS BIGINT) AS n_matches,
       b.license, a.dice, coalesce(array_to_string(a.names, ','), '') AS licenses
FROM u LEFT JOIN a ON u.r = a.r LEFT JOIN b ON u.r = b.r
"""
