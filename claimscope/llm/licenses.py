"""License scans by Dice coefficient over word bigrams, with DataFrame functions only.

The normal form has A-Z in lower case and every run of other ASCII characters than letters
and digits as one space; line ends stay, and sentence ends (``.``, ``!`` or ``?`` before a space or tab)
are marked.  A text's units are its lines, the sentences of its lines, and its paragraphs (parts
between lines without words).  A template is the set of its word bigrams; a unit's bigrams count
with repeats.  2 |U and T| / (|U| + |T|) of ``SIMILAR`` or more is a match.

A match needs |U| between |T| s / (2 - s) and |T| (2 - s) / s, where s is ``SIMILAR``, and |U| is one
less than the unit's words: units too short or too long for every template are dropped before
bigrams are made, and a unit is compared with templates within these bounds only.  A row is
worked on where it is read: nothing is shuffled, and the templates are a constant of the plan.

Edge cases: a null or empty text has no units.  Equal units of a text count once.  Repeated rows
are judged one by one.  A unit of one word has no bigram and matches nothing.  U+0001 in a text ends
a sentence.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIMILAR = 0.8

# Licence names (SPDX) and notices as their publishers word them.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
                   "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
            "persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
                "later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_OTHER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# as above, but for the line feed and the sentence mark
_WITHIN = r"[\x00\x02-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"
_SENTENCE = r"[.!?]+[\x20\x09]+"
_MARK = "\x01"


def _bigrams(text: str) -> list[str]:
    words = re.sub(_OTHER, " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def _sizes(similar: float, templates: Sequence[tuple[str, str]]) -> list[tuple[str, list[str], int, int]]:
    """License, bigrams, least and most bigrams of a unit that can match."""
    out = []
    for name, text in templates:
        grams = _bigrams(text)
        out.append((name, grams, math.ceil(len(grams) * similar / (2 - similar) - 1e-9), math.floor(len(grams) * (2 - similar) / similar + 1e-9)))
    return out


def license_matches(text: Column, similar: float = SIMILAR, templates: Sequence[tuple[str, str]] = TEMPLATES) -> Column:
    """Array of (license, dice), one for every matching pair of unit and template."""
    sized = _sizes(similar, templates)
    least, most = min(t[2] for t in sized), max(t[3] for t in sized)
    low = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    form = F.regexp_replace(F.regexp_replace(low, _SENTENCE, _MARK), _WITHIN, " ")
    lines = F.split(form, "\n")
    sentences = F.split(form, f"[\n{_MARK}]")
    paragraphs = F.split(form, f"\n[{_MARK} ]*\n")
    words = F.transform(F.concat(lines, sentences, paragraphs), lambda u: F.filter(F.split(u, f"[{_MARK} \n]+"), lambda w: w != ""))
    near = F.array_distinct(F.filter(words, lambda w: F.size(w).between(least + 1, most + 1)))
    grams = F.transform(near, lambda w: F.transform(F.slice(w, 2, F.size(w) - 1), lambda x, i: F.concat(F.get(w, i), F.lit(" "), x)))
    known = F.array(*[F.struct(F.lit(name).alias("license"), F.array(*map(F.lit, g)).alias("grams"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))
                      for name, g, lo, hi in sized])
    pairs = F.flatten(F.transform(grams, lambda g: F.transform(
        F.filter(known, lambda t: F.size(g).between(t["lo"], t["hi"])),
        lambda t: F.struct(t["license"].alias("license"),
                           (F.size(F.array_intersect(t["grams"], g)) * 2.0 / (F.size(g) + F.size(t["grams"]))).alias("dice")))))
    return F.filter(pairs, lambda p: p["dice"] >= similar)


def scan_licenses(docs: DataFrame, text_col: str = "text", out: str = "licenses", similar: float = SIMILAR,
                  templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """``docs`` with the array column ``out`` of matches."""
    return docs.withColumn(out, license_matches(F.col(text_col), similar, templates))


def license_report(docs: DataFrame) -> DataFrame:
    """One row per document: number of matches, licences found, best coefficient (0 without a match)."""
    got = scan_licenses(docs.select("doc_id", "text")).select("doc_id", "licenses")
    return got.select("doc_id", F.size("licenses").cast("long").alias("n_matches"),
                      F.array_join(F.array_sort(F.array_distinct("licenses.license")), ",").alias("licenses"),
                      F.coalesce(F.array_max("licenses.dice"), F.lit(0.0)).alias("best_dice"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


#: The same result in DuckDB: every unit against every template, without bounds.
ORACLE = rf"""
WITH template(license, t) AS (VALUES {", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in TEMPLATES)}),
tw AS (SELECT row_number() OVER () AS k, license, string_split(trim(regexp_replace(lower(t), '{_OTHER}', ' ', 'g')), ' ') AS w FROM template),
tg AS (SELECT DISTINCT k, license, w[i] || ' ' || w[i + 1] AS g FROM (SELECT k, license, w, unnest(range(1, len(w))) AS i FROM tw)),
tn AS (SELECT k, license, count(*) AS n FROM tg GROUP BY ALL),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_replace(regexp_replace(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
        '{_SENTENCE}', chr(1), 'g'), '{_WITHIN}', ' ', 'g') AS form FROM documents),
unit AS (SELECT r, unnest(string_split(form, chr(10))) AS u FROM d
         UNION ALL SELECT r, unnest(regexp_split_to_array(form, '[\n\x01]')) FROM d
         UNION ALL SELECT r, unnest(regexp_split_to_array(form, '\n[\x01 ]*\n')) FROM d),
form AS (SELECT DISTINCT r, trim(regexp_replace(u, '[\x01 \n]+', ' ', 'g')) AS u FROM unit),
uw AS (SELECT r, u, string_split(u, ' ') AS w FROM form),
un AS (SELECT r, u, len(w) - 1 AS n FROM uw),
ug AS (SELECT DISTINCT r, u, w[i] || ' ' || w[i + 1] AS g FROM (SELECT r, u, w, unnest(range(1, len(w))) AS i FROM uw)),
pair AS (SELECT r, u, k, count(*) AS c FROM ug JOIN tg USING (g) GROUP BY ALL),
hit AS (SELECT r, license, c * 2.0::DOUBLE / (un.n + tn.n) AS dice FROM pair JOIN un USING (r, u) JOIN tn USING (k)
        WHERE c * 2.0::DOUBLE / (un.n + tn.n) >= {SIMILAR})
SELECT doc_id, count(license) AS n_matches, coalesce(string_agg(DISTINCT license, ',' ORDER BY license), '') AS licenses,
       coalesce(max(dice), 0.0::DOUBLE) AS best_dice
FROM d LEFT JOIN hit USING (r) GROUP BY r, doc_id
"""
