"""Operator 3, licence scans by the Dice coefficient over word bigrams.

Every line of a text, every block of lines between empty lines, and the whole text are normalised to words
(lower case, ASCII marks dropped) and compared to licence templates. Dice is twice the shared bigrams over
the sum of both counts, repeats included, so with a threshold t only templates of t/(2-t) to (2-t)/t times
as many bigrams can match: sizes prune first, then an index from bigram to template leaves only those
that share enough. One pass over the texts, no shuffle.

Defined cases: null text is empty and finds nothing; a unit of one word has no bigrams and matches nothing;
ties between templates go to the first by name; repeated rows and null ids are kept; an empty table gives an
empty result; other columns are never read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.llm.common import table, text_of

THRESHOLD = 0.8
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

#: Notices and licence texts (fixed wording).
TEMPLATES = (
    ("all-rights-reserved", "All rights reserved."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("bsd-2-clause", "Licensed under the BSD 2-Clause License."),
    ("bsd-3-clause", "Licensed under the BSD 3-Clause License."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("lgpl-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("mit", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("agpl-3.0", 'This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details. You should have received a copy of the GNU Affero General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.'),
    ("bsd-2-clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
    ("bsd-2-clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.'),
    ("bsd-3-clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
    ("bsd-3-clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.'),
    ("bsl-1.0", 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:'),
    ("gpl-3.0", 'This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.'),
    ("unlicense", 'This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.'),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
)

_BLANK = str.maketrans(dict.fromkeys(MARKS, " "))


def words(text: str) -> list[str]:
    return text.lower().translate(_BLANK).split()


class Templates:
    def __init__(self, templates=TEMPLATES, threshold: float = THRESHOLD):
        self.threshold = threshold
        self.names, self.grams, self.sizes, self.index = [], [], [], {}
        for name, text in templates:
            w = words(text)
            grams = Counter(zip(w, w[1:], strict=False))
            for g in grams:
                self.index.setdefault(g, []).append(len(self.names))
            self.names.append(name)
            self.grams.append(grams)
            self.sizes.append(max(0, len(w) - 1))
        # Which templates a unit of so many bigrams may match, were the smaller of both wholly shared.
        most = int(max(self.sizes, default=0) * (2 - threshold) / threshold) + 2
        self.open = [frozenset(k for k, b in enumerate(self.sizes) if b and 2 * min(n, b) / (n + b) >= threshold) for n in range(most + 1)]

    def best(self, w: list[str]) -> tuple[str, float] | None:
        """The template that matches these words best, if one reaches the threshold."""
        n = len(w) - 1
        if n < 1 or n >= len(self.open) or not (fit := self.open[n]):
            return None
        shared: Counter = Counter()
        for g in zip(w, w[1:], strict=False):
            for k in self.index.get(g, ()):
                shared[k] += 1
        found = None
        for k, most in shared.items():
            if k in fit and 2 * most / (n + self.sizes[k]) >= self.threshold:
                dice = 2 * (Counter(zip(w, w[1:], strict=False)) & self.grams[k]).total() / (n + self.sizes[k])
                if dice >= self.threshold and (found is None or (-dice, self.names[k]) < (-found[1], found[0])):
                    found = self.names[k], dice
        return found

    def scan(self, text: str) -> list[tuple[int, int, str, float]]:
        """(start, end, template, dice) of every line, block of lines and whole text that matches, in code points."""
        out, at = set(), 0
        # Line ends of two characters become one with a space before it, so that places stay.
        text = text.replace("\r\n\r\n", "  \n\n").replace("\r\n", " \n")
        blocks = text.split("\n\n")
        units = []
        for block in blocks:
            lines = block.split("\n")
            parts, start = [], at
            for line in lines:
                parts.append(words(line))
                units.append((start, start + len(line), parts[-1]))
                start += len(line) + 1
            if len(lines) > 1:
                units.append((at, at + len(block), [w for p in parts for w in p]))
            at += len(block) + 2
        if len(blocks) > 1:
            units.append((0, len(text), words(text)))
        for start, end, w in units:
            if found := self.best(w):
                out.add((start, end, *found))
        return sorted(out)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, found: array<struct<start, end, license, dice>>."""

    @F.pandas_udf("array<struct<start:int,end:int,license:string,dice:double>>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = Templates(templates, threshold)
        for batch in batches:
            yield pd.Series([[dict(zip(("start", "end", "license", "dice"), x, strict=True)) for x in known.scan(t)] for t in batch], dtype=object)

    return docs.select(F.col(id_col).alias("id"), of(text_of(text_col)).alias("found"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    spelled = F.transform("found", lambda x: F.concat_ws(":", x["license"], x["start"], x["end"]))
    best = F.array_min(F.transform("found", lambda x: F.struct((-x["dice"]).alias("minus"), x["license"].alias("license"))))
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("found").cast("long").alias("n_found"),
        best["license"].alias("license"),
        F.round(-best["minus"], 6).alias("dice"),
        F.array_join(spelled, ",").alias("found"),
    )


QUERIES = {"op3_license_scan": op3_license_scan}


def _oracle() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    split = f"list_filter(string_split(translate(lower(u), {quote(MARKS)} || chr(9) || chr(10) || chr(13), repeat(' ', {len(MARKS) + 3})), ' '), lambda x: x <> '')"
    values = ", ".join(f"({k}, {quote(n)}, {quote(t)})" for k, (n, t) in enumerate(TEMPLATES))
    grams = "SELECT {key}, w[i] || ' ' || w[i + 1] AS g, count(*) AS c FROM (SELECT {key}, w, unnest(range(1, len(w))) AS i FROM {table}) GROUP BY ALL"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, replace(replace(coalesce(text, ''), chr(13) || chr(10) || chr(13) || chr(10), '  ' || chr(10) || chr(10)), chr(13) || chr(10), ' ' || chr(10)) AS t FROM documents),
b0 AS (SELECT r, t, unnest(bs) AS u, generate_subscripts(bs, 1) AS k, len(bs) AS n FROM (SELECT r, t, string_split(t, chr(10) || chr(10)) AS bs FROM d)),
b AS (SELECT *, CAST(sum(length(u) + 2) OVER (PARTITION BY r ORDER BY k) - length(u) - 2 AS BIGINT) AS s FROM b0),
l0 AS (SELECT r, k, s AS bs, unnest(ls) AS u, generate_subscripts(ls, 1) AS j FROM (SELECT r, k, s, string_split(u, chr(10)) AS ls FROM b)),
l AS (SELECT r, u, CAST(bs + sum(length(u) + 1) OVER (PARTITION BY r, k ORDER BY j) - length(u) - 1 AS BIGINT) AS s FROM l0),
units AS (SELECT row_number() OVER () AS unit, * FROM (
  SELECT r, s, s + length(u) AS e, {split} AS w FROM (
    SELECT r, u, s FROM l UNION ALL SELECT r, u, s FROM b WHERE contains(u, chr(10)) UNION ALL SELECT DISTINCT r, t, 0 FROM b WHERE n > 1))
  WHERE len(w) > 1),
tpl AS (SELECT k, name, {split} AS w FROM (VALUES {values}) AS v(k, name, u)),
ug AS ({grams.format(key='unit', table='units')}),
tg AS ({grams.format(key='k', table='tpl')}),
shared AS (SELECT unit, k, sum(least(ug.c, tg.c)) AS n FROM ug JOIN tg USING (g) GROUP BY unit, k),
dice AS (SELECT unit, name, r, s, e, 2 * n / (len(units.w) - 1 + len(tpl.w) - 1) AS dice FROM shared JOIN units USING (unit) JOIN tpl USING (k)),
best AS (SELECT DISTINCT r, s, e, name, dice FROM (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY dice DESC, name) AS p FROM dice WHERE dice >= {THRESHOLD}) WHERE p = 1),
told AS (SELECT r, count(*) AS n_found, arg_min(name, (-dice, name)) AS license, round(max(dice), 6) AS dice, string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, e, name) AS found FROM best GROUP BY r)
SELECT doc_id, coalesce(n_found, 0) AS n_found, license, dice, coalesce(found, '') AS found FROM d LEFT JOIN told USING (r)
"""


ORACLES = {"op3_license_scan": _oracle()}
