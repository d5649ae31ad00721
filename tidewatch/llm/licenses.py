"""Licence scans: sparse TF-IDF cosine to templates, then inheritance from the nearest
directory above with a licence.

Units are the lines of a file that speak of licences (a header or a note may stand anywhere
in the text), the paragraph and the comment block around such a line, and the whole text of
a licence file. Lines are held against short notices; blocks and whole texts also against
wrapped headers, headings of licence files and whole texts of short licences. The terms of a unit and of the templates
are weighted by count times the inverse document frequency over the templates (a term that
no template has gets the highest), and joined on the term: the dot products are sums over
joined terms, so no unit is compared with a template that shares no term with it.

A file's own licence is that of its best unit: the one with the highest score, or, of units
that are nearly equal to a template, the one with the longest. The licence files of a directory give it a
licence; a file without one of its own takes that of the nearest directory on its path.
Directories are resolved first (each distinct one once), then files joined on theirs.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import map_arrow, stage_table

#: least cosine of a unit and a template
THRESHOLD = 0.55
#: a unit and a template from this cosine on are nearly equal
NEAR = 0.9
#: rows of a table of directories that may be broadcast
BROADCAST_ROWS = 1_000_000
# fixed values: names of licence files, words that mark a unit, and notices of common licences
LICENSE_FILE = r"(?i)^(un)?licen[sc]e([-.].*)?$|^copying([-.].*)?$"
MARKERS = r"(?i)licen[sc]|copyright|spdx|hereby granted|public domain|redistribution and use"
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, version 3 of the License."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated this work to the public domain under CC0 1.0."),
    ("Proprietary", "Copyright. All rights reserved."),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0."),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0."),
    ("EUPL-1.2", "Licensed under the European Union Public Licence, version 1.2 (EUPL)."),
    ("CDDL-1.0", "The contents of this file are subject to the terms of the Common Development and Distribution License, version 1.0 (CDDL)."),
    ("Zlib", "Released under the zlib License."),
    ("Artistic-2.0", "Licensed under the Artistic License 2.0."),
    ("OFL-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
    ("WTFPL", "Do What The Fuck You Want To Public License"),
    ("PostgreSQL", "Released under the PostgreSQL License."),
    ("MS-PL", "Licensed under the Microsoft Public License (Ms-PL)."),
)
_MIT_GRANT = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'
_MIT = _MIT_GRANT + ' The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
_BSD_2 = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_3 = " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
_ISC_END = ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
_APACHE = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'
_APACHE_END = ' Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'


def _gnu(name: str, what: str, license: str, version: str, heading: str) -> list[tuple[str, str]]:
    """First paragraph of the header, the whole header, the heading of the licence file, and the identifiers."""
    first = f"This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {license} as published by the Free Software Foundation; either version {version} of the License, or (at your option) any later version."
    rest = f" This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {license} for more details. You should have received a copy of the GNU {license} along with this {what}. If not, see http://www.gnu.org/licenses/."
    return [(name, first), (name, first + rest), (name, f"GNU {license} Version {version}, {heading}"), *((name, f"SPDX-License-Identifier: {name}{x}") for x in ("", "-only", "-or-later"))]


# fixed values: identifiers of further licences
IDENTIFIERS = ("BSL-1.0", "EPL-1.0", "EPL-2.0", "EUPL-1.2", "CDDL-1.0", "Zlib", "Artistic-2.0", "OFL-1.1", "WTFPL", "PostgreSQL", "MS-PL", "0BSD", "Unlicense", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "Python-2.0", "NCSA")
_BOOST = "Boost Software License - Version 1.0 - August 17th, 2003"
_BOOST_GRANT = " Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:"
_ZLIB = "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"
# headers and headings, for units of more lines
TEXTS = (
    *TEMPLATES,
    *((name, f"SPDX-License-Identifier: {name}") for name in IDENTIFIERS),
    ("BSL-1.0", _BOOST), ("BSL-1.0", _BOOST + _BOOST_GRANT), ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)"), ("Zlib", _ZLIB),
    ("EPL-2.0", "Eclipse Public License - v 2.0"), ("EPL-1.0", "Eclipse Public License - v 1.0"), ("EUPL-1.2", "European Union Public Licence v. 1.2 EUPL"), ("Artistic-2.0", "The Artistic License 2.0"),
    ("OFL-1.1", "SIL Open Font License Version 1.1 - 26 February 2007"), ("CDDL-1.0", "Common Development and Distribution License (CDDL) Version 1.0"),
    ("MIT", _MIT_GRANT), ("MIT", _MIT), ("MIT", "MIT License Copyright " + _MIT),
    ("BSD-2-Clause", _BSD_2), ("BSD-2-Clause", _BSD_2 + _BSD_END), ("BSD-3-Clause", _BSD_2 + _BSD_3), ("BSD-3-Clause", _BSD_2 + _BSD_3 + _BSD_END), ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("ISC", _ISC), ("ISC", _ISC + _ISC_END), ("ISC", "SPDX-License-Identifier: ISC"),
    ("Apache-2.0", _APACHE), ("Apache-2.0", _APACHE + _APACHE_END), ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    *_gnu("GPL-3.0", "program", "General Public License", "3", "29 June 2007"), *_gnu("GPL-2.0", "program", "General Public License", "2", "June 1991"),
    *_gnu("LGPL-3.0", "library", "Lesser General Public License", "3", "29 June 2007"), *_gnu("LGPL-2.1", "library", "Lesser General Public License", "2.1", "February 1999"),
    *_gnu("LGPL-2.0", "library", "Library General Public License", "2", "June 1991"), *_gnu("AGPL-3.0", "program", "Affero General Public License", "3", "19 November 2007"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"), ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
_MARKED = re.compile(MARKERS)
_LEADER = re.compile(r"\s*(?:(//+!?|/\*+!?|\*+/|\*+|#+|--+|;+|%+|<!--|-->|(?:dnl|rem)(?=\s))\s*)?", re.IGNORECASE)
_TRAILER = re.compile(r"\s*(?:\*+/|-->|\*+|#+)?\s*\Z")


_EXPRESSION = re.compile(r"(?i)spdx-license-identifier:\s*(.*)")
_PIECE = re.compile(r"\s+(?:or|and|with)\s+|[()]|[A-Za-z0-9.+:-]+|\s+", re.IGNORECASE)
_OPERATOR = re.compile(r"\s+(or|and|with)\s+\Z", re.IGNORECASE)


def expression(line: str) -> list[str] | None:
    """Names, operators and brackets of the SPDX expression of a line, operators between single spaces; None for a single name or
    where what follows the identifier isn't an expression."""
    found = _EXPRESSION.search(line)
    if not found:
        return None
    pieces, at, text = [], 0, found[1].strip()
    for m in _PIECE.finditer(text):
        if m.start() != at:
            return None
        at = m.end()
        operator = _OPERATOR.match(m[0])
        pieces.append(f" {operator[1].upper()} " if operator else m[0])
    pieces = [x for x in pieces if not x.isspace()]
    return pieces if at == len(text) and any(is_operator(x) for x in pieces) else None


def is_operator(piece: str) -> bool:
    return piece in (" OR ", " AND ", " WITH ")


def units_of(text: str, whole: bool) -> Iterator[tuple[int, int, int | None, list[str] | None, str]]:
    """``line``, ``unit`` (a number), ``part``, ``pieces``, ``text`` of the blocks of a text and, if asked for, of the whole. A line
    with an SPDX expression gives a unit for each name of it: its place in the expression is the ``part``."""
    for k, (line, unit) in enumerate([*blocks(text), *([(-1, text)] if whole else [])]):
        pieces = expression(unit) if "\n" not in unit else None
        if not pieces:
            yield line, k, None, None, unit
            continue
        for at, name in enumerate(pieces):
            if name not in ("(", ")") and not is_operator(name) and (at == 0 or pieces[at - 1] != " WITH "):
                yield line, k, at, pieces, f"SPDX-License-Identifier: {name}"


def blocks(text: str) -> list[tuple[int, str]]:
    """Paragraphs and comment blocks of more than a line that have a marker, each with the line of its first marker, and lines with an
    SPDX identifier. A paragraph
    ends at a line without words, a comment block (or a stretch without comments) at an empty line; both where comments begin or end."""
    lines, close = [], None
    for raw in text.split("\n"):
        m = _LEADER.match(raw)
        body = raw[m.end():]
        lines.append((body[:_TRAILER.search(body).start()] if m[1] or close else body.strip(), bool(m[1] or close), not raw.strip()))
        if close:
            close = None if close in raw else close
        elif m[1]:
            mark = "*/" if m[1].startswith("/*") else "-->" if m[1] == "<!--" else None
            close = mark if mark and mark not in body else None
    out = {(k, k): (k, x[0]) for k, x in enumerate(lines) if "spdx-license-identifier" in x[0].lower()}
    for ends in (lambda x: not x[0], lambda x: x[2]):
        start = 0
        for k in range(len(lines) + 1):
            if k < len(lines) and not ends(lines[k]) and (k == start or lines[k][1] == lines[k - 1][1]):
                continue
            words = [x for x in range(start, k) if lines[x][0]]
            marker = next((x for x in words if _MARKED.search(lines[x][0])), None)
            if marker is not None and len(words) > 1:
                out[words[0], words[-1]] = (marker, " ".join(lines[x][0] for x in words))
            start = k + 1 if k < len(lines) and ends(lines[k]) else k
    return list(out.values())


_TERM = regex.compile(r"[\p{L}\p{N}]+(?:[.+-][\p{L}\p{N}]+)*")


def _terms(text: Column) -> Column:
    """Lower-case runs of letters, digits and inner dots, hyphens or plus signs."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+(?:[.+-][\p{L}\p{N}]+)*)"), 1)


def template_weights(texts: tuple[tuple[str, str], ...] = TEMPLATES) -> tuple[dict[str, tuple[float, list[float]]], list[int], float]:
    """For each term of the templates its idf and its weight in each template (scaled to length 1); the number of terms of each
    template; and the idf of a term that no template has."""
    counts = [Counter(_TERM.findall(text.lower())) for _, text in texts]
    n = len(texts)
    idf = {t: math.log((1.0 + n) / (1.0 + sum(t in c for c in counts))) + 1.0 for c in counts for t in c}
    norms = [math.sqrt(sum((tf * idf[t]) ** 2 for t, tf in c.items())) for c in counts]
    return {t: (i, [c[t] * i / x if t in c else 0.0 for c, x in zip(counts, norms, strict=True)]) for t, i in idf.items()}, [len(c) for c in counts], math.log(1.0 + n) + 1.0


def scores(units: DataFrame, texts: tuple[tuple[str, str], ...], keys: tuple[str, ...]) -> DataFrame:
    """``keys``, ``license``, ``score`` and ``size`` (of the template, in terms) of all units and templates that are
    alike. ``units`` has ``text`` and the ``keys`` that name a unit. One aggregate gives a unit's norm and its products with all templates."""
    tf = units.select(*keys, F.explode(_terms(F.col("text"))).alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("tf"))
    weights, sizes, unseen = template_weights(texts)
    # fixed and small: a row for each term of the templates
    table = units.sparkSession.createDataFrame([(t, i, w) for t, (i, w) in sorted(weights.items())], "term string, idf double, weights array<double>")
    w = tf.join(F.broadcast(table), "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(unseen)))
    dots = [F.sum(F.col("w") * F.col("weights")[k]).alias(f"dot{k}") for k in range(len(texts))]
    each = w.groupBy(*keys).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), *dots)
    alike = F.array(*[F.struct(F.lit(name).alias("license"), F.round(F.col(f"dot{k}") / F.col("norm"), 9).alias("score"), F.lit(sizes[k]).cast("long").alias("size")) for k, (name, _) in enumerate(texts)])
    return each.select(*keys, F.inline(F.filter(alike, lambda x: x["score"] >= THRESHOLD)))


def own_licenses(marked: DataFrame) -> DataFrame:
    """``row``, ``license``, ``score`` and ``line`` (from 0, of a block its first marked line; -1: the whole text) of the best unit of
    each file that has one; of an SPDX expression the whole, with known names in the form used here and others as written. ``marked`` has ``row``, ``name``, ``text`` of the files with a marker."""
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("line"), x.alias("unit"))), lambda u: u["unit"].rlike(MARKERS))
    whole = F.when(F.col("name").rlike(LICENSE_FILE), F.array(F.struct(F.lit(-1).alias("line"), F.col("text").alias("unit")))).otherwise(F.array().cast("array<struct<line:int,unit:string>>"))
    units = marked.select("row", F.explode_outer(F.concat(lines, whole)).alias("u")).filter("u is not null").select("row", "u.line", F.lit(0).alias("unit"), F.col("u.unit").alias("text"))
    at = (-F.col("line")).alias("at")
    best = scores(units, TEMPLATES, ("row", "line", "unit")).groupBy("row").agg(F.max(F.struct("score", at, "license", "size")).alias("b")).select("row", F.lit(1).alias("short"), "b.*")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for row, is_license, text in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                out += [(row, *unit) for unit in units_of(text, is_license)]
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate(kinds)], names=["row", "line", "unit", "part", "pieces", "text"])

    more = map_arrow(marked.select("row", F.col("name").rlike(LICENSE_FILE).alias("is_license"), "text"), run, "row long, line int, unit int, part int, pieces array<string>, text string")
    # of a unit the most similar template; the names of an expression are put together again
    keys = ("row", "line", "unit", "part", "pieces")
    more = scores(more, TEXTS, keys).groupBy(*keys).agg(F.max(F.struct("score", "size", "license")).alias("b"))
    names = F.map_from_entries(F.collect_list(F.when(F.col("part").isNotNull(), F.struct("part", "b.license"))))
    more = more.groupBy("row", "line", "unit", "pieces").agg(F.min("b.score").alias("score"), F.max("b.size").alias("size"), F.max("b.license").alias("single"), names.alias("names"))
    joined = F.array_join(F.transform("pieces", lambda x, k: F.coalesce(F.try_element_at("names", k), x)), "")
    more = more.select("row", F.lit(0).alias("short"), "score", at, F.coalesce(joined, "single").alias("license"), "size")
    rank = F.struct(F.when(F.col("score") >= NEAR, F.col("size")).otherwise(0).alias("near"), "score", "short", "at", "license")
    return best.unionByName(more).groupBy("row").agg(F.max(rank).alias("b")).select("row", "b.license", "b.score", (-F.col("b.at")).alias("line"))


def _parent(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def nearest_licensed(dirs: DataFrame, licensed: DataFrame) -> DataFrame:
    """``dir``, ``license``, ``from_dir``: for each distinct directory, the licence of the nearest licensed one on its path (itself
    first; '' is the top). ``licensed`` has one row for each licensed directory: ``dir``, ``license``."""
    parts = F.when(F.col("dir") == "", F.array().cast("array<string>")).otherwise(F.split("dir", "/"))
    up = dirs.select("dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))).alias("from_dir"))
    hit = up.join(_sized(licensed.withColumnRenamed("dir", "from_dir")), "from_dir")
    return hit.groupBy("dir").agg(F.max(F.struct(F.length("from_dir").alias("n"), "from_dir", "license")).alias("b")).select("dir", "b.license", "b.from_dir")


def _sized(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def license_scan(files: DataFrame, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text") -> DataFrame:
    """Licence of every file.

    Returns ``id_col``, ``path_col``, ``own_license``, ``own_line``, ``license`` (its own, or else the
    inherited one; null if neither) and ``from_dir`` (where it was inherited from; null if its
    own). Null texts have no licence of their own, a null path lies in the top directory; ties go
    to the first unit, then the last name; repeated rows each give a row; other columns are
    left out; an empty table gives an empty result.
    """
    src = files.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("__id"), F.col(path_col).alias("__path"), F.coalesce(F.regexp_replace(F.col(path_col), r"^/+", ""), F.lit("")).alias("path"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    src = src.withColumn("dir", _parent(F.col("path"))).withColumn("name", F.regexp_extract("path", r"([^/]*)$", 1))
    # rows are numbered once, and texts kept where they have a marker
    names = stage_table(src.select("row", "__id", "__path", "dir", "name", F.when(F.col("text").rlike(MARKERS), F.col("text")).alias("text")), "files")
    own = stage_table(own_licenses(names.filter("text is not null").select("row", "name", "text")), "own-licenses")
    licensed = names.filter(F.col("name").rlike(LICENSE_FILE)).join(own, "row").groupBy("dir").agg(F.max(F.struct("score", "license")).alias("b")).select("dir", "b.license")
    licensed = stage_table(licensed, "licensed")
    found = stage_table(nearest_licensed(names.select("dir").distinct(), licensed), "directories")
    inherited = found.select("dir", F.col("license").alias("above"), "from_dir")
    out = names.drop("text").join(_sized(own.select("row", F.col("license").alias("own_license"), F.col("line").alias("own_line"))), "row", "left").join(_sized(inherited), "dir", "left")
    return out.select(
        F.col("__id").alias(id_col), F.col("__path").alias(path_col), "own_license", "own_line",
        F.coalesce("own_license", "above").alias("license"),
        F.when(F.col("own_license").isNull(), F.col("from_dir")).alias("from_dir"),
    )


def oracle_sql(path_sql: str) -> str:
    """The registered query's result in DuckDB's SQL; ``path_sql`` makes the path from a row of documents."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    values = ", ".join(f"({k}, {quoted(a)}, {quoted(b)})" for k, (a, b) in enumerate(TEMPLATES))
    terms = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+(?:[.+-][\p{{L}}\p{{N}}]+)*')"
    n = len(TEMPLATES)
    return f"""
WITH f AS (SELECT doc_id, {path_sql} AS path, coalesce(text, '') AS text FROM documents),
g AS (SELECT *, regexp_replace(path, '/?[^/]*$', '') AS dir, regexp_extract(path, '[^/]*$') AS name FROM f),
tpl AS (SELECT * FROM (VALUES {values}) AS t(tpl, license, text)),
ttf AS (SELECT tpl, license, term, count(*) AS tf FROM (SELECT tpl, license, unnest({terms.format('text')}) AS term FROM tpl) GROUP BY ALL),
idf AS (SELECT term, ln((1.0 + {n}) / (1.0 + count(*))) + 1 AS idf FROM ttf GROUP BY term),
tw AS (SELECT tpl, license, term, tf * idf / sqrt(sum((tf * idf) ** 2) OVER (PARTITION BY tpl)) AS weight FROM ttf JOIN idf USING (term)),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS unit, unnest(range(len(string_split(text, chr(10))))) AS line FROM g),
units AS (SELECT doc_id, line, unit FROM lines WHERE regexp_matches(unit, '{MARKERS}')
  UNION ALL SELECT doc_id, -1, text FROM g WHERE regexp_matches(name, '{LICENSE_FILE}') AND regexp_matches(text, '{MARKERS}')),
utf AS (SELECT doc_id, line, term, count(*) AS tf FROM (SELECT doc_id, line, unnest({terms.format('unit')}) AS term FROM units) GROUP BY ALL),
uw AS (SELECT doc_id, line, term, tf * coalesce(idf, ln(1.0 + {n}) + 1) AS w FROM utf LEFT JOIN idf USING (term)),
norm AS (SELECT doc_id, line, sqrt(sum(w * w)) AS norm FROM uw GROUP BY ALL),
score AS (SELECT doc_id, line, license, round(sum(w * weight) / any_value(norm), 9) AS score FROM uw JOIN tw USING (term) JOIN norm USING (doc_id, line) GROUP BY doc_id, line, tpl, license),
own AS (SELECT doc_id, license, score, line FROM score WHERE score >= {THRESHOLD} QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, line, license DESC) = 1),
lic AS (SELECT dir, license FROM g JOIN own USING (doc_id) WHERE regexp_matches(name, '{LICENSE_FILE}') QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, license DESC) = 1),
near AS (SELECT d.dir, lic.license, lic.dir AS from_dir FROM (SELECT DISTINCT dir FROM g) d JOIN lic ON d.dir = lic.dir OR starts_with(d.dir, lic.dir || '/') OR lic.dir = ''
  QUALIFY row_number() OVER (PARTITION BY d.dir ORDER BY length(lic.dir) DESC) = 1)
SELECT g.doc_id, g.path, own.license AS own_license, own.line AS own_line, coalesce(own.license, near.license) AS license,
  CASE WHEN own.license IS NULL THEN near.from_dir END AS from_dir
FROM g LEFT JOIN own USING (doc_id) LEFT JOIN near ON g.dir = near.dir
"""
