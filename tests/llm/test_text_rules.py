import math
import random
import re
from collections import Counter

import duckdb
import pytest

from tidewatch.llm import divergence, licenses, winnow
from tidewatch.llm import queries as Q

SF = "/root/testdata/sf0.001"


def base(text):
    w = re.findall("[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    c, hit = Counter(zip(w, w[1:], w[2:])), set()
    for k in range(len(w) - 2):
        if c[tuple(w[k:k + 3])] > 1:
            hit |= {k, k + 1, k + 2}
    n = len(hit)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), n, len(w) < 50 or 100 * n > 50 * len(w)


def order(x):
    return sorted(x, key=lambda v: (v[0] is not None, v))


def test_quality_base_counts(clashing, empty, texts):
    got = divergence.judge(clashing).collect()
    assert order((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == order((i, *base(t)) for i, t in texts)
    assert not any(r.kept and r.base_failed for r in got)
    assert divergence.judge(empty).count() == 0


def test_quality_divergence_rejects_odd_histograms(spark):
    words = "the of and to in is that for it with as on river stone cloud paper garden window basket candle ".split()
    r = random.Random(1)
    good = [(k, " ".join(r.choice(words) for _ in range(300)), "en") for k in range(60)]
    odd = [(100, " ".join(f"{r.choice(words)}###$$$" for _ in range(200)), "en"), (101, " ".join(f"w{chr(97 + j % 26)}{chr(97 + j // 26)}x" for j in range(300)), None), (102, "## ab", "en")]
    got = {r.doc_id: r for r in divergence.judge(spark.createDataFrame(good + odd, "doc_id long, text string, lang string")).collect()}
    assert not got[100].kept and got[100].char_js > 0.3
    assert not got[101].kept and got[101].word_js > 0.3
    assert got[102].char_js is None and got[102].word_js is None and got[102].base_failed
    assert all(r.word_js < 0.3 and r.char_js < 0.3 for k, r in got.items() if k < 100)


def grams(texts, items):
    words = lambda t: re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(i)
    out = []
    for i, t in texts:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        out.append((i, len(w), len(hit), tuple(sorted(found))))
    return out


@pytest.mark.parametrize("limit", [winnow.BROADCAST_ROWS, 0])
def test_winnowing_equals_all_windows(spark, clashing, empty, texts, monkeypatch, limit):
    from pyspark.sql import functions as F

    monkeypatch.setattr(winnow._sized, "__defaults__", (limit,))
    extra = [(900, "THE same, line"), (901, None), (902, ""), (903, "again"), (904, "the same line again " * 9), (905, " ".join((texts[0][1] or "").split()[:25]))]
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").unionByName(spark.createDataFrame(extra, "item_id long, text string"))
    items = [(r.item_id, r.text) for r in bench.collect()]
    got = winnow.contamination(clashing, bench.withColumn("doc_id", F.lit("clash"))).collect()
    assert order((r.doc_id, r.n_words, r.n_hit, tuple(sorted(r["items"]))) for r in got) == order(grams(texts, items))
    assert any(r.n_hit for r in got)
    none = spark.createDataFrame([], bench.schema)
    assert winnow.contamination(empty, bench).count() == 0
    assert winnow.contamination(clashing, none).filter("n_hit > 0").count() == 0


def oracle(name, sf=SF):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    rel = con.execute(Q.ORACLES[name])
    names = [d[0] for d in rel.description]
    return sorted((dict(zip(names, r)) for r in rel.fetchall()), key=by_id)


def by_id(row):
    return row.get("doc_id", row.get("vec_id"))


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_oracles(spark, name):
    got = sorted((r.asDict() for r in Q.QUERIES[name](spark, SF).collect()), key=by_id)
    assert got == oracle(name)


def test_license_inheritance(spark, clashing, empty):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    files = [(1, "a/LICENSE", mit), (2, "a/b/x.py", "code"), (3, "a/b/c/COPYING.txt", "words\n" + gpl), (4, "a/b/c/d/y.py", None), (5, "a/b/z.py", f"code\n# {gpl}\n"), (6, "ab/q.py", ""), (7, "/a/top.py", "x"),
             (8, None, mit), (9, "e/license.md", "nothing of the kind"), (10, "e/f.py", "no licence is given here")]
    got = {r.doc_id: (r.own_license, r.license, r.from_dir) for r in licenses.license_scan(spark.createDataFrame(files, "doc_id int, path string, text string")).collect()}
    assert got == {1: ("MIT", "MIT", None), 2: (None, "MIT", "a"), 3: ("GPL-3.0", "GPL-3.0", None), 4: (None, "GPL-3.0", "a/b/c"), 5: ("GPL-3.0", "GPL-3.0", None), 6: (None, None, None),
                   7: (None, "MIT", "a"), 8: ("MIT", "MIT", None), 9: (None, None, None), 10: (None, None, None)}
    assert licenses.license_scan(clashing, path_col="path").count() == clashing.count()
    assert licenses.license_scan(empty, path_col="source").count() == 0


GPL_3 = """ This program is free software: you can redistribute it and/or modify
 it under the terms of the GNU General Public License as published by
 the Free Software Foundation, either version 3 of the License, or
 (at your option) any later version.

 This program is distributed in the hope that it will be useful,
 but WITHOUT ANY WARRANTY; without even the implied warranty of
 MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 GNU General Public License for more details."""
LGPL_21 = """ This library is free software; you can redistribute it and/or
 modify it under the terms of the GNU Lesser General Public
 License as published by the Free Software Foundation; either
 version 2.1 of the License, or (at your option) any later version."""
BSD = """ Copyright 2019 X. All rights reserved.

 Redistribution and use in source and binary forms, with or without
 modification, are permitted provided that the following conditions are
 met:

 1. Redistributions of source code must retain the above copyright notice,
    this list of conditions and the following disclaimer.
 2. Redistributions in binary form must reproduce the above copyright
    notice, this list of conditions and the following disclaimer in the
    documentation and/or other materials provided with the distribution.
"""
APACHE = """ Licensed under the Apache License, Version 2.0 (the "License");
 you may not use this file except in compliance with
 the License."""
MIT = licenses._MIT.replace(", ", ",\n").replace(". ", ".\n\n")


def test_wrapped_headers_and_license_files(spark):
    star = lambda x: "/*\n" + "\n".join(f" *{v}" for v in x.split("\n")) + "\n */\nint main() { return 0; }\n"
    hashes = lambda x: "#!/bin/sh\n" + "\n".join(f"#{v}" for v in x.split("\n")) + "\necho a\n"
    bare = lambda x: "/*" + x + "*/\nint x;\n"
    files = [("top/LICENSE", "Released under the MIT License.", "MIT")]
    for name, text in (("GPL-3.0", GPL_3), ("GPL-2.0", GPL_3.replace("version 3", "version 2")), ("LGPL-2.1", LGPL_21), ("BSD-2-Clause", BSD), ("Apache-2.0", APACHE), ("MIT", " Copyright (c) 2020 X\n\n" + MIT)):
        files += [(f"top/{name}-{k}", way(text), name) for k, way in enumerate((star, hashes, bare))]
    heading = "                    GNU {}GENERAL PUBLIC LICENSE\n                       Version {}\n\n Everyone is permitted to copy and distribute verbatim copies\n of this license document, but changing it is not allowed.\n"
    for name, kind, version in (("GPL-3.0", "", "3, 29 June 2007"), ("GPL-2.0", "", "2, June 1991"), ("LGPL-2.1", "LESSER ", "2.1, February 1999"), ("AGPL-3.0", "AFFERO ", "3, 19 November 2007")):
        files.append((f"{name}/COPYING", heading.format(kind, version), name))
    files += [("m/LICENSE", "MIT License\n\nCopyright (c) 2020 X\n\n" + MIT, "MIT"), ("b/LICENSE", BSD, "BSD-2-Clause"), ("top/own.c", "// Copyright 2019 X. All rights reserved.\nint x;", "Proprietary"), ("top/none.c", "int x;\nint y;", None)]
    files += [(f"top/{x}.c", f"/* SPDX-License-Identifier: {x} */\nint x;\n", y) for x, y in (("LGPL-2.1-or-later", "LGPL-2.1"), ("GPL-2.0-only", "GPL-2.0"), ("ISC", "ISC"))]
    want = {path: own for path, _, own in files}
    got = {r.path: r.own_license for r in licenses.license_scan(spark.createDataFrame([(k, a, b) for k, (a, b, _) in enumerate(files)], "doc_id int, path string, text string")).collect()}
    assert {k: (got[k], v) for k, v in want.items() if got[k] != v} == {}


def test_license_expressions_and_families(spark):
    files = [(f"/* SPDX-License-Identifier: {x} */", y) for x, y in (
        ("MIT OR Apache-2.0", "MIT OR Apache-2.0"), ("(MIT or apache-2.0) AND BSD-3-Clause", "(MIT OR Apache-2.0) AND BSD-3-Clause"), ("GPL-2.0-or-later WITH Classpath-exception-2.0", "GPL-2.0 WITH Classpath-exception-2.0"),
        ("MIT OR LicenseRef-Own", "MIT OR LicenseRef-Own"), ("BSL-1.0", "BSL-1.0"), ("0BSD", "0BSD"), ("EPL-2.0 OR GPL-2.0-only OR MIT", "EPL-2.0 OR GPL-2.0 OR MIT"), ("LicenseRef-A OR LicenseRef-B", None), ("MIT OR", "MIT"))]
    files += [("BSD 3-Clause License\n\nCopyright (c) 2021, X\n", "BSD-3-Clause"), ("// Distributed under the Boost Software License, Version 1.0.\nint x;", "BSL-1.0"),
              ("// Distributed under the Boost Software License, Version 1.0.\n//    (See accompanying file LICENSE_1_0.txt or copy at\n//          http://www.boost.org/LICENSE_1_0.txt)\nint x;", "BSL-1.0"),
              ("Licensed under the European Union Public Licence, version 1.2 (EUPL).", "EUPL-1.2"), ("Eclipse Public License - v 2.0\n\nTHE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE", "EPL-2.0"),
              ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.", "EPL-2.0"), ("# Released under the PostgreSQL License.", "PostgreSQL"), ("the licence of the poet", None), ("a driving license or two", None)]
    rows = [(k, f"{k}.txt", text) for k, (text, _) in enumerate(files)]
    got = {r.doc_id: r.own_license for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id int, path string, text string")).collect()}
    assert {files[k][0]: (got[k], want) for k, (_, want) in enumerate(files) if got[k] != want} == {}


@pytest.mark.parametrize("line, want", [("SPDX-License-Identifier: MIT", None), ("SPDX-License-Identifier: ", None), ("no identifier OR any", None), ("SPDX-License-Identifier: MIT  or\tISC", ["MIT", " OR ", "ISC"]),
                                        ("spdx-license-identifier: ((A AND B))", ["(", "(", "A", " AND ", "B", ")", ")"]), ("SPDX-License-Identifier: MIT OR A, B", None), ("SPDX-License-Identifier: ORACLE", None)])
def test_expression(line, want):
    assert licenses.expression(line) == want


def plain_license(name, text):
    """Best unit of a file by comparing each unit with each template, term by term."""
    found = []
    lines = [(k, None, 1, x) for k, x in enumerate(text.split("\n"))]
    is_license = bool(re.search(licenses.LICENSE_FILE, name))
    lines += [(-1, None, 1, text)] * is_license
    pools = [(licenses.TEMPLATES, [x for x in lines if re.search(licenses.MARKERS, x[3])]), (licenses.TEXTS, [(line, None, 0, x) for line, x in licenses.blocks(text)] + [(-1, None, 0, text)] * is_license)]
    for texts, units in pools:
        bags = [Counter(licenses._TERM.findall(t.lower())) for _, t in texts]
        idf = lambda t: math.log((1 + len(bags)) / (1 + sum(t in b for b in bags))) + 1
        size = lambda b: math.sqrt(sum((n * idf(t)) ** 2 for t, n in b.items()))
        for line, _, short, unit in units:
            bag = Counter(licenses._TERM.findall(unit.lower()))
            alike = [(round(sum(n * b[t] * idf(t) ** 2 for t, n in bag.items()) / size(bag) / size(b), 9), len(b), license) for b, (license, _) in zip(bags, texts, strict=True)] if bag else []
            alike = [x for x in alike if x[0] >= licenses.THRESHOLD]
            if short:
                found += [(score, -line, license, n) for score, n, license in alike]
            elif alike:
                score, n, license = max(alike)
                found.append((n if score >= licenses.NEAR else 0, score, 0, -line, license))
    lined = [x for x in found if len(x) == 4]
    ranked = [x for x in found if len(x) == 5]
    if lined:
        score, at, license, n = max(lined)
        ranked.append((n if score >= licenses.NEAR else 0, score, 1, at, license))
    return (max(ranked)[4], -max(ranked)[3]) if ranked else (None, None)


def test_units_against_plain(spark):
    """Lines, blocks and whole texts in random order, comment styles and wrapping, with repeated rows."""
    rng = random.Random(3)
    parts = [GPL_3, LGPL_21, BSD, APACHE, " Copyright (c) 2020 X", " all rights reserved by the author, who holds the copyright", " a licence for driving", " Licensed under CC BY 4.0.", " Released under the MIT License.", " some words", "", " " + licenses._ISC]
    files = []
    for k in range(60):
        text = ""
        for part in rng.choices(parts, k=rng.randint(1, 4)):
            words, wrapped = part.split(" "), ""
            while rng.random() < 0.3 and len(words) > 3:
                words.pop(rng.randrange(1, len(words)))
            for w in words:
                wrapped += w + ("\n " if rng.random() < 0.05 else " ")
            lead = rng.choice(["", "// ", "# ", " * "])
            text += "\n".join(lead + x for x in wrapped.split("\n")) + rng.choice(["\n", "\n\n", "\nint x;\n"])
        files.append((k, f"d{k}/" + rng.choice(["LICENSE", "a.c"]), text))
    rows = spark.createDataFrame([*files, files[0]], "doc_id int, path string, text string").repartition(5)
    got = licenses.license_scan(rows).collect()
    assert len(got) == len(files) + 1
    want = {k: plain_license(path.split("/")[1], text) for k, path, text in files}
    assert {r.doc_id: ((r.own_license, r.own_line), want[r.doc_id]) for r in got if (r.own_license, r.own_line) != want[r.doc_id]} == {}
    assert len({w[0] for w in want.values()}) > 5


def test_top_directory_license(spark):
    files = [(1, "LICENSE", "Licensed under CC BY-NC 4.0."), (2, "x/y/z.txt", ""), (3, "t.txt", "")]
    got = {r.doc_id: (r.license, r.from_dir) for r in licenses.license_scan(spark.createDataFrame(files, "doc_id int, path string, text string")).collect()}
    assert got == {1: ("CC-BY-NC-4.0", None), 2: ("CC-BY-NC-4.0", ""), 3: ("CC-BY-NC-4.0", "")}
