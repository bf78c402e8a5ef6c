import glob
import math
import os
import re
from collections import Counter

import duckdb
import pyspark
import pytest

from keyrelay.llm import licenses as li

MIT = li.TEMPLATES[3][1]
FILES = [
    (1, "a/LICENSE", MIT), (2, "a/b/c/x.py", "print(1)"), (3, "a/b/y.py", "# Licensed under the Apache License, Version 2.0.\ncode"),
    (4, "a/b/LICENSE", "Licensed under CC BY-NC 4.0"), (5, "a/b/c/z.py", None), (6, "d/x.py", "no notice"), (7, "top.py", "nothing"),
    (8, "a/q.py", ""), (9, "d/w.py", "Some prose first. This work is licensed under the GNU General Public License, version 3. More prose."),
    (10, None, "This work is licensed under the GNU General Public License, version 3"), (11, "a/b/y.py", "we license nothing of the sort"),
    (12, "e/LICENSE", "Released under the MIT License."), (12, "e/LICENSE", "Released under the MIT License."), (13, "e/f/g/h/i.c", "int x;"),
    (14, "a/b/c/long.txt", "permission " * 20000), (15, "d/two.txt", "Released under the MIT License.\n\nLicensed under the Apache License, Version 2.0")]


def terms(text):
    return re.findall(li.TERM, text.lower())


def plain(files):
    cue = re.compile(li.CUE)
    segments = []
    for k, (_, path, text) in enumerate(files):
        if text and cue.search(text):
            parts = [("file", text)] + [("p", x) for x in re.split(r"\n[ \t]*\n", text) if cue.search(x)]
            parts += [("l", x) for x in re.split(r"\n|(?<=[.!?])[ ]+(?=[A-Z])", text) if cue.search(x)]
            segments += [(k, kind, tuple(terms(x))) for kind, x in parts if terms(x)]
    vectors = [Counter(s[2]) for s in segments] + [Counter(terms(t)) for _, t in li.TEMPLATES]
    df = Counter(t for v in vectors for t in v)
    idf = {t: 1 + math.log((1 + len(vectors)) / (1 + n)) for t, n in df.items()}
    weigh = lambda v: {t: (1 + math.log(n)) * idf[t] for t, n in v.items()}
    norm = lambda w: math.sqrt(sum(x * x for x in w.values()))
    own, licensed = {}, {}
    for (k, kind, _), v in zip(segments, vectors):
        w = weigh(v)
        for (name, text), tv in zip(li.TEMPLATES, vectors[len(segments):]):
            u = weigh(tv)
            need, never = li.conditions(name, text)
            if set(v) & set(never) or any(not set(v) & set(g) for g in need):
                continue
            score = round(sum(x * u.get(t, 0) for t, x in w.items()) / norm(w) / norm(u), 6)
            if score >= li.LEAST:
                own[k] = min(own.get(k, (0, "")), (-score, name))
                if kind == "file":
                    d = (files[k][1] or "").rpartition("/")[0]
                    licensed[d] = min(licensed.get(d, (0, "")), (-score, name))
    out = []
    for k, (i, path, _) in enumerate(files):
        d = (path or "").rpartition("/")[0]
        if k in own:
            out.append((i, own[k][1], -own[k][0], "own", None))
            continue
        while d not in licensed and d:
            d = d.rpartition("/")[0]
        out.append((i, licensed[d][1], -licensed[d][0], "inherited", d) if d in licensed else (i, None, None, "none", None))
    return out


def test_against_brute_force(spark):
    df = spark.createDataFrame(FILES, "doc_id long, path string, text string").selectExpr("*", "'x' AS dir", "'y' AS rid", "'z' AS own")
    got = li.scan(df, keep=("doc_id",)).collect()
    key = lambda r: (r[0], str(r[1]), r[3])
    found = sorted([(r.doc_id, r.license, r.score, r.origin, r.from_dir) for r in got], key=key)
    want = sorted(plain(FILES), key=key)
    assert [(a, b, d, e) for a, b, _, d, e in found] == [(a, b, d, e) for a, b, _, d, e in want]
    assert all(a[2] == b[2] or abs(a[2] - b[2]) < 2e-6 for a, b in zip(found, want))
    by_id = {r.doc_id: r for r in got}
    assert by_id[2].license == "CC-BY-NC-4.0" and by_id[2].from_dir == "a/b"
    assert by_id[8].license == "MIT" and by_id[8].from_dir == "a"
    assert by_id[13].license == "MIT" and by_id[9].license == "GPL-3.0"


def test_empty_table_and_no_python(spark):
    none = spark.createDataFrame([], "path string, text string")
    out = li.scan(none)
    assert out.collect() == []
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


PACKAGES = os.path.dirname(os.path.dirname(pyspark.__file__))
#: License files of installed packages, with their own heads, holders and line breaks.
REAL = {"requests-*.dist-info/**/LICENSE": "Apache-2.0", "packaging-*.dist-info/**/LICENSE.APACHE": "Apache-2.0",
        "hypothesis-*.dist-info/**/LICENSE.txt": "MPL-2.0", "pluggy-*.dist-info/**/LICENSE": "MIT",
        "attrs-*.dist-info/**/LICENSE": "MIT", "psutil-*.dist-info/LICENSE": "BSD-3-Clause",
        "idna-*.dist-info/**/LICENSE.md": "BSD-3-Clause", "xxhash-*.dist-info/LICENSE": "BSD-2-Clause",
        "pygments-*.dist-info/**/LICENSE": "BSD-2-Clause", "pyspark/licenses/LICENSE-d3.min.js.txt": "ISC"}
TAGS = [("// SPDX-License-Identifier: MIT", "MIT"), ("# SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
        ("/* SPDX-License-Identifier: GPL-2.0 WITH Linux-syscall-note */", "GPL-2.0"),
        ("<!-- SPDX-License-Identifier: GPL-3.0-or-later-->", "GPL-3.0"), ("# spdx-license-identifier: bsd-3-clause", "BSD-3-Clause"),
        ("# SPDX-License-Identifier: MPL-2.0.", "MPL-2.0"), ("# SPDX-License-Identifier: Zlib", "Zlib"),
        ("# SPDX-License-Identifier: (MIT OR LGPL-2.1+)", "LGPL-2.1"), ("# SPDX-License-Identifier: NOASSERTION", None)]


def test_real_license_files_license_their_directories(spark):
    files = [(p, name, path[0]) for p, name in REAL.items() if (path := glob.glob(f"{PACKAGES}/{p}", recursive=True))]
    if not files:
        pytest.skip("no license files installed")
    texts = [(name, open(path, encoding="utf-8").read()) for _, name, path in files]
    for name in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "CC0-1.0"):    # with a head, other lines, parts left out
        words = dict(li.FULL_TEXTS)["GPL-3.0" if name == "AGPL-3.0" else name].split()
        if name == "AGPL-3.0":          # the Affero license: the GPL's wording under its own name
            words = " ".join(words).replace("GNU General", "GNU Affero General").replace("GNU GENERAL", "GNU AFFERO GENERAL").split()
        texts.append((name, "The frobnicator is Copyright (C) 2021 Jo Doe.\n\n" + "\n".join(
            " ".join(words[k:k + 9]) for k in range(0, len(words) * 9 // 10, 9))))
    df = spark.createDataFrame([row for k, (_, text) in enumerate(texts) for row in
                                ((2 * k, f"p{k}/LICENSE", text), (2 * k + 1, f"p{k}/src/x.c", "int x;"))],
                               "doc_id long, path string, text string")
    got = {r.doc_id: (r.license, r.origin) for r in li.scan(df, keep=("doc_id",)).collect()}
    want = {}
    for k, (name, _) in enumerate(texts):
        want |= {2 * k: (name, "own"), 2 * k + 1: (name, "inherited")}
    assert got == want


def test_spdx_tags(spark):
    rows = [(k, f"t{k}/a.c", f"{tag}\nint main;") for k, (tag, _) in enumerate(TAGS)]
    df = spark.createDataFrame([*rows, *((100 + k, f"t{k}/b.c", "int x;") for k in range(len(TAGS))),
                                (200, "u/LICENSE", TAGS[0][0]), (201, "u/v/b.c", "int x;")],
                               "doc_id long, path string, text string")
    got = {r.doc_id: (r.license, r.origin, r.score) for r in li.scan(df, keep=("doc_id",)).collect()}
    assert [got[k] for k in range(len(TAGS))] == [(n, "own", 1.0) if n else (None, "none", None) for _, n in TAGS]
    assert all(got[100 + k][0] is None for k in range(len(TAGS)))       # a tag in a file says nothing of the files beside it
    assert got[201] == ("MIT", "inherited", 1.0)


NOTICES = [
    ("Licensed under CC BY-ND 4.0", "CC-BY-ND-4.0"), ("This text is licensed under CC BY-NC-ND 4.0.", "CC-BY-NC-ND-4.0"),
    ("Licensed under CC BY 4.0", "CC-BY-4.0"), ("Licensed under CC BY-NC-SA 4.0", "CC-BY-NC-SA-4.0"), ("Licensed under CC BY-ND 3.0", None),
    ("Licensed under the GNU Lesser General Public License, version 2.1", "LGPL-2.1"),
    ("Licensed under the GNU Lesser General Public License, version 3", "LGPL-3.0"),
    ("Licensed under the GNU Affero General Public License, version 3", "AGPL-3.0"),
    ("Licensed under the GNU General Public License, version 2", "GPL-2.0"),
    ("This project is licensed under the MIT license.", "MIT"), ("Licensed under the BSD 2-Clause License", "BSD-2-Clause"),
    ("Released under the BSD 3-Clause License.", "BSD-3-Clause"), ("Licensed under the ISC License", "ISC"),
    ("Licensed under the Apache License, Version 1.1", None), ("Licensed under the Mozilla Public License, v. 1.1", None),
    ("# SPDX-License-Identifier: MIT OR Apache-2.0", "Apache-2.0")]


def test_versions_and_clauses_agree(spark):
    rows = [(k, f"s{k}", "en", text) for k, (text, _) in enumerate(NOTICES)]
    rows += [(100, "b", "en", MIT + "\n\n" + li.TEMPLATES[1][1]), (101, "b", "en/x", "int y;"),
             (102, "c", "en", li.FULL_TEXTS["MIT"]), (103, "c", "en/z", "int z;"), (104, None, None, None), (105, "c", "fr", "")]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, text string")
    files = df.withColumn("path", pyspark.sql.functions.concat_ws("/", "source", "lang", pyspark.sql.functions.col("doc_id").cast("string")))
    got = {r.doc_id: r for r in li.scan(files, keep=("doc_id",)).collect()}
    assert {k: got[k].license for k in range(len(NOTICES))} == {k: name for k, (_, name) in enumerate(NOTICES)}
    assert got[100].licenses == "Apache-2.0,MIT"                    # a bundle names all its licenses
    assert got[15].licenses == "Apache-2.0,MIT" and got[103].license == "MIT" and got[103].origin == "inherited" and got[103].licenses == "MIT"
    # the SQL states the same rules: tags, full texts, families, versions, bundles
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    want = {r[0]: r[1:] for r in con.execute(li.ORACLE_SQL).fetchall()}
    for k, r in got.items():
        assert (r.path, r.license, r.origin, r.from_dir, r.licenses) == (want[k][0], want[k][1], want[k][3], want[k][4], want[k][5]), k
        assert r.score == want[k][2] or abs(r.score - want[k][2]) < 2e-6
