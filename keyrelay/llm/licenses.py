"""License scan: sparse TF-IDF cosine to templates, then inheritance from the nearest licensed directory.

DataFrame functions only. Segments of files that hold a cue word (whole files, paragraphs, lines and sentences) become term vectors;
equal segments are scored once. An SPDX tag names its license outright: its identifiers are read, not scored. A file's own license
is its best segment's or its tag's; a file that as a whole is a license text (or a tag) licenses its directory, and files without
a license of their own take that of their nearest licensed directory.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import local_frame
from .common import settle, table
from .license_texts import FULL_TEXTS

#: Least cosine of a match.
LEAST = 0.6
CUE = r"(?i)licen[cs]|copyright|spdx|permission|warrant|redistribut|public domain|CC[ -](?:BY|0)"
TERM = r"[a-z0-9]+(?:\.[0-9]+)*"
_ID = r"\(*[A-Za-z0-9](?:[A-Za-z0-9.+-]*[A-Za-z0-9+])?\)*"
#: An SPDX tag with its expression; in an expression, exceptions and an identifier.
TAG = rf"(?i:SPDX-License-Identifier):[ \t]*({_ID}(?: +(?:AND|OR|WITH) +{_ID})*)"
EXCEPTION, IDENTIFIER = r" +WITH +[^ ]+", r"[A-Za-z0-9]+(?:[.-][A-Za-z0-9]+)*"

#: Short notices by which licenses are named (fixed values: the wording of the licenses' own notices), and full texts.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at. Unless required by applicable law or "
                   "agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                   "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
                "option) any later version."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License"),
    ("MIT", "This project is licensed under the MIT License"),
    ("ISC", "Licensed under the ISC License"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0"),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0"),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0"),
    ("CC0-1.0", "Released to the public domain under CC0 1.0"),
    *FULL_TEXTS.items(),
]

#: Names, clauses and versions (terms that say the same are one group): a segment matches a notice only if it has a term of every group
#: that the notice has. Fixed values.
GROUPS = (("mit",), ("isc",), ("apache",), ("mozilla", "mpl"), ("bsd",), ("cc",), ("cc0",), ("affero", "agpl"), ("lesser", "library", "lgpl"),
          ("nc", "noncommercial"), ("nd", "noderivatives", "noderivs"), ("sa", "sharealike"), ("1", "1.0", "v1", "v1.0"),
          ("2", "2.0", "v2", "v2.0"), ("2.1", "v2.1"), ("3", "3.0", "v3", "v3.0"), ("4", "4.0", "v4", "v4.0"))
#: Groups that a notice of a family must not meet in a segment unless it has them itself, by the start of the license's name.
APART = {"GPL": GROUPS[7:9], "LGPL": GROUPS[7:8], "AGPL": GROUPS[8:9], "CC-BY": GROUPS[9:12]}
#: The Affero license has the wording of the GPL, version 3, and names itself more often than that text does.
AFFERO, AFFERO_TIMES = "affero", 6


def conditions(license: str, text: str) -> tuple[list[tuple], list[str]]:
    """(groups that a segment must have a term of, terms that it must not have) to match a template; none for full texts."""
    if FULL_TEXTS.get(license) == text:
        return [], []
    own = set(re.findall(TERM, text.lower()))
    apart = next((groups for start, groups in APART.items() if license.startswith(start + "-")), ())
    return [g for g in GROUPS if own & set(g)], [t for g in apart if not own & set(g) for t in g]


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def _segments(text: Column) -> Column:
    """Whole file, paragraphs, and lines and sentences of a text that hold a cue: (kind, norm), norm the joined terms."""
    with_cue = lambda xs: F.filter(xs, lambda x: x.rlike(CUE))
    kinds = [("file", F.array(text)), ("paragraph", with_cue(F.split(text, r"\n[ \t]*\n"))),
             ("line", with_cue(F.split(text, r"\n|(?<=[.!?])[ ]+(?=[A-Z])")))]
    return F.filter(F.flatten(F.array(*[_named(kind, xs) for kind, xs in kinds])), lambda s: s["norm"] != "")


def _tagged(text: Column) -> Column:
    """Licenses that the SPDX tags of a text name: versions "only", "or later" and "+" under the license's plain name."""
    names = F.create_map(*[F.lit(x) for n in dict.fromkeys(n for n, _ in TEMPLATES) for x in (n.lower(), n)])
    ids = F.flatten(F.transform(F.regexp_extract_all(text, F.lit(TAG), F.lit(1)), lambda x: F.regexp_extract_all(
        F.regexp_replace(x, EXCEPTION, ""), F.lit(IDENTIFIER), F.lit(0))))
    ids = F.transform(F.filter(ids, lambda x: ~x.isin("AND", "OR")),
                      lambda x: F.regexp_replace(x, "(?i)-(?:only|or-later)$", ""))
    return F.transform(F.filter(ids, lambda x: ~F.lower(x).isin("none", "noassertion")),
                       lambda x: F.coalesce(F.element_at(names, F.lower(x)), x))


def _named(kind: str, texts: Column) -> Column:
    return F.transform(texts, lambda x: F.struct(F.lit(kind).alias("kind"), F.array_join(terms(x), " ").alias("norm")))


def _vectors(keyed: DataFrame) -> DataFrame:
    """(key, n, term, tf) of texts (key, n, norm)."""
    return keyed.select("key", "n", F.explode(F.split("norm", " ")).alias("term")).groupBy("key", "n", "term").agg(
        F.count("*").alias("tf"))


def _templates(spark: SparkSession) -> DataFrame:
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("license", T.StringType()),
                           T.StructField("text", T.StringType())])
    rows = [(f"template {k}", name, text) for k, (name, text) in enumerate(TEMPLATES)]
    return local_frame(spark, rows, schema).select("key", "license", F.lit(1).cast("long").alias("n"),
                                                   F.array_join(terms(F.col("text")), " ").alias("norm"))


def best_templates(segments: DataFrame) -> DataFrame:
    """(key, license, score, full) of distinct segments (key, n, norm) that reach the least cosine to a template.

    full: the template is a full text. Weights: (1 + ln tf) (1 + ln((1 + N) / (1 + df))), N and df over all segments, each as often as it occurs, and templates.
    """
    templates = _templates(segments.sparkSession)
    vectors = settle(_vectors(segments.select("key", "n", "norm").union(templates.select("key", "n", "norm"))),
                     "license-terms")
    total = len(TEMPLATES) + (segments.agg(F.sum("n")).first()[0] or 0)
    df = vectors.groupBy("term").agg(F.sum("n").alias("df"))
    idf = df.select("term", (1 + F.log((1 + F.lit(total)) / (1 + F.col("df")))).alias("idf"))
    weighted = settle(vectors.join(idf, "term").select("key", "term", "tf", ((1 + F.log("tf")) * F.col("idf")).alias("w")),
                      "license-weights")
    of_templates = weighted.filter(F.col("key").startswith("template "))
    norms = of_templates.groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    # the templates' terms, a few thousand rows however large the input: a column of weights for every template
    wide = of_templates.join(F.broadcast(norms), "key").groupBy("term").agg(
        *[F.sum(F.when(F.col("key") == f"template {k}", F.col("w") / F.col("norm"))).alias(f"v{k}")
          for k in range(len(TEMPLATES))])
    dots = (weighted.filter(~F.col("key").startswith("template ")).repartition("key").join(F.broadcast(wide), "term", "left")
            .groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"),
                                F.collect_set(F.when(F.col("term").isin([t for g in GROUPS for t in g]), F.col("term"))).alias("decisive"),
                                F.max(F.when(F.col("term") == AFFERO, F.col("tf"))).alias("affero"),
                                *[F.sum(F.col("w") * F.col(f"v{k}")).alias(f"d{k}") for k in range(len(TEMPLATES))]))
    def scored(k: int, name: str, text: str) -> Column:
        need, never = conditions(name, text)
        fits = [F.arrays_overlap("decisive", F.array(*map(F.lit, g))) for g in need]
        fits += [~F.arrays_overlap("decisive", F.array(*map(F.lit, never)))] if never else []
        full = FULL_TEXTS.get(name) == text
        own = F.when(F.col("affero") > AFFERO_TIMES, F.lit("AGPL-3.0")).otherwise(name) if name == "GPL-3.0" and full else F.lit(name)
        score = -F.round(F.col(f"d{k}") / F.col("norm"), 6)
        return F.struct((F.when(reduce(Column.__and__, fits), score) if fits else score).alias("s"), own.alias("license"),
                        F.lit(full).alias("full"))

    every = F.array(*[scored(k, name, text) for k, (name, text) in enumerate(TEMPLATES)])
    best = dots.select("key", F.array_min(F.filter(every, lambda x: x["s"] <= -LEAST)).alias("b")).filter("b IS NOT NULL")
    return best.select("key", F.col("b.license").alias("license"), (-F.col("b.s")).alias("score"), "b.full")


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row of ``files``: the columns ``keep``, path, license, score, origin, from_dir and licenses.

    licenses: all that the file's segments and tags name (a bundle has several), or, where it is inherited, all that the license files
    of the directory name; sorted, joined by commas. origin: "own" (a segment or an SPDX tag of the file), "inherited" (from_dir: the nearest directory above it that holds a license file) or
    "none". Ties go to the alphabetically first license. Null and empty texts have no license of their own; a null or empty path
    lies in the root directory "". Repeated rows are scanned alike; an empty table stays empty; other columns are not read.
    """
    text, path = F.col(text_col).cast("string"), F.coalesce(F.col(path_col).cast("string"), F.lit(""))
    directory = F.when(F.locate("/", path) > 0, F.regexp_replace(path, "/[^/]*$", "")).otherwise("")
    rest = F.regexp_replace(text, TAG, " ")     # a tag's words are not scored: they are much alike for all licenses
    rows = files.select(
        F.struct(*[F.col(c) for c in keep], path.alias("path")).alias("row"), directory.alias("dir"),
        F.when(text.rlike(CUE), _segments(rest)).alias("segments"),
        F.when(text.rlike(TAG), _tagged(text)).alias("tags"),
        F.when(text.rlike(TAG), ~F.lower(rest).rlike(TERM)).alias("bare")).withColumn("rid", F.monotonically_increasing_id())
    rows = settle(rows, "license-files")        # fixes the row numbers
    found = rows.select("rid", "dir", F.inline("segments")).withColumn("key", F.sha2("norm", 256))
    distinct = settle(found.groupBy("key").agg(F.count("*").alias("n"), F.min("norm").alias("norm")), "license-segments")
    best = settle(best_templates(distinct), "license-best")
    hits = settle(found.join(best, "key").select("rid", "dir", "kind", "full",
                                                 F.struct((-F.col("score")).alias("s"), "license").alias("hit")), "license-hits")
    tags = rows.select("rid", "dir", F.when(F.col("bare"), "file").otherwise("tag").alias("kind"), F.lit(False).alias("full"),
                       F.explode("tags").alias("tag"))
    tags = tags.select("rid", "dir", "kind", "full", F.struct(F.lit(-1.0).alias("s"), F.col("tag").alias("license")).alias("hit"))
    hits = hits.union(tags)
    # a sentence that licenses of one family share does not outdo the full text of one of them
    family = lambda hit: F.substring_index(hit["license"], "-", 1)
    own = hits.groupBy("rid").agg(F.min("hit").alias("best"), F.min(F.when((F.col("kind") == "file") & F.col("full"), F.col("hit")))
                                  .alias("whole"))
    differ = (family(F.col("best")) == family(F.col("whole"))) & (F.col("best.license") != F.col("whole.license"))
    own = own.select("rid", F.when(differ, F.col("whole")).otherwise(F.col("best")).alias("own"), "whole")
    named = hits.select("rid", "dir", "kind", F.col("hit.license").alias("name")).join(own, "rid")
    named = named.filter(F.col("whole").isNull() | (family(F.col("whole")) != F.substring_index("name", "-", 1)) | (F.col("name") == F.col("whole.license")))
    listed = lambda by: F.array_join(F.array_sort(F.collect_set("name")), ",").alias(by)
    own = own.drop("whole").join(named.groupBy("rid").agg(listed("own_all")), "rid", "left")
    # distinct names of a directory's license files first: a directory may hold very many of them
    files_of = hits.filter("kind = 'file'").select("rid").distinct()
    given_all = (named.join(files_of, "rid", "left_semi").select(F.col("dir").alias("from_dir"), "name").distinct()
                 .groupBy("from_dir").agg(listed("given_all")))
    licensed = (hits.filter("kind = 'file'").groupBy(F.col("dir").alias("from_dir")).agg(F.min("hit").alias("given"))
                .join(given_all, "from_dir", "left"))
    steps = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda k: F.struct(
        k.alias("depth"), F.array_join(F.slice(steps, 1, k), "/").alias("from_dir")))
    ancestors = rows.select("dir").distinct().select("dir", F.inline(F.array_distinct(above)))
    nearest = (ancestors.join(licensed, "from_dir").groupBy("dir")
               .agg(F.max_by(F.struct("from_dir", "given", "given_all"), "depth").alias("near")))
    out = rows.select("row", "dir", "rid").join(own, "rid", "left").join(nearest, "dir", "left")
    hit = F.coalesce("own", "near.given")
    return out.select("row.*", hit["license"].alias("license"), (-hit["s"]).alias("score"),
                      F.when(F.col("own").isNotNull(), "own").when(F.col("near").isNotNull(), "inherited")
                      .otherwise("none").alias("origin"),
                      F.when(F.col("own").isNull(), F.col("near.from_dir")).alias("from_dir"),
                      F.when(F.col("own").isNotNull(), F.col("own_all")).otherwise(F.col("near.given_all")).alias("licenses"))


def op9_licenses(spark, sf_dir):
    """Registered query: the whole ``documents`` table, laid out as source/language/doc_id."""
    docs = table(spark, sf_dir, "documents").withColumn("path", F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")))
    return scan(docs, keep=("doc_id",))


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_list(items) -> str:
    return "[" + ", ".join(map(_sql_text, items)) + "]::VARCHAR[]"


def _sql_templates() -> str:
    """(i, license, text, full, groups needed, terms that must not occur) of all templates."""
    rows = []
    for k, (name, text) in enumerate(TEMPLATES):
        need, never = conditions(name, text)
        rows.append(f"({k}, {_sql_text(name)}, {_sql_text(text)}, {FULL_TEXTS.get(name) == text}, "
                    f"[{', '.join(_sql_list(g) for g in need)}]::VARCHAR[][], {_sql_list(never)})")
    return ", ".join(rows)


ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, concat_ws('/', source, lang, CAST(doc_id AS VARCHAR)) AS path, concat_ws('/', source, lang) AS dir,
             text, regexp_replace(text, '{TAG}', ' ', 'g') AS rest, row_number() OVER () AS r FROM documents),
names AS (SELECT DISTINCT license FROM (VALUES {_sql_templates()}) AS t(i, license, text, full_text, need, never)),
ids AS (
  SELECT r, dir, bare, regexp_replace(id, '(?i)-(only|or-later)$', '') AS id FROM (
    SELECT r, dir, NOT regexp_matches(lower(rest), '{TERM}') AS bare,
           unnest(regexp_extract_all(regexp_replace(tag, '{EXCEPTION}', '', 'g'), '{IDENTIFIER}')) AS id
    FROM (SELECT r, dir, rest, unnest(regexp_extract_all(text, '{TAG}', 1)) AS tag FROM d)) WHERE id NOT IN ('AND', 'OR')),
tags AS (SELECT DISTINCT r, dir, CASE WHEN bare THEN 'file' ELSE 'tag' END AS kind, coalesce(names.license, id) AS license, 1.0 AS score,
           false AS is_full FROM ids LEFT JOIN names ON lower(names.license) = lower(id) WHERE lower(id) NOT IN ('none', 'noassertion')),
parts AS (
  SELECT r, dir, 'file' AS kind, rest AS part FROM d WHERE regexp_matches(text, '{CUE}')
  UNION ALL SELECT r, dir, 'paragraph', unnest(string_split_regex(rest, '\n[ \t]*\n')) FROM d WHERE regexp_matches(text, '{CUE}')
  UNION ALL SELECT r, dir, 'line', unnest(string_split_regex(regexp_replace(rest, '([.!?]) +([A-Z])', '\1' || chr(1) || '\2', 'g'),
                   '\n|\x01')) FROM d WHERE regexp_matches(text, '{CUE}')),
seg AS (SELECT *, array_to_string(regexp_extract_all(lower(part), '{TERM}'), ' ') AS norm FROM parts
        WHERE kind = 'file' OR regexp_matches(part, '{CUE}')),
s AS (SELECT r, dir, kind, norm FROM seg WHERE norm <> ''),
tpl AS (SELECT 'template ' || i AS key, license, full_text, need, never, array_to_string(regexp_extract_all(lower(text), '{TERM}'), ' ') AS norm
        FROM (VALUES {_sql_templates()}) AS t(i, license, text, full_text, need, never)),
keyed AS (SELECT norm AS key, norm, count(*) AS n FROM s GROUP BY norm UNION ALL SELECT key, norm, 1 FROM tpl),
vec AS (SELECT key, n, term, count(*) AS tf FROM (SELECT key, n, unnest(string_split(norm, ' ')) AS term FROM keyed) GROUP BY ALL),
idf AS (SELECT term, 1 + ln((1 + (SELECT sum(n) FROM keyed)) / (1.0 + sum(n))) AS idf FROM vec GROUP BY term),
w AS (SELECT key, term, (1 + ln(tf)) * idf AS w FROM vec JOIN idf USING (term)),
nrm AS (SELECT key, sqrt(sum(w * w)) AS norm FROM w GROUP BY key),
have AS (SELECT key, list(term) AS terms, max(CASE WHEN term = '{AFFERO}' THEN tf ELSE 0 END) AS affero FROM vec GROUP BY key),
tv AS (SELECT w.key AS template, term, w / nrm.norm AS v FROM w JOIN tpl USING (key) JOIN nrm USING (key)),
sc AS (SELECT dots.key, template, round(dot / nrm.norm, 6) AS score FROM (
         SELECT w.key, template, sum(w.w * tv.v) AS dot FROM w JOIN tv USING (term)
         WHERE w.key NOT IN (SELECT key FROM tpl) GROUP BY ALL) dots JOIN nrm ON nrm.key = dots.key),
best AS (SELECT sc.key, CASE WHEN tpl.license = 'GPL-3.0' AND full_text AND affero > {AFFERO_TIMES} THEN 'AGPL-3.0' ELSE tpl.license END AS license,
                score, full_text AS is_full
         FROM sc JOIN tpl ON tpl.key = sc.template JOIN have ON have.key = sc.key
         WHERE score >= {LEAST} AND NOT list_has_any(terms, never)
           AND len(list_filter(need, lambda g: NOT list_has_any(terms, g))) = 0
         QUALIFY row_number() OVER (PARTITION BY sc.key ORDER BY score DESC, license, is_full) = 1),
hits AS (SELECT r, dir, kind, license, score, is_full FROM s JOIN best ON best.key = s.norm
         UNION ALL SELECT r, dir, kind, license, score, is_full FROM tags),
top AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, license) = 1),
whole AS (SELECT * FROM hits WHERE kind = 'file' AND is_full QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, license) = 1),
own AS (SELECT top.r, CASE WHEN same THEN whole.license ELSE top.license END AS license, CASE WHEN same THEN whole.score ELSE top.score END AS score
        FROM top LEFT JOIN whole USING (r),
        LATERAL (SELECT coalesce(split_part(top.license, '-', 1) = split_part(whole.license, '-', 1), false) AS same)),
named AS (SELECT DISTINCT hits.r, hits.dir, hits.license FROM hits LEFT JOIN whole USING (r) WHERE whole.license IS NULL
          OR split_part(hits.license, '-', 1) <> split_part(whole.license, '-', 1) OR hits.license = whole.license),
own_all AS (SELECT r, string_agg(license, ',' ORDER BY license) AS licenses FROM named GROUP BY r),
given_all AS (SELECT dir AS from_dir, string_agg(license, ',' ORDER BY license) AS licenses FROM (
                SELECT DISTINCT dir, license FROM named WHERE r IN (SELECT r FROM hits WHERE kind = 'file')) GROUP BY dir),
lic AS (SELECT dir AS from_dir, license, score FROM hits WHERE kind = 'file'
        QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, license) = 1),
near AS (SELECT x.dir, lic.*, given_all.licenses FROM (SELECT DISTINCT dir FROM d) x
         JOIN lic ON lic.from_dir = '' OR x.dir = lic.from_dir OR starts_with(x.dir, lic.from_dir || '/')
         LEFT JOIN given_all ON given_all.from_dir = lic.from_dir
         QUALIFY row_number() OVER (PARTITION BY x.dir ORDER BY length(lic.from_dir) DESC) = 1)
SELECT doc_id, path, coalesce(own.license, near.license) AS license, coalesce(own.score, near.score) AS score,
       CASE WHEN own.license IS NOT NULL THEN 'own' WHEN near.license IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       CASE WHEN own.license IS NULL THEN near.from_dir END AS from_dir,
       CASE WHEN own.license IS NULL THEN near.licenses ELSE own_all.licenses END AS licenses
FROM d LEFT JOIN own USING (r) LEFT JOIN own_all USING (r) LEFT JOIN near ON near.dir = d.dir
"""
