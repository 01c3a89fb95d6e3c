"""Licence scan of files: TF-IDF cosine to templates, then inheritance.

A licence has several templates: a notice, the title of its text, an opening
passage, its SPDX line. Every text is cut into units: statements (lines, and
sentences within a line), paragraphs (up to a line without a letter or digit),
and sentences of a paragraph with its lines joined and comment marks dropped,
so a notice wrapped over lines is one unit. A unit's vector has each of its
distinct terms once, weighted by the inverse document frequency over all files;
terms that no template has count with the weight of an unseen term. Of a file's
units the best cosine to a template of ``THRESHOLD`` or more is its own
licence. Besides, a unit must hold all terms of an SPDX line, as lines of
different licences differ in one term only, and of a template of up to
``SHORT`` terms (in German "mit" is a word, not half a licence).

The sparse side is small: only template terms need weights (their document
frequencies are counted over all files). By Cauchy-Schwarz a unit that reaches
the threshold holds THRESHOLD**2 of the template's squared length, so its file
does: files that hold so much of no template are not cut into units at all.
Nor can it unless its template terms hold THRESHOLD**2 of the unit's own
squared length. Both tests lose none; the few units that pass meet the
templates' vectors term by term.

A file without a licence of its own takes that of the nearest directory at or
above its own that has a licence file (named LICENSE, LICENCE, COPYING or
NOTICE) with one. Directories, not files, are expanded to their ancestors,
and files meet their directory through a salted join, so a directory with a
third of all files is no hot key.

Native: DataFrame functions only. Defined results: null or empty text has no
licence of its own; a null path counts as an empty one, whose directory is the
root; equal scores go to the first template name; among licence files of one
directory the best score, then the first path and id decide; rows equal in id,
path and text are returned as often as they occur; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import checkpointed, read_table

THRESHOLD = 0.7
SALTS = 32
SHORT = 4  # terms of a template that counts only if all are there
TERM = r"[a-z0-9]+(?:[.][0-9]+)*"
SENTENCE = r"([^ \n][.!?]) +([A-Z])"
PARAGRAPH = r"\n(?:[^A-Za-z0-9\n]*\n)+"
LINE_START = r"\n[^A-Za-z0-9\n]*"
LICENCE_FILE = r"(?i)^(licen[sc]e|copying|notice)([.][a-z]+)?$"

# Short notices, titles and opening passages of public licences,
# and the identifiers of their SPDX lines.
NOTICES = (
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
TITLES = (
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("MIT", "MIT License"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
)
PASSAGES = (
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
                 "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                 "or (at your option) any later version."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                   "compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation; either version 2 of the License, "
                "or (at your option) any later version."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
                 "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                 "or (at your option) any later version."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the Software), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
            "and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
)
SPDX_LINE = "SPDX-License-Identifier: "
TEMPLATES = (*NOTICES, *TITLES, *PASSAGES, *((name, SPDX_LINE + name) for name, _ in NOTICES))


def terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def needs_all(template: str) -> bool:
    """Is a unit without one of the template's terms another thing?"""
    return template.startswith(SPDX_LINE) or len(set(re.findall(TERM, template.lower()))) <= SHORT


def statements(text: Column) -> Column:
    return F.split(F.regexp_replace(text, SENTENCE, "$1\n$2"), "\n")


def units(text: Column) -> Column:
    """Statements, paragraphs, and sentences of paragraphs with joined lines."""
    paragraphs = F.split(text, PARAGRAPH)
    joined = F.flatten(F.transform(paragraphs, lambda p: statements(F.regexp_replace(p, LINE_START, " "))))
    return F.concat(statements(text), paragraphs, joined)


def _heavy(vectors: dict[int, set[str]], idf: dict[str, float], share: float) -> list[str]:
    """Terms of which every unit near a template has one: of each template the
    heaviest, until the others hold less than ``share`` of its squared length."""
    out: set[str] = set()
    for held in vectors.values():
        rest = need = sum(idf[t] ** 2 for t in held)
        for t in sorted(held, key=lambda t: (-idf[t], t)):
            if rest < need * share:
                break
            out.add(t)
            rest -= idf[t] ** 2
    return sorted(out)


def own_licences(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(key, licence, score) of the files (key, text) that state one."""
    spark = files.sparkSession
    listed = [(i, licence, text, needs_all(text)) for i, (licence, text) in enumerate(templates)]
    vectors = checkpointed(spark.createDataFrame(listed, "template int, licence string, text string, whole boolean")
                           .select("template", "licence", "whole", F.explode(terms(F.col("text"))).alias("term")))
    of: dict[int, set[str]] = {}
    for r in vectors.collect():  # the templates: fixed and small
        of.setdefault(r["template"], set()).add(r["term"])
    vocabulary = sorted(set().union(*of.values()))
    known = F.array(*[F.lit(t) for t in vocabulary])
    hits = files.withColumn("held_terms", F.array_intersect(terms(F.col("text")), known))
    # one count for each template term, and one of all files
    seen = {r["term"]: r["n"] for r in hits.select(F.explode(F.concat(
        F.array(F.lit("")), F.coalesce("held_terms", F.array().cast("array<string>")))).alias("term"))
        .groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = seen.get("", 0)
    idf = {t: math.log((1 + total) / (1 + seen.get(t, 0))) + 1 for t in vocabulary}
    unseen = math.log(1 + total) + 1
    weight = F.create_map(*[F.lit(x) for t, w in idf.items() for x in (t, w)])

    def squared(of_terms: Column) -> Column:
        return F.aggregate(of_terms, F.lit(0.0), lambda a, t: a + weight[t] * weight[t])

    share = (threshold - 1e-6) ** 2  # scores are rounded
    near = F.lit(False)
    for held in sorted({tuple(sorted(x)) for x in of.values()}):
        need = share * sum(idf[t] ** 2 for t in held)
        near = near | (squared(F.array_intersect("held_terms", F.array(*map(F.lit, held)))) >= need)
    heavy = F.array(*[F.lit(t) for t in _heavy(of, idf, share)])
    close = hits.where(F.arrays_overlap("held_terms", heavy)).where(near)

    cut = (close.select("key", F.posexplode(units(F.col("text"))).alias("at", "unit"))
           .withColumn("all", terms(F.col("unit")))
           .withColumn("hits", F.array_intersect("all", known)))
    cut = (cut.where(F.size("hits") > 0).withColumn("held", squared(F.col("hits")))
           .withColumn("square", F.col("held") + (F.size("all") - F.size("hits")) * (unseen * unseen))
           .where(F.col("held") >= share * F.col("square"))
           .dropDuplicates(["key", "at"]))  # equal rows share a key: scored once
    weights = spark.createDataFrame(list(idf.items()) or [("", 0.0)], "term string, w double")
    weighted = vectors.join(F.broadcast(weights), "term")
    lengths = weighted.groupBy("template").agg(
        F.sum(F.col("w") * F.col("w")).alias("template_square"), F.count(F.lit(1)).alias("size"))
    dots = (cut.select("key", "at", "square", F.explode("hits").alias("term"))
            .join(F.broadcast(weighted), "term")
            .groupBy("key", "at", "square", "template", "licence", "whole")
            .agg(F.sum(F.col("w") * F.col("w")).alias("dot"), F.count(F.lit(1)).alias("common"))
            .join(F.broadcast(lengths), "template")
            .withColumn("score", F.round(F.col("dot") / F.sqrt(F.col("square") * F.col("template_square")), 6))
            .where((F.col("score") >= threshold) & (~F.col("whole") | (F.col("common") == F.col("size")))))
    best = F.min(F.struct((-F.col("score")).alias("s"), "licence"))
    return dots.groupBy("key").agg(best.alias("b")).select("key", F.col("b.licence").alias("licence"), (-F.col("b.s")).alias("score"))


def directory(path: Column) -> Column:
    """The part before the last slash; empty for the root."""
    return F.regexp_replace(F.coalesce(path, F.lit("")), r"/?[^/]*$", "")


def scan(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """files (doc_id, path, text) -> doc_id, path, own_licence, own_score,
    licence, how (own, inherited, none), from_dir."""
    path = F.coalesce("path", F.lit(""))
    rows = files.select("doc_id", "path", "text", F.xxhash64("doc_id", path, F.coalesce("text", F.lit(""))).alias("key"))
    listed = rows.select("key", "doc_id", "path").groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.first("doc_id").alias("doc_id"), F.first("path").alias("path"))
    own = checkpointed(own_licences(rows.select("key", "text"), templates, threshold))
    listed = checkpointed(listed.join(own, "key", "left").withColumn("dir", directory(F.col("path"))))

    name = F.regexp_extract(F.coalesce("path", F.lit("")), r"([^/]*)$", 1)
    granted = (listed.where(F.col("licence").isNotNull() & name.rlike(LICENCE_FILE))
               .groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("s"), "path", "doc_id", "licence")).alias("b"))
               .select(F.col("dir").alias("ancestor"), F.col("b.licence").alias("granted")))
    steps = F.split("dir", "/")
    up = F.when(F.col("dir") == "", F.array(F.lit(""))).otherwise(F.transform(
        F.sequence(F.lit(0), F.size(steps)), lambda i: F.array_join(F.slice(steps, F.lit(1), i), "/")))
    inherited = (listed.select("dir").distinct()
                 .select("dir", F.posexplode(up).alias("depth", "ancestor"))
                 .join(granted, "ancestor")
                 .groupBy("dir").agg(F.max(F.struct("depth", "ancestor", "granted")).alias("b"))
                 .select("dir", F.col("b.ancestor").alias("from_dir"), F.col("b.granted").alias("granted"))
                 .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    out = (listed.withColumn("salt", F.pmod("key", F.lit(SALTS)).cast("int"))
           .join(inherited, ["dir", "salt"], "left")
           .withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))))
    has = F.col("licence").isNotNull()
    return out.select(
        "doc_id", "path", F.col("licence").alias("own_licence"), F.col("score").alias("own_score"),
        F.coalesce("licence", "granted").alias("licence"),
        F.when(has, "own").when(F.col("granted").isNotNull(), "inherited").otherwise("none").alias("how"),
        F.when(~has, F.col("from_dir")).alias("from_dir"))


# The tables have no paths; the query lays the documents out as a tree of
# source / language / folder, with every tenth as a licence file at one of the
# three levels. Every document is scanned.
PATH_SQL = """
concat(coalesce(source, 'none'),
  CASE WHEN doc_id % 1000 = 0 THEN '/LICENSE'
       WHEN doc_id % 100 = 0 THEN concat('/', coalesce(lang, 'none'), '/LICENSE')
       WHEN doc_id % 10 = 0 THEN concat('/', coalesce(lang, 'none'), '/', CAST(doc_id % 7 AS STRING), '/LICENSE')
       ELSE concat('/', coalesce(lang, 'none'), '/', CAST(doc_id % 7 AS STRING), '/', CAST(doc_id AS STRING), '.txt') END)
"""


def op4_licences(spark, sf_dir):
    """The licence of every document, own or inherited."""
    docs = read_table(spark, sf_dir, "documents")
    return scan(docs.select("doc_id", F.expr(PATH_SQL).alias("path"), "text"))


_VALUES = ",\n".join(f"({i}, '{licence}', '{text}', {needs_all(text)})" for i, (licence, text) in enumerate(TEMPLATES))


def _split_sql(text: str) -> str:
    return (f"string_split(regexp_replace({text}, '{SENTENCE.replace(chr(92) + 'n', chr(10))}', "
            "'\\1' || chr(10) || '\\2', 'g'), chr(10))")


OP4_SQL = f"""
WITH files AS (
  SELECT doc_id, {PATH_SQL.replace('STRING', 'VARCHAR')} AS path, coalesce(text, '') AS text FROM documents),
templates(tid, licence, text, whole) AS (VALUES {_VALUES}),
tt AS (SELECT tid, licence, whole, unnest(list_distinct(regexp_extract_all(lower(text), '{TERM}'))) AS term FROM templates),
voc AS (SELECT DISTINCT term FROM tt),
dt AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '{TERM}'))) AS term FROM files),
df AS (SELECT voc.term, count(dt.doc_id) AS n FROM voc LEFT JOIN dt ON dt.term = voc.term GROUP BY voc.term),
w AS (SELECT term, ln((1 + (SELECT count(*) FROM files)) / (1 + n)) + 1 AS w FROM df),
pa AS (SELECT doc_id, text, regexp_split_to_array(text, '{PARAGRAPH}') AS p FROM files),
un AS (SELECT doc_id, list_concat({_split_sql('text')}, p, flatten([{_split_sql(f"regexp_replace(x, '{LINE_START}', ' ', 'g')")} for x in p])) AS u FROM pa),
st AS (SELECT doc_id, unnest(u) AS s, generate_subscripts(u, 1) AS pos FROM un),
su AS (SELECT doc_id, pos, unnest(list_distinct(regexp_extract_all(lower(s), '{TERM}'))) AS term FROM st),
sq AS (SELECT su.doc_id, su.pos, sum(CASE WHEN w.w IS NULL
        THEN (ln(1 + (SELECT count(*) FROM files)) + 1) * (ln(1 + (SELECT count(*) FROM files)) + 1) ELSE w.w * w.w END) AS square
       FROM su LEFT JOIN w ON w.term = su.term GROUP BY su.doc_id, su.pos),
tq AS (SELECT tid, sum(w.w * w.w) AS square, count(*) AS size FROM tt JOIN w ON w.term = tt.term GROUP BY tid),
dot AS (SELECT su.doc_id, su.pos, tt.tid, tt.licence, tt.whole, sum(w.w * w.w) AS dot, count(*) AS common
        FROM su JOIN tt ON tt.term = su.term JOIN w ON w.term = su.term
        GROUP BY su.doc_id, su.pos, tt.tid, tt.licence, tt.whole),
sc AS (SELECT dot.doc_id, dot.licence, round(dot.dot / sqrt(sq.square * tq.square), 6) AS score
       FROM dot JOIN sq ON sq.doc_id = dot.doc_id AND sq.pos = dot.pos JOIN tq ON tq.tid = dot.tid
       WHERE NOT dot.whole OR dot.common = tq.size),
own AS (SELECT doc_id, licence, score FROM sc WHERE score >= {THRESHOLD}
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, licence) = 1),
f AS (SELECT files.doc_id, path, own.licence, own.score, regexp_replace(path, '/?[^/]*$', '') AS dir,
             regexp_extract(path, '([^/]*)$', 1) AS name
      FROM files LEFT JOIN own ON own.doc_id = files.doc_id),
g AS (SELECT dir AS ancestor, licence AS granted FROM f WHERE licence IS NOT NULL AND regexp_matches(name, '{LICENCE_FILE}')
      QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, path, doc_id) = 1),
h AS (SELECT d.dir, g.ancestor AS from_dir, g.granted
      FROM (SELECT DISTINCT dir FROM f) d JOIN g ON d.dir = g.ancestor OR starts_with(d.dir, g.ancestor || '/')
      QUALIFY row_number() OVER (PARTITION BY d.dir ORDER BY length(g.ancestor) DESC) = 1)
SELECT f.doc_id, f.path, f.licence AS own_licence, f.score AS own_score, coalesce(f.licence, h.granted) AS licence,
       CASE WHEN f.licence IS NOT NULL THEN 'own' WHEN h.granted IS NOT NULL THEN 'inherited' ELSE 'none' END AS how,
       CASE WHEN f.licence IS NULL THEN h.from_dir END AS from_dir
FROM f LEFT JOIN h ON h.dir = f.dir
"""
