"""Licence scan: sparse TF-IDF cosine to templates, then inheritance from the nearest directory with a licence file.

Units are the lines of every file (header notices may stand anywhere) and the
whole text of each licence file.  Terms are runs of a-z and 0-9 in lower case.
Weights are term counts times idf over the template collection; a term in no
template has the idf of document frequency 0.  A unit whose terms cover less
than the squared threshold of a template's squared length cannot reach the
threshold (Cauchy-Schwarz), so only the others are unfolded into terms.

A file without a licence by these units is compared by its runs: as many terms
as a template has, over line ends and comment marks, from each of the
template's terms on.  So wrapped notices are found, those inside long
paragraphs, and full licence texts, by the sentences they hold.  Licence files
are compared with the titles of full texts too, and all files with the notices
of kindred licences, which keep the templates' licences apart from theirs.  Texts are cut into overlapping
pieces of bounded length first; every run lies whole in one.

A file's own licence is the template of greatest cosine at or above the
threshold (ties: the smaller template number).  A file without one inherits
from the nearest ancestor directory, its own included, that has a licence file
with a licence; of several in one directory the greatest cosine, then the
least path, counts.

DataFrame functions only.  Null or empty text has no own licence; a null path
has no directory and inherits nothing.  Every input row gives one output row
and is a file of its own, also where ids are null or repeat.  A text with the
BSD conditions on binary forms but none on names is BSD-2-Clause; the opening
sentence alone stands for BSD-3-Clause.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from realty_spark.llm.common import land, read_table

THRESHOLD = 0.8
LICENCE_NAME = "(?i)^(licen[cs]e|copying|notice)([.].*)?$"

# Short notices and opening sentences of public licences, by SPDX name.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]

# Notices of kindred licences, compared by runs only, so that their wrapped headers are not taken for the templates' licences.
KINDRED = [(name, f"This {work} is free software; you can redistribute it and/or modify it under the terms of the {licence} "
                  f"as published by the Free Software Foundation; either version {version} of the License, or any later version.")
           for name, work, licence, version in (
               ("GPL-1.0", "program", "GNU General Public License", "1"),
               ("GPL-2.0", "program", "GNU General Public License", "2"),
               ("LGPL-2.0", "library", "GNU Library General Public License", "2"),
               ("LGPL-2.1", "library", "GNU Lesser General Public License", "2.1"),
               ("LGPL-3.0", "library", "GNU Lesser General Public License", "3"),
               ("AGPL-3.0", "program", "GNU Affero General Public License", "3"))]
KINDRED.append(("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1; you may not use this file "
                           "except in compliance with the License."))

# Titles of full texts, for licence files.
TITLES = [
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("GPL-1.0", "GNU GENERAL PUBLIC LICENSE Version 1, February 1989"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-2.0", "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
]
PIECE_TERMS = 512


def template_weights(templates: list[tuple[str, str]]) -> tuple[list[dict[str, float]], dict[str, float], float]:
    """(weights of each template scaled to length one, idf of each term, idf of a term in no template)."""
    terms = [Counter(re.findall("[a-z0-9]+", text.lower())) for _, text in templates]
    frequency = Counter(t for c in terms for t in c)
    idf = {t: math.log((1 + len(terms)) / (1 + n)) + 1 for t, n in frequency.items()}
    out = []
    for c in terms:
        w = {t: n * idf[t] for t, n in c.items()}
        length = math.sqrt(sum(v * v for v in w.values()))
        out.append({t: v / length for t, v in w.items()})
    return out, idf, math.log(1 + len(terms)) + 1


def _terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda t: t != "")


def own_licences(files: DataFrame, templates: list[tuple[str, str]], threshold: float) -> DataFrame:
    """(id, template, similarity) of each (id, path, text) file with a licence of its own."""
    weights, idf, other = template_weights(templates)
    base = F.regexp_extract("path", "([^/]*)$", 1)
    lines = files.select("id", F.posexplode(F.split("text", "\n")).alias("line", "unit_text"))
    whole = files.where(base.rlike(LICENCE_NAME)).select("id", F.lit(-1).alias("line"), F.col("text").alias("unit_text"))
    units = lines.union(whole).select("id", "line", _terms(F.col("unit_text")).alias("terms"))
    hits = F.array_intersect("terms", F.array(*[F.lit(t) for t in sorted(idf)]))
    units = units.withColumn("hits", hits).where(F.size("hits") > 0)
    near = units.where(F.array_max(_covers(F.col("hits"), weights)) >= threshold * threshold - 1e-9).select("id", "line", "terms")
    return _best(near, weights, idf, other, threshold)


def _best(near: DataFrame, weights: list[dict[str, float]], idf: dict[str, float], other: float, threshold: float) -> DataFrame:
    """(id, template, similarity) of each id's best unit; of a unit with a template of its own only that one counts."""
    spark = near.sparkSession
    keys = [c for c in near.columns if c != "terms"]
    counted = near.select(*keys, F.explode("terms").alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("n"))
    idfs = F.broadcast(spark.createDataFrame(sorted(idf.items()), "term string, idf double"))  # the templates' terms
    weighed = counted.join(idfs, "term", "left").withColumn("w", F.col("n") * F.coalesce("idf", F.lit(other)))
    table = [(t, i, v) for i, w in enumerate(weights) for t, v in sorted(w.items())]
    by_term = F.broadcast(spark.createDataFrame(table, "term string, template int, v double"))
    lengths = weighed.groupBy(*keys).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    dots = weighed.join(by_term, ["term", "template"] if "template" in keys else ["term"])
    dots = dots.groupBy(*dict.fromkeys([*keys, "template"])).agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    cosine = dots.join(lengths, keys).withColumn("similarity", F.round(F.col("dot") / F.col("length"), 6))
    best = cosine.where(F.col("similarity") >= threshold).groupBy("id").agg(
        F.max(F.struct("similarity", (-F.col("template")).alias("less"))).alias("top"))
    return best.select("id", (-F.col("top.less")).alias("template"), F.col("top.similarity").alias("similarity"))


def _covers(hits: Column, weights: list[dict[str, float]]) -> Column:
    """For each template the squared weights of its terms among the distinct ``hits``, summed; a term is looked up once for all templates."""
    squares = {t: [w.get(t, 0.0) ** 2 for w in weights] for t in sorted({t for w in weights for t in w})}
    table = F.create_map(*[x for t, row in squares.items() for x in (F.lit(t), F.array(*map(F.lit, row)))])
    none = F.array(*[F.lit(0.0)] * len(weights))
    return F.aggregate(hits, none, lambda acc, t: F.zip_with(acc, table[t], lambda a, b: a + b))


def run_licences(files: DataFrame, templates: list[tuple[str, str]], titles: list[tuple[str, str]], threshold: float) -> DataFrame:
    """(id, template, similarity) of each (id, path, text) file by its runs of terms; titles are numbered after the templates."""
    weights, idf, other = template_weights(templates + titles)
    sizes = [len(re.findall("[a-z0-9]+", text.lower())) for _, text in templates + titles]
    named = F.coalesce(F.regexp_extract("path", "([^/]*)$", 1).rlike(LICENCE_NAME), F.lit(False))
    pieces = files.select("id", F.xxhash64("text").alias("of"), named.alias("named"), _terms(F.col("text")).alias("all")).where(F.size("all") > 0)
    begins = F.sequence(F.lit(0), F.size("all") - 1, F.lit(PIECE_TERMS))
    pieces = pieces.select("id", "of", "named", F.posexplode(F.transform(
        begins, lambda b: F.slice(F.col("all"), b + 1, PIECE_TERMS + max(sizes)))).alias("piece", "terms"))
    hits = F.array_intersect("terms", F.array(*[F.lit(t) for t in sorted(idf)]))
    pieces = pieces.withColumn("hits", hits).where(F.size("hits") > 0)
    least = threshold * threshold - 1e-9
    found = F.filter(F.transform(_covers(F.col("hits"), weights), lambda v, i: F.when((v >= least) & ((i < len(templates)) | F.col("named")), i)),
                     lambda i: i.isNotNull())
    near = pieces.withColumn("template", F.explode(found))
    words = F.element_at(F.array(*[F.array(*[F.lit(t) for t in sorted(w)]) for w in weights]), F.col("template") + 1)
    size = F.element_at(F.array(*[F.lit(n) for n in sizes]), F.col("template") + 1)
    near = near.withColumn("words", words).withColumn("size", size)
    # a run begins with a term of its template; one that begins in the next piece is left to that piece
    starts = F.filter(F.sequence(F.lit(1), F.least(F.size("terms"), F.lit(PIECE_TERMS))),
                      lambda at: F.array_contains("words", F.element_at("terms", at)))
    near = near.withColumn("begin", F.explode(starts)).withColumn("terms", F.expr("slice(terms, begin, size)"))
    of_run = F.array_intersect("terms", F.array(*[F.lit(t) for t in sorted(idf)]))
    cover = F.element_at(_covers(of_run, weights), F.col("template") + 1)
    near = near.where(cover >= least).select("id", "of", "piece", "template", "begin", "terms")  # `of`: rows may share an id
    return _best(near, weights, idf, other, threshold)


# Sentences that tell the BSD licences apart, as terms.
BSD_BINARY = "redistributions in binary form must reproduce the above copyright notice"
BSD_NAMES = "may be used to endorse or promote products derived from this software"


def _two_clauses(own: DataFrame, files: DataFrame) -> DataFrame:
    """A BSD licence whose text has the clause on binary forms but none on names is BSD-2-Clause; the opening sentence alone is not told apart."""
    terms = F.concat(F.lit(" "), F.array_join(_terms(F.col("text")), " "), F.lit(" "))
    two = terms.contains(f" {BSD_BINARY} ") & ~terms.contains(f" {BSD_NAMES} ")
    bsd = own.where("licence = 'BSD-3-Clause'").join(files.select("id", "text"), "id")
    told = bsd.dropDuplicates(["id"]).select("id", F.when(two, "BSD-2-Clause").otherwise("BSD-3-Clause").alias("licence"), "similarity")
    return own.where("licence <> 'BSD-3-Clause'").unionByName(told)


def scan(files: DataFrame, id_col: str = "id", path_col: str = "path", text_col: str = "text",
         templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD,
         kindred: list[tuple[str, str]] = KINDRED, titles: list[tuple[str, str]] = TITLES) -> DataFrame:
    """(id, path, licence, similarity, from_dir) of every file; from_dir is null for a file's own licence."""
    spark = files.sparkSession
    files = files.select(files[id_col].alias("given"), files[path_col].alias("path"), files[text_col].alias("text"))
    # rows are told by their contents, so that null and repeated ids keep their licences
    row = [F.struct(F.isnull(c), F.col(c)) for c in ("given", "path", "text")]
    files = files.withColumn("id", F.struct(F.xxhash64(*row).alias("a"), F.xxhash64(F.lit(1), *row).alias("b")))
    names = F.broadcast(spark.createDataFrame([(i, n) for i, (n, _) in enumerate(templates + kindred + titles)], "template int, licence string"))
    own = land(own_licences(files, templates, threshold).join(names, "template").select("id", "licence", "similarity"), "own")
    others = run_licences(files.join(own.select("id"), "id", "left_anti"), templates + kindred, titles, threshold)
    own = own.unionByName(land(others.join(names, "template").select("id", "licence", "similarity"), "own-runs"))
    own = land(_two_clauses(own, files), "licences")
    listed = files.select("id", "given", "path").withColumn("dir", F.regexp_replace(F.col("path"), "/?[^/]*$", ""))
    listed = listed.join(own, "id", "left")

    licence_files = listed.where(F.regexp_extract("path", "([^/]*)$", 1).rlike(LICENCE_NAME) & F.col("licence").isNotNull())
    of_dir = licence_files.groupBy("dir").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "path", "licence")).alias("top")).select(
        F.col("dir").alias("from_dir"), F.col("top.licence").alias("inherited"))
    # distinct directories unfold into their ancestors, not files; a directory of many files is joined once
    dirs = listed.where("licence is null and dir is not null").select("dir").distinct()
    parts = F.split("dir", "/")
    above = dirs.select("dir", F.posexplode(F.transform(F.sequence(F.lit(0), F.size(parts)),
                                                        lambda n: F.array_join(F.slice(parts, 1, n), "/"))).alias("depth", "from_dir"))
    nearest = above.join(of_dir, "from_dir").groupBy("dir").agg(F.max(F.struct("depth", "from_dir", "inherited")).alias("near")).select(
        "dir", F.col("near.from_dir").alias("from_dir"), F.col("near.inherited").alias("inherited"))
    out = listed.join(nearest, "dir", "left")
    return out.select(F.col("given").alias("id"), "path", F.coalesce("licence", "inherited").alias("licence"), "similarity",
                      F.when(F.col("licence").isNull(), F.col("from_dir")).alias("from_dir"))


# Stand-in for a tree of files: paths made of a document's source and id; every eighth file has a licence file's name.
_PATH = ("concat_ws('/', coalesce(source, 'none'), concat('g', cast(doc_id div 400 as string)), concat('d', cast(doc_id div 40 as string)), "
         "CASE WHEN doc_id % 8 = 0 THEN concat('LICENSE.', cast(doc_id as string)) ELSE concat(cast(doc_id as string), '.txt') END)")


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own or inherited licence of every document, as a file of a tree."""
    docs = read_table(spark, sf_dir, "documents")
    files = docs.select(F.col("doc_id").alias("id"), F.expr(_PATH).alias("path"), "text")
    return scan(files).withColumnRenamed("id", "doc_id")


def _oracle() -> str:
    weights, idf, other = template_weights(TEMPLATES)
    idfs = ", ".join(f"('{t}', {v!r}::DOUBLE)" for t, v in sorted(idf.items()))
    table = ", ".join(f"('{t}', {i}, {v!r}::DOUBLE)" for i, w in enumerate(weights) for t, v in sorted(w.items()))
    names = ", ".join(f"({i}, '{n}')" for i, (n, _) in enumerate(TEMPLATES))
    path = _PATH.replace("doc_id div", "doc_id //").replace("as string", "as varchar")
    return f"""
WITH i(term, idf) AS (VALUES {idfs}), t(term, template, v) AS (VALUES {table}), m(template, licence) AS (VALUES {names}),
f AS (SELECT doc_id, {path} AS path, text FROM documents),
u AS (SELECT doc_id, 1 AS kind, unnest(string_split(text, chr(10))) AS x FROM f
      UNION ALL SELECT doc_id, 2, text FROM f WHERE regexp_matches(regexp_extract(path, '([^/]*)$', 1), '{LICENCE_NAME}')),
n AS (SELECT row_number() OVER () AS unit, doc_id, regexp_extract_all(lower(x), '[a-z0-9]+') AS terms FROM u),
c AS (SELECT unit, doc_id, term, count(*) AS n FROM (SELECT unit, doc_id, unnest(terms) AS term FROM n
      WHERE list_has_any(terms, (SELECT list(DISTINCT term) FROM i))) GROUP BY ALL),
w AS (SELECT unit, doc_id, c.term, n * coalesce(idf, {other!r}::DOUBLE) AS w FROM c LEFT JOIN i ON i.term = c.term),
l AS (SELECT unit, sqrt(sum(w * w)) AS length FROM w GROUP BY 1),
s AS (SELECT doc_id, template, round(sum(w * v) / any_value(length), 6) AS similarity
      FROM w JOIN t ON t.term = w.term JOIN l USING (unit) GROUP BY unit, doc_id, template),
o AS (SELECT doc_id, licence, similarity FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY similarity DESC, template) AS k
      FROM s WHERE similarity >= {THRESHOLD}) JOIN m USING (template) WHERE k = 1),
p AS (SELECT f.doc_id, path, regexp_replace(path, '/?[^/]*$', '') AS dir, licence, similarity FROM f LEFT JOIN o ON o.doc_id = f.doc_id),
d AS (SELECT dir AS from_dir, licence AS inherited FROM (SELECT *, row_number() OVER (PARTITION BY dir ORDER BY similarity DESC, path) AS k
      FROM p WHERE licence IS NOT NULL AND regexp_matches(regexp_extract(path, '([^/]*)$', 1), '{LICENCE_NAME}')) WHERE k = 1),
a AS (SELECT p.doc_id, from_dir, inherited, row_number() OVER (PARTITION BY p.doc_id ORDER BY length(from_dir) DESC) AS k
      FROM p JOIN d ON p.dir = d.from_dir OR starts_with(p.dir, d.from_dir || '/') OR d.from_dir = '' WHERE licence IS NULL)
SELECT p.doc_id, path, coalesce(licence, inherited) AS licence, similarity, from_dir
FROM p LEFT JOIN a ON a.doc_id = p.doc_id AND k = 1
"""


ORACLE = _oracle()
