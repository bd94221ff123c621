"""Licences of documents by TF-IDF cosine to templates, inherited along directories (operator 8), in DataFrame operations only.

A document that speaks of licence matters becomes three sparse vectors: its whole text, all of its lines and sentences that
speak of them, and the spans around each such place (200 characters before, 600 behind). Weights are term counts times
ln((1 + N) / (1 + df)) + 1, where N and df count the documents that speak and the templates. Vectors join the templates on
terms: the whole text those of whole licence texts, the others those of short notices. A whole text that is close to a
licence text makes the document a licence file of that licence; else the closest notice, if close enough, is the
document's own licence, and the document is a licence file if half of its words stand in such lines. A licence file speaks
for its directory, and documents without an own licence take that of the nearest directory above them that has one, found
by joining distinct directories with their ancestors.

Defined results: null or empty texts have no notice; a very long text is vectorised whole, its terms spread over tasks; a
null path has no directory and inherits nothing; of equally close templates the first in order counts; of several licence
files in a directory the closest match speaks, then the least licence name; a licence without a template is told as the
closest one, if close enough (an older version, say); repeated rows are judged each, equal texts by
one vector; columns that bear the name of a result are replaced, all others kept; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from countertide.llm.common import sized, table
from countertide.llm.licence_texts import LICENCE_TEXTS
from countertide.llm.registry import query
from countertide.plans.shared import freeze

#: Usual short notices of licences.
NOTICES = (
    ("MIT", "Released under the MIT License. Permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-2.0", "This program is free software under the terms of the GNU General Public License, version 2."),
    ("GPL-3.0", "This program is free software under the terms of the GNU General Public License, version 3."),
    ("GPL-3.0", "Distributed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL-3.0", "under the terms of the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "under the terms of the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted. BSD 3-Clause License."),
    ("BSD-2-Clause", "BSD 2-Clause License. Redistribution and use in source and binary forms are permitted."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, dedicated to the public domain under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "Copyright. All rights reserved."),
)
#: (licence, text, whether the text is a whole licence)
TEMPLATES = (*((name, text, False) for name, text in NOTICES), *((name, text, True) for name, text in LICENCE_TEXTS))

SPEAKS = r"(?i)licen[cs]e|spdx-|copyright|all rights reserved|public domain|permission is hereby granted|redistribution and use"
TERM = r"[a-z0-9]+(?:\.[0-9]+)*"
#: Characters of a span before and behind the place that speaks.
BEFORE, BEHIND = 200, 600
#: Least cosines: of notices, and of a whole text for a licence file.
LEAST, LEAST_FILE = 0.5, 0.7


def _terms(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(TERM), F.lit(0))


def _lines(text: Column) -> Column:
    """Lines and sentences that speak."""
    cut = F.split(F.regexp_replace(text, "([.!?;])[ \t\r\f]+", "$1\n"), "\n")
    return F.array_join(F.filter(cut, lambda x: x.rlike(SPEAKS)), "\n")


def _spans(text: Column) -> Column:
    """What lies around the places that speak; where spans meet, each character is taken once."""
    parts = F.split(F.regexp_replace(text, f"({SPEAKS})", "\x1e$1"), "\x1e")

    def around(part: Column, k: Column) -> Column:
        tail = F.substring(part, F.greatest(F.length(part) - BEFORE + 1, F.lit(1)), F.lit(BEFORE))
        both = F.concat(F.substring(part, F.lit(1), F.lit(BEHIND)), F.lit(" "), tail)
        head = F.substring(part, F.lit(1), F.lit(BEHIND))
        middle = F.when(F.length(part) <= BEFORE + BEHIND, part).otherwise(both)
        return F.when(k == 0, tail).when(k == F.size(parts) - 1, head).otherwise(middle)

    return F.array_join(F.transform(parts, around), "")


def _kept(df: DataFrame, *replaced: str) -> Column:
    """All columns but the replaced ones as one, so that no name of theirs meets one of ours."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in replaced]).alias("row")


def own_licences(docs: DataFrame, text: str = "text", templates=TEMPLATES, least: float = LEAST, least_file: float = LEAST_FILE) -> DataFrame:
    """``docs`` without the text, with ``licence``, ``similarity`` and ``is_file``."""
    spark = docs.sparkSession
    body = F.col(f"`{text}`").cast("string")
    noted = docs.select(_kept(docs, text.lower(), "licence", "similarity", "is_file"), F.when(body.rlike(SPEAKS), body).alias("spoken"))
    noted = freeze(noted.withColumn("key", F.when(F.col("spoken").isNotNull(), F.xxhash64("spoken"))), "notices")
    texts = noted.filter("key IS NOT NULL").groupBy("key").agg(F.first("spoken").alias("spoken"), F.count(F.lit(1)).alias("n"))
    kinds = F.array(
        *[F.struct(F.lit(k).alias("kind"), _terms(c).alias("terms")) for k, c in (("text", F.col("spoken")), ("line", _lines(F.col("spoken"))), ("span", _spans(F.col("spoken"))))]
    )
    each = texts.select("key", "n", F.explode(kinds).alias("k")).select("key", "n", "k.kind", F.explode("k.terms").alias("term"))
    terms = freeze(each.groupBy("key", "n", "kind", "term").agg(F.count(F.lit(1)).alias("tf")), "notice_terms")

    fixed = spark.createDataFrame(
        [(k, name, whole, x) for k, (name, x, whole) in enumerate(templates)], "template int, licence string, whole boolean, body string"
    )
    template_terms = fixed.select("template", "licence", "whole", F.explode(_terms(F.col("body"))).alias("term"))
    template_terms = template_terms.groupBy("template", "licence", "whole", "term").agg(F.count(F.lit(1)).alias("ttf"))
    total = (noted.filter("key IS NOT NULL").count()) + len(templates)
    seen = terms.filter("kind = 'text'").select("term", "n").unionAll(template_terms.select("term", F.lit(1).cast("long")))
    idf = F.log((1.0 + total) / (1.0 + F.sum("n"))) + 1.0
    weights = freeze(seen.groupBy("term").agg(idf.alias("idf")), "idf")
    # The templates are a fixed list of some thousand terms.
    vectors = freeze(template_terms.join(weights, "term").withColumn("tw", F.col("ttf") * F.col("idf")), "template_terms")
    lengths = vectors.groupBy("template").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("tlen"))
    weighted = terms.join(sized(weights), "term").withColumn("w", F.col("tf") * F.col("idf"))
    weighted = freeze(weighted.select("key", "kind", "term", "tf", "w"), "weighted")
    norm = weighted.groupBy("key", "kind").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("len"), F.sum("tf").alias("words"))
    near = weighted.join(sized(vectors), "term").filter((F.col("kind") == "text") == F.col("whole"))
    dots = near.groupBy("key", "kind", "template", "licence").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    cosine = F.round(F.col("dot") / (F.col("len") * F.col("tlen")), 6)
    close = F.struct(cosine.alias("similarity"), (-F.col("template")).alias("place"), "licence")
    best = dots.join(norm.select("key", "kind", "len"), ["key", "kind"]).join(F.broadcast(lengths), "template").groupBy("key").agg(
        F.max(F.when(F.col("kind") == "text", close)).alias("file"), F.max(F.when(F.col("kind") != "text", close)).alias("notice")
    )
    words = norm.groupBy("key").agg(*[F.max(F.when(F.col("kind") == k, F.col("words"))).alias(k) for k in ("line", "text")])
    is_file = F.coalesce(F.col("file.similarity") >= least_file, F.lit(False))
    chosen = F.when(is_file, F.col("file")).when(F.col("notice.similarity") >= least, F.col("notice"))
    judged = best.join(words, "key").select(F.col("key").alias("of"), chosen.alias("c"), (is_file | (2 * F.col("line") >= F.col("text"))).alias("is_file"))
    judged = judged.filter("c IS NOT NULL").select("of", "c.licence", "c.similarity", "is_file")
    out = noted.drop("spoken").join(sized(freeze(judged, "licences")), F.col("key") == F.col("of"), "left")
    return out.select("row.*", "licence", "similarity", F.coalesce("is_file", F.lit(False)).alias("is_file"))


def _directory(path: Column) -> Column:
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", ""))


def inherit(judged: DataFrame, path: str = "path") -> DataFrame:
    """``judged`` with ``effective`` (the own licence or the inherited one) and ``inherited_from`` (a directory or null)."""
    placed = judged.select(_kept(judged, "effective", "inherited_from"), "licence", "similarity", "is_file", _directory(F.col(f"`{path}`")).alias("dir"))
    speaks = placed.filter("is_file AND dir IS NOT NULL").groupBy("dir").agg(F.min_by("licence", F.struct(-F.col("similarity"), "licence")).alias("says"))
    says = freeze(speaks.select(F.col("dir").alias("up"), "says"), "directory_licences")
    directories = placed.filter("dir IS NOT NULL").select("dir").distinct()
    above = directories.select("dir", F.explode(F.sequence(F.lit(1), F.size(F.split("dir", "/")))).alias("depth"))
    above = above.withColumn("up", F.array_join(F.slice(F.split("dir", "/"), F.lit(1), F.col("depth")), "/"))
    nearest = above.join(sized(says), "up").groupBy("dir").agg(F.max_by(F.struct("up", "says"), "depth").alias("n"))
    nearest = freeze(nearest.select(F.col("dir").alias("of"), "n.up", "n.says"), "nearest")
    met = placed.join(sized(nearest), F.col("dir") == F.col("of"), "left")
    return met.select(
        "row.*", F.coalesce("licence", "says").alias("effective"), F.when(F.col("licence").isNull(), F.col("up")).alias("inherited_from")
    )


def _sql() -> str:
    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    values = ",\n".join(f"({k}, {quoted(name)}, {whole}, {quoted(text)})" for k, (name, text, whole) in enumerate(TEMPLATES))
    speaks = quoted(SPEAKS)
    return f"""
WITH fixed(template, licence, whole, body) AS (VALUES {values}
), d AS (
  SELECT doc_id, text, concat_ws('/', source, lang, CAST(doc_id AS VARCHAR)) AS path, regexp_matches(text, {speaks}) AS speaks FROM documents
), t AS (
  SELECT text, count(*) AS n, string_split(regexp_replace(text, {quoted(f"({SPEAKS})")}, chr(30) || '\\1', 'g'), chr(30)) AS parts
  FROM d WHERE speaks GROUP BY text
), bodies AS (
  SELECT text, n, 'text' AS kind, text AS body FROM t
  UNION ALL
  SELECT text, n, 'line', array_to_string(list_filter(
    string_split(regexp_replace(text, '([.!?;])[ \t\r\f]+', '\\1' || chr(10), 'g'), chr(10)), lambda x: regexp_matches(x, {speaks})), chr(10)) FROM t
  UNION ALL
  SELECT text, n, 'span', array_to_string(list_transform(parts, lambda p, i: CASE
    WHEN i = 1 THEN substring(p, greatest(length(p) - {BEFORE - 1}, 1), {BEFORE})
    WHEN i = len(parts) THEN substring(p, 1, {BEHIND})
    WHEN length(p) <= {BEFORE + BEHIND} THEN p
    ELSE substring(p, 1, {BEHIND}) || ' ' || substring(p, greatest(length(p) - {BEFORE - 1}, 1), {BEFORE}) END), '') FROM t
), terms AS (
  SELECT text, n, kind, term, count(*) AS tf
  FROM (SELECT text, n, kind, unnest(regexp_extract_all(lower(body), '{TERM}')) AS term FROM bodies) GROUP BY ALL
), template_terms AS (
  SELECT template, licence, whole, term, count(*) AS ttf
  FROM (SELECT template, licence, whole, unnest(regexp_extract_all(lower(body), '{TERM}')) AS term FROM fixed) GROUP BY ALL
), total AS (
  SELECT (SELECT count(*) FROM d WHERE speaks) + (SELECT count(*) FROM fixed) AS total
), weights AS (
  SELECT term, ln((CAST(1 AS DOUBLE) + max(total)) / (1 + sum(n))) + 1 AS idf
  FROM (SELECT term, n FROM terms WHERE kind = 'text' UNION ALL SELECT term, 1 FROM template_terms), total GROUP BY term
), vectors AS (
  SELECT template, licence, whole, term, ttf * idf AS tw FROM template_terms JOIN weights USING (term)
), lengths AS (
  SELECT template, sqrt(sum(tw * tw)) AS tlen FROM vectors GROUP BY template
), weighted AS (
  SELECT text, kind, term, tf, tf * idf AS w FROM terms JOIN weights USING (term)
), norm AS (
  SELECT text, kind, sqrt(sum(w * w)) AS len, sum(tf) AS words FROM weighted GROUP BY ALL
), cosines AS (
  SELECT text, kind, template, licence, round(dot / (len * tlen), 6) AS similarity
  FROM (SELECT text, kind, template, licence, sum(w * tw) AS dot FROM weighted JOIN vectors USING (term) WHERE (kind = 'text') = whole GROUP BY ALL)
  JOIN norm USING (text, kind) JOIN lengths USING (template)
), ranked AS (
  SELECT text, kind = 'text' AS of_file, licence, similarity,
         row_number() OVER (PARTITION BY text, kind = 'text' ORDER BY similarity DESC, template) AS place FROM cosines
), words AS (
  SELECT text, max(words) FILTER (kind = 'line') AS line, max(words) FILTER (kind = 'text') AS whole FROM norm GROUP BY text
), own AS (
  SELECT w.text, CASE WHEN f.similarity >= {LEAST_FILE} THEN f.licence ELSE h.licence END AS licence,
         CASE WHEN f.similarity >= {LEAST_FILE} THEN f.similarity ELSE h.similarity END AS similarity,
         coalesce(f.similarity >= {LEAST_FILE}, false) OR coalesce(2 * line >= whole, false) AS is_file
  FROM words w
  LEFT JOIN (SELECT * FROM ranked WHERE place = 1 AND of_file) f USING (text)
  LEFT JOIN (SELECT * FROM ranked WHERE place = 1 AND NOT of_file AND similarity >= {LEAST}) h USING (text)
), judged AS (
  SELECT doc_id, regexp_replace(path, '/[^/]*$', '') AS dir, path LIKE '%/%' AS placed, licence, similarity, licence IS NOT NULL AND is_file AS is_file
  FROM d LEFT JOIN own USING (text)
), says AS (
  SELECT dir AS up, licence AS says FROM judged WHERE is_file AND placed
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY similarity DESC, licence) = 1
), above AS (
  SELECT dir, depth, array_to_string(string_split(dir, '/')[1:depth], '/') AS up
  FROM (SELECT dir, unnest(range(1, len(string_split(dir, '/')) + 1)) AS depth FROM (SELECT DISTINCT dir FROM judged WHERE placed))
), nearest AS (
  SELECT dir, up, says FROM above JOIN says USING (up) QUALIFY row_number() OVER (PARTITION BY dir ORDER BY depth DESC) = 1
)
SELECT doc_id, licence, similarity, coalesce(is_file, false) AS is_file, coalesce(licence, says) AS effective,
       CASE WHEN licence IS NULL THEN up END AS inherited_from
FROM judged LEFT JOIN nearest ON placed AND judged.dir = nearest.dir
"""


ORACLE = _sql()


@query("op8_licences", ORACLE)
def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no path of their own; host and language are taken as their directories."""
    docs = table(spark, sf_dir, "documents")
    placed = docs.select("doc_id", "text", F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")).alias("path"))
    judged = freeze(own_licences(placed), "judged")
    return inherit(judged).select("doc_id", "licence", "similarity", "is_file", "effective", "inherited_from")
