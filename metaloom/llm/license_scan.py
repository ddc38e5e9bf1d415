"""License scans with a positional index of rare words.

Every template is a licence's text or notice, of which STOP words are place-holders only. Its key phrases are mandatory.
Document frequencies of all template words are counted over all documents; the ANCHORS words of a template's key phrases
that are rarest by these go into the index, with their positions.

A file's own licence words decide what is looked up: a template is possible in it only if it has all words of the key
phrases, and of these only the ones of highest IDF are looked up, each at every place where the file has it. A posting
says where the template would begin; the postings that agree on one beginning are intersected. Only these candidates are
verified: the template's words are matched at their places and the key phrases must be whole. As every place of a
template holds all its anchors, none is missed.

Only DataFrame functions: one pass over the texts leaves each document's template words with their positions; all that
follows works on these, one row for a document, a template and a beginning. Nothing is quadratic in a text's length.

Defined cases: a null or empty text has no words and no labels, and score 0; repeated rows are reported each; score is
the best share of a template's words that stand at their places, 0 where no template was verified.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, ascii_lower, let, plain_words, save

#: Rare words of a template that are looked up.
ANCHORS = 2
#: Place-holders, fixed values.
STOP = set("a all an and any are as at be but by do does for from has have if in into is it its may no not of on only or other out shall should such that the their them there these they this those to was were which will with without you your".split()) - {"by"}
#: The phrases that the base columns report, with their labels.
BASE = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]
#: Fixed values, the licences' own texts and notices: label, text, key phrases.
NOTICES = [
    ("gpl-2.0", "GNU General Public License, version 2", ["gnu general public license", "version 2"]),
    ("gpl-3.0", "GNU General Public License, version 3", ["gnu general public license", "version 3"]),
    ("gpl-notice", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by
        the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it
        will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General
        Public License for more details.""", ["free software", "gnu general public license", "free software foundation", "any later version"]),
    ("lgpl", "GNU Lesser General Public License", ["gnu lesser general public license"]),
    ("agpl", "GNU Affero General Public License", ["gnu affero general public license"]),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain
        a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under
        the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
        language governing permissions and limitations under the License.""", ["apache license version 2 0"]),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"),
        to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or
        sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright
        notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT
        WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
        NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
        TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""", ["permission is hereby granted free of charge", "person obtaining a copy"]),
    ("bsd-2-clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
        1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in
        binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials
        provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
        INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""", ["redistribution and use in source and binary forms"]),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright
        notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
        INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.""", ["permission to use copy modify", "distribute this software for any purpose"]),
    ("mpl-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can
        obtain one at https://mozilla.org/MPL/2.0/.""", ["mozilla public license"]),
    ("epl", "Eclipse Public License", ["eclipse public license"]),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the
        use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
        redistribute it freely, subject to the following restrictions""", ["authors be held liable for any damages", "including commercial applications"]),
    ("cc-by-nc", "CC BY-NC", ["cc by nc"]),
    ("cc-by-nd", "CC BY-ND", ["cc by nd"]),
    ("cc-by-sa", "CC BY-SA", ["cc by sa"]),
    ("cc0", "Creative Commons Zero", ["creative commons zero"]),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this
        software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""", ["unencumbered software released into the public domain"]),
]


def templates() -> list[dict]:
    """Of each template: number, label, whether it is a base phrase, words (position to word, without STOP), key (positions of key phrases)."""
    out = []
    for label, text, phrases, base in [*((la, t, [t], True) for t, la in BASE), *((*x, False) for x in NOTICES)]:
        all_words = re.findall("[a-z0-9]+", text.lower())
        key: set[int] = set()
        for phrase in phrases:
            p = phrase.split()
            at = next(i for i in range(len(all_words)) if all_words[i : i + len(p)] == p)
            key |= set(range(at, at + len(p)))
        words = {i: w for i, w in enumerate(all_words) if w not in STOP or base}
        first = min(words)
        words = {i - first: w for i, w in words.items()}
        out.append({"number": len(out), "label": label, "base": base, "words": words, "key": sorted({i - first for i in key} & words.keys())})
    return out


VOCABULARY = sorted({w for t in templates() for w in t["words"].values()})


def positions(docs: DataFrame) -> DataFrame:
    """row, doc_id, n_words, hits (array of pos and word: where words of VOCABULARY stand)."""
    hit = lambda x, i: F.when(x.isin(VOCABULARY), F.struct(i.alias("pos"), x.alias("word")))
    found = lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"), F.filter(F.transform(w, hit), lambda x: x.isNotNull()).alias("hits"))
    words = plain_words(ascii_lower(F.coalesce("text", F.lit(""))))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", let(words, found).alias("m"))
    return save(rows.select("row", "doc_id", "m.n_words", "m.hits"), "license-positions")


def index(places: DataFrame) -> list[tuple[str, int, int]]:
    """word, template, place: each template's ANCHORS key words of highest IDF in places."""
    n = places.count()
    df = {r.word: r["count"] for r in places.select(F.explode(F.array_distinct("hits.word")).alias("word")).groupBy("word").count().collect()}  # VOCABULARY at most
    idf = lambda w: math.log((n + 1) / (df.get(w, 0) + 1))
    rare = lambda t: sorted(t["key"], key=lambda i: (-idf(t["words"][i]), i))[:ANCHORS]
    return [(t["words"][i], t["number"], i) for t in templates() for i in rare(t)]


def candidates(places: DataFrame) -> DataFrame:
    """row, template, at: where all anchors of a template that a document may have agree on its beginning."""
    spark, anchors = places.sparkSession, index(places)
    own = F.array_distinct("hits.word")
    texts = lambda words: F.array(*map(F.lit, sorted(words)))
    of = {t["number"]: {w for w, number, _ in anchors if number == t["number"]} for t in templates()}
    needs = F.array(*(F.struct(F.lit(t["number"]).alias("template"), texts({t["words"][i] for i in t["key"]}).alias("key"), texts(of[t["number"]]).alias("rare")) for t in templates()))
    # the templates that a file's own words allow, and its words of highest IDF in these
    possible = let(own, lambda d: F.filter(needs, lambda t: F.size(F.array_except(t["key"], d)) == 0))
    some = places.select("row", "hits", possible.alias("possible")).filter(F.size("possible") > 0)
    rare = F.array_distinct(F.flatten("possible.rare"))
    looked = some.select("row", F.col("possible.template").alias("templates"), let(rare, lambda r: F.filter("hits", lambda h: F.array_contains(r, h["word"]))).alias("hits"))
    table = F.broadcast(spark.createDataFrame(anchors, "word string, template int, place int"))
    size = F.broadcast(spark.createDataFrame([(number, sum(a[1] == number for a in anchors)) for number in of], "template int, n_anchors int"))
    met = looked.select("row", "templates", F.explode("hits").alias("h")).select("row", "templates", "h.*").join(table, "word")
    met = met.filter(F.array_contains("templates", F.col("template"))).select("row", "template", (F.col("pos") - F.col("place")).alias("at")).filter("at >= 0")
    return met.groupBy("row", "template", "at").count().join(size, "template").filter("count = n_anchors").select("row", "template", "at")


def placements(places: DataFrame) -> DataFrame:
    """row, label, base, at (the word where a verified template begins), share (of its words that match)."""
    spark = places.sparkSession
    found = save(candidates(places), "license-candidates")
    postings = [(w, t["number"], i, i in t["key"]) for t in templates() for i, w in t["words"].items()]
    table = F.broadcast(spark.createDataFrame(postings, "word string, template int, place int, key boolean"))
    facts = [(t["number"], t["label"], t["base"], len(t["key"]), len(t["words"])) for t in templates()]
    facts = F.broadcast(spark.createDataFrame(facts, "template int, label string, base boolean, n_key int, n_template int"))
    which = found.groupBy("row").agg(F.collect_set("template").alias("templates"))  # of all templates at most
    hits = places.join(which, "row").select("row", "templates", F.explode("hits").alias("h")).select("row", "templates", "h.*")
    met = hits.join(table, "word").filter(F.array_contains("templates", F.col("template")))
    met = met.select("row", "template", (F.col("pos") - F.col("place")).alias("at"), "key").join(found, ["row", "template", "at"], "left_semi")
    met = met.groupBy("row", "template", "at").agg(F.count("*").alias("n"), F.count_if("key").alias("keys")).join(facts, "template").filter("keys = n_key")
    return met.select("row", "label", "base", "at", (F.col("n") / F.col("n_template")).alias("share"))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score: a row for each of docs."""
    places = positions(docs)
    base = F.col("base")
    found = placements(places).groupBy("row").agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("at"))).cast("bigint").alias("first_word"), F.max(F.when(base, F.col("at"))).cast("bigint").alias("last_word"),
        F.collect_set(F.when(base, F.col("label"))).alias("base_labels"), F.collect_set("label").alias("labels"), F.max("share").alias("score"),
    )
    listed = lambda c: F.coalesce(F.array_join(F.sort_array(c), ","), F.lit("")).alias(c)
    out = places.select("row", "doc_id", "n_words").join(found, "row", "left")
    return out.select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word", listed("base_labels"), listed("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))


def sql() -> str:
    """The same for DuckDB: every template tried at every place, without an index."""
    rows = ", ".join(f"({t['number']}, '{t['label']}', {str(t['base']).lower()}, {i}, '{w}', {str(i in t['key']).lower()}, {len(t['key'])}, {len(t['words'])})" for t in templates() for i, w in t["words"].items())
    return rf"""
WITH t(template, label, base, place, word, is_key, n_key, n_template) AS (VALUES {rows}),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
e AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM d),
p AS (SELECT doc_id, label, base, pos - place AS begins, count(*)::DOUBLE / any_value(n_template) AS share FROM e JOIN t USING (word)
      WHERE pos >= place GROUP BY doc_id, template, label, base, pos - place HAVING count(*) FILTER (is_key) = any_value(n_key)),
g AS (SELECT doc_id, count(*) FILTER (base) AS n_base, min(begins) FILTER (base) AS first_word, max(begins) FILTER (base) AS last_word,
      string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM p GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN g USING (doc_id)"""
