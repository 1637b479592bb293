"""License texts by diagonal voting: word k-grams joined to template positions."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Fixed phrases and labels that must be found wherever their words stand consecutively.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Own templates: opening words of well-known license notices, and their labels.
TEMPLATES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under the apache license version 2 0": "apache-2.0",
    "you may not use this file except in compliance with the license": "apache-2.0",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
    "public license": "gpl",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by 4 0": "cc-by-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "licensed under cc by nd 4 0": "cc-by-nd-4.0",
    "licensed under cc by nc sa 4 0": "cc-by-nc-sa-4.0",
    "licensed under cc by nc nd 4 0": "cc-by-nc-nd-4.0",
    "under the terms of the gnu lesser general public license as published by the free software foundation": "lgpl",
    "under the terms of the gnu affero general public license as published by the free software foundation": "agpl",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "has waived all copyright and related or neighboring rights to this work": "cc0-1.0",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
#: Words that change the license: a place must have the same ones as its template.
DECISIVE = ("nc", "nd", "sa", "lesser", "affero")
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: Words in a gram; the shortest phrase has as many.
K = 2
#: Diagonals at most so far apart belong to one place: words put in or left out.
NEIGHBOURS = 2
#: The least share of a template's words, in order, that a place must have.
LEAST = 0.8
#: A word that is a number, as in versions.
NUMBER = "^[0-9]+$"


def templates() -> list[tuple[int, str, str, bool]]:
    """(number, words, label, whether all words must agree)."""
    base = [(words, label, True) for words, label in BASE.items()]
    return [(i, *x) for i, x in enumerate(base + [(words, label, False) for words, label in TEMPLATES.items()])]


def decisive(words: list[str]) -> list[str]:
    """The words of a template that a place must have, sorted: version numbers only where the template has some."""
    return sorted(w for w in words if w in DECISIVE or re.match(NUMBER, w))


def lower_ascii(text: Column) -> Column:
    """Lower case without the Kelvin sign, the one other character that would become an ASCII letter."""
    return F.lower(F.replace(text, F.lit("K"), F.lit("ĸ")))


def places(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document with its verified places: row, doc_id, n_words, spans.

    Each rolling gram of a document is hashed and looked up among the grams of the templates (a table
    of fixed size, a few hundred rows). A hit at word p of the text and t of a template votes for the
    diagonal p - t. Votes are summed by document, template and diagonal; neighbouring
    diagonals that overlap are merged into one place; a place is verified on its words: a fixed
    phrase word by word, another template by the share of its grams that the place has in
    the template's order, and by its decisive words: the place must hold the same ones, so BY-NC is no
    BY with a word put in, nor version 2 a cut-off version 3. Only hits and one row per document are shuffled, no text.
    """
    grams = []
    for number, words, _label, exact in templates():
        parts = words.split()
        grams += [
            (" ".join(parts[t : t + K]), number, t, len(parts), math.ceil(len(parts) / LEAST), words if exact else None)
            for t in range(len(parts) - K + 1)
        ]
    known = spark.createDataFrame(grams, "gram string, template int, t int, size int, reach int, exact string")
    known = known.withColumn("h", F.xxhash64(*[F.get(F.split("gram", " "), F.lit(i)) for i in range(K)]))
    known = known.select("h", "template", "t", "size", "reach", "exact")
    words = docs.select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        F.array_remove(F.split(lower_ascii(F.coalesce("text", F.lit(""))), SEPARATORS), "").alias("words"),
    )
    words = words.withColumn("n_words", F.size("words").cast("long"))
    rolled = words.select("*", F.posexplode_outer("words").alias("p", "word"))
    # past the last word a gram has nulls: such a hash meets no template, and its words would not agree
    rolled = rolled.withColumn("h", F.xxhash64("word", *[F.get("words", F.col("p") + i) for i in range(1, K)]))
    hits = rolled.join(F.broadcast(known), "h", "left").where(
        F.col("template").isNotNull() | F.coalesce(F.col("p") == 0, F.lit(True))
    )
    # negative positions have no words: slice() would count them from the end
    at = F.col("p") - F.col("t")
    agree = (at >= 0) & (F.array_join(F.slice("words", F.greatest(at, F.lit(0)) + 1, F.col("size")), " ") == F.col("exact"))
    # no place that is verified goes on beyond the reach
    telling = F.transform(
        F.slice("words", F.col("p") + 1, F.col("reach")), lambda w, i: F.struct((F.col("p") + i).alias("at"), w.alias("word"))
    )
    telling = F.filter(telling, lambda x: x["word"].isin(*DECISIVE) | x["word"].rlike(NUMBER))
    hits = hits.select(
        "row", "doc_id", "n_words", "template", "t", "p", at.alias("diagonal"), "size",
        F.when(F.col("exact").isNull(), F.lit(None)).otherwise(agree).alias("exact"),
        F.when(F.col("exact").isNull(), telling).alias("telling"),
    )
    votes = hits.groupBy("row", "template", "diagonal").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.first("size").alias("size"),
        F.first("exact").alias("exact"),
        F.count("t").alias("votes"),
        F.min("t").alias("t_first"),
        F.max("t").alias("t_last"),
        F.min_by("telling", "p").alias("telling"),
    )
    # a phrase of fixed words is one diagonal; others may go on in the next ones
    line = Window.partitionBy("row", "template").orderBy("diagonal")
    near = (F.col("diagonal") - F.lag("diagonal").over(line)) <= NEIGHBOURS
    fresh = F.when(F.col("exact").isNotNull() | ~F.coalesce(near, F.lit(False)), 1).otherwise(0)
    merged = (
        votes.withColumn("fresh", fresh)
        .withColumn("place", F.sum("fresh").over(line))
        .groupBy("row", "template", "place")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_words").alias("n_words"),
            F.first("size").alias("size"),
            F.first("exact").alias("exact"),
            F.sum("votes").alias("votes"),
            F.min_by("telling", F.col("diagonal") + F.col("t_first")).alias("telling"),
            F.min(F.col("diagonal") + F.col("t_first")).alias("first"),
            F.max(F.col("diagonal") + F.col("t_last") + K).alias("end"),
        )
    )
    # a place that stretches over more words than the template and its gaps has its votes from elsewhere
    share = F.least(F.col("votes") / (F.col("size") - K + 1), F.col("size") / (F.col("end") - F.col("first")), F.lit(1.0))
    own = {number: decisive(words.split()) for number, words, _, exact in templates() if not exact}
    said = F.element_at(
        F.create_map(*[x for n, ws in own.items() for x in (F.lit(n), F.array(*map(F.lit, ws)).cast("array<string>"))]), F.col("template")
    )
    versioned = F.exists(said, lambda w: w.rlike(NUMBER))
    inside = F.filter("telling", lambda x: (x["at"] < F.col("end")) & (versioned | ~x["word"].rlike(NUMBER)))
    same = F.array_sort(F.transform(inside, lambda x: x["word"])) == said
    similarity = F.when(F.col("exact").isNotNull(), F.col("exact").cast("double")).when(same, share)
    verified = F.when(
        F.col("template").isNotNull() & (similarity >= LEAST), F.struct("template", "first", "end", similarity.alias("similarity"))
    )
    return merged.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.collect_list(verified).alias("spans"),
    )


def op2_license_scan(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Labels of the licenses in each document, with the places of the fixed phrases.

    ``score`` is the greatest similarity of a verified place, 0 without one. A null text
    counts as empty: no words, no labels. Each row is scanned on its own, also if it
    repeats or has no doc_id. An empty table gives no rows; other columns are not
    looked at.
    """
    table = templates()
    label_of = F.create_map(*[F.lit(x) for number, _, label, _ in table for x in (number, label)])
    base = F.filter("spans", lambda s: s["template"] < len(BASE))
    labels = lambda spans: F.array_join(
        F.array_sort(F.array_distinct(F.transform(spans, lambda s: label_of[s["template"]]))), ","
    )
    found = places(spark, docs).withColumn("base", base)
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda s: s["first"])).cast("long").alias("first_word"),
        F.array_max(F.transform("base", lambda s: s["first"])).cast("long").alias("last_word"),
        labels(F.col("base")).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["similarity"])), F.lit(0.0)).alias("score"),
    )


def _sql() -> str:
    values = ", ".join(
        f"({number}, '{words}', '{label}', {str(exact).upper()})" for number, words, label, exact in templates()
    )
    said = ", ".join(f"'{w}'" for w in DECISIVE)
    return re.sub(
        r"\n +", "\n", rf"""
WITH t AS (SELECT * FROM (VALUES {values}) AS v(template, phrase, label, exact)),
tw AS (SELECT *, string_split(phrase, ' ') AS tws FROM t),
tg AS (SELECT template, label, exact, len(tws) AS size, tws, i - 1 AS t, tws[i] || ' ' || tws[i + 1] AS gram
  FROM tw, unnest(range(1, len(tws))) AS r(i)),
d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(replace(coalesce(text, ''), chr(8490), chr(312))),
  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT doc_id, ws, i - 1 AS p, ws[i] || ' ' || ws[i + 1] AS gram FROM d, unnest(range(1, len(ws))) AS r(i)),
h AS (SELECT doc_id, template, label, exact, size, t, p, p - t AS diagonal,
  p >= t AND ws[p - t + 1:p - t + size] = tws AS agree FROM g JOIN tg USING (gram)),
v AS (SELECT doc_id, template, label, exact, size, diagonal, bool_and(agree) AS agree, count(*) AS votes,
  min(p) AS first, max(p) + 2 AS stop FROM h GROUP BY ALL),
f AS (SELECT *, CASE WHEN NOT exact AND diagonal - lag(diagonal) OVER w <= {NEIGHBOURS} THEN 0 ELSE 1 END AS fresh
  FROM v WINDOW w AS (PARTITION BY doc_id, template ORDER BY diagonal)),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS place FROM f),
m AS (SELECT doc_id, template, label, exact, size, place, bool_and(agree) AS agree, sum(votes) AS votes,
  min(first) AS first, max(stop) AS stop FROM n GROUP BY ALL),
c AS (SELECT template, list_sort(list_filter(tws, lambda x: x IN ({said}) OR regexp_matches(x, '{NUMBER}'))) AS own,
  len(list_filter(tws, lambda x: regexp_matches(x, '{NUMBER}'))) > 0 AS versioned FROM tw),
k AS (SELECT m.*, own = list_sort(list_filter(ws[first + 1:stop], lambda x: x IN ({said})
  OR (versioned AND regexp_matches(x, '{NUMBER}')))) AS same FROM m JOIN c USING (template) JOIN d USING (doc_id)),
s AS (SELECT *, CASE WHEN exact THEN agree::INT::DOUBLE WHEN same
  THEN least(votes / (size - 1), size / (stop - first), 1.0) END AS similarity FROM k),
o AS (SELECT doc_id, count(*) FILTER (exact) AS n_base, min(first) FILTER (exact) AS first_word,
  max(first) FILTER (exact) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact) AS base_labels,
  string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(similarity) AS score FROM s WHERE similarity >= {LEAST} GROUP BY 1)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0.0)::DOUBLE AS score FROM d LEFT JOIN o USING (doc_id)"""
    )


SQL = _sql()
