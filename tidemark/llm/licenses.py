"""License scan by diagonal voting, with DataFrame functions only.

Every pair of neighbouring words of a document is joined by hash, checked by
its words, to the places of that pair in the templates. A hit votes for the
diagonal document place less template place. A base phrase stands where its
diagonal has all votes. For the longer license texts, neighbouring diagonals of
one template, from any diagonal to `DRIFT` words on (words put in or left out),
are merged, so a span is at most `DRIFT` words longer than its template. The
span is verified: pairs count whose first word in it comes after that of the
template's pair before, and they must be `SHARE` of the template or more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import with_place, written

# The phrases whose places are counted, and wordings of license notices.
PHRASES = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]
NOTICES = [
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
            "as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license version 3"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
            "the software to deal in the software without restriction"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHARE = 0.85
DRIFT = 6


def template_rows() -> list[tuple]:
    """(pair, template, place, label, base, pairs) of every word pair of every template."""
    rows = []
    for base, texts in ((True, PHRASES), (False, NOTICES)):
        for label, text in texts:
            words = text.split()
            pairs = [" ".join(words[i:i + 2]) for i in range(len(words) - 1)]
            rows += [(p, f"{label}:{text}", i, label, base, len(pairs)) for i, p in enumerate(pairs)]
    return rows


def templates(spark: SparkSession) -> DataFrame:
    """The template rows with the hash of their pair; as large as the lists above."""
    df = spark.createDataFrame(template_rows(), "pair string, template string, place int, label string, base boolean, pairs int")
    return df.withColumn("hash", F.xxhash64("pair"))


def words_of(text) -> F.Column:
    """Words of the lower-cased text.

    lower() also changes letters beyond A-Z, but no character of a base
    phrase comes from one of those, and letters stay letters, so words and
    phrases are those of the text with A-Z alone lower-cased.
    """
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({WORD})"), F.lit(1))


def hits(rows: DataFrame) -> DataFrame:
    """(row, template, label, base, pairs, place, at): each word pair of (row, text) that stands in a template."""
    words = rows.select("row", words_of(F.col("text")).alias("words"))
    pairs = words.select("row", F.posexplode(
        F.zip_with("words", F.slice("words", F.lit(2), F.greatest(F.size("words"), F.lit(1))), lambda a, b: F.concat_ws(" ", a, b))).alias("at", "pair"))
    known = F.broadcast(templates(rows.sparkSession))  # a few hundred rows, fixed by the lists
    return (pairs.withColumn("hash", F.xxhash64("pair")).join(known, ["hash", "pair"])
            .select("row", "template", "label", "base", "pairs", "place", F.col("at").cast("long").alias("at")))


def spans(found: DataFrame) -> DataFrame:
    """(row, label, base, first, share): base phrases by full diagonals, notices by verified spans of merged diagonals."""
    votes = found.withColumn("diagonal", F.col("at") - F.col("place"))
    phrases = (votes.where("base").groupBy("row", "label", "template", "diagonal", "pairs")
               .agg(F.count(F.lit(1)).alias("n")).where("n = pairs")
               .select("row", "label", F.lit(True).alias("base"), F.col("diagonal").alias("first"), F.lit(1.0).alias("share")))
    group = ["row", "label", "template", "pairs"]
    votes = votes.where("NOT base")
    lines = votes.groupBy(*group, "diagonal").agg(F.count(F.lit(1)).alias("n"))  # a place votes once for a diagonal
    near = Window.partitionBy("row", "template").orderBy("diagonal").rangeBetween(0, DRIFT)
    begun = lines.withColumn("n", F.sum("n").over(near)).where(F.col("n") >= SHARE * F.col("pairs"))
    merged = begun.select("row", "template", F.col("diagonal").alias("begin"),
                          F.explode(F.sequence("diagonal", F.col("diagonal") + DRIFT)).alias("diagonal"))
    places = votes.join(merged, ["row", "template", "diagonal"]).groupBy(*group, "begin", "place").agg(F.min("at").alias("at"))
    before = F.lag("at").over(Window.partitionBy("row", "template", "begin").orderBy("place"))
    notices = (places.withColumn("rises", F.coalesce(F.col("at") > before, F.lit(True)))
               .groupBy(*group, "begin").agg(F.count_if("rises").alias("n"), F.min("at").alias("first")).where(F.col("n") >= SHARE * F.col("pairs"))
               .select("row", "label", F.lit(False).alias("base"), "first", (F.col("n") / F.col("pairs")).alias("share")))
    return phrases.union(notices)


def scanned(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    score: the best span's share of its template (1 for a base phrase), 0 if
    there is none; labels are empty strings then. A null or empty text has no
    words. A notice is looked for as a whole text: one word has no pair.
    """
    rows = with_place(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.select("doc_id", "text", F.struct("f", "r").alias("row"))
    found = spans(written(hits(rows))).groupBy("row").agg(
        F.count_if("base").cast("long").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first"))).alias("first_word"), F.max(F.when(F.col("base"), F.col("first"))).alias("last_word"),
        F.concat_ws(",", F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label"))))).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.collect_set("label"))).alias("labels"), F.max("share").alias("score"))
    counts = rows.select("doc_id", "row", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    return counts.join(found, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


def oracle_sql() -> str:
    """DuckDB SQL for the rows of `scanned` over `documents`."""
    rows = ", ".join(f"('{p}', '{t}', {i}, '{label}', {base}, {n})" for p, t, i, label, base, n in template_rows())
    return f"""
WITH w AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(lower(COALESCE(text, '')), '{WORD}') AS words FROM documents),
p AS (SELECT rid, k - 1 AS pos, words[k] || ' ' || words[k + 1] AS pair
  FROM (SELECT rid, words, unnest(generate_series(1, len(words) - 1)) AS k FROM w WHERE len(words) > 1) x),
t(pair, template, place, label, base, pairs) AS (VALUES {rows}),
hits AS (SELECT rid, template, label, base, pairs, place, pos, pos - place AS diagonal FROM p JOIN t USING (pair)),
phrases AS (SELECT rid, label, true AS base, diagonal AS start, CAST(1 AS DOUBLE) AS share FROM hits WHERE base
  GROUP BY rid, label, template, diagonal, pairs HAVING count(*) = pairs),
lines AS (SELECT rid, label, template, pairs, diagonal, count(*) AS n FROM hits WHERE NOT base GROUP BY rid, label, template, pairs, diagonal),
near AS (SELECT *, sum(n) OVER (PARTITION BY rid, template ORDER BY diagonal RANGE BETWEEN CURRENT ROW AND {DRIFT} FOLLOWING) AS around FROM lines),
begun AS (SELECT rid, template, diagonal AS begin_at FROM near WHERE around >= CAST({SHARE} AS DOUBLE) * pairs),
places AS (SELECT rid, label, template, pairs, begin_at, place, min(pos) AS pos FROM hits JOIN begun USING (rid, template)
  WHERE NOT base AND diagonal BETWEEN begin_at AND begin_at + {DRIFT} GROUP BY rid, label, template, pairs, begin_at, place),
rising AS (SELECT *, COALESCE(pos > lag(pos) OVER (PARTITION BY rid, template, begin_at ORDER BY place), true) AS rises FROM places),
sums AS (SELECT rid, label, template, pairs, begin_at, count(*) FILTER (rises) AS n, min(pos) AS start FROM rising
  GROUP BY rid, label, template, pairs, begin_at),
spans AS (SELECT * FROM phrases UNION ALL
  SELECT rid, label, false, start, CAST(n AS DOUBLE) / pairs FROM sums WHERE n >= CAST({SHARE} AS DOUBLE) * pairs),
found AS (SELECT rid, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
    max(share) AS score FROM spans GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(COALESCE(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, COALESCE(base_labels, '') AS base_labels, COALESCE(labels, '') AS labels,
  COALESCE(score, 0) AS score
FROM w LEFT JOIN found USING (rid)"""
