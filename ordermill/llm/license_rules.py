"""Licence scan by sentence rules.

Texts are split into pieces at line ends and after ``.``, ``!``, ``?``, ``;`` or ``:`` followed by white
space.  A piece is normalised: lower case, everything but letters, digits and ``+`` becomes one space, which
takes comment marks away.  A sentence is one piece, or several that follow each other across single line ends;
it does not go on after a blank line or one of the marks above.  Pieces are joined by equality with all runs of
words of the known sentences, some thousand rows.  Pieces in a row that hold the words of a known sentence
from its first to its last are that sentence, however it is wrapped.  The
identifiers of a text, in order, are matched against rules, which are sequences of identifiers.  A rule is
found where its identifiers follow each other in the text's sequence of known sentences (other sentences
between them do not matter, other known ones do).  Of rules that begin at one place only the longest counts.

Defined results: null and empty texts have no licence and, like all texts without one, no row; texts
without an id are kept apart by a row number of their own; rows that repeat an id and a text are joined in
one row, whose ``times`` says how often; long texts are split whole; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Sentences of well-known licence notices, and the licences that sequences of them state.
SENTENCES = {
    "apache_line": "Licensed under the Apache License, Version 2.0",
    "apache_header": 'Licensed under the Apache License, Version 2.0 (the "License")',
    "apache_comply": "you may not use this file except in compliance with the License",
    "apache_copy": "You may obtain a copy of the License at",
    "apache_as_is": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "mit_line": "Released under the MIT License",
    "mit_licensed": "Licensed under the MIT License",
    "mit_grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "mit_notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "gpl3_line": "This work is licensed under the GNU General Public License, version 3",
    "gpl_free": "This program is free software",
    "gpl_terms3": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl_terms2": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version",
    "gpl_hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "bsd_grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd_line": "Licensed under the BSD 3-Clause License",
    "mpl_line": "This Source Code Form is subject to the terms of the Mozilla Public License, v",
    "cc_by_nc": "Licensed under CC BY-NC 4.0",
    "cc_by": "Licensed under CC BY 4.0",
    "cc_by_sa": "Licensed under CC BY-SA 4.0",
    "all_rights": "All rights reserved",
}
RULES = [
    ("Apache-2.0", ["apache_line"]),
    ("Apache-2.0", ["apache_header", "apache_comply", "apache_copy"]),
    ("Apache-2.0", ["apache_header", "apache_comply", "apache_copy", "apache_as_is"]),
    ("MIT", ["mit_line"]),
    ("MIT", ["mit_licensed"]),
    ("MIT", ["mit_grant", "mit_notice"]),
    ("GPL-3.0", ["gpl3_line"]),
    ("GPL-3.0-or-later", ["gpl_free", "gpl_terms3"]),
    ("GPL-3.0-or-later", ["gpl_free", "gpl_terms3", "gpl_hope"]),
    ("GPL-2.0-or-later", ["gpl_free", "gpl_terms2"]),
    ("GPL-2.0-or-later", ["gpl_free", "gpl_terms2", "gpl_hope"]),
    ("BSD", ["bsd_grant"]),
    ("BSD-3-Clause", ["bsd_line"]),
    ("MPL-2.0", ["mpl_line"]),
    ("CC-BY-NC-4.0", ["cc_by_nc"]),
    ("CC-BY-4.0", ["cc_by"]),
    ("CC-BY-SA-4.0", ["cc_by_sa"]),
    ("proprietary", ["all_rights"]),
]

# Java and RE2 read both patterns alike.  Only the comparison SQL uses BREAK: it reads each line by itself, so
# it agrees where no known sentence is wrapped.
BREAK = r"[\r\n]+|[.!?;:]+[ \t]+"
NOISE = r"[^\p{L}\p{N}+]+"
# A line end with the comment marks and white space that follow; what ends a sentence, written ``|``.
LINE_END = r"(?:\r\n|\r|\n)[^\p{L}\p{N}+\r\n]*"
SENTENCE_END = r"\n\n+|[.!?;:]+(?=[ \t\n]|\z)"
PIECE_END = r"\n|(?=[|])"


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), NOISE, " "))


def known_sentences(spark: SparkSession, sentences: dict[str, str] = SENTENCES) -> DataFrame:
    """Normalised sentence and its number.  A known sentence must not hold a break itself."""
    rows = spark.createDataFrame(list(enumerate(sentences.values())), "sentence_id int, sentence string")
    return rows.select("sentence_id", normalised(F.col("sentence")).alias("sentence"))


def known_runs(spark: SparkSession, sentences: dict[str, str] = SENTENCES) -> DataFrame:
    """Every run of words of the known sentences: its text, number of words, and where it stands, as
    sentence number, words of the sentence and words before the run."""
    places: dict[str, list[tuple[int, int, int]]] = {}
    for number, sentence in known_sentences(spark, sentences).collect():
        words = sentence.split(" ")
        for low in range(len(words)):
            for high in range(low + 1, len(words) + 1):
                places.setdefault(" ".join(words[low:high]), []).append((number, len(words), low))
    rows = [(text, text.count(" ") + 1, stands) for text, stands in places.items()]
    return spark.createDataFrame(rows, "piece string, words int, stands array<struct<sentence_id:int,whole:int,before:int>>")


def pieces(text: Column) -> Column:
    """The pieces of a text; one that does not go on with the sentence of the piece before begins with ``|``."""
    lines = F.regexp_replace(F.translate(text, "|", ","), LINE_END, "\n")
    return F.split(F.regexp_replace(lines, SENTENCE_END, "|"), PIECE_END)


def rule_table(rules=RULES, sentences: dict[str, str] = SENTENCES) -> list[tuple[str, list[int]]]:
    ids = list(sentences)
    return [(licence, [ids.index(name) for name in names]) for licence, names in rules]


def licences(docs: DataFrame, sentences: dict[str, str] = SENTENCES, rules=RULES) -> DataFrame:
    """doc_id, licences (distinct, sorted), sentence_ids (the text's known sentences in order), n_rules
    (places where a rule matches), times (rows with this id and text)."""
    spark = docs.sparkSession
    numbered = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.xxhash64("text"), F.lit(0)).alias("same"),
        F.monotonically_increasing_id().alias("row"),
        "text",
    )
    part = numbered.select("doc_id", "same", "row", F.posexplode(pieces(F.col("text"))).alias("at", "raw"))
    part = part.select("doc_id", "same", "row", "at", F.col("raw").startswith("|").alias("anew"), normalised(F.col("raw")).alias("piece"))
    # the runs of the known sentences are fixed text of a few hundred kB
    met = part.join(F.broadcast(known_runs(spark, sentences)), "piece")
    in_order = Window.partitionBy("row", "doc_id", "same").orderBy("at")
    up_to_here = in_order.rowsBetween(Window.unboundedPreceding, 0)
    # pieces without a gap or a sentence end between them, and the words of the text's pieces before each
    chained = met.select(
        "row",
        "doc_id",
        "same",
        "at",
        "words",
        (F.col("at") - F.row_number().over(in_order)).alias("gaps"),
        F.sum(F.col("anew").cast("int")).over(up_to_here).alias("ends"),
        (F.sum("words").over(up_to_here) - F.col("words")).alias("passed"),
        "stands",
    )
    # after the window, which has to count each piece once
    chained = chained.withColumn("stands", F.explode("stands")).select("*", "stands.*")
    # pieces of one sentence agree in where it begins; they do not overlap, so all of its words are met once
    begins = (F.col("passed") - F.col("before")).alias("begins")
    found = chained.groupBy("row", "doc_id", "same", "gaps", "ends", "sentence_id", "whole", begins).agg(
        F.min("at").alias("at"), F.sum("words").alias("words")
    ).where(F.col("words") == F.col("whole"))
    by_text = found.groupBy("row", "doc_id", "same").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "whole", "sentence_id"))), lambda x: x["sentence_id"]).alias("sentence_ids")
    )
    once = by_text.groupBy("doc_id", F.when(F.col("doc_id").isNull(), F.col("row")).alias("own"), "same", "sentence_ids").agg(F.count(F.lit(1)).alias("times"))
    table = sorted(rule_table(rules, sentences), key=lambda rule: -len(rule[1]))
    places = F.sequence(F.lit(1), F.size("sentence_ids"))

    def at_place(i: Column) -> Column:
        out = F.lit(None).cast("string")
        for licence, ids in reversed(table):  # the longest rule is asked first
            here = F.slice("sentence_ids", i, F.lit(len(ids))) == F.array(*[F.lit(x) for x in ids])
            out = F.when(here, F.lit(licence)).otherwise(out)
        return out

    matched = once.withColumn("found", F.filter(F.transform(places, at_place), lambda x: x.isNotNull()))
    return matched.where(F.size("found") > 0).select(
        "doc_id",
        F.array_join(F.array_sort(F.array_distinct("found")), ",").alias("licences"),
        F.array_join(F.transform("sentence_ids", lambda x: x.cast("string")), ",").alias("sentence_ids"),
        F.size("found").cast("long").alias("n_rules"),
        "times",
    )


def comparison_sql(sentences: dict[str, str] = SENTENCES, rules=RULES) -> str:
    """The same over the table ``documents`` in DuckDB."""
    quote = lambda text: "'" + text.replace("'", "''") + "'"
    clean = lambda x: f"trim(regexp_replace(lower({x}), {quote(NOISE)}, ' ', 'g'))"
    values = ", ".join(f"({i}, {quote(text)})" for i, text in enumerate(sentences.values()))
    cases = " ".join(
        f"WHEN ids[i:i + {len(ids) - 1}] = {ids} THEN {quote(licence)}"
        for licence, ids in sorted(rule_table(rules, sentences), key=lambda rule: -len(rule[1]))
    )
    return f"""
WITH known AS (
  SELECT id, {clean("sentence")} AS sentence FROM (VALUES {values}) v(id, sentence)
), numbered AS (
  SELECT row_number() OVER () AS r, doc_id, text FROM documents
), parts AS (
  SELECT r, doc_id, text, unnest(regexp_split_to_array(text, {quote(BREAK)})) AS raw,
         generate_subscripts(regexp_split_to_array(text, {quote(BREAK)}), 1) AS place FROM numbered
), found AS (
  SELECT r, doc_id, text, list(id ORDER BY place) AS ids
  FROM parts JOIN known ON known.sentence = {clean("raw")} GROUP BY r, doc_id, text
), once AS (
  SELECT doc_id, text, CASE WHEN doc_id IS NULL THEN r END AS own, ids, count(*) AS times FROM found GROUP BY ALL
), matched AS (
  SELECT *, list_filter([CASE {cases} END FOR i IN range(1, len(ids) + 1)], lambda x: x IS NOT NULL) AS hits FROM once
)
SELECT doc_id, array_to_string(list_sort(list_distinct(hits)), ',') AS licences,
       array_to_string(ids, ',') AS sentence_ids, len(hits) AS n_rules, times
FROM matched WHERE len(hits) > 0
"""
