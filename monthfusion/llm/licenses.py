"""License scans by diagonal voting.

Templates are known license phrases and notices.  Every rolling run of words of every
document is hashed in one pass, in generated code, and joined with the templates' runs
by hash (runs of two words for short phrases, of ``RUN`` words for notices).  A match of
document position p and template position q votes for the diagonal p - q.  Votes are
summed per document, template and diagonal.  Neighbouring diagonals are merged if they
are no further apart than ``GAP`` of the template's length, as inserted or missing words
leave them.  A merged span is verified: the matches, which carry both positions, are
gone through in the document's order, and the longest chain of them that is in the
template's order too is found.  The score is the chain's share of all of the template's
runs, and it counts from ``MIN_SCORE``; so both the words, by hash and then by
themselves, and their order have to agree.  Phrases of the base list must be complete.

The table of template runs is fixed, some hundred rows, and is broadcast up to
``BROADCAST_ROWS``; a longer list of templates is joined by shuffle, of runs of words,
not of texts.

Defined cases: NULL and empty texts have no words, no places, empty labels and score 0.
Rows with equal id and text share their result; ids that are NULL or tied stay rows of
their own.  A very long text is one row of a scan; its matches, not its words, are
grouped.  An empty table gives an empty result.  Other columns are not read, whatever
their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthfusion.llm.sqltext import plain_words, run_hash
from monthfusion.sources.scratch import scratch_dir

RUN = 3
GAP = 0.5
MIN_SCORE = 0.6
BROADCAST_ROWS = 2_000_000


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    base: bool = False


# Phrases and labels, and the wording of public license notices.
TEMPLATES = (
    Template("mit", "mit license", base=True),
    Template("apache", "apache license", base=True),
    Template("gpl", "general public license", base=True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    Template("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software"
        " to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense"
        " and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"
        " the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"
        " provided that the above copyright notice and this permission notice appear in all copies",
    ),
    Template(
        "apache",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"
        " without warranties or conditions of any kind either express or implied",
    ),
    Template("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    Template("agpl", "under the terms of the gnu affero general public license as published by the free software foundation"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("cc-by", "licensed under cc by 4 0"),
    Template("cc-by-sa", "licensed under cc by sa 4 0"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by-nc-sa", "licensed under cc by nc sa 4 0"),
    Template("cc-by-nd", "licensed under cc by nd 4 0"),
    Template("cc0", "licensed under cc0 1 0"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
    Template("proprietary", "all rights reserved"),
)


def run_length(template: Template) -> int:
    n = len(template.text.split())
    return 2 if template.base or n < RUN else RUN


def template_runs(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """(hash, template, q, run, words, n_runs, base) for every run of every template."""
    rows = []
    for number, t in enumerate(templates):
        words, run = t.text.split(), run_length(t)
        rows += [(number, q, run, words[q : q + run], len(words), len(words) - run + 1, t.base) for q in range(len(words) - run + 1)]
    table = spark.createDataFrame(rows, "template int, q int, run int, run_words array<string>, template_words int, n_runs int, base boolean")
    hashed = F.when(F.col("run") == 2, F.expr(run_hash("run_words", "0", 2))).otherwise(F.expr(run_hash("run_words", "0", RUN)))
    return table.withColumn("hash", hashed)


def keyed(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))


def matches(spark: SparkSession, documents: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """(doc_id, text_hash, template, p, q): template runs that stand in documents, by word."""
    runs = template_runs(spark, templates)
    rolling = keyed(documents).select("doc_id", "text_hash", F.expr(plain_words("text")).alias("words"))
    rolling = rolling.select("doc_id", "text_hash", "words", F.posexplode("words").alias("p", "word"))
    hashes = f"array({run_hash('words', 'p', 2)}, {run_hash('words', 'p', RUN)})"
    hashed = rolling.select("doc_id", "text_hash", "words", "p", F.expr(f"explode({hashes})").alias("hash"))
    if runs.count() <= BROADCAST_ROWS:
        found = hashed.join(F.broadcast(runs), "hash").where("slice(words, p + 1, run) = run_words")
    else:  # a row that moves has the words of its run only
        near = hashed.withColumn("near", F.expr(f"slice(words, p + 1, {RUN})")).drop("words")
        found = near.join(runs, "hash").where("slice(near, 1, run) = run_words")
    return found.select("doc_id", "text_hash", "template", "p", "q", "template_words", "n_runs", "base")


def longest_chain(places: str, n_runs: str) -> str:
    """Length of the longest row of (p, q) in which both grow; ``best`` has, for each q,
    the longest that ends with it so far."""
    longer = "1 + coalesce(array_max(slice(best, 1, x.q)), 0)"
    step = f"(best, x) -> transform(best, (n, q) -> if(q = x.q, greatest(n, {longer}), n))"
    # Of one p only one q can be in a chain, so larger q come first.
    ordered = f"array_sort({places}, (a, b) -> if(a.p = b.p, b.q - a.q, a.p - b.p))"
    return f"array_max(aggregate({ordered}, array_repeat(0, {n_runs}), {step}))"


def spans(spark: SparkSession, documents: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """(doc_id, text_hash, template, label, base, start, score): verified places."""
    folder = scratch_dir(spark, "license-votes")
    # Rows with equal id and text vote once.
    place = ["doc_id", "text_hash", "template", "template_words", "n_runs", "base"]
    votes = matches(spark, documents, templates).withColumn("diagonal", F.expr("p - q"))
    votes.groupBy(*place, "diagonal").agg(F.collect_set("q").alias("runs")).write.parquet(folder)
    votes = spark.read.parquet(folder)
    whole = votes.where("base AND size(runs) = n_runs").select("doc_id", "text_hash", "template", "base", F.col("diagonal").alias("start"), F.lit(1.0).alias("score"))
    notices = votes.where("NOT base")
    along = Window.partitionBy("doc_id", "text_hash", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along)
    grouped = notices.withColumn("new", F.when(apart <= F.expr(f"{GAP} * template_words"), 0).otherwise(1)).withColumn("merged", F.sum("new").over(along))
    spots = F.expr("transform(runs, q -> struct(diagonal + q AS p, q AS q))")
    merged = grouped.groupBy(*place, "merged").agg(F.min("diagonal").alias("start"), F.flatten(F.collect_list(spots)).alias("places"))
    merged = merged.withColumn("score", F.expr(f"{longest_chain('places', 'n_runs')} / n_runs"))
    near = merged.where(F.col("score") >= MIN_SCORE).select("doc_id", "text_hash", "template", "base", F.greatest("start", F.lit(0)).alias("start"), "score")
    names = F.create_map(*[F.lit(x) for k, t in enumerate(templates) for x in (k, t.label)])
    return whole.unionByName(near).withColumn("label", names[F.col("template")])


def scan(spark: SparkSession, documents: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Per row: doc_id, n_words, places and labels, and the best score."""
    base = [F.when(F.col("base"), F.col(c)) for c in ("start", "label")]
    found = spans(spark, documents, templates).groupBy(F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash")).agg(
        F.count(base[0]).alias("n_base"), F.min(base[0]).cast("bigint").alias("first_word"), F.max(base[0]).cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(base[1])), ",").alias("base_labels"), F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("score").alias("score"),
    )
    folder = scratch_dir(spark, "license-places")
    found.write.parquet(folder)
    found = spark.read.parquet(folder)
    n_words = F.expr(r"cast(regexp_count(lower(coalesce(text, '')), r'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS bigint)")
    rows = keyed(documents).select("doc_id", "text_hash", n_words.alias("n_words"))
    joined = rows.join(found, (rows["text_hash"] == found["found_hash"]) & rows["doc_id"].eqNullSafe(found["found_id"]), "left")
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("base_labels", "labels")], F.coalesce("score", F.lit(0.0)).alias("score"),
    )
