"""License scans by an exact set-similarity join of text blocks with licence templates.

A block is a stretch of a line twice as long as the template, one beginning at each of its lengths, or the words on both sides of a
line break, so that wrapped notices count and words strewn over a long line don't; comment marks are no words. It matches a template
when it holds at least the threshold's share of the template's distinct words. A line is first met as a whole, which holds all its stretches.
Words are ordered by the number of blocks that hold them, rarest first. A matching block must hold one
of the template's first words (prefix filter), be large enough (length filter), and have enough words left
after the shared one (positional filter); what remains is verified. All steps are DataFrame operations.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.9

# The base phrases with their labels.
PHRASES = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# A line break as a word of its own; lowered text has no upper case.
BREAK, BETWEEN_MARKED = "N", r"[\x00-\x2F\x3A-\x4D\x4F-\x60\x7B-\x7F]+"

#: Notices by label, as licences ask for them or as files usually give them.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "Copyright. All rights reserved."),
    ("proprietary", "All rights reserved."),
)


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def words(lower: Column) -> Column:
    return F.filter(F.split(lower, BETWEEN), lambda w: w != "")


def template_words(text: str) -> list[str]:
    """The words of a template, by the rule of words()."""
    low = "".join(c.lower() if c.isascii() else c for c in text)
    return "".join(c if not c.isascii() or c.isalnum() else " " for c in low).split()


def template_sets(templates=TEMPLATES) -> list[tuple[str, tuple[str, ...]]]:
    """Label and distinct words of each template."""
    return [(label, tuple(dict.fromkeys(template_words(text)))) for label, text in templates]


def strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def phrase_starts(found: Column, phrase: str) -> Column:
    """Word numbers at which the phrase's words stand one after another."""
    parts = phrase.split()
    last = F.size(found) - len(parts)

    def here(i):
        hit = found[i] == parts[0]
        for k, part in enumerate(parts[1:], 1):
            hit = hit & (found[i + k] == part)
        return hit

    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), here)).otherwise(F.array().cast("array<int>"))


def base_places(docs: DataFrame) -> DataFrame:
    """doc_id, row key, number of words, and the places of the base phrases."""
    lower = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), lowered(F.col("text")).alias("lower"))
    split = lower.select("doc_id", "row_key", words(F.col("lower")).alias("words"), F.col("lower").contains("license").alias("may"))
    none = F.array().cast("array<int>")
    return split.select(
        "doc_id",
        "row_key",
        F.size("words").cast("long").alias("n_words"),
        *[F.when(F.col("may"), phrase_starts(F.col("words"), p)).otherwise(none).alias(label) for label, p in PHRASES],
    )


def text_blocks(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """One row for each line: row key, line number, the line and its distinct words of the vocabulary."""
    lines = docs.select(F.xxhash64("doc_id", "text").alias("row_key"), F.posexplode(F.split(lowered(F.col("text")), "\n")).alias("block", "line"))
    return lines.select("row_key", "block", "line", F.array_intersect(F.split("line", BETWEEN), strings(vocabulary)).alias("held"))


def stretches_that_match(lines: DataFrame) -> DataFrame:
    """row_key, block, template, label, containment of lines of which a stretch matches.

    lines: row_key, block, template, label, length, need, size, ranks, and spots (place and rank of its words of the vocabulary). Each word
    lies in the stretch that begins at or before it and in the one before that.
    """
    own = F.filter("spots", lambda s: F.array_contains(F.col("ranks"), s["rank"]))
    spots = lines.select("row_key", "block", "template", "label", "length", "need", "size", F.explode(own).alias("spot"))
    stretch = F.floor(F.col("spot.place") / F.col("length"))
    placed = spots.select("*", F.explode(F.array(stretch, stretch - 1)).alias("stretch")).where("stretch >= 0")
    each = placed.groupBy("row_key", "block", "template", "label", "need", "size", "stretch").agg(F.size(F.collect_set("spot.rank")).alias("n"))
    most = each.where("n >= need").groupBy("row_key", "block", "template", "label", "size").agg(F.max("n").alias("n"))
    return most.select("row_key", "block", "template", "label", (F.col("n") / F.col("size")).alias("containment"))


def break_blocks(docs: DataFrame, span: int, firsts: list[str]) -> DataFrame:
    """One row for each line break between words, in texts with one of the first words: row key, number, span words before and after.

    Lines without words are skipped: a run of them is one break.
    """
    lower = docs.select(F.xxhash64("doc_id", "text").alias("row_key"), lowered(F.col("text")).alias("lower")).where(F.col("lower").contains("\n"))
    marked = F.filter(F.split(F.regexp_replace("lower", r"\n[\x00-\x2F\x3A-\x60\x7B-\x7F]*", f" {BREAK} "), BETWEEN_MARKED), lambda w: w != "")
    cut = lower.select("row_key", marked.alias("marked")).where(F.arrays_overlap("marked", strings(firsts)))
    places = F.filter(F.sequence(F.lit(1), F.size("marked")), lambda i: F.col("marked")[i - 1] == BREAK)

    def sides(i):
        # Marks never stand side by side, so twice the span holds enough words.
        before = F.filter(F.slice("marked", F.greatest(i - 2 * span, F.lit(1)), F.least(i - 1, F.lit(2 * span))), lambda w: w != BREAK)
        after = F.filter(F.slice("marked", i + 1, F.lit(2 * span)), lambda w: w != BREAK)
        return F.struct(F.reverse(F.slice(F.reverse(before), 1, span)).alias("before"), F.slice(after, 1, span).alias("after"))

    return cut.select("row_key", F.posexplode(F.transform(places, sides)).alias("block", "sides")).select("row_key", "block", "sides.before", "sides.after")


def matching_blocks(docs: DataFrame, threshold: float = THRESHOLD, templates=TEMPLATES) -> DataFrame:
    """row_key, block, label and containment of each template in each block that reaches the threshold.

    The result has one row for each distinct (row key, block, template); rows that repeat share a key. Blocks at line breaks have negative
    numbers. They match only by words of both sides, at most the template's length from each; neighbouring ones are one.
    """
    sets = template_sets(templates)
    vocabulary = sorted({w for _, ws in sets for w in ws})
    blocks = text_blocks(docs, vocabulary)
    counted = blocks.select(F.explode("held").alias("word")).groupBy("word").count()
    counts = dict(counted.collect())  # at most one row for each word of the templates
    order = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    lengths = [len(template_words(text)) for _, text in templates]
    index, firsts = [], set()
    for number, (label, ws) in enumerate(sets):
        ranks = sorted(rank[w] for w in ws)
        need = math.ceil(threshold * len(ranks) - 1e-9)
        for at, r in enumerate(ranks[: len(ranks) - need + 1]):
            index.append((r, number, label, at, len(ranks), need, ranks, lengths[number]))
            firsts.add(order[r])
    spark = docs.sparkSession
    wanted = spark.createDataFrame(index, "rank int, template int, label string, at int, size int, need int, ranks array<int>, length int")

    def ranks_of(found):
        return F.transform(found, lambda w: F.array_position(strings(order), w).cast("int") - 1)

    def candidates(held):
        probes = held.select("*", F.posexplode("held").alias("place", "rank"))
        n = F.size("held")
        left = F.least(F.col("size") - 1 - F.col("at"), n - 1 - F.col("place"))
        return probes.join(F.broadcast(wanted), "rank").where((n >= F.col("need")) & (F.least("at", "place") + 1 + left >= F.col("need")))

    ordered = F.filter(ranks_of(F.col("held")), lambda r: r >= 0)
    line_words = F.filter(F.split("line", BETWEEN), lambda w: w != "")
    spots = F.filter(F.transform(line_words, lambda w, i: F.struct(i.alias("place"), (F.array_position(strings(order), w).cast("int") - 1).alias("rank"))), lambda s: s["rank"] >= 0)
    probed = blocks.where(F.arrays_overlap("held", strings(sorted(firsts))))
    held = probed.select("row_key", "block", F.array_sort(ordered).alias("held"), spots.alias("spots"))
    shared = F.size(F.array_intersect("held", "ranks"))
    met = candidates(held).where(shared >= F.col("need")).withColumn("containment", shared / F.col("size"))
    # A line that one stretch holds is the block itself.
    short = F.element_at("spots", -1)["place"] < 2 * F.col("length")
    verified = met.where(short).select("row_key", "block", "template", "label", "containment").unionByName(stretches_that_match(met.where(~short)))
    in_lines = verified.dropDuplicates(["row_key", "block", "template"])

    both = break_blocks(docs, max(lengths), sorted(firsts)).where(F.arrays_overlap(F.concat("before", "after"), strings(sorted(firsts))))
    sides = both.select("row_key", "block", ranks_of(F.col("before")).alias("before"), ranks_of(F.col("after")).alias("after"))
    held = sides.withColumn("held", F.array_sort(F.filter(F.array_distinct(F.concat("before", "after")), lambda r: r >= 0)))
    before = F.slice("before", F.greatest(F.size("before") - F.col("length") + 1, F.lit(1)), F.col("length"))
    after = F.slice("after", F.lit(1), F.col("length"))
    n_before, n_after, n_both = (F.size(F.array_intersect("ranks", side)) for side in (before, after, F.concat(before, after)))
    spanning = candidates(held).where((n_both >= F.col("need")) & (n_before < F.col("need")) & (n_after < F.col("need")))
    runs = spanning.groupBy("row_key", "template", "label").agg(F.collect_set("block").alias("at"), F.max(n_both / F.col("size")).alias("containment"))
    starts = F.filter("at", lambda b: ~F.array_contains("at", b - 1))
    over_breaks = runs.select("row_key", F.explode(starts).alias("block"), "template", "label", "containment")
    return in_lines.unionByName(over_breaks.withColumn("block", -1 - F.col("block")))


def scan_licenses(docs: DataFrame, threshold: float = THRESHOLD, templates=TEMPLATES) -> DataFrame:
    """Licence labels of every row of docs (doc_id, text; other columns are ignored).

    n_base counts the base phrases; labels joins theirs with those of matching blocks; score is the best containment, 1 with
    a base phrase, 0 without any match. A null text is empty: no words, no labels. Rows that repeat stay rows with the same result.
    """
    base = base_places(docs)
    method = matching_blocks(docs, threshold, templates).groupBy("row_key").agg(
        F.collect_set("label").alias("found"), F.max("containment").alias("containment"), F.count(F.lit(1)).alias("n_blocks")
    )
    labels = [label for label, _ in PHRASES]
    places = F.concat(*labels)
    base_labels = F.array_compact(F.array(*[F.when(F.size(c) > 0, F.lit(c)) for c in labels]))
    found = F.coalesce("found", F.array().cast("array<string>"))
    return base.join(method, "row_key", "left").select(
        "doc_id",
        "n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, found)), ",").alias("labels"),
        F.when(F.size(places) > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
        F.coalesce("n_blocks", F.lit(0)).cast("long").alias("n_blocks"),
    )


def scan_sql(threshold: float = THRESHOLD, templates=TEMPLATES) -> str:
    """scan_licenses() of the table documents by comparing every stretch of lines and every line break with every template."""
    sets = [(k, label, ws, len(template_words(text))) for k, ((label, ws), (_, text)) in enumerate(zip(template_sets(templates), templates, strict=True))]
    quoted = ",".join(f"({k},'{label}',[{','.join(repr(w) for w in ws)}],{length},{math.ceil(threshold * len(ws) - 1e-9)})" for k, label, ws, length in sets)
    lower, between = f"translate(coalesce(text,''),'{UPPER}','{LOWER}')", r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    cut = "list_filter(regexp_split_to_array({}, '" + between + "'), lambda w: w<>'')"
    starts = []
    for label, phrase in PHRASES:
        parts = phrase.split()
        test = " AND ".join(f"ws[i+{k}]='{p}'" for k, p in enumerate(parts))
        starts.append(f"list_filter(range(1, len(ws)-{len(parts) - 2}), lambda i: {test}) AS p_{label}")
    has = ",".join(f"CASE WHEN len(p_{label})>0 THEN '{label}' END" for label, _ in PHRASES)
    places = "||".join(f"p_{label}" for label, _ in PHRASES)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS k, doc_id, {lower} AS low FROM documents),
words AS (SELECT k, doc_id, {cut.format("low")} AS ws FROM docs),
base AS (SELECT k, doc_id, len(ws) AS n_words, {", ".join(starts)} FROM words),
placed AS (SELECT k, doc_id, n_words, {places} AS ps, list_filter([{has}], lambda x: x IS NOT NULL) AS bl FROM base),
lines AS (SELECT k, b, {cut.format("line")} AS line FROM (SELECT k, unnest(string_split(low, chr(10))) AS line, generate_subscripts(string_split(low, chr(10)), 1) AS b FROM docs)),
templates(t, label, tw, length, need) AS (VALUES {quoted}),
whole AS (SELECT k, t, label, line, tw, length, need FROM lines JOIN templates ON len(list_intersect(line, tw)) >= need),
stretched AS (SELECT k, t, label, need, len(tw) AS size, list_max(list_transform(range(0, len(line), length), lambda i: len(list_intersect(line[i+1:i+2*length], tw)))) AS m FROM whole),
in_lines AS (SELECT k, t, label, m / size AS c FROM stretched WHERE m >= need),
breaks AS (SELECT k, row_number() OVER (PARTITION BY k ORDER BY b) AS nr, sum(len(line)) OVER (PARTITION BY k ORDER BY b)::BIGINT AS upto FROM lines WHERE len(line) > 0),
sides AS (SELECT k, nr, t, label, tw, need, ws[greatest(upto-length+1, 1):upto] AS x, ws[upto+1:upto+length] AS y
 FROM breaks JOIN words USING (k) JOIN templates ON list_has_any(ws[greatest(upto-length+1, 1):upto+length], tw)),
spanning AS (SELECT k, nr, t, label, len(list_intersect(x || y, tw)) / len(tw) AS c FROM sides
 WHERE len(list_intersect(x || y, tw)) >= need AND len(list_intersect(x, tw)) < need AND len(list_intersect(y, tw)) < need),
headed AS (SELECT *, nr - 1 IS DISTINCT FROM lag(nr) OVER (PARTITION BY k, t ORDER BY nr) AS head FROM spanning),
hits AS (SELECT k, label, c, 1 AS one FROM in_lines UNION ALL SELECT k, label, c, head::INT FROM headed),
found AS (SELECT k, list(DISTINCT label) AS ls, max(c) AS c, sum(one) AS n FROM hits GROUP BY k)
SELECT doc_id, n_words::BIGINT AS n_words, len(ps)::BIGINT AS n_base, (list_min(ps)-1)::BIGINT AS first_word, (list_max(ps)-1)::BIGINT AS last_word,
 coalesce(array_to_string(list_sort(bl), ','), '') AS base_labels, coalesce(array_to_string(list_sort(list_distinct(bl || coalesce(ls, []))), ','), '') AS labels,
 CASE WHEN len(ps)>0 THEN 1.0::DOUBLE ELSE coalesce(c, 0)::DOUBLE END AS score, coalesce(n, 0)::BIGINT AS n_blocks
FROM placed LEFT JOIN found USING (k)"""
