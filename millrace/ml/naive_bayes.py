"""Multinomial naive Bayes as relations: counts, logarithms and a join.

The model is a table with one row per term, its counts in the classes that have it, and a table with one row per class. Logarithms are whole
numbers of billionths, so that sums, and with them predictions, do not depend on the order of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import settle

UNIT = 1_000_000_000  # a logarithm of 1
WORDS = "[a-z]+"


def units(value: Column) -> Column:
    """The logarithm in billionths."""
    return F.rint(F.log(value) * UNIT).cast("long")


def term_counts(docs: DataFrame, keys: Sequence[str], text: str, pattern: str = WORDS) -> DataFrame:
    """(keys, term, tf) of lower-cased texts."""
    terms = docs.select(*keys, F.explode(F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))).alias("term"))
    return terms.groupBy(*keys, "term").agg(F.count("*").alias("tf"))


@dataclass(frozen=True)
class NaiveBayes:
    """terms: (term, weights: array of (label, weight above that of an unseen term)); classes: (label, n_docs, prior, unseen)."""

    terms: DataFrame
    classes: DataFrame


def fit(docs: DataFrame, label: str, text: str, smoothing: int = 1, pattern: str = WORDS) -> NaiveBayes:
    """Counts of terms by class with additive smoothing. Rows with a null label or text take no part.

    Words are counted by (class, term) before they are shuffled, so that a frequent word or a class with most of the rows is no hot key.
    """
    known = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(F.col(label).alias("label"), F.col(text).alias("text"))
    words = known.select("label", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(pattern), F.lit(0))).alias("term"))
    counts = settle(words.groupBy("label", "term").agg(F.count("*").alias("n")), "bayes-counts")
    sizes = known.groupBy("label").agg(F.count("*").alias("n_docs"))
    totals = counts.groupBy("label").agg(F.sum("n").alias("n_words"))
    vocabulary = counts.agg(F.count_distinct("term")).scalar()
    all_docs = sizes.agg(F.sum("n_docs")).scalar()
    classes = sizes.join(totals, "label", "left").select(
        "label",
        "n_docs",
        (units(F.col("n_docs")) - units(all_docs)).alias("prior"),
        (units(F.lit(smoothing)) - units(F.coalesce("n_words", F.lit(0)) + smoothing * vocabulary)).alias("unseen"),
    )
    weight = units((F.col("n") + smoothing) / F.lit(float(smoothing)))
    terms = counts.groupBy("term").agg(F.collect_list(F.struct("label", weight.alias("weight"))).alias("weights"))
    return NaiveBayes(settle(terms, "bayes-terms"), settle(classes, "bayes-classes"))


def scores(tf: DataFrame, keys: Sequence[str], model: NaiveBayes) -> DataFrame:
    """(keys, label, score) of every text and class, from term_counts(); terms that no class has are left out.

    A text without a known term has no row. The score is the logarithm of the class's share and of the words in it, in billionths.
    """
    known = tf.join(model.terms, "term")
    one = F.struct(F.lit(None).cast(model.classes.schema["label"].dataType).alias("label"), F.lit(0).cast("long").alias("weight"))
    parts = known.select(*keys, "tf", F.explode(F.concat("weights", F.array(one))).alias("w"))
    # The row without a class counts all known words of the text, whatever class they are in.
    sums = parts.groupBy(*keys, F.col("w.label").alias("label")).agg(F.sum(F.col("tf") * F.col("w.weight")).alias("above"), F.sum("tf").alias("n"))
    per_text = sums.groupBy(*keys).agg(
        F.max(F.when(F.col("label").isNull(), F.col("n"))).alias("n"),
        F.collect_list(F.when(F.col("label").isNotNull(), F.struct("label", "above"))).alias("found"),
    )
    every = model.classes.agg(F.collect_list(F.struct("label", "prior", "unseen"))).scalar()
    listed = per_text.select(*keys, "n", F.map_from_entries("found").alias("found"), F.explode(every).alias("c"))
    above = F.coalesce(F.col("found")[F.col("c.label")], F.lit(0))
    return listed.select(*keys, F.col("c.label").alias("label"), (F.col("c.prior") + F.col("n") * F.col("c.unseen") + above).alias("score"))


def predict(docs: DataFrame, keys: Sequence[str], text: str, model: NaiveBayes, pattern: str = WORDS) -> DataFrame:
    """(keys, predicted, margin): the class with the highest score, ties to the smaller label, and its lead over the next one in billionths.

    `keys` name a row; rows that share them are one text. A text without a known term gets the most frequent class and no margin.
    """
    scored = scores(term_counts(docs, keys, text, pattern), keys, model)
    best = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("loss"), "label")))
    ranked = scored.groupBy(*keys).agg(best.alias("ranked"))
    leader = model.classes.agg(F.min_by("label", F.struct((-F.col("n_docs")).alias("a"), "label"))).scalar()
    second, first = F.get("ranked", F.lit(1)), F.get("ranked", F.lit(0))
    found = ranked.select(*[F.col(k).alias(f"_{k}") for k in keys], first["label"].alias("predicted"), (second["loss"] - first["loss"]).alias("margin"))
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_{k}"))
    asked = docs.select(*keys).distinct()
    return asked.join(found, match, "left").select(*keys, F.coalesce("predicted", leader).alias("predicted"), "margin")


def word_contributions(tf: DataFrame, keys: Sequence[str], predicted: DataFrame, model: NaiveBayes, top: int) -> DataFrame:
    """(keys, predicted, place, term, tf, contribution): the words of each text that speak most for the predicted class, in billionths.

    A word's contribution is what it adds to the predicted class's score, times the number of classes, less what it adds to all classes' scores.
    """
    classes = model.classes.agg(F.count("*").alias("n"), F.sum("unseen").alias("unseen")).select(F.struct("n", "unseen")).scalar()
    own = F.aggregate(F.filter("weights", lambda w: w["label"] == F.col("predicted")), F.lit(0).cast("long"), lambda s, w: s + w["weight"])
    every = F.aggregate("weights", F.lit(0).cast("long"), lambda s, w: s + w["weight"])
    named = predicted.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("predicted"))
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_{k}"))
    unseen = model.classes.select(F.col("label").alias("predicted"), "unseen")
    rows = tf.join(model.terms, "term").join(named, match).join(unseen, "predicted")
    share = classes["n"] * (own + F.col("unseen")) - every - classes["unseen"]
    scored = rows.select(*keys, "predicted", "term", "tf", (F.col("tf") * share).alias("contribution"))
    # The best words of a text are found by sorting numbers, not texts; a text's words are a part of it and fit a task.
    listed = F.array_sort(F.collect_list(F.struct((-F.col("contribution")).alias("loss"), "term", "tf")))
    best = scored.groupBy(*keys, "predicted").agg(F.slice(listed, 1, top).alias("best"))
    out = best.select(*keys, "predicted", F.posexplode("best").alias("place", "b"))
    return out.select(*keys, "predicted", (F.col("place") + 1).alias("place"), "b.term", "b.tf", (-F.col("b.loss")).alias("contribution"))
