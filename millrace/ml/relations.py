"""Learning-related results that are plain relations: TF-IDF, anomalies, drift, fairness, segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import over_last_rows
from millrace.operators.quantiles import quantiles
from millrace.operators.relational import attach, cents, total
from millrace.session import settle


def tfidf(docs: DataFrame, key: str, text: str, pattern: str = "[a-z]+") -> DataFrame:
    """(key, term, tf, tfidf) with idf = ln((N + 1) / (df + 1)). Texts are cut into terms once; `key` is unique.

    Whole texts are dealt by key, so their terms are counted where they are cut. The weights of all terms are written before
    they are joined: Spark knows their size then, and moves the counts only if the vocabulary is too large to broadcast.
    """
    found = F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))
    # A null term in every document counts the documents on the way.
    terms = docs.select(key, text).repartition(key).select(key, F.explode(F.concat(F.array(F.lit(None).cast("string")), F.coalesce(found, F.array().cast("array<string>")))).alias("term"))
    tf = settle(terms.groupBy(key, "term").agg(F.count("*").alias("tf")), "tfidf-counts")
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    n_docs = tf.where("term is null").agg(F.count("*")).scalar()
    idf = settle(df.where("term is not null").select("term", F.log((n_docs + 1) / (F.col("df") + 1)).alias("idf")), "tfidf-weights")
    return tf.join(idf, "term").select(key, "term", "tf", (F.col("tf") * F.col("idf")).alias("tfidf"))


def rolling_anomalies(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, rows: int, limit: float
) -> DataFrame:
    """Rows further than `limit` deviations from the mean of the `rows` rows before them.

    A row needs a full history of that length.
    """
    framed = over_last_rows(
        df, keys, order, rows, 1, {"_n": F.count("*"), "_mean": F.avg(value), "_std": F.stddev_samp(value)}
    )
    z = (F.col(value) - F.col("_mean")) / F.nullif(F.col("_std"), F.lit(0.0))
    scored = framed.withColumn("z", z).where((F.col("_n") == rows) & (F.abs("z") > limit))
    return scored.drop("_n", "_mean", "_std")


def iqr_anomalies(df: DataFrame, keys: Sequence[str], value: str, reach: float = 1.5) -> DataFrame:
    """Rows outside the quartile fences of their group; the quartiles are exact."""
    q = quantiles(df, keys, value, (0.25, 0.75))
    wide = q.groupBy(*keys).agg(
        F.max(F.when(F.col("p") == 0.25, F.col("quantile"))).alias("_q1"),
        F.max(F.when(F.col("p") == 0.75, F.col("quantile"))).alias("_q3"),
    )
    spread = reach * (F.col("_q3") - F.col("_q1"))
    fences = wide.select(*keys, (F.col("_q1") - spread).alias("low"), (F.col("_q3") + spread).alias("high"))
    return attach(df, fences, keys).where((F.col(value) < F.col("low")) | (F.col(value) > F.col("high")))


def disparate_impact(pred: DataFrame, group: str, selected: Column, threshold: float = 0.8) -> DataFrame:
    """Selection rate per group, its ratio to the highest rate, and whether the ratio is below the threshold."""
    rates = pred.groupBy(group).agg(F.count("*").alias("n"), F.avg(selected.cast("int")).alias("rate"))
    top = rates.agg(F.max("rate")).scalar()
    ratio = F.try_divide("rate", top)
    return rates.select(
        group, "n", F.round("rate", 6).alias("rate"), F.round(ratio, 6).alias("ratio"), (ratio < threshold).cast("int").alias("flagged")
    )


def drift_report(reference: DataFrame, current: DataFrame, features: dict[str, Column], floor: float = 1e-6) -> DataFrame:
    """(feature, bin, n_ref, n_cur, psi_part): share of each bin in two samples and its part of the
    population stability index. A feature is a column that names the bin of a row; shares are kept
    above `floor`, so that empty bins count."""

    def binned(df: DataFrame, side: int) -> DataFrame:
        cells = [F.struct(F.lit(n).alias("feature"), c.cast("string").alias("bin")) for n, c in features.items()]
        counts = df.select(F.inline(F.array(*cells))).groupBy("feature", "bin").agg(F.count("*").alias("n"))
        zero = F.lit(0).cast("long")
        return counts.select("feature", "bin", (F.col("n") if side == 0 else zero).alias("n_ref"), (F.col("n") if side == 1 else zero).alias("n_cur"))

    both = binned(reference, 0).unionByName(binned(current, 1)).groupBy("feature", "bin")
    bins = both.agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    totals = bins.groupBy("feature").agg(F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"))
    p = F.greatest(F.col("n_ref") / F.col("t_ref"), F.lit(floor))
    q = F.greatest(F.col("n_cur") / F.col("t_cur"), F.lit(floor))
    return bins.join(totals, "feature").select("feature", "bin", "n_ref", "n_cur", ((q - p) * F.log(q / p)).alias("psi_part"))


def rfm(orders: DataFrame) -> DataFrame:
    """Recency in days before the newest order, frequency and money per customer."""
    newest = orders.agg(F.max("o_orderdate")).scalar()
    return orders.groupBy("o_custkey").agg(
        F.datediff(newest, F.max("o_orderdate")).alias("recency"),
        F.count("*").alias("frequency"),
        (total(cents(F.col("o_totalprice"))).cast("double") / 100).alias("money"),
    )
