"""Drift of a table's numbers against a reference, with bins and distances that come from the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import running_totals
from millrace.operators.quantiles import quantiles
from millrace.operators.relational import attach


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns]
    return df.select(F.inline(F.array(*cells)))


def quantile_edges(reference: DataFrame, columns: Sequence[str], bins: int) -> DataFrame:
    """(feature, edges): the values that cut the reference into bins of about equal size, each once, rising."""
    probs = [i / bins for i in range(1, bins)]
    found = quantiles(_long(reference, columns), ["feature"], "value", probs, interpolate=False)
    return found.groupBy("feature").agg(F.array_sort(F.collect_set("quantile")).alias("edges"))


def psi_part(n_ref: Column, t_ref: Column, n_cur: Column, t_cur: Column, floor: float) -> Column:
    """What a bin adds to the population stability index; shares are kept above `floor`, so that empty bins count."""
    p, q = F.greatest(n_ref / t_ref, F.lit(floor)), F.greatest(n_cur / t_cur, F.lit(floor))
    return (q - p) * F.log(q / p)


def numeric_drift(reference: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = 10, floor: float = 1e-6) -> DataFrame:
    """(feature, bin, low, n_ref, n_cur, psi_part) with bins from quantiles of the reference.

    A value lies in the bin of the last edge below it: bin 0 holds all up to the first edge, and low is the edge below a bin. Nulls are
    a bin of their own, -1. Bins that no side fills are left out; a column without a value in the reference has one bin beside that of nulls.
    """
    sides = _long(reference, columns).withColumn("_cur", F.lit(0)).unionByName(_long(current, columns).withColumn("_cur", F.lit(1)))
    # Values collapse to counts before they meet the edges.
    counts = sides.groupBy("feature", "value").agg(F.sum(1 - F.col("_cur")).alias("n_ref"), F.sum("_cur").alias("n_cur"))
    edges = F.coalesce("edges", F.array().cast("array<double>"))
    below = F.filter(edges, lambda e: e < F.col("value"))
    placed = counts.join(quantile_edges(reference, columns, bins), "feature", "left").select(
        "feature", "n_ref", "n_cur", F.when(F.col("value").isNull(), -1).otherwise(F.size(below)).alias("bin"), F.array_max(below).alias("low")
    )
    binned = placed.groupBy("feature", "bin").agg(F.max("low").alias("low"), F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    totals = binned.groupBy("feature").agg(F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"))
    part = psi_part(*[F.col(c) for c in ("n_ref", "t_ref", "n_cur", "t_cur")], floor)
    return binned.join(totals, "feature").select("feature", "bin", "low", "n_ref", "n_cur", part.alias("psi_part"))


def ks_distance(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, n_ref, n_cur, distance, at): the largest gap between the shares of rows up to a value, and the least value where it is.

    Both sides' values merge into one order of distinct values with counts, whose running totals are cut into even parts.
    """
    sides = _long(reference, columns).withColumn("_cur", F.lit(0)).unionByName(_long(current, columns).withColumn("_cur", F.lit(1)))
    counts = sides.where("value is not null").groupBy("feature", "value").agg(F.sum(1 - F.col("_cur")).alias("r"), F.sum("_cur").alias("c"))
    upto = running_totals(counts, ["feature"], ["value"], {"upto_r": F.col("r"), "upto_c": F.col("c")})
    totals = counts.groupBy("feature").agg(F.sum("r").alias("n_ref"), F.sum("c").alias("n_cur"))
    gap = F.abs(F.try_divide("upto_r", "n_ref") - F.try_divide("upto_c", "n_cur"))
    both = attach(upto, totals, ["feature"]).withColumn("gap", F.round(gap, 12))
    return both.groupBy("feature").agg(
        F.max("n_ref").alias("n_ref"), F.max("n_cur").alias("n_cur"), F.max("gap").alias("distance"), F.max_by("value", F.struct("gap", -F.col("value"))).alias("at")
    )
