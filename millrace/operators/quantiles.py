"""Exact quantiles without bringing a group to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.relational import attach
from millrace.session import settle


def ranged_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, value, n, part): distinct values with counts, range-partitioned and numbered.

    Copies collapse before the sort. The table is written once, because the
    partition number comes from sampled bounds and must not change between uses.
    """
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("n"))
    ranged = counts.repartitionByRange(*keys, value).withColumn("part", F.spark_partition_id())
    return settle(ranged, "ranged")


def quantiles_of(counts: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], interpolate: bool = True) -> DataFrame:
    """(keys, p, quantile) from ranged_counts, with linear interpolation or else the value at the position rounded down."""
    counts = counts.where(F.col(value).isNotNull())
    sizes = counts.groupBy(*keys, "part").agg(F.sum("n").alias("size"))
    per_key = Window.partitionBy(*keys)
    earlier = per_key.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *keys,
        "part",
        F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"),
        F.sum("size").over(per_key).alias("total"),
    )
    along = Window.partitionBy(*keys, "part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    placed = attach(counts.withColumn("upto", F.sum("n").over(along)), offsets, [*keys, "part"])
    placed = placed.withColumn("hi", F.col("before") + F.col("upto")).withColumn("lo", F.col("hi") - F.col("n"))
    wanted = placed.select("*", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p"))
    wanted = wanted.withColumn("h", (F.col("total") - 1) * F.col("p"))

    def at(position):
        return F.max(F.when((F.col("lo") <= position) & (position < F.col("hi")), F.col(value)))

    found = wanted.groupBy(*keys, "p").agg(
        at(F.floor("h")).alias("low"), at(F.ceil("h")).alias("high"), F.max(F.col("h") - F.floor("h")).alias("share")
    )
    between = F.col("low") + (F.col("high") - F.col("low")) * F.col("share")
    return found.select(*keys, "p", (between if interpolate else F.col("low")).alias("quantile"))


def quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], interpolate: bool = True) -> DataFrame:
    return quantiles_of(ranged_counts(df.where(F.col(value).isNotNull()), keys, value), keys, value, probs, interpolate)
