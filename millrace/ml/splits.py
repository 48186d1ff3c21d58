"""Exact best splits of ordered features, as a decision tree would choose them, from class counts in running totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ordered import running_totals
from millrace.operators.relational import attach


def value_counts(rows: DataFrame, features: Sequence[str], label: str, classes: Sequence, by: Sequence[str] = ()) -> DataFrame:
    """(by, feature, value, n0, n1, ...): rows of each class at each value of each feature, as doubles; nulls take no part."""
    cells = [F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]
    long = rows.where(F.col(label).isin(list(classes))).select(*by, F.col(label).alias("_label"), F.inline(F.array(*cells))).where("value is not null")
    return long.groupBy(*by, "feature", "value").agg(*[F.count_if(F.col("_label") == c).alias(f"n{i}") for i, c in enumerate(classes)])


def gini(counts: Sequence[Column]) -> Column:
    """Impurity of class counts."""
    n = sum(counts[1:], counts[0])
    return 1 - F.try_divide(sum((c * c for c in counts[1:]), counts[0] * counts[0]).cast("double"), (n * n).cast("double"))


def split_gains(rows: DataFrame, features: Sequence[str], label: str, classes: Sequence, by: Sequence[str] = ()) -> DataFrame:
    """(by, feature, value, n_left, n_right, gain) of every possible split: rows up to a value go left.

    gain: the fall of the Gini impurity, with sides weighted by their rows. Copies of a value collapse first and the values of a feature are
    cut into even parts, so that neither a frequent value nor a feature has to fit a task. A feature's last value splits nothing.
    """
    counts = value_counts(rows, features, label, classes, by)
    keys, names = [*by, "feature"], [f"n{i}" for i in range(len(classes))]
    left = running_totals(counts, keys, ["value"], {f"l{i}": F.col(n) for i, n in enumerate(names)})
    totals = counts.groupBy(*keys).agg(*[F.sum(n).alias(f"t{i}") for i, n in enumerate(names)])
    both = attach(left, totals, keys)
    on_left = [F.col(f"l{i}") for i in range(len(classes))]
    on_right = [F.col(f"t{i}") - F.col(f"l{i}") for i in range(len(classes))]
    whole = [F.col(f"t{i}") for i in range(len(classes))]
    n_left, n_right = sum(on_left[1:], on_left[0]), sum(on_right[1:], on_right[0])
    n = n_left + n_right
    gain = gini(whole) - (n_left * gini(on_left) + n_right * gini(on_right)) / n
    return both.select(*keys, "value", n_left.alias("n_left"), n_right.alias("n_right"), F.when(n_right > 0, gain).alias("gain")).where("n_right > 0")


def best_splits(rows: DataFrame, features: Sequence[str], label: str, classes: Sequence, by: Sequence[str] = (), digits: int = 12) -> DataFrame:
    """(by, feature, value, n_left, n_right, gain, place): the best split of each feature, and its place among the features.

    Gains are compared by so many digits; ties go to the smaller value, then to the feature's name. A feature of one value has no split.
    """
    gains = split_gains(rows, features, label, classes, by).withColumn("gain", F.round("gain", digits))
    best = gains.groupBy(*by, "feature").agg(F.max_by(F.struct("value", "n_left", "n_right", "gain"), F.struct("gain", -F.col("value"))).alias("b"))
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("b.gain"), "feature"))
    return best.select(*by, "feature", "b.*", place.alias("place"))
