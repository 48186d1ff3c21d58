"""Measures of predictions as relations, for tables of any size.

Rows collapse to distinct scores with counts; curves are running totals over these, cut into even parts, so that
neither a frequent score nor a group with most of the rows has to fit a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import running_totals
from millrace.operators.relational import attach


def score_counts(pred: DataFrame, by: Sequence[str], score: str, label: str) -> DataFrame:
    """(by, score, pos, neg): rows of label 1 and others at each score. Rows without a score or label take no part."""
    rows = pred.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    hit = (F.col(label) == 1).cast("long")
    return rows.groupBy(*by, F.col(score).alias("score")).agg(F.sum(hit).alias("pos"), F.sum(1 - hit).alias("neg"))


def roc_curve(pred: DataFrame, by: Sequence[str], score: str, label: str) -> DataFrame:
    """(by, score, pos, neg, tp, fp): rows of each kind at a score, and at that score or above it."""
    counts = score_counts(pred, by, score, label).withColumn("_down", -F.col("score"))
    return running_totals(counts, by, ["_down"], {"tp": F.col("pos"), "fp": F.col("neg")}).drop("_down")


def ranking_metrics(pred: DataFrame, by: Sequence[str], score: str, label: str) -> DataFrame:
    """(by, n, positives, auc, average_precision): ties count half; null where a group has one kind of rows only.

    The area counts pairs exactly, in whole numbers.
    """
    curve = roc_curve(pred, by, score, label)
    # A negative is beaten by all positives above its score and half of those at it.
    twice = F.sum((F.col("neg") * (2 * F.col("tp") - F.col("pos"))).cast("decimal(38,0)"))
    pos, neg = F.sum("pos"), F.sum("neg")
    precision = F.sum(F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp"))))
    sums = curve.groupBy(*by).agg(twice.alias("twice"), pos.alias("positives"), neg.alias("negatives"), precision.alias("weighted"))
    pairs = F.col("positives").cast("double") * F.col("negatives")
    return sums.select(
        *by,
        (F.col("positives") + F.col("negatives")).alias("n"),
        "positives",
        F.try_divide(F.col("twice").cast("double"), 2 * pairs).alias("auc"),
        F.try_divide("weighted", "positives").alias("average_precision"),
    )


def threshold_metrics(pred: DataFrame, by: Sequence[str], score: str, label: str, threshold: float = 0.5, floor: float = 1e-15) -> DataFrame:
    """(by, accuracy, precision, recall, f1, log_loss, brier) of scores that are probabilities; 1 is predicted from the threshold on."""
    counts = score_counts(pred, by, score, label)
    p = F.least(F.greatest(F.col("score").cast("double"), F.lit(floor)), F.lit(1 - floor))
    above = F.col("score") >= threshold
    count = lambda condition, column: F.sum(F.when(condition, F.col(column)).otherwise(0))
    sums = counts.groupBy(*by).agg(
        count(above, "pos").alias("tp"), count(above, "neg").alias("fp"), count(~above, "pos").alias("fn"), count(~above, "neg").alias("tn"),
        (-F.sum(F.col("pos") * F.log(p) + F.col("neg") * F.log(1 - p))).alias("loss"),
        F.sum(F.col("pos") * F.pow(1 - F.col("score"), 2) + F.col("neg") * F.pow(F.col("score"), 2)).alias("square"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    return sums.select(
        *by, (tp + tn).alias("hits"), ((tp + tn) / n).alias("accuracy"), F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, tp + fn).alias("recall"), F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1"),
        (F.col("loss") / n).alias("log_loss"), (F.col("square") / n).alias("brier"),
    )


def binary_metrics(pred: DataFrame, by: Sequence[str], score: str, label: str, threshold: float = 0.5) -> DataFrame:
    """All of ranking_metrics and threshold_metrics, one row a group; without `by` one row."""
    keyed = pred if by else pred.withColumn("_all", F.lit(0))
    keys = list(by) or ["_all"]
    both = attach(ranking_metrics(keyed, keys, score, label), threshold_metrics(keyed, keys, score, label, threshold), keys)
    return both if by else both.drop("_all")


def regression_metrics(pred: DataFrame, by: Sequence[str], value: str, label: str) -> DataFrame:
    """(by, n, rmse, mae, bias, r2). The mean of the labels is subtracted before they are squared."""
    rows = pred.where(F.col(value).isNotNull() & F.col(label).isNotNull())
    rows = rows if by else rows.withColumn("_all", F.lit(0))
    keys = list(by) or ["_all"]
    means = rows.groupBy(*keys).agg(F.avg(label).alias("_mean"))
    error, apart = F.col(label) - F.col(value), F.col(label) - F.col("_mean")
    out = attach(rows, means, keys).groupBy(*keys).agg(
        F.count("*").alias("n"), F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"), F.avg(-error).alias("bias"),
        (1 - F.try_divide(F.sum(error * error), F.sum(apart * apart))).alias("r2"),
    )
    return out if by else out.drop("_all")


def class_metrics(pred: DataFrame, label: str, prediction: str) -> DataFrame:
    """(n, accuracy, macro_f1, weighted_f1, kappa) of predicted classes, from the confusion table; rows without a label take no part."""
    cells = pred.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("l"), F.col(prediction).alias("p")).agg(F.count("*").alias("n"))
    sides = cells.select(
        F.inline(F.array(F.struct(F.col("l").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"), F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0).alias("hits")),
                         F.struct(F.col("p").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"), F.lit(0).cast("long").alias("hits"))))
    )
    sums = sides.where("class is not null").groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    f1 = F.coalesce(F.try_divide(2 * F.col("hits"), F.col("support") + F.col("predicted")), F.lit(0.0))
    n, hits = F.sum("support"), F.sum("hits")
    chance = F.sum(F.col("support").cast("double") * F.col("predicted")) / (n.cast("double") * n)
    real = F.col("support") > 0
    return sums.agg(
        n.alias("n"), (hits / n).alias("accuracy"), F.avg(F.when(real, f1)).alias("macro_f1"), (F.sum(f1 * F.col("support")) / n).alias("weighted_f1"),
        F.try_divide(hits / n - chance, 1 - chance).alias("kappa"),
    )


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, as sums of them depend on the order of rows in their last digits."""
    cells: list[Column] = [F.round(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes]
    return df.select(*cells)
