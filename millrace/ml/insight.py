"""Explaining models and documenting models and data."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Model, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.ml import models


def feature_names(pred: DataFrame, features: str = "features") -> list[str]:
    """Names of the slots of a feature vector, from its metadata; scaling keeps the order but not the names."""
    attrs = pred.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    slots = {a["idx"]: a.get("name", str(a["idx"])) for kind in attrs.values() for a in kind}
    return [slots[i] for i in sorted(slots)]


def weights(model: PipelineModel, names: Sequence[str]) -> DataFrame:
    """(feature, weight): coefficients of a linear model or importances of a tree model."""
    last = model.stages[-1]
    values = last.coefficients if hasattr(last, "coefficients") else last.featureImportances
    rows = [(n, float(v)) for n, v in zip(names, values.toArray(), strict=True)]
    if not rows:
        raise ValueError("no feature names")
    return SparkSession.active().createDataFrame(rows, "feature string, weight double")


def contributions(pred: DataFrame, model: Model, key: str) -> DataFrame:
    """(key, slot, contribution, margin): what each feature adds to a linear margin.

    The contributions of a row and the intercept add up to its margin. Slots that are zero are left out.
    """
    coefficients = F.array(*[F.lit(float(c)) for c in model.coefficients.toArray()])
    arrays = pred.select(key, vector_to_array("features").alias("x"), F.get(vector_to_array("rawPrediction"), 1).alias("margin"))
    parts = arrays.select(key, "margin", F.posexplode(F.zip_with("x", coefficients, lambda x, w: x * w)).alias("slot", "contribution"))
    return parts.where("contribution <> 0")


SLICE = 1024  # vectors that a task unpacks at a time


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, slot, value) of the stored slots of (key, vector), in slices and without a Python object for each slot."""
    for batch in batches:
        for at in range(0, len(batch), SLICE):
            keys, vectors = batch.slice(at, SLICE).columns
            kinds, _, indices, values = vectors.flatten()
            sizes = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False).astype("i8")
            stored = values.flatten().to_numpy(zero_copy_only=False)
            slots = np.arange(len(stored)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            # Dense vectors have no indices.
            sparse = pc.fill_null(pc.equal(kinds, 0), False).to_numpy(zero_copy_only=False)
            slots[np.repeat(sparse, sizes)] = indices.flatten().to_numpy(zero_copy_only=False)
            kept = np.flatnonzero(stored != 0)
            owners = keys.take(pa.array(np.repeat(np.arange(len(keys)), sizes)[kept]))
            yield pa.RecordBatch.from_arrays([owners, pa.array(slots[kept].astype("i4")), pa.array(stored[kept])], names=["key", "slot", "value"])


def sparse_slots(df: DataFrame, key: str, features: str) -> DataFrame:
    """(key, slot, value) of the slots that a vector column stores, whatever its width: sparse vectors stay sparse."""
    found = df.select(key, features).mapInArrow(_slots, f"key {df.schema[key].dataType.simpleString()}, slot int, value double")
    return found.withColumnRenamed("key", key)


def class_weights(model: Model) -> tuple[DataFrame, DataFrame]:
    """(class, slot, weight) of the weights that are not 0, and (class, intercept), of a linear classifier of any number of classes."""
    spark = SparkSession.active()
    matrix, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    if len(matrix) == 1:  # two classes share one row: the margin of class 1 and its opposite
        matrix, intercepts = np.stack([-matrix[0], matrix[0]]), np.array([-intercepts[0], intercepts[0]])
    classes, slots = np.nonzero(matrix)
    cells = pd.DataFrame({"class": classes.astype("i4"), "slot": slots.astype("i4"), "weight": matrix[classes, slots]})
    heads = pd.DataFrame({"class": np.arange(len(matrix), dtype="i4"), "intercept": intercepts.astype(float)})
    return spark.createDataFrame(cells, "class int, slot int, weight double"), spark.createDataFrame(heads, "class int, intercept double")


def class_contributions(pred: DataFrame, model: Model, key: str, features: str = "features") -> DataFrame:
    """(key, class, slot, value, contribution): what each stored slot adds to the margin of each class.

    For sparse and wide vectors and any number of classes: slots are rows that meet the weights in a join.
    """
    weights, _ = class_weights(model)
    parts = sparse_slots(pred, key, features).join(weights, "slot")
    return parts.select(key, "class", "slot", "value", (F.col("value") * F.col("weight")).alias("contribution"))


def explained_margins(pred: DataFrame, model: Model, key: str, features: str = "features") -> DataFrame:
    """(key, class, explained, margin): contributions and intercept added up, beside the margin that the model gives."""
    _, intercepts = class_weights(model)
    sums = class_contributions(pred, model, key, features).groupBy(key, "class").agg(F.sum("contribution").alias("s"))
    margins = pred.select(key, F.posexplode(vector_to_array("rawPrediction")).alias("class", "margin"))
    both = margins.join(intercepts, "class").join(sums, [key, "class"], "left")
    return both.select(key, "class", (F.coalesce("s", F.lit(0.0)) + F.col("intercept")).alias("explained"), "margin")


def permuted(df: DataFrame, key: str, column: str, buckets: int) -> DataFrame:
    """df with one column's values moved between rows.

    Rows are dealt into hash buckets of bounded size, and each takes the value of
    the next row in hash order, the last one that of the first.
    """
    order = F.xxhash64(F.col(key), F.lit(column))
    dealt = df.withColumn("_h", order).withColumn("_b", F.pmod(F.xxhash64("_h"), F.lit(buckets)))
    w = Window.partitionBy("_b").orderBy("_h", key)
    following = F.coalesce(F.lead(column).over(w), F.first(column).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return dealt.withColumn(column, following).drop("_h", "_b")


def permutation_importance(
    model: PipelineModel, df: DataFrame, key: str, columns: Sequence[str], score: Callable[[DataFrame], float], buckets: int
) -> DataFrame:
    """(column, drop): how much the score falls when a column's values are moved between rows.

    The caller says how many buckets the rows are dealt into, so that equal rows move equally in every run.
    """
    with models.kept(df):
        base = score(model.transform(df))
        rows = [(c, float(base - score(model.transform(permuted(df, key, c, buckets))))) for c in columns]
    return df.sparkSession.createDataFrame(rows, "column string, drop double")


def data_card(df: DataFrame, name: str, label: str | None = None) -> DataFrame:
    """Facts on a table as (name, section, item, n): rows, nulls of each column with its type, and rows of each label value.

    A relation of any size: nothing is collected, however many label values there are.
    """
    counted = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    facts = [("rows", "all", F.col("_rows"))]
    facts += [("nulls", f"{f.name} {f.dataType.simpleString()}", F.col(f.name)) for f in df.schema.fields]
    cells = [F.struct(F.lit(section).alias("section"), F.lit(item).alias("item"), n.alias("n")) for section, item, n in facts]
    card = counted.select(F.inline(F.array(*cells)))
    if label is not None:
        balance = df.groupBy(F.col(label).cast("string").alias("item")).agg(F.count("*").alias("n"))
        card = card.unionByName(balance.select(F.lit("label_balance").alias("section"), "item", "n"))
    return card.select(F.lit(name).alias("name"), "section", "item", "n")


def model_card(
    pred: DataFrame, name: str, intended_use: str, limits: str, label: str, group: str, train_rows: int
) -> DataFrame:
    """A model documented as (name, section, item, n, value, text): purpose, limits, rows, metrics, and metrics per group.

    `n` counts rows, `value` holds a metric. Groups are rows of the card and never collected.
    """
    metrics = models.classification_metrics(pred, label)
    chance = "better than chance" if metrics.get("auc", 0.0) > 0.6 else "no better than chance"
    head = [("purpose", "intended use", None, None, intended_use), ("purpose", "limits", None, None, limits)]
    head += [("rows", "train", train_rows, None, None), ("metrics", "verdict", None, None, chance)]
    head += [("metrics", k, None, round(v, 4), None) for k, v in metrics.items()]
    card = pred.sparkSession.createDataFrame(head, "section string, item string, n long, value double, text string")
    hits = F.avg((F.col(label) == F.col("prediction")).cast("int"))
    by_group = pred.groupBy(F.col(group).cast("string").alias("item")).agg(
        F.count("*").alias("n"), hits.alias("accuracy"), F.avg("prediction").alias("selection_rate")
    )
    missing = F.lit(None).cast("string")
    measures = [
        F.struct(F.lit(f"group {m}").alias("section"), F.col("item"), F.col("n"), F.round(m, 4).alias("value"), missing.alias("text"))
        for m in ("accuracy", "selection_rate")
    ]
    tested = pred.agg(F.lit("rows").alias("section"), F.lit("test").alias("item"), F.count("*").alias("n"), F.lit(None).cast("double").alias("value"), missing.alias("text"))
    return card.unionByName(tested).unionByName(by_group.select(F.inline(F.array(*measures)))).select(F.lit(name).alias("name"), "*")
