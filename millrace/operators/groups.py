"""Python over groups: one small model per key, and a map-reduce over Python functions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from millrace.operators.relational import attach

LANES = 16  # tasks over which partial values of one key are dealt


def per_group_model(df: DataFrame, key: str, features: Sequence[str], target: str) -> DataFrame:
    """Least squares per key: (key, n, intercept, one coefficient per feature).

    A group may hold any share of the rows, so it is never brought together:
    Spark sums the products about the group's means, and Python sees one row of
    sums per key, in Arrow batches, to solve its small system.
    """
    names = [*features, target]
    means = df.groupBy(key).agg(F.count("*").alias("n"), *[F.avg(c).alias(f"_m_{c}") for c in names])
    centred = attach(df.select(key, *names), means.drop("n"), [key]).select(key, *[(F.col(c) - F.col(f"_m_{c}")).alias(c) for c in names])
    products = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    sums = centred.groupBy(key).agg(*[F.sum(F.col(a) * F.col(b)).alias(f"_s_{a}_{b}") for a, b in products])
    table = attach(means, sums, [key])
    fields = ", ".join(f"`{c}` double" for c in ("intercept", *features))
    key_type = df.schema[key].dataType.simpleString()
    features, n_features = list(features), len(features)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            def column(a, b):
                return batch[f"_s_{a}_{b}" if f"_s_{a}_{b}" in batch else f"_s_{b}_{a}"].to_numpy(float)

            left = np.empty((len(batch), n_features, n_features))
            right = np.empty((len(batch), n_features))
            for i, a in enumerate(features):
                right[:, i] = column(a, target)
                for j, b in enumerate(features):
                    left[:, i, j] = column(a, b)
            slopes = np.einsum("gij,gj->gi", np.linalg.pinv(left), right)
            centre = batch[[f"_m_{c}" for c in features]].to_numpy(float)
            out = batch[[key, "n"]].copy()
            out["intercept"] = batch[f"_m_{target}"].to_numpy(float) - (slopes * centre).sum(axis=1)
            for i, c in enumerate(features):
                out[c] = slopes[:, i]
            yield out

    return table.mapInPandas(solve, f"`{key}` {key_type}, n long, {fields}")


def mapreduce(
    lines: DataFrame, mapper: Callable[[str], Iterable[tuple]], reducer: Callable = add, schema: str = "key string, value long"
) -> DataFrame:
    """Map each line to (key, value) pairs and reduce the values of a key with an associative, commutative function.

    For functions that no expression can say. Lines come in Arrow batches, of which each is combined
    on its own. Partial values are then combined per (key, lane), with lanes dealt at random, and the
    few lanes of a key at last, so that a frequent key is spread over tasks; groups pass in batches too.
    """
    text, (key, value) = lines.columns[0], _parse_ddl(schema)

    def combined(pairs: Iterable[tuple]) -> dict:
        found: dict = {}
        for k, v in pairs:
            found[k] = reducer(found[k], v) if k in found else v
        return found

    def mapped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = combined(pair for line in batch[text] for pair in mapper(line))
            yield pd.DataFrame({key: pd.Series(list(found), dtype=object), value: pd.Series(list(found.values()), dtype=object)})

    def reduced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows of a key stand together; only the last key of a batch may go on in the next."""
        last: list = []
        for batch in batches:
            found = combined([*last, *zip(batch[key], batch[value])])
            last = [found.popitem()] if found else []
            yield pd.DataFrame({key: pd.Series(list(found), dtype=object), value: pd.Series(list(found.values()), dtype=object)})
        yield pd.DataFrame(last, columns=[key, value], dtype=object)

    partial = lines.select(text).mapInPandas(mapped, schema).withColumn("_lane", F.floor(F.rand(31) * LANES))
    for keys in ([key, "_lane"], [key]):
        dealt = partial.repartition(*keys).sortWithinPartitions(key).select(key, value)
        partial = dealt.mapInPandas(reduced, schema).withColumn("_lane", F.lit(0))
    return partial.select(key, value)


def _parse_ddl(schema: str) -> list[str]:
    return S.StructType.fromDDL(schema).names
