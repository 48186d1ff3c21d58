"""Ridge regression and its cross-validation from sums of products, in one scan.

The products of a fold are added up once. What a model learns from is the total minus the fold it is tested on, and the
error on that fold follows from the fold's own sums, so that neither folds nor penalties read the rows again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold_sums(rows: DataFrame, fold: Column, features: Sequence[str], target: str) -> DataFrame:
    """(fold, n, products): sums of the products of 1, all features and the target, the upper triangle row by row.

    Whole-number columns are added up exactly. Rows with a null take no part.
    """
    names = [*features, target]
    present = F.lit(True)
    for c in names:
        present = present & F.col(c).isNotNull()
    cells = rows.where(present).select(fold.alias("fold"), *names)
    whole = {f.name: f.dataType.simpleString() in ("tinyint", "smallint", "int", "bigint") for f in cells.schema.fields}
    entries = [F.lit(1), *[F.col(c) for c in names]]
    kinds = [True, *[whole[c] for c in names]]

    def product(i: int, j: int) -> Column:
        if kinds[i] and kinds[j]:
            return F.sum(entries[i].cast("decimal(19,0)") * entries[j].cast("decimal(19,0)")).cast("double")
        return F.sum(entries[i].cast("double") * entries[j].cast("double"))

    pairs = [(i, j) for i in range(len(entries)) for j in range(i, len(entries))]
    sums = cells.groupBy("fold").agg(F.count("*").alias("n"), *[product(i, j).alias(f"p{i}_{j}") for i, j in pairs])
    return sums.select("fold", "n", F.array(*[f"p{i}_{j}" for i, j in pairs]).alias("products"))


def _square(products: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros((len(products), size, size))
    upper = np.triu_indices(size)
    out[:, upper[0], upper[1]] = products
    out[:, upper[1], upper[0]] = products
    return out


def ridge_grid(rows: DataFrame, fold: Column, features: Sequence[str], target: str, penalties: Sequence[float]) -> DataFrame:
    """(fold, penalty, n_train, n_test, mse, intercept, weights) for each fold held out and each penalty.

    Features are centred and scaled by the training rows' deviations, the intercept is not penalised; weights are for the features as given.
    A feature that does not vary in training has weight 0. Folds are few: their sums are as wide as the square of the features.
    """
    per_fold = fold_sums(rows, fold, features, target)
    width = (len(features) + 2) * (len(features) + 3) // 2
    totals = per_fold.agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("products")[i]) for i in range(width)]).alias("products"))
    whole = totals.select(F.struct("n", "products")).scalar()
    asked = per_fold.select("fold", "n", "products", whole["n"].alias("all_n"), whole["products"].alias("all_products"), F.explode(F.array(*[F.lit(float(p)) for p in penalties])).alias("penalty"))
    size = len(features) + 2

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            own, total = (_square(np.stack(batch[c].to_numpy()), size) for c in ("products", "all_products"))
            out = batch[["fold", "penalty"]].copy()
            fits = [fitted(t - o, o, p) for o, t, p in zip(own, total, batch["penalty"])]
            out["n_train"], out["n_test"] = batch["all_n"] - batch["n"], batch["n"]
            out["mse"], out["intercept"], out["weights"] = ([f[i] for f in fits] for i in range(3))
            yield out

    kind = asked.schema["fold"].dataType.simpleString()
    schema = f"fold {kind}, penalty double, n_train long, n_test long, mse double, intercept double, weights array<double>"
    return asked.mapInPandas(solve, schema)


def fitted(train: np.ndarray, test: np.ndarray, penalty: float) -> tuple[float, float, list[float]]:
    """Mean squared error on the test sums, intercept and weights. Sums are of products of 1, features and target."""
    n = train[0, 0]
    if n <= 0:
        return float("nan"), float("nan"), [float("nan")] * (len(train) - 2)
    mean = train[0] / n
    centred = train / n - np.outer(mean, mean)
    spread = np.sqrt(np.maximum(np.diag(centred)[1:-1], 0))
    varied = spread > 1e-12 * np.maximum(1, np.abs(mean[1:-1]))
    safe = np.where(varied, spread, 1)
    left = centred[1:-1, 1:-1] / np.outer(safe, safe)
    left[~varied], left[:, ~varied] = 0, 0
    left[np.diag_indices_from(left)] += penalty + ~varied
    weights = np.where(varied, np.linalg.solve(left, np.where(varied, centred[1:-1, -1] / safe, 0)) / safe, 0)
    intercept = mean[-1] - weights @ mean[1:-1]
    by = np.concatenate([[-intercept], -weights, [1]])
    return float(by @ test @ by / max(test[0, 0], 1)), float(intercept), weights.tolist()


def best_penalty(grid: DataFrame) -> DataFrame:
    """(penalty, mse): the error over all held-out rows of each penalty, the best one first."""
    pooled = grid.groupBy("penalty").agg((F.sum(F.col("mse") * F.col("n_test")) / F.sum("n_test")).alias("mse"))
    return pooled.orderBy("mse", "penalty")
