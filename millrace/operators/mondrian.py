"""Anonymity by cuts that follow the data: groups are halved at medians as long as both halves stay large enough."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.quantiles import quantiles_of, ranged_counts
from millrace.operators.relational import attach
from millrace.session import settle

# Rows of a group that one task cuts to the end; larger groups are cut by all tasks together, round after round.
LOCAL_ROWS = 32_768


def _long(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    cells = [F.struct(F.lit(i).alias("dim"), F.col(c).cast("double").alias("value")) for i, c in enumerate(columns)]
    return rows.select("_group", F.inline(F.array(*cells)))


def best_cuts(rows: DataFrame, whole: Sequence[float], columns: Sequence[str], k: int) -> DataFrame:
    """(_group, dim, cut, n, n_left): for each group that can be cut, its widest column, the median at which it is, its rows and those that go left.

    Columns count by their width in the group over that in the table, whole. Values up to the cut go left. Medians are exact, from distinct values
    with counts in ranges, so that no group has to fit a task.
    """
    counts = ranged_counts(_long(rows, columns), ["_group", "dim"], "value")
    medians = quantiles_of(counts, ["_group", "dim"], "value", [0.5], interpolate=False).select("_group", "dim", F.col("quantile").alias("cut"))
    sides = attach(counts, medians, ["_group", "dim"]).groupBy("_group", "dim").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("value") <= F.col("cut"), F.col("n")).otherwise(0)).alias("n_left"), F.max("cut").alias("cut"),
        (F.max("value") - F.min("value")).alias("width"),
    )
    fair = sides.where((F.col("n_left") >= k) & (F.col("n") - F.col("n_left") >= k))
    share = F.round(F.col("width") / F.greatest(F.get(F.array(*map(F.lit, whole)), F.col("dim")), F.lit(1e-300)), 9)
    found = F.max_by(F.struct("dim", "cut", "n", "n_left"), F.struct(share.alias("w"), -F.col("dim")))
    return fair.groupBy("_group").agg(found.alias("c")).select("_group", "c.*")


def _rounded(share: np.ndarray) -> np.ndarray:
    """Nine decimals, halves up by the digits of the number, as Spark rounds."""
    scaled = share * 1e9
    out = np.floor(scaled + 0.5) / 1e9
    for i in np.flatnonzero(np.abs(scaled - np.floor(scaled) - 0.5) < 1e-4):
        out[i] = float(Decimal(repr(float(share[i]))).quantize(Decimal("1e-9"), ROUND_HALF_UP))
    return out


def cut_paths(values: Sequence[np.ndarray], whole: Sequence[float], k: int, rounds: int | None) -> np.ndarray:
    """The paths of the rows of one group, values being its columns, by the rule of best_cuts. A round cuts all parts of the group together."""
    paths = np.full(len(values[0]), "", dtype=object)
    rows, part = np.arange(len(paths)), np.zeros(len(paths), dtype=np.int64)  # the rows of parts still to be cut, and their part
    while len(rows) and (rounds is None or rounds > 0):
        n = np.bincount(part)
        first = np.cumsum(n) - n
        best, dim_of, cut_of = np.zeros(len(n)), np.full(len(n), -1), np.zeros(len(n))
        for dim, column in enumerate(values):
            held = column[rows]
            held = held[np.lexsort((held, part))]
            cut = held[first + (n - 1) // 2]
            along = np.repeat(cut, n)
            n_left = np.add.reduceat(((held <= along) | np.isnan(along)).astype(np.int64), first)
            with np.errstate(invalid="ignore", over="ignore"):
                share = _rounded((held[first + n - 1] - held[first]) / np.maximum(whole[dim], 1e-300))
            share[np.isnan(share)] = np.inf  # as in Spark, where it is above every number
            better = (n_left >= k) & (n - n_left >= k) & ((dim_of < 0) | (share > best))
            best[better], dim_of[better], cut_of[better] = share[better], dim, cut[better]
        rows, part = rows[dim_of[part] >= 0], part[dim_of[part] >= 0]
        chosen, cut = np.stack([column[rows] for column in values])[dim_of[part], np.arange(len(rows))], cut_of[part]
        right = ~((chosen <= cut) | np.isnan(cut))
        paths[rows] += np.where(right, "1", "0").astype(object)
        part = np.unique(2 * part + right, return_inverse=True)[1]
        rounds = None if rounds is None else rounds - 1
    return paths


def _cut_to_the_end(small: DataFrame, whole: Sequence[float], columns: Sequence[str], k: int, rounds: int | None) -> DataFrame:
    """Groups of a bounded number of rows: each one goes to a task, which makes all cuts that are left."""
    names = [f"_v{i}" for i in range(len(columns))]

    def run(group: pa.Table) -> pa.Table:
        paths = cut_paths([group.column(c).to_numpy() for c in names], whole, k, rounds)
        whole_paths = pa.array(group.column("_group")[0].as_py() + paths, pa.string())
        return group.drop_columns(names).set_column(group.schema.get_field_index("_group"), "_group", whole_paths)

    # The number of tasks is given, since by their few bytes Spark would bring the groups together in one.
    tasks = int(small.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    valued = small.withColumns({n: F.col(c).cast("double") for n, c in zip(names, columns, strict=True)})
    return valued.repartition(tasks, "_group").groupBy("_group").applyInArrow(run, small.schema)


def mondrian(df: DataFrame, columns: Sequence[str], k: int, rounds: int | None = None, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """df with _group, a path of cuts: each group has k rows at least if the table has, and no row is suppressed.

    columns: ordered quasi-identifiers, whole numbers or doubles that are not null; rows with a null in one form groups of their own, which the caller
    may suppress: their _group is null. Every group that can be cut is cut, until no cut leaves k rows on both sides; a caller who wants larger
    groups gives a number of rounds. Groups of more than local_rows rows are cut in rounds by all tasks together; about log2(rows / local_rows)
    rounds suffice. What is smaller goes on in one task each, to the same cuts.
    """
    present = F.lit(True)
    for c in columns:
        present = present & F.col(c).isNotNull()
    rows = settle(df.withColumn("_group", F.when(present, F.lit(""))), "mondrian")
    spans = [(F.max(c).cast("double") - F.min(c).cast("double")).alias(f"_{i}") for i, c in enumerate(columns)]
    total, *whole = rows.where("_group is not null").agg(F.count("*").alias("_n"), *spans).first()
    # Rows in the group that a row is in, null if the group stays as it is.
    rows = rows.withColumn("_size", F.when(F.col("_group").isNotNull(), F.lit(total)))
    value = F.array(*[F.col(c).cast("double") for c in columns])
    large, done = F.col("_size") > local_rows, 0
    while (rounds is None or done < rounds) and not rows.where(large).isEmpty():
        cuts = settle(best_cuts(rows.where(large), whole, columns, k), "mondrian-cuts")
        named = cuts.withColumnRenamed("_group", "_g")
        # Few groups have many rows each, many groups few: Spark broadcasts the cuts in the first case and shuffles in the second.
        cut = rows.join(named, large & (F.col("_group") == F.col("_g")), "left")
        left = F.get(value, F.col("dim")) <= F.col("cut")
        moved = F.when(F.col("cut").isNotNull(), F.concat("_group", F.when(left, "0").otherwise("1"))).otherwise(F.col("_group"))
        size = F.when(F.col("cut").isNotNull(), F.when(left, F.col("n_left")).otherwise(F.col("n") - F.col("n_left"))).when(~large, F.col("_size"))
        rows = settle(cut.select(*df.columns, moved.alias("_group"), size.alias("_size")), "mondrian")
        done += 1
    small = F.coalesce(F.col("_size") <= local_rows, F.lit(False))
    ended = _cut_to_the_end(rows.where(small).drop("_size"), whole, columns, k, None if rounds is None else rounds - done)
    return settle(rows.where(~small).drop("_size").unionByName(ended), "mondrian")


def generalised(grouped: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(_group, n, and low and high of each column): what is published in place of the values of a group's rows."""
    cells = [f(c).alias(f"{c}_{name}") for c in columns for f, name in ((F.min, "low"), (F.max, "high"))]
    return grouped.where("_group is not null").groupBy("_group").agg(F.count("*").alias("n"), *cells)


def mondrian_sql(source: str, columns: Sequence[str], k: int) -> str:
    """Common table expressions for WITH RECURSIVE of DuckDB, a round to each step; the last, `grouped`, has the source's columns and _group."""
    listed = "[" + ", ".join(f"CAST({c} AS DOUBLE)" for c in columns) + "]"
    dims = len(columns)
    parts = [
        f"m0 AS (SELECT *, '' AS _group, true AS _open, {listed} AS _v FROM {source})",
        f"rng AS (SELECT i AS dim, max(_v[i]) - min(_v[i]) AS whole FROM m0, (SELECT unnest(range(1, {dims + 1})) AS i) GROUP BY 1)",
        f"""m AS (SELECT * FROM m0 UNION ALL (WITH o AS (SELECT * FROM m WHERE _open),
        a AS (SELECT _group, i AS dim, count(*) AS n, list(_v[i] ORDER BY _v[i])[(count(*) - 1) // 2 + 1] AS cut, max(_v[i]) - min(_v[i]) AS width
            FROM o, (SELECT unnest(range(1, {dims + 1})) AS i) GROUP BY ALL),
        b AS (SELECT a.*, (SELECT count(*) FROM o WHERE o._group = a._group AND o._v[a.dim] <= a.cut) AS n_left FROM a),
        c AS (SELECT _group, dim, cut FROM b JOIN rng USING (dim) WHERE n_left >= {k} AND n - n_left >= {k}
            QUALIFY row_number() OVER (PARTITION BY _group ORDER BY round(width / greatest(whole, 1e-300), 9) DESC, dim) = 1)
        SELECT o.* REPLACE (CASE WHEN c.cut IS NULL THEN o._group ELSE o._group || CASE WHEN _v[c.dim] <= c.cut THEN '0' ELSE '1' END END AS _group,
            c.cut IS NOT NULL AS _open) FROM o LEFT JOIN c ON c._group = o._group))""",
        "grouped AS (SELECT * EXCLUDE (_open, _v) FROM m WHERE NOT _open)",
    ]
    return ",\n        ".join(parts)
