"""Clusters of whole-number vectors by Lloyd rounds, the same in every run and partitioning.

All numbers of clusters are tried side by side: a row is placed among the centres of each, and one aggregate per round adds up all of
them, in each task before the shuffle. Centres are whole numbers too, so distances are exact and ties go to the lower cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import settle


def whole_vectors(df: DataFrame, key: str, columns: Sequence[str], steps: int) -> DataFrame:
    """(key, x): whole-number columns moved to 0 to `steps` by their range, rounded down; null where a column is."""
    ranges = df.agg(*[F.struct(F.min(c).cast("long").alias("low"), F.max(c).cast("long").alias("high")).alias(c) for c in columns])
    bounds = ranges.select(F.struct(*columns)).scalar()

    def scaled(c: str) -> Column:
        low, high = bounds[c]["low"], bounds[c]["high"]
        return F.call_function("div", (F.col(c).cast("long") - low) * steps, F.greatest(high - low, F.lit(1)))

    cells = [scaled(c) for c in columns]
    present = F.lit(True)
    for c in columns:
        present = present & F.col(c).isNotNull()
    return df.select(key, F.when(present, F.array(*cells)).alias("x"))


def squared(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda p, q: (p - q) * (p - q)), F.lit(0).cast("long"), lambda s, v: s + v)


def starts(rows: DataFrame, key: str, ks: Sequence[int]) -> DataFrame:
    """(k, number, at): the first rows by a hash of their key as starting centres, the same ones for every k."""
    first = rows.orderBy(F.md5(F.col(key).cast("string")), key).limit(max(ks)).agg(F.array_sort(F.collect_list(F.struct(F.md5(F.col(key).cast("string")), F.col(key), F.col("x")))).alias("f"))
    listed = first.select(F.posexplode(F.col("f")).alias("number", "s")).select("number", F.col("s.x").alias("at"))
    return listed.select(F.explode(F.array(*[F.lit(k) for k in ks])).alias("k"), "number", "at").where("number < k")


def _centres(centres: DataFrame) -> Column:
    """All centres as one array, as many as there are clusters over all k."""
    return centres.agg(F.collect_list(F.struct("k", "number", "at"))).scalar()


def distances(rows: DataFrame, key: str, centres: DataFrame, ks: Sequence[int]) -> DataFrame:
    """(key, x, k, number, own, other): the nearest centre of each k, its squared distance and that of the next nearest one."""
    far = rows.select(key, "x", _centres(centres).alias("_c")).select(
        key, "x", F.transform("_c", lambda c: F.struct(squared(F.col("x"), c["at"]).alias("d"), c["number"].alias("number"), c["k"].alias("k"))).alias("_d")
    )

    def ranked(k: int) -> Column:
        return F.struct(F.lit(k).alias("k"), F.array_sort(F.filter("_d", lambda d: d["k"] == k)).alias("r"))

    placed = far.select(key, "x", F.inline(F.array(*[ranked(k) for k in ks])))
    return placed.select(key, "x", "k", F.col("r")[0]["number"].alias("number"), F.col("r")[0]["d"].alias("own"), F.get("r", F.lit(1))["d"].alias("other"))


def lloyd(rows: DataFrame, key: str, ks: Sequence[int], rounds: int) -> DataFrame:
    """(k, number, at) after some rounds. rows: key and x, vectors of one length of whole numbers; rows without x take no part.

    A centre is the mean of its rows, rounded down in each component; a cluster without rows keeps its centre.
    """
    rows = settle(rows.where("x is not null").select(key, "x"), "lloyd-rows")
    centres = settle(starts(rows, key, ks), "lloyd-centres")
    width = rows.agg(F.max(F.size("x")).alias("w")).first()["w"] or 0
    for _ in range(rounds):
        sums = distances(rows, key, centres, ks).groupBy("k", "number").agg(F.count("*").alias("n"), *[F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(width)])
        means = sums.select("k", "number", F.array(*[F.floor(F.col(f"s{i}") / F.col("n")) for i in range(width)]).alias("mean"))
        moved = centres.join(means, ["k", "number"], "left").select("k", "number", F.coalesce("mean", "at").alias("at"))
        centres = settle(moved, "lloyd-centres")
    return centres


def cluster_moments(rows: DataFrame, key: str, centres: DataFrame, ks: Sequence[int]) -> DataFrame:
    """(k, n, cost, silhouette, largest) of each k, in one pass over the rows.

    cost: sum of squared distances to the centres. silhouette: mean over the rows of (b - a) / max(a, b), where a and b are the distances to the
    nearest centre and the next one; 0 for a row at both. largest: rows of the largest cluster.
    """
    placed = distances(rows.where("x is not null"), key, centres, ks)
    a, b = F.sqrt("own"), F.sqrt("other")
    lead = F.when(F.col("other") > 0, (b - a) / b).otherwise(0.0)
    per_cluster = placed.groupBy("k", "number").agg(F.count("*").alias("n"), F.sum("own").alias("cost"), F.sum(lead).alias("lead"))
    return per_cluster.groupBy("k").agg(
        F.sum("n").alias("n"), F.sum("cost").alias("cost"), (F.sum("lead") / F.sum("n")).alias("silhouette"), F.max("n").alias("largest")
    )


def far_rows(rows: DataFrame, key: str, centres: DataFrame, k: int, deviations: float) -> DataFrame:
    """(key, number, distance) of rows whose distance to their centre is above their cluster's mean by so many standard deviations."""
    placed = distances(rows.where("x is not null"), key, centres.where(F.col("k") == k), [k]).select(key, "number", F.sqrt("own").alias("distance"))
    usual = placed.groupBy("number").agg(F.avg("distance").alias("_m"), F.stddev_samp("distance").alias("_s"))
    return placed.join(usual, "number").where(F.col("distance") > F.col("_m") + deviations * F.col("_s")).select(key, "number", "distance")


def lloyd_sql(rows: str, key: str, ks: Sequence[int], rounds: int) -> str:
    """The same as common table expressions for DuckDB, unrolled: `rows` names a relation (key, x); c0 to c<rounds> are the centres, p the last placing."""
    wanted = "[" + ", ".join(map(str, ks)) + "]"
    parts = [
        f"""f AS (SELECT row_number() OVER (ORDER BY md5(CAST({key} AS VARCHAR)), {key}) - 1 AS number, x FROM {rows} ORDER BY 1 LIMIT {max(ks)}),
        c0 AS (SELECT k, CAST(number AS INTEGER) AS number, x AS mid FROM f, (SELECT CAST(unnest({wanted}) AS INTEGER) AS k) WHERE number < k)"""
    ]

    def placed(name: str, centres: str) -> str:
        return f"""{name}_d AS (SELECT {key}, x, k, number, CAST(list_sum(list_transform(list_zip(x, mid), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
            FROM {rows}, {centres}),
        {name} AS (SELECT *, row_number() OVER (PARTITION BY {key}, k ORDER BY d, number) AS r, lead(d) OVER (PARTITION BY {key}, k ORDER BY d, number) AS other FROM {name}_d
            QUALIFY r = 1)"""

    for i in range(rounds):
        parts.append(placed(f"p{i}", f"c{i}"))
        parts.append(
            f"""u{i} AS (SELECT k, number, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS m FROM p{i}, (SELECT unnest(range(1, (SELECT max(len(x)) FROM {rows}) + 1)) AS i) GROUP BY ALL),
        m{i} AS (SELECT k, number, list(m ORDER BY i) AS mid FROM u{i} GROUP BY ALL),
        c{i + 1} AS (SELECT k, number, coalesce(m.mid, c.mid) AS mid FROM c{i} c LEFT JOIN m{i} m USING (k, number))"""
        )
    parts.append(placed("p", f"c{rounds}"))
    return ",\n        ".join(parts)
