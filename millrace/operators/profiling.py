"""Describing and checking tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from millrace.operators.quantiles import quantiles_of
from millrace.session import settle


def profile(df: DataFrame) -> DataFrame:
    """One row per column: counts, nulls, distinct values, range, mean, deviation, quartiles, top value.

    All columns go through one count of distinct (column, value) pairs, where
    copies collapse before the shuffle; everything else reads those counts.
    """
    cells = []
    for f in df.schema.fields:
        number = isinstance(f.dataType, S.NumericType)
        text = F.col(f.name).cast("string")
        num = F.col(f.name).cast("double") if number else F.lit(None).cast("double")
        cells.append(F.struct(F.lit(f.name).alias("column"), F.lit(number).alias("numeric"), text.alias("text"), num.alias("num")))
    long = df.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    counts = long.groupBy("column", "numeric", "text", "num").agg(F.count("*").alias("n"))
    counts = settle(counts.repartitionByRange("column", "num", "text").withColumn("part", F.spark_partition_id()), "profile")
    present = F.col("text").isNotNull()
    plain = ~F.col("numeric")
    stats = counts.groupBy("column").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(present, 0).otherwise(F.col("n"))).alias("n_null"),
        F.count("text").alias("n_distinct"),
        F.min("num").alias("min_num"),
        F.max("num").alias("max_num"),
        F.min(F.when(plain, F.col("text"))).alias("min_text"),
        F.max(F.when(plain, F.col("text"))).alias("max_text"),
        (F.sum(F.col("num") * F.col("n")) / F.sum(F.when(F.col("num").isNotNull(), F.col("n")))).alias("mean"),
        F.max(F.when(present, F.struct("n", "text"))).alias("top"),
    )
    # One row per column of the table: the mean joins back to the counts for the deviation.
    squares = (
        counts.where("num is not null")
        .join(stats.select("column", "mean"), "column")
        .groupBy("column")
        .agg(
            F.sqrt(F.sum(F.col("n") * F.pow(F.col("num") - F.col("mean"), 2)) / F.nullif(F.sum("n") - 1, F.lit(0))).alias("std")
        )
    )
    merged = counts.where("num is not null").groupBy("column", "num", "part").agg(F.sum("n").alias("n"))
    quartiles = quantiles_of(merged, ["column"], "num", (0.25, 0.5, 0.75))
    wide = quartiles.groupBy("column").agg(
        *[F.max(F.when(F.col("p") == p, F.col("quantile"))).alias(name) for p, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))]
    )
    joined = stats.join(squares, "column", "left").join(wide, "column", "left")
    return joined.select(
        "column", "n_rows", "n_null", "n_distinct", "min_num", "max_num", "min_text", "max_text",
        F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"),
        *[F.round(q, 4).alias(q) for q in ("q25", "q50", "q75")],
        F.col("top.text").alias("top"), F.col("top.n").alias("top_count"),
    )


def file_sizes(df: DataFrame) -> DataFrame:
    """(path, length) of the files that a table read from files is made of, from what Spark knows of each file; no data is read for it."""
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length")).groupBy("path").agg(F.max("length").alias("length"))


def five_v(df: DataFrame, ts: str, used: Column, n_bytes: DataFrame | None = None) -> DataFrame:
    """The five V's of a table as (measure, value).

    Volume: rows, and bytes when the sizes of its files are given, as by file_sizes(). Velocity: rows per
    day that has rows. Variety: columns and distinct types. Veracity: share of
    null cells and of repeated rows. Value: share of rows a report uses.
    """
    columns = df.columns
    nulls = sum((F.col(c).isNull().cast("int") for c in columns), F.lit(0))
    whole = df.agg(
        F.count("*").alias("n"),
        F.sum(nulls).alias("nulls"),
        F.sum(used.cast("int")).alias("used"),
    )
    # Repeats and days come from counts that shrink in each task before the shuffle.
    per_row = df.groupBy(F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256).alias("row")).agg(F.count("*").alias("n"))
    repeats = per_row.agg(F.sum(F.col("n") - 1).alias("repeats"))
    days = df.groupBy(F.to_date(ts).alias("day")).agg(F.count("*").alias("n"))
    days = days.agg(F.min("n").alias("day_min"), F.max("n").alias("day_max"), F.count("day").alias("n_days"))

    def measures(frame: DataFrame, **named: Column) -> DataFrame:
        pairs = [F.struct(F.lit(k).alias("measure"), v.cast("double").alias("value")) for k, v in named.items()]
        return frame.select(F.inline(F.array(*pairs)))

    out = measures(
        whole,
        volume_rows=F.col("n"),
        variety_columns=F.lit(len(columns)),
        variety_types=F.lit(len({f.dataType.simpleString() for f in df.schema.fields})),
        veracity_null_share=F.round(F.col("nulls") / (F.col("n") * len(columns)), 6),
        value_used_share=F.round(F.col("used") / F.col("n"), 6),
    )
    out = out.unionByName(measures(repeats, veracity_repeated_rows=F.col("repeats")))
    out = out.unionByName(
        measures(days, velocity_day_min=F.col("day_min"), velocity_day_max=F.col("day_max"), velocity_days=F.col("n_days"))
    )
    if n_bytes is not None:
        out = out.unionByName(measures(n_bytes.agg(F.sum("length").alias("b")), volume_bytes=F.col("b")))
    return out


@dataclass(frozen=True)
class NotNull:
    column: str


@dataclass(frozen=True)
class InRange:
    column: str
    low: float
    high: float


@dataclass(frozen=True)
class Unique:
    columns: Sequence[str]


@dataclass(frozen=True)
class References:
    column: str
    other: DataFrame
    other_column: str


def quality_gate(df: DataFrame, rules: Sequence) -> DataFrame:
    """(rule, n_checked, n_failed, passed), one row per rule.

    Null and range rules share one pass. A uniqueness rule counts the rows
    beyond the first of each key; a reference rule counts non-null orphans.
    """
    cell_rules, frames = [], []
    for rule in rules:
        if isinstance(rule, NotNull):
            cell_rules.append((f"not_null({rule.column})", F.col(rule.column).isNull()))
        elif isinstance(rule, InRange):
            cell_rules.append((f"in_range({rule.column})", ~F.col(rule.column).between(rule.low, rule.high)))
        elif isinstance(rule, Unique):
            keys = df.groupBy(*rule.columns).agg(F.count("*").alias("n"))
            frames.append(
                keys.agg(
                    F.lit(f"unique({','.join(rule.columns)})").alias("rule"),
                    F.coalesce(F.sum("n"), F.lit(0)).alias("n_checked"),
                    F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_failed"),
                )
            )
        elif isinstance(rule, References):
            known = rule.other.select(F.col(rule.other_column).alias("k")).distinct().withColumn("known", F.lit(True))
            used = df.where(F.col(rule.column).isNotNull()).groupBy(F.col(rule.column).alias("k")).agg(F.count("*").alias("n"))
            frames.append(
                used.join(known, "k", "left").agg(
                    F.lit(f"references({rule.column})").alias("rule"),
                    F.coalesce(F.sum("n"), F.lit(0)).alias("n_checked"),
                    F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("n_failed"),
                )
            )
        else:
            raise TypeError(f"unknown rule {rule!r}")
    if cell_rules:
        sums = [F.sum(bad.cast("int")).alias(f"f{i}") for i, (_, bad) in enumerate(cell_rules)]
        wide = df.agg(F.count("*").alias("n"), *sums)
        rows = [
            F.struct(F.lit(name).alias("rule"), F.col("n").alias("n_checked"), F.coalesce(f"f{i}", F.lit(0)).alias("n_failed"))
            for i, (name, _) in enumerate(cell_rules)
        ]
        frames.insert(0, wide.select(F.inline(F.array(*rows))))
    if not frames:
        raise ValueError("no rules given")
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out.withColumn("passed", F.col("n_failed") == 0)
