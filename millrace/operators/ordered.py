"""Ranks, neighbours and running values inside groups of any size.

A plain window sends a whole group to one task. Here the rows are range-partitioned
by the group and the full order within it, so a group, or a single order value,
with a third of all rows is cut into many parts of about equal size. The parts
are numbered and written once to the shared folder: the cut comes from sampled
bounds and must be the same for every later use. Windows then work per (keys,
part), and what earlier parts contribute comes from a table with one row per (keys, part).
Keys and part are one value, so that the exchange of the rows for their windows also serves the join with that table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import settle

PART = "_part"
GROUP = "_group"


def in_parts(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """df with a part number that never decreases along the order of a group.

    `order` should be unique within a group; equal rows cannot be cut apart.
    """
    ranged = df.repartitionByRange(*[F.col(k).asc() for k in keys], *order)
    return settle(ranged.withColumn(PART, F.spark_partition_id()), "parts")


def grouped(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """rows of in_parts with part and keys as one value, GROUP, which is never null and in which null keys match each other.

    The part comes first, as numbers are compared faster than keys.
    """
    return rows.withColumn(GROUP, F.struct(PART, *keys))


def _group(keys: Sequence[str]):
    """All parts of a group: as many rows as the group has parts."""
    return Window.partitionBy(*[F.col(GROUP)[k] for k in keys])


def _along(keys: Sequence[str]):
    return _group(keys).orderBy(F.col(GROUP)[PART])


def _before(keys: Sequence[str]):
    """The parts of a group before this one."""
    return _along(keys).rowsBetween(Window.unboundedPreceding, -1)


def rank_within(
    df: DataFrame, keys: Sequence[str], by: str, tie: Sequence[str], tiles: int = 4, descending: bool = True
) -> DataFrame:
    """Add row_number, rank, dense_rank and ntile per group, ordered by one column.

    `tie` makes row_number and ntile definite; rank and dense_rank look at `by` only.
    """
    leading = F.desc(by) if descending else F.asc(by)
    order = [leading, *[F.asc(t) for t in tie]]
    rows = grouped(in_parts(df, keys, order), keys)
    in_order, by_value = Window.partitionBy(GROUP).orderBy(*order), Window.partitionBy(GROUP).orderBy(leading)
    local = rows.select(
        "*",
        F.row_number().over(in_order).alias("_rn"),
        F.rank().over(by_value).alias("_rk"),
        F.dense_rank().over(by_value).alias("_dr"),
    )
    # Values with counts say all of a part; a file of the written table holds one part, so they collapse before the shuffle.
    values = rows.groupBy(GROUP, F.struct(by).alias("_value")).agg(F.count("*").alias("_c"))
    least, most = (F.max, F.min) if descending else (F.min, F.max)
    of_last = F.min_by("_c", "_value") if descending else F.max_by("_c", "_value")
    parts = values.groupBy(GROUP).agg(
        F.sum("_c").alias("_n"),
        F.count("*").alias("_d"),
        (F.sum("_c") - of_last + 1).alias("_last_rk"),
        least("_value").alias("_first"),
        most("_value").alias("_last"),
    )
    # A value may run over several parts. `_joins` says that a part goes on with
    # the value the part before it ended with.
    parts = parts.select(
        "*",
        F.coalesce(F.sum("_n").over(_before(keys)), F.lit(0)).alias("_ahead"),
        F.coalesce(F.sum("_d").over(_before(keys)), F.lit(0)).alias("_d_ahead"),
        F.sum("_n").over(_group(keys)).alias("_total"),
        F.coalesce(F.col("_first").eqNullSafe(F.lag("_last").over(_along(keys))), F.lit(False)).alias("_joins"),
    )
    # The rank of the value a part ends with, where that value begins in the part.
    begun = F.when((F.col("_d") > 1) | ~F.col("_joins"), F.col("_ahead") + F.col("_last_rk"))
    parts = parts.select(
        GROUP,
        "_ahead",
        "_total",
        "_joins",
        F.last(begun, ignorenulls=True).over(_before(keys)).alias("_carried"),
        (F.col("_d_ahead") - F.sum(F.col("_joins").cast("int")).over(_along(keys))).alias("_d_before"),
    )
    numbered = local.join(parts, GROUP).withColumn("row_number", F.col("_rn") + F.col("_ahead"))
    small, longer = F.expr(f"_total div {tiles}"), F.col("_total") % tiles
    in_longer = longer * (small + 1)
    position = F.col("row_number") - 1
    tile = F.when(position < in_longer, F.floor(position / (small + 1))).otherwise(
        longer + F.floor((position - in_longer) / F.greatest(small, F.lit(1)))
    )
    carried_on = F.col("_joins") & (F.col("_dr") == 1)
    return numbered.select(
        *df.columns,
        "row_number",
        F.when(carried_on, F.col("_carried")).otherwise(F.col("_rk") + F.col("_ahead")).alias("rank"),
        (F.col("_dr") + F.col("_d_before")).alias("dense_rank"),
        (tile + 1).cast("int").alias("ntile"),
    )


def lag_delta(df: DataFrame, keys: Sequence[str], order: str, tie: str, value: str) -> DataFrame:
    """Add the previous and next value of a group, the change and the seconds since the previous row."""
    rows = grouped(in_parts(df, keys, [F.asc(order), F.asc(tie)]), keys)
    cell = F.struct(F.col(order).alias("t"), F.col(value).alias("v"))
    ends = rows.groupBy(GROUP).agg(
        F.min_by(cell, F.struct(order, tie)).alias("_first"), F.max_by(cell, F.struct(order, tie)).alias("_last")
    )
    carry, ahead = F.lag("_last").over(_along(keys)), F.lead("_first").over(_along(keys))
    ends = ends.select(GROUP, carry.alias("_carry"), ahead.alias("_ahead"))
    w = Window.partitionBy(GROUP).orderBy(order, tie)
    both = rows.select("*", F.lag(cell).over(w).alias("_prev"), F.lead(cell).over(w).alias("_next")).join(ends, GROUP)
    prev, following = F.coalesce("_prev", "_carry"), F.coalesce("_next", "_ahead")
    micros = F.unix_micros(F.col(order).cast("timestamp")) - F.unix_micros(prev["t"].cast("timestamp"))
    return both.select(
        *df.columns,
        prev["v"].alias("prev_value"),
        following["v"].alias("next_value"),
        (F.col(value) - prev["v"]).alias("delta"),
        (micros / 1_000_000).alias("gap_seconds"),
    )


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """Add the sum of each value over a group's rows up to this one, nulls counting as nothing."""
    columns = {f"_v_{name}": value for name, value in values.items()}
    valued = df.select("*", *[v.alias(c) for c, v in columns.items()])
    rows = grouped(in_parts(valued, keys, [F.asc(o) for o in order]), keys)
    sums = rows.groupBy(GROUP).agg(*[F.sum(c).alias(c) for c in columns])
    sums = sums.select(GROUP, *[F.coalesce(F.sum(c).over(_before(keys)), F.lit(0)).alias(f"_b{c}") for c in columns])
    w = Window.partitionBy(GROUP).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.select("*", *[F.sum(c).over(w).alias(f"_l{c}") for c in columns])
    totals = [(F.coalesce(f"_l_v_{n}", F.lit(0)) + F.col(f"_b_v_{n}")).alias(n) for n in values]
    return local.join(sums, GROUP).select(*df.columns, *totals)


def over_last_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    first: int,
    last: int,
    aggregates: Mapping[str, Column],
    chunk: int = 100_000,
) -> DataFrame:
    """Add aggregates over the rows `first` to `last` before this one (0 is this row).

    For the mean of the last five rows say first=4, last=0. Groups are numbered
    and cut into chunks of equal size, which overlap by the frame.
    """
    if not 0 <= last <= first < chunk:
        raise ValueError("need 0 <= last <= first < chunk")
    numbered = running_totals(df, keys, order, {"_at": F.lit(1).cast("long")})
    position = F.col("_at") - 1
    home = F.floor(position / chunk)
    # Rows near the end of a chunk also go to the next one, as its run-up.
    also = F.when(position % chunk >= chunk - first, F.array(home, home + 1)).otherwise(F.array(home))
    spread = numbered.select("*", home.alias("_home"), F.explode(also).alias("_chunk"))
    w = Window.partitionBy(*keys, "_chunk").orderBy("_at").rowsBetween(-first, -last)
    framed = spread.select("*", *[a.over(w).alias(name) for name, a in aggregates.items()])
    return framed.where("_chunk = _home").select(*df.columns, *aggregates)


def over_last_span(
    df: DataFrame, keys: Sequence[str], order: str, row_id: str, seconds: int, sums: Mapping[str, Column]
) -> DataFrame:
    """Add sums over a group's rows of the last `seconds` up to and including this row's time.

    A sum over a span is the difference of two running totals. Each row asks
    for the total just before its span and the one after all rows of its time, so
    no span has to fit a task. `row_id` is unique; give exact types (decimal or
    long), since a difference of doubles loses digits.
    """
    at = F.unix_micros(F.col(order).cast("timestamp"))
    nothing = {n: F.lit(None) for n in sums}

    def entry(time: Column, kind: int, row: Column, values: Mapping[str, Column]) -> Column:
        cells = [values[n].cast(types[n]).alias(f"_s_{n}") for n in sums]
        return F.struct(time.alias("_at"), F.lit(kind).alias("_kind"), row.alias("_row"), *cells)

    types = {f.name: f.dataType for f in df.select(*[v.alias(n) for n, v in sums.items()]).schema.fields}
    row = F.struct(*df.columns)
    empty = F.lit(None).cast(df.select(row.alias("r")).schema["r"].dataType)
    entries = F.array(
        entry(at - seconds * 1_000_000, 0, empty, nothing), entry(at, 1, empty, sums), entry(at, 2, row, nothing)
    )
    asked = df.select(*keys, F.col(row_id).alias("_id"), F.inline(entries))
    totals = running_totals(asked, keys, ["_at", "_kind", "_id"], {n: F.col(f"_s_{n}") for n in sums})
    sign = F.when(F.col("_kind") == 2, 1).when(F.col("_kind") == 0, -1)
    differences = [F.sum(sign * F.col(n)).cast(types[n]).alias(n) for n in sums]
    answered = totals.where("_kind <> 1").groupBy("_id").agg(F.first("_row", ignorenulls=True).alias("_row"), *differences)
    return answered.select("_row.*", *sums)
