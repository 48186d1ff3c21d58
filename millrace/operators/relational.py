"""Joins and grouped aggregates of the ETL core.

No join carries a broadcast hint: Spark broadcasts a side when its measured
size is below the session's threshold, and otherwise shuffles both sides and
splits skewed partitions at run time. Facts are summed to the join key first,
so that a key with very many rows shrinks before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exact(value: Column, scale: int = 2) -> Column:
    """Money as a decimal: sums do not depend on the order of rows."""
    return value.cast(f"decimal(18,{scale})")


def cents(value: Column) -> Column:
    """Money as a whole number of cents: much cheaper than a decimal, and its sums are exact too."""
    return F.rint(value * 100).cast("long")


def total(units: Column) -> Column:
    """Sum of whole numbers that cannot overflow."""
    return F.sum(units.cast("decimal(20,0)"))


def net_units(price: str, discount: str) -> Column:
    """Discounted price in units of a hundredth of a cent."""
    return cents(F.col(price)) * (100 - cents(F.col(discount)))


def attach(rows: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join on equal keys in which null keys match each other, with one copy of the keys."""
    renamed = other.withColumnsRenamed({c: f"_r_{c}" for c in on})
    match = F.lit(True)
    for c in on:
        match = match & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return rows.join(renamed, match).drop(*[f"_r_{c}" for c in on])


def filter_rows(lineitem: DataFrame, since: str) -> DataFrame:
    """Typed line items shipped since a day, with the amounts a report needs."""
    return lineitem.where(F.col("l_shipdate") >= F.lit(since).cast("timestamp_ntz")).select(
        "l_orderkey",
        "l_partkey",
        "l_returnflag",
        F.date_format("l_shipdate", "yyyy-MM").alias("month"),
        (net_units("l_extendedprice", "l_discount") / 10_000).alias("net"),
    )


def order_revenue(lineitem: DataFrame) -> DataFrame:
    """Line items summed to their order, in units of net_units."""
    net = net_units("l_extendedprice", "l_discount")
    return lineitem.groupBy("l_orderkey").agg(total(net).alias("revenue"), F.count("*").alias("n_lines"))


def join_star(lineitem, orders, customer, nation, region) -> DataFrame:
    """Revenue by region, nation and order year over the star."""
    dated = orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    by_customer = (
        order_revenue(lineitem)
        .join(dated, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey", "year")
        .agg(F.sum("revenue").alias("revenue"), F.sum("n_lines").alias("n_lines"))
    )
    by_nation = (
        by_customer.join(customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", "year")
        .agg(F.sum("revenue").alias("revenue"), F.sum("n_lines").alias("n_lines"))
    )
    return (
        by_nation.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("r_name", "n_name", "year", (F.col("revenue").cast("double") / 10_000).alias("revenue"), "n_lines")
    )


def enrich_left(df: DataFrame, extra: DataFrame, on: str) -> DataFrame:
    """All rows of df, with nulls where extra has no row for the key."""
    return df.join(extra, on, "left")


def semi_filter(df: DataFrame, allowed: DataFrame, on: str) -> DataFrame:
    """Rows of df whose key is in allowed; a key listed twice does not double a row."""
    return df.join(allowed.select(on), on, "left_semi")


def group_agg(lineitem: DataFrame) -> DataFrame:
    """Sums, means and distinct counts by return flag and line status.

    Lines are summed to their order first, which makes its orders countable: no row is sent twice for the distinct count.
    """
    keys = ["l_returnflag", "l_linestatus"]
    units = {"qty": cents(F.col("l_quantity")), "net": net_units("l_extendedprice", "l_discount"), "price": cents(F.col("l_extendedprice"))}
    orders = lineitem.groupBy(*keys, "l_orderkey").agg(*[F.sum(u).alias(n) for n, u in units.items()], F.count("*").alias("lines"))
    return orders.groupBy(*keys).agg(
        (total(F.col("qty")).cast("double") / 100).alias("sum_qty"),
        (total(F.col("net")).cast("double") / 10_000).alias("sum_net"),
        F.round(total(F.col("price")).cast("double") / 100 / F.sum("lines"), 4).alias("avg_price"),
        F.sum("lines").alias("n_lines"),
        F.count("l_orderkey").alias("n_orders"),
    )


def combined_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts by key. Each task sums its own rows before anything is shuffled."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def top_k(df: DataFrame, by: str, tie: Sequence[str], k: int) -> DataFrame:
    """The k largest rows with a fixed order among equals; each task keeps only k."""
    return df.orderBy(F.desc(by), *tie).limit(k)


def word_count(docs: DataFrame, text: str = "text", pattern: str = "[a-z]+") -> DataFrame:
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


def regular_report(orders, customer, nation, region, month: str | None = None) -> DataFrame:
    """Orders and turnover by month, region and segment with subtotals and a grand total.

    `level` is 0 for detail rows and grows as columns are summed away. Orders
    are summed to (customer, month) before the joins and before the roll-up
    multiplies rows.
    """
    dated = orders.withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    if month is not None:
        start = F.to_timestamp_ntz(F.lit(f"{month}-01"))
        dated = dated.where((F.col("o_orderdate") >= start) & (F.col("o_orderdate") < F.add_months(start, 1)))
    small = dated.groupBy("o_custkey", "month").agg(
        F.count("*").alias("n"), total(cents(F.col("o_totalprice"))).alias("total")
    )
    placed = (
        small.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("month", "c_nationkey", "c_mktsegment")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return (
        placed.rollup("month", F.col("r_name").alias("region"), F.col("c_mktsegment").alias("segment"))
        .agg(
            F.sum("n").alias("n_orders"),
            (F.sum("total").cast("double") / 100).alias("turnover"),
            F.grouping_id().cast("int").alias("level"),
        )
    )
