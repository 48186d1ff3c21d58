"""Split windows against plain windows, with a group that holds most rows, ties and null keys."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators import ordered
from millrace.operators.quantiles import quantiles
from millrace.session import setting


@pytest.fixture(scope="module")
def rows(spark):
    key = F.when(F.col("id") % 3 != 0, "hot").when(F.col("id") % 33 == 0, None).otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string")))
    seconds = (F.xxhash64("id") % 900_000).cast("long")
    at = F.timestamp_seconds(F.lit(1_700_000_000) + seconds)
    value = F.when(F.col("id") % 50 == 0, None).otherwise(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(40)).cast("double"))
    return spark.range(3000).select(
        "id", key.alias("k"), at.alias("t"), value.alias("v"), F.coalesce(value, F.lit(-1.0)).alias("w")
    )


@pytest.fixture(autouse=True)
def many_parts(spark):
    """Small inputs are otherwise merged to one part at run time."""
    with setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        yield


def same(left, right):
    order = sorted(left.columns)
    a = sorted(map(repr, left.select(*order).collect()))
    assert a == sorted(map(repr, right.select(*order).collect()))


def test_ranks(rows):
    got = ordered.rank_within(rows, ["k"], "w", ["id"], 7)
    by, tie = W.partitionBy("k").orderBy(F.desc("w")), W.partitionBy("k").orderBy(F.desc("w"), "id")
    want = rows.select("*", F.row_number().over(tie).cast("long").alias("row_number"), F.rank().over(by).cast("long").alias("rank"), F.dense_rank().over(by).cast("long").alias("dense_rank"), F.ntile(7).over(tie).alias("ntile"))
    same(got, want)


def test_ranks_ascending_with_few_rows(rows):
    few = rows.where("id < 40")
    got = ordered.rank_within(few, ["k"], "w", ["id"], 9, descending=False)
    w = W.partitionBy("k").orderBy("w", "id")
    same(got.select("id", "ntile", "row_number"), few.select("id", F.ntile(9).over(w).alias("ntile"), F.row_number().over(w).cast("long").alias("row_number")))


def test_neighbours(rows):
    got = ordered.lag_delta(rows, ["k"], "t", "id", "v")
    w = W.partitionBy("k").orderBy("t", "id")
    want = rows.select("id", F.lag("v").over(w).alias("prev_value"), F.lead("v").over(w).alias("next_value"))
    same(got.select("id", "prev_value", "next_value"), want)


def test_running_total(rows):
    got = ordered.running_totals(rows, ["k"], ["t", "id"], {"s": F.col("v")})
    w = W.partitionBy("k").orderBy("t", "id").rowsBetween(W.unboundedPreceding, 0)
    same(got.select("id", "s"), rows.select("id", F.coalesce(F.sum("v").over(w), F.lit(0.0)).alias("s")))


@pytest.mark.parametrize("first,last,chunk", [(4, 0, 5), (4, 0, 1000), (10, 1, 16), (0, 0, 3)])
def test_moving_frames(rows, first, last, chunk):
    got = ordered.over_last_rows(rows, ["k"], ["t", "id"], first, last, {"s": F.sum("v"), "n": F.count("*")}, chunk)
    w = W.partitionBy("k").orderBy("t", "id").rowsBetween(-first, -last)
    same(got.select("id", "s", "n"), rows.select("id", F.sum("v").over(w).alias("s"), F.count("*").over(w).alias("n")))


def test_frame_must_fit_its_chunk(rows):
    with pytest.raises(ValueError):
        ordered.over_last_rows(rows, ["k"], ["t"], 5, 0, {"n": F.count("*")}, 5)


def test_time_span(rows):
    got = ordered.over_last_span(rows, ["k"], "t", "id", 7200, {"s": F.col("v").cast("decimal(18,2)"), "n": F.lit(1).cast("long")})
    w = W.partitionBy("k").orderBy(F.unix_micros("t")).rangeBetween(-7_200_000_000, 0)
    want = rows.select("id", F.coalesce(F.sum(F.col("v").cast("decimal(18,2)")).over(w), F.lit(0)).cast("decimal(18,2)").alias("s"), F.count("*").over(w).alias("n"))
    same(got.select("id", "s", "n"), want)


def test_a_hot_group_is_cut_into_even_parts(spark, rows):
    """A third of the rows have one key and one order value; the tie column cuts them apart."""
    hot = rows.select(F.lit("one").alias("k"), F.lit(5.0).alias("w"), "id").where("id % 2 = 0").union(rows.select("k", "w", "id").where("id % 2 = 1"))
    parts = ordered.in_parts(hot, ["k"], [F.desc("w"), F.asc("id")]).groupBy("_part").count()
    sizes = [r["count"] for r in parts.collect()]
    assert len(sizes) > 1 and max(sizes) < 3 * sum(sizes) / len(sizes)


@pytest.mark.parametrize("partitions", ["3", "23"])
def test_ranks_when_values_run_over_parts(spark, partitions):
    df = spark.range(400).select(
        F.when(F.col("id") < 380, "a").otherwise(None).alias("k"),
        F.when(F.col("id") % 5 < 3, 7.0).when(F.col("id") % 5 == 3, 2.0).otherwise((F.col("id") % 11).cast("double")).alias("w"),
        "id",
    )
    with setting(spark, "spark.sql.shuffle.partitions", partitions):
        for descending in (True, False):
            lead = F.desc("w") if descending else F.asc("w")
            by, tie = W.partitionBy("k").orderBy(lead), W.partitionBy("k").orderBy(lead, "id")
            want = df.select("*", F.row_number().over(tie).cast("long").alias("row_number"), F.rank().over(by).cast("long").alias("rank"), F.dense_rank().over(by).cast("long").alias("dense_rank"), F.ntile(3).over(tie).alias("ntile"))
            same(ordered.rank_within(df, ["k"], "w", ["id"], 3, descending), want)


def test_exact_quantiles(rows):
    probs = (0.0, 0.25, 0.5, 0.9, 1.0)
    got = {(r["k"], r["p"]): r["quantile"] for r in quantiles(rows, ["k"], "v", probs).collect()}
    want = rows.groupBy("k").agg(F.expr("percentile(v, array(0.0, 0.25, 0.5, 0.9, 1.0))").alias("q")).collect()
    assert None in {r["k"] for r in want} and len(got) == 5 * len(want)
    for r in want:
        for p, q in zip(probs, r["q"]):
            assert abs(got[(r["k"], p)] - q) < 1e-9
