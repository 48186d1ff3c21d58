"""Approximate answers of bounded size: distinct counts, frequent items, quantiles, membership."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 32_768  # bits of one bitmap built by bitmap_construct_agg


def distinct_sketches(df: DataFrame, keys: Sequence[str], value: str, lg_k: int = 12) -> DataFrame:
    """One HyperLogLog sketch per key, at most about 2**lg_k bytes each; sketches can be stored and merged."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, F.lit(lg_k)).alias("sketch"))


def merge_distinct(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Estimates from stored sketches, merged to coarser keys; the rows behind them are not read again."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx"))


def approx_distinct(df: DataFrame, keys: Sequence[str], value: str, rsd: float = 0.02) -> DataFrame:
    return df.groupBy(*keys).agg(F.approx_count_distinct(value, rsd).alias("approx"))


def heavy_hitters(items: DataFrame, item: str, k: int, tracked: int = 10_000) -> DataFrame:
    """(item, estimate) of the k most frequent items, from sketches that track a bounded number of items."""
    top = items.agg(F.expr(f"approx_top_k({item}, {int(k)}, {int(tracked)})").alias("top"))
    return top.select(F.inline("top")).toDF(item, "estimate")


def count_min_size(error: float, confidence: float) -> tuple[int, int]:
    """(depth, width) so that an estimate exceeds the truth by at most `error` times the number of all items, with this confidence."""
    return math.ceil(math.log(1 / (1 - confidence))), math.ceil(math.e / error)


def count_min(items: DataFrame, item: str, depth: int, width: int) -> DataFrame:
    """Count-min table (lane, cell, n) of at most depth x width rows, see count_min_size.

    Each task first adds up its own cells, so an item that fills a third of the
    data sends one row per lane and task.
    """
    lanes = items.select(item, F.explode(F.sequence(F.lit(0), F.lit(depth - 1))).alias("lane"))
    return lanes.groupBy("lane", _cell(item, width).alias("cell")).agg(F.count("*").alias("n"))


def _cell(item: str, width: int) -> Column:
    return F.pmod(F.xxhash64(F.col("lane"), F.col(item)), F.lit(width))


def count_min_estimate(table: DataFrame, probes: DataFrame, item: str, depth: int, width: int) -> DataFrame:
    """(item, estimate) for distinct probes; an estimate is never below the true count."""
    lanes = probes.select(item, F.explode(F.sequence(F.lit(0), F.lit(depth - 1))).alias("lane"))
    keyed = lanes.withColumn("cell", _cell(item, width))
    found = keyed.join(table, ["lane", "cell"], "left")
    return found.groupBy(item).agg(F.min(F.coalesce("n", F.lit(0))).alias("estimate"))


def quantile_sketches(df: DataFrame, keys: Sequence[str], value: str, k: int = 400) -> DataFrame:
    """One mergeable KLL sketch per key."""
    return df.groupBy(*keys).agg(F.kll_sketch_agg_double(value, F.lit(k)).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(keys, p, approx) read from quantile_sketches."""
    read = [
        F.struct(F.lit(float(p)).alias("p"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("approx"))
        for p in probs
    ]
    return sketches.select(*keys, F.inline(F.array(*read)))


def bloom_blocks(items: int, rate: float, hashes: int = 5) -> int:
    """Number of blocks for so many distinct items and this share of false positives.

    A fifth is added, since items fall unevenly on the blocks.
    """
    bits = -hashes / math.log(1 - rate ** (1 / hashes))
    return max(1, math.ceil(1.2 * items * bits / BLOCK_BITS))


def _bloom_block(item: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(item), F.lit(blocks))


def _bloom_positions(item: Column, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(item, F.lit(i)), F.lit(BLOCK_BITS)) for i in range(1, hashes + 1)]


def bloom_filter(items: DataFrame, item: str, blocks: int, hashes: int = 5) -> DataFrame:
    """(block, bits): a Bloom filter of `blocks` bitmaps with 32,768 bits, 4 KiB each.

    All bits of an item lie in one block, so a probe needs one lookup. The size
    is fixed by `blocks`, whatever the number of items; about 10 bits per item
    give one false positive in a hundred.
    """
    bits = items.select(
        _bloom_block(F.col(item), blocks).alias("block"),
        F.explode(F.array(*_bloom_positions(F.col(item), hashes))).alias("bit"),
    )
    return bits.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def bloom_member(probes: DataFrame, item: str, bloom: DataFrame, blocks: int, hashes: int = 5) -> DataFrame:
    """Add `maybe`: false means the item is certainly not in the set."""
    keyed = probes.withColumn("block", _bloom_block(F.col(item), blocks))
    joined = keyed.join(bloom, "block", "left")
    hit = F.col("bits").isNotNull()
    for position in _bloom_positions(F.col(item), hashes):
        byte = F.conv(F.hex(F.expr("bits").substr((F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        hit = hit & (byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (position % 8).cast("int"))) != 0)
    return joined.withColumn("maybe", F.coalesce(hit, F.lit(False))).select(*probes.columns, "maybe")
