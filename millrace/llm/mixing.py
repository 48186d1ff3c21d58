"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks. With integer weights W, a round gives every source W blocks as long as it has them. In a round, block j
of a source that supplies c blocks has a release time and a deadline: the slots in which a fluid schedule would begin and end it.
The block with the earliest deadline of those released takes each slot; unit blocks with such windows always meet their deadlines,
so at every slot each source is less than one block from its fluid share. Rounds in which all sources supply the
same numbers have the same order, so one pattern for each such case is worked out and joined to all blocks.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.session import settle

BLOCK = 16  # documents of a source in a block
RESOLUTION = 1000  # blocks in a full round, about
BUCKET = 50_000  # documents numbered in one sorted run
BROADCAST_ROWS = 200_000  # pattern rows, of some 50 bytes each, up to which the pattern is broadcast


def home_of(source: Column) -> Column:
    """A key without nulls for a source."""
    return F.xxhash64(source, source.isNull())


def numbered(docs: DataFrame, sizes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """docs with nth: the number of each row in its source, from 0, in the order of a hash of the whole row; and source_weight.

    A source is dealt over runs by that hash, so that no run holds much more than `bucket` rows of it.
    """
    runs = max(1, math.ceil(docs.count() / bucket))
    # One key serves the window and the join, so whole rows are shuffled once.
    home = home_of(F.col("source"))
    hashed = docs.withColumn("mixed", F.xxhash64(*docs.columns)).withColumns({"home": home, "run": F.pmod(F.shiftright("mixed", 32), F.lit(runs))})
    counts = hashed.groupBy("home", "run").agg(F.count(F.lit(1)).alias("n"))
    # One row for each source and run.
    before = counts.select("home", "run", (F.sum("n").over(Window.partitionBy("home").orderBy("run")) - F.col("n")).alias("before"))
    before = before.join(sizes.select(home.alias("home"), F.col("weight").alias("source_weight")), "home")
    ranked = hashed.withColumn("within", F.row_number().over(Window.partitionBy("home", "run").orderBy("mixed")))
    return ranked.join(before, ["home", "run"]).select(*docs.columns, "source_weight", (F.col("before") + F.col("within") - 1).alias("nth"))


def round_edges(sizes: DataFrame) -> Column:
    """The rounds from which on some source supplies another number of blocks than before, as a sorted array.

    sizes: source, n_blocks, weight. A source supplies its weight, then perhaps a rest, then nothing.
    """
    full, part = F.floor(F.col("n_blocks") / F.col("weight")), F.ceil(F.col("n_blocks") / F.col("weight"))
    edges = sizes.select(F.explode(F.array(F.lit(0).cast("long"), full, part)).alias("edge"))
    return edges.agg(F.sort_array(F.collect_set("edge"))).scalar()


def sources_of(sizes: DataFrame) -> Column:
    return sizes.agg(F.sort_array(F.collect_list(F.struct("source", "n_blocks", "weight")))).scalar()


def patterns(sizes: DataFrame) -> DataFrame:
    """edge, source, j, in_round, release, deadline of each block in a round, for every case of supplies.

    There are two cases at most for each source and one more, dealt over the tasks, and a case has one row for each block of a round.
    """
    spark = sizes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cases = spark.range(1).select(F.explode(round_edges(sizes)).alias("edge")).repartition(parts, "edge")
    # Through explode, as no subquery may be merged into a higher-order function.
    cases = cases.select("edge", F.explode(F.array(sources_of(sizes))).alias("sources"))
    given = F.transform(
        "sources",
        lambda s: F.struct(
            s["source"].alias("source"),
            s["weight"].alias("weight"),
            F.greatest(F.lit(0).cast("long"), F.least(s["weight"], s["n_blocks"] - F.col("edge") * s["weight"])).alias("supply"),
        ),
    )
    cases = cases.select("edge", F.filter(given, lambda s: s["supply"] > 0).alias("given")).where(F.size("given") > 0)
    whole = F.aggregate("given", F.lit(0).cast("long"), lambda a, s: a + F.when(s["supply"] == s["weight"], s["weight"]).otherwise(0))
    cases = cases.select("edge", "given", whole.alias("whole"), F.filter("given", lambda s: s["supply"] < s["weight"]).alias("rests"))

    def fluid(share: Column) -> Column:
        """Slots used in the fluid schedule when each source has had this share of a full round."""
        return F.aggregate("rests", F.col("whole") * share, lambda a, s: a + F.least(s["supply"].cast("double"), share * s["weight"]))

    tiny = 1e-9

    def blocks_of(s: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0).cast("long"), s["supply"] - 1),
            lambda j: F.struct(
                F.ceil(fluid((j + 1) / s["weight"]) - tiny).alias("deadline"),
                s["source"].alias("source"),
                j.alias("j"),
                F.floor(fluid(j / s["weight"]) + tiny).alias("release"),
            ),
        )

    blocks = cases.select("edge", F.explode(F.flatten(F.transform("given", blocks_of))).alias("due"))
    arrivals = blocks.groupBy("edge", F.col("due.release").alias("release")).agg(F.collect_list("due").alias("due"))
    arrivals = arrivals.groupBy("edge").agg(F.sort_array(F.collect_list(F.struct("release", "due"))).alias("arrivals"))

    def step(order: Column, arrival: Column) -> Column:
        """Slots before this release are taken; the blocks that wait and those that come follow by deadline."""
        slot = arrival["release"].cast("int")
        waiting = F.concat(F.slice(order, slot + 1, F.size(order)), arrival["due"])
        return F.concat(F.slice(order, 1, slot), F.sort_array(waiting))

    # Each slot takes the block with the earliest deadline of those released, so an order changes only where blocks are released.
    none = F.slice(F.col("arrivals")[0]["due"], 1, 0)
    walked = arrivals.select("edge", F.posexplode(F.aggregate("arrivals", none, step)).alias("in_round", "taken"))
    return walked.select("edge", "taken.source", "taken.j", F.col("in_round").cast("long").alias("in_round"), "taken.release", "taken.deadline")


def rounds_of(pattern: DataFrame) -> Column:
    """edge, before, slots of each case in order: the slots of all earlier rounds, and those of one of its own."""
    cases = pattern.groupBy("edge").agg(F.count(F.lit(1)).alias("slots"))
    known = cases.agg(F.sort_array(F.collect_list(F.struct("edge", F.lit(0).cast("long").alias("before"), "slots"))).alias("known"))

    def add(found: Column, case: Column) -> Column:
        last = F.element_at(found, -1)
        before = last["before"] + (case["edge"] - last["edge"]) * last["slots"]
        return F.concat(found, F.array(F.struct(case["edge"].alias("edge"), before.alias("before"), case["slots"].alias("slots"))))

    return known.select(F.aggregate(F.slice("known", 2, F.size("known")), F.slice("known", 1, 1), add)).scalar()


def case_of(rounds: str, turn: Column) -> Column:
    """The last of the rounds whose edge is at most this turn, by halving steps."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(25))])
    found = F.aggregate(steps, F.lit(0), lambda at, more: F.when(F.get(rounds, at + more - 1)["edge"] <= turn, at + more).otherwise(at))
    return F.get(rounds, found - 1)


def weighted_sizes(docs: DataFrame, exponent: float, weights: Mapping[str, int] | None, block: int, resolution: int) -> DataFrame:
    """source, n_docs, n_blocks, weight of every source."""
    counts = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"))
    sizes = counts.select("source", "n_docs", F.ceil(F.col("n_docs") / block).alias("n_blocks"))
    if weights is not None:
        given = F.create_map(*[F.lit(x) for p in weights.items() for x in p])[F.col("source")] if weights else F.lit(None)
        return sizes.withColumn("weight", F.coalesce(given.cast("long"), F.lit(1).cast("long")))
    power = F.pow("n_blocks", F.lit(exponent))
    total = sizes.agg(F.sum(power)).scalar()
    return sizes.withColumn("weight", F.greatest(F.lit(1), F.round(resolution * power / total)).cast("long"))


OWN = ("source_weight", "block", "slot", "release", "deadline", "position")


def mix(
    docs: DataFrame,
    exponent: float = 0.5,
    weights: Mapping[str, int] | None = None,
    block: int = BLOCK,
    resolution: int = RESOLUTION,
    bucket: int = BUCKET,
) -> DataFrame:
    """docs with source_weight, block (of the source), slot (of all blocks), its release and deadline, and position.

    Ordering by position gives the mix; it has gaps after short blocks. weights: blocks of each source in a round, at least 1; sources not
    named get 1. Without it, the number of a source's blocks to the power `exponent`, scaled to a round of about `resolution` blocks.
    Every row comes out once: a source that is used up leaves its share to the others. A null source is a source; rows that
    repeat are rows; an empty table stays empty. Columns of docs named like an added one are replaced. Each
    source is a row of a small table and of one array in a cell, and a round has a block of each at least; documents are any number.
    """
    kept = docs.drop(*OWN)
    # As one value, the row's columns cannot clash with those of the schedule.
    docs = kept.select("source", F.struct(*kept.columns).alias("whole_row"))
    # The few rows of sizes are needed in several places, so they are kept as a table.
    sizes = settle(weighted_sizes(docs, exponent, weights, block, resolution), "mix-sizes")
    pattern = settle(patterns(sizes), "mix-pattern")
    placed = (
        numbered(docs, sizes, bucket)
        .withColumn("block", F.floor(F.col("nth") / block))
        .withColumn("turn", F.floor(F.col("block") / F.col("source_weight")))
        .withColumn("all_rounds", rounds_of(pattern))
        .withColumn("case", case_of("all_rounds", F.col("turn")))
        .withColumn("at_edge", F.col("case.edge"))
        .withColumn("at_j", F.col("block") - F.col("turn") * F.col("source_weight"))
        .withColumn("before", F.col("case.before") + (F.col("turn") - F.col("case.edge")) * F.col("case.slots"))
    )
    named = pattern.select("edge", F.col("source").alias("of"), "j", "in_round", "release", "deadline")
    # A row for each block of a round in each case of supplies: bounded by the weights, and checked.
    if pattern.count() <= BROADCAST_ROWS:
        named = F.broadcast(named)
    joined = placed.join(named, (F.col("at_edge") == F.col("edge")) & F.col("source").eqNullSafe(F.col("of")) & (F.col("at_j") == F.col("j")))
    slot = F.col("before") + F.col("in_round")
    return joined.select(
        "whole_row.*",
        "source_weight",
        "block",
        slot.alias("slot"),
        (F.col("before") + F.col("release")).alias("release"),
        (F.col("before") + F.col("deadline")).alias("deadline"),
        (slot * block + F.pmod(F.col("nth"), F.lit(block))).alias("position"),
    )
