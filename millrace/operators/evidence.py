"""Digests that show where a table or a log was changed: a tree over buckets of rows, and linked blocks of log entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import running_totals
from millrace.session import settle

NOTHING = "0" * 64


def row_digest(df: DataFrame) -> Column:
    """SHA-256 of a row over its columns in name order, each with its name and type; nulls are apart from empty text."""

    def cell(name: str) -> Column:
        head = f"{name}:{df.schema[name].dataType.simpleString()}"
        return F.coalesce(F.concat(F.lit(f"{head}="), F.col(name).cast("string")), F.lit(f"{head}-"))

    cells = [cell(c) for c in sorted(df.columns)]
    return F.sha2(F.concat(*[F.concat(F.length(c).cast("string"), c) for c in cells]), 256)


def bucket_of(digest: Column, depth: int) -> Column:
    """The first bits of a digest in hex."""
    return F.shiftright(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), 32 - depth).cast("long")


def merkle_tree(df: DataFrame, depth: int) -> DataFrame:
    """(level, node, n, digest): 2 ** depth buckets of rows at level `depth`, pairs of nodes above them, and the root at level 0.

    A row's bucket is the beginning of its own digest, so that neither a frequent key nor copies of a row, which are one entry with a count, fill a
    bucket: choose the depth so that 2 ** depth buckets hold some thousand rows each. A changed row changes its old bucket and its new one.
    """
    if not 0 <= depth <= 24:
        raise ValueError("a tree has 0 to 24 levels below its root")
    entries = df.select(row_digest(df).alias("d")).groupBy("d").agg(F.count("*").alias("c"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("d", "c"))), lambda e: F.concat(e["d"], F.lit("*"), e["c"].cast("string"))), ",")
    filled = entries.groupBy(bucket_of(F.col("d"), depth).alias("node")).agg(F.sum("c").alias("n"), F.sha2(listed, 256).alias("digest"))
    every = df.sparkSession.range(1 << depth).withColumnRenamed("id", "node")
    leaves = every.join(filled, "node", "left").select("node", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("digest", F.lit(NOTHING)).alias("digest"))
    level = settle(leaves.withColumn("level", F.lit(depth)), "merkle")
    tree = level
    for height in range(depth - 1, -1, -1):
        sides = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node", "digest"))), lambda e: e["digest"]), "")
        above = level.groupBy(F.shiftright("node", 1).alias("node")).agg(F.sum("n").alias("n"), F.sha2(sides, 256).alias("digest"))
        level = settle(above.withColumn("level", F.lit(height)), "merkle")
        tree = tree.unionByName(level)
    return tree.select("level", "node", "n", "digest")


def changed_nodes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(level, node, n_before, n_after) of the nodes of two trees that differ: none if the tables are the same, else a path from the root to each changed bucket."""
    a = before.select("level", "node", F.col("n").alias("n_before"), F.col("digest").alias("_a"))
    b = after.select("level", "node", F.col("n").alias("n_after"), F.col("digest").alias("_b"))
    return a.join(b, ["level", "node"], "full").where(~F.col("_a").eqNullSafe(F.col("_b"))).drop("_a", "_b")


def rows_of_buckets(df: DataFrame, buckets: DataFrame, depth: int) -> DataFrame:
    """The rows of df that lie in the given buckets (node); the part of a table to look at when its tree differs."""
    marked = df.withColumn("_bucket", bucket_of(row_digest(df), depth))
    return marked.join(buckets.select(F.col("node").alias("_bucket")).distinct(), "_bucket", "left_semi").select(*df.columns)


def log_blocks(entries: DataFrame, sequence: str, size: int) -> DataFrame:
    """(block, n, first, last, content, link): blocks of log entries by their sequence number, chained to the block before.

    sequence: a whole number that the log gave each entry when it was written. content: digest of the entries of a block in order; link: digest of the
    contents of the block before and this one. A block has `size` entries at most, so that it fits a task, however long the log is.
    """
    cells = F.struct(F.col(sequence).cast("long").alias("s"), row_digest(entries).alias("d"))
    blocks = entries.select(F.call_function("div", F.col(sequence).cast("long"), F.lit(size)).alias("block"), cells.alias("e"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list("e")), lambda e: F.concat(e["s"].cast("string"), F.lit("="), e["d"])), ",")
    own = blocks.groupBy("block").agg(F.count("*").alias("n"), F.min("e.s").alias("first"), F.max("e.s").alias("last"), F.sha2(listed, 256).alias("content"))
    own = settle(own, "log-blocks")
    before = own.select((F.col("block") + 1).alias("block"), F.col("content").alias("_before"))
    linked = F.sha2(F.concat(F.coalesce("_before", F.lit(NOTHING)), F.col("content")), 256)
    return own.join(before, "block", "left").select("block", "n", "first", "last", "content", linked.alias("link"))


def log_root(blocks: DataFrame, fan: int = 1024) -> DataFrame:
    """(n_entries, n_blocks, root): one digest over all links in order; links are joined by so many at a time until one is left.

    Keep it apart from the log: whoever cuts off the end of the log and of its blocks cannot make it again.
    """
    level = blocks.select(F.col("block").alias("at"), F.col("link").alias("d"))
    counts = blocks.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_entries"), F.count("*").alias("n_blocks"), F.max("block").alias("top"))
    top = counts.first()["top"]
    reach = 1 if top is None else int(top) + 1
    while True:
        listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "d"))), lambda e: F.concat(e["at"].cast("string"), F.lit("="), e["d"])), ",")
        level = level.groupBy(F.call_function("div", F.col("at"), F.lit(fan)).alias("at")).agg(F.sha2(listed, 256).alias("d"))
        reach = -(-reach // fan)
        if reach <= 1:
            break
        level = settle(level, "log-level")
    root = level.agg(F.coalesce(F.max("d"), F.lit(NOTHING))).scalar()
    return counts.select("n_entries", "n_blocks", root.alias("root"))


def damaged_blocks(kept: DataFrame, entries: DataFrame, sequence: str, size: int) -> DataFrame:
    """(block, kind) of blocks whose entries do not agree with the kept ones: changed, missing (entries or the whole block), added."""
    now = log_blocks(entries, sequence, size).select("block", F.col("n").alias("_n"), F.col("content").alias("_content"), F.col("link").alias("_link"))
    both = kept.join(now, "block", "full")
    kind = (
        F.when(F.coalesce("_n", F.lit(0)) < F.coalesce("n", F.lit(0)), "missing")
        .when(F.coalesce("_n", F.lit(0)) > F.coalesce("n", F.lit(0)), "added")
        .when(F.col("content") != F.col("_content"), "changed")
    )
    return both.select("block", kind.alias("kind")).where("kind is not null")


def numbered(entries: DataFrame, order: list[str], name: str = "sequence") -> DataFrame:
    """entries with a sequence number from 0, along an order that is unique; parts of the log are numbered side by side."""
    return running_totals(entries.withColumn("_all", F.lit(0)), ["_all"], order, {name: F.lit(1).cast("long")}).drop("_all").withColumn(name, F.col(name) - 1)
