"""Jaccard join of documents by their word shingles, with token-combination prefixes.

Texts with equal shingle sets form a class. Shingles are ordered by the number of classes that hold them, rarest first. Linked classes
share a shingle in their prefixes, and two in prefixes longer by one. A rare shared shingle is found by itself; shingles in many
classes are indexed only in pairs. Pairs of classes that meet are verified by their whole sets.

Near copies in great number meet everywhere. So each class is first verified with one other that it meets most, which ties large groups
together; after that only classes that no links join yet are compared, wherever they meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm import arrow_text, components, meeting, shingles
from millrace.session import settle

SHARE = 80  # hundredths of the union that linked sets have in common
RARE = 32  # classes that hold a shingle indexed by itself
BLOCK = 1 << 18


def _cut(words: int) -> meeting.Cut:
    def cut(batch: pa.RecordBatch, seen: set) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bytes | None]]:
        data, offsets = arrow_text.utf8_bytes(batch.column(1))
        for a, b in arrow_text.blocks(offsets, BLOCK):
            values, cuts = shingles.distinct_shingles(data, offsets[a : b + 1], words)
            sizes = np.diff(cuts)
            raw = values.tobytes()
            names = np.array([xxhash.xxh64_intdigest(raw[8 * x : 8 * y]) for x, y in zip(cuts, cuts[1:])], "u8").view("i8")
            known, first = np.unique(names, return_index=True)
            # A set that the task has sent before is not sent again.
            new = [i for x, i in zip(known.tolist(), first.tolist(), strict=True) if sizes[i] and x not in seen]
            seen.update(names[new].tolist())
            first = np.sort(np.array(new, "i8"))
            keep = np.zeros(b - a, bool)
            keep[first] = True
            numbers = np.cumsum(keep) - 1
            owner = np.repeat(np.where(keep, numbers, -1), sizes)
            ids = batch.column(0).slice(a, b - a)
            side = pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array(names), pa.array(sizes.astype("i8"))], names=["doc_id", "class", "n"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, side.schema) as writer:
                writer.write_batch(side)
            yield names[first], owner[owner >= 0], values[owner >= 0], sink.getvalue().to_pybytes()

    return cut


def _documents(sides: DataFrame) -> DataFrame:
    """doc_id, class, n of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.column(0).to_pylist():
                yield from pa.ipc.open_stream(block)

    return sides.mapInArrow(run, "doc_id long, class long, n long")


def prefixes(held: DataFrame, sizes: DataFrame, share: int = SHARE) -> DataFrame:
    """class, n, key, df, rank for the shingles in a class's prefix and one more, of classes that can have links.

    held: class, key of shared shingles. Shingles of no other class come first in the order and need no rows.
    """
    counts = held.groupBy("key").agg(F.count(F.lit(1)).alias("df")).where("df >= 2")
    rows = held.join(counts, "key").join(sizes.select("class", "n"), "class")
    own = Window.partitionBy("class")
    ranked = rows.withColumn("m", F.count(F.lit(1)).over(own)).withColumn("rank", F.col("n") - F.col("m") + F.row_number().over(own.orderBy("df", "key")) - 1)
    return ranked.withColumn("prefix", F.col("n") - F.ceil(F.col("n") * share / 100) + 1).where("n - m < prefix")


def verified(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """The pairs (a, b) of classes whose sets have enough in common."""
    left = sets.select(F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("keys").alias("keys_a"))
    right = sets.select(F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("keys").alias("keys_b"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("keys_a", "keys_b"))
    return both.where(common * 100 >= (F.col("n_a") + F.col("n_b") - common) * share).select("a", "b")


def _pairs_between(met: DataFrame, share: int) -> DataFrame:
    """Pairs of classes of different components that have a key in common; met: key, class, n, room, root.

    room: the most shingles that a class can share with another if this key holds the first that they share. The component with most
    classes under a key is paired with the others, and the others with one another.
    """
    sizes = met.groupBy("key", "root").agg(F.count(F.lit(1)).alias("members"))
    main = sizes.groupBy("key").agg(F.max_by("root", F.struct("members", "root")).alias("main"), F.count(F.lit(1)).alias("roots")).where("roots > 1")
    open_ = met.join(main, "key")
    others = open_.where("root <> main").select("key", F.col("class").alias("c"), F.col("n").alias("n_c"), F.col("room").alias("room_c"), F.col("root").alias("root_c"))
    fits = F.least("room", "room_c") * (100 + share) >= (F.col("n") + F.col("n_c")) * share
    found = open_.join(others, "key").where((F.col("root") != F.col("root_c")) & fits)
    return found.select(F.least("class", "c").alias("a"), F.greatest("class", "c").alias("b")).distinct()


def linked_classes(held: DataFrame, sizes: DataFrame, share: int = SHARE, rare: int = RARE) -> DataFrame:
    """class, root of every class with links; held: class, key; sizes: class, n."""
    ranked = settle(prefixes(held, sizes, share), "ngram-ranked")
    sets = settle(ranked.groupBy("class").agg(F.max("n").alias("n"), F.collect_list("key").alias("keys")), "ngram-sets")
    own = ((F.col("n") - F.col("m")) / F.col("n")).alias("own")
    index = ranked.where("rank <= prefix").select("class", "n", "key", "df", "rank", "prefix", own)

    # First each class with the one that leads most of its prefix. A text that others were made from has few shingles
    # of its own, so it leads.
    inner = index.where("rank < prefix").select("class", "key", "own")
    leaders = inner.groupBy("key").agg(F.min_by("class", F.struct("own", "class")).alias("leader")).select("key", "leader")
    votes = inner.join(leaders, "key").where("leader <> class").groupBy("class", "leader").agg(F.count(F.lit(1)).alias("votes"))
    first = votes.groupBy("class").agg(F.max_by("leader", F.struct("votes", "leader")).alias("b")).select(F.col("class").alias("a"), "b")
    tried = settle(first, "ngram-tried")
    links = settle(verified(tried, sets, share), "ngram-links")
    roots = components.stars(links)

    # Then classes that are not joined yet, wherever they meet.
    rooted = index.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    mixed_keys = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
    rooted = settle(rooted.join(mixed_keys, "key"), "ngram-rooted")
    alone = rooted.where((F.col("df") <= rare) & (F.col("rank") < F.col("prefix")))
    alone = alone.select("key", "class", "n", (F.col("n") - F.col("rank")).alias("room"), "root")
    often = rooted.where(F.col("df") > rare).groupBy("class").agg(
        F.first("n").alias("n"), F.first("root").alias("root"), F.array_sort(F.collect_list(F.struct("rank", "key"))).alias("keys")
    )
    in_pairs = often.select(F.explode(_combinations(F.col("keys"))).alias("pair"), "class", "n", "root")
    in_pairs = in_pairs.select(F.col("pair.key").alias("key"), "class", "n", (F.col("n") + 1 - F.col("pair.rank")).alias("room"), "root")
    pairs = _pairs_between(alone, share).unionByName(_pairs_between(in_pairs, share)).distinct()
    done = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = verified(pairs.join(done, ["a", "b"], "left_anti"), sets, share)
    found = components.stars(links.unionByName(more))
    return found.select(F.col("node").alias("class"), "root")


def _combinations(keys: Column) -> Column:
    """A hash of each pair of keys, and the rank of the second."""

    def joined(x: Column, y: Column) -> Column:
        return F.struct(F.xxhash64(x["key"], y["key"]).alias("key"), y["rank"].alias("rank"))

    later = F.transform(keys, lambda x, i: F.transform(F.slice(keys, i + 2, F.size(keys)), lambda y: joined(x, y)))
    return F.flatten(later)


def similar_documents(docs: DataFrame, words: int = shingles.WORDS, share: int = SHARE, rare: int = RARE) -> DataFrame:
    """doc_id, n_shingles and component_id of every row: the smallest doc_id that links reach.

    Two rows link when 100 times their common shingles are at least `share` times all of theirs. A null text or one without words
    has no shingle and no link; its component is its own id. Rows that repeat are linked with each other and stay rows. A null id is no smallest
    id: the component has one if any member has. Sets are compared by 64-bit hashes of shingles. Columns besides doc_id and text are ignored.
    """
    entries, sides = meeting.shared(docs.select("doc_id", "text"), _cut(words), "ngram-shared")
    rows = settle(_documents(sides), "ngram-documents")
    held = settle(entries.select(F.col("owner").alias("class"), "key").distinct(), "ngram-held")
    sizes = rows.where("n > 0").groupBy("class").agg(F.max("n").alias("n"))
    roots = settle(linked_classes(held, sizes, share, rare), "ngram-roots")
    placed = rows.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    least = placed.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("least"))
    joined = placed.join(least, "root", "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))
