"""Prefix trie of conversations, in adaptive radix trees over turn ids of fixed width.

A turn's id is 16 bytes of a digest of role and text, and a conversation is the string of its turns' ids. Strings are
dealt in order, so that a task's trees hold neighbouring strings, and copies of a conversation are split between tasks like any others. Only depths
at whole turns are nodes of the trie. A node that is no prefix of a tree's first or last string lies in that tree alone and is
finished there; the others, few in each tree, are added up over all trees.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.radix_tree import RadixTree
from millrace.session import settle

WIDTH = 16  # bytes of a turn id
FAMILY = 100  # conversations that share the template of the first among them
SHARED = 6  # a conversation takes fewer turns than this from its template
TREE_BYTES = 1 << 24  # bytes of strings in one tree, about
TREE_ROWS = 1 << 16  # strings in one tree at most
NODE, EDGE, ENDS = range(3)
NO_ENDS = hashlib.sha256(b"").hexdigest()

_FOUND = pa.schema(
    [("kind", pa.int32()), ("part", pa.int64()), ("side", pa.int64()), ("key", pa.binary()), ("parent", pa.binary()), ("turn_id", pa.binary())]
    + [(c, pa.int64()) for c in ("depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "length")]
    + [("ends", pa.string())]
)
_FOUND_SQL = (
    "kind int, part long, side long, key binary, parent binary, turn_id binary, depth long, conv_id long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, length long, ends string"
)
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "turn_id"]


def turn_id(role: Column, text: Column) -> Column:
    """16 bytes of a digest of a role and a text, in hex; null counts as empty."""
    role, text = F.coalesce(role.cast("string"), F.lit("")), F.coalesce(text.cast("string"), F.lit(""))
    return F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH)


def turns_by_conversation(conversations: DataFrame) -> DataFrame:
    """conv_id and turns, an array of (id, length) by turn, null turns first; turns with equal numbers are ordered by their ids."""
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        turn_id(F.col("role"), F.col("text")).alias("id"),
        F.coalesce(F.length(F.col("text").cast("string")), F.lit(0)).alias("length"),
    )
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "id", "length"))).alias("turns"))
    return grouped.select("conv_id", F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["length"].alias("length"))).alias("turns"))


def rebuilt(conversations: DataFrame, family: int = FAMILY, shared: int = SHARED) -> DataFrame:
    """conv_id and turns of every conversation, begun with its family's first turns.

    The first h turns of conversation c come from conversation c - c % family (fewer if that has fewer, none if it is absent), then c's own
    turns after its first h follow; h is the CRC-32 of c in decimals, modulo `shared`; the remainder by
    `family` has the sign of c, as in SQL. A conversation may be left without turns.
    """
    own = settle(turns_by_conversation(conversations), "trie-turns")
    heads = own.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("home"), F.slice("turns", 1, max(1, shared - 1)).alias("head"))
    asked = own.withColumn("home", F.col("conv_id") - F.col("conv_id") % family).withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).cast("int"))
    none = F.slice("turns", 1, 0)
    begun = F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")), F.slice("turns", F.col("h") + 1, F.size("turns")))
    return asked.join(heads, "home", "left").select("conv_id", begun.alias("turns"))


class _Chunk:
    """A tree of neighbouring strings, and the rows that it gives."""

    def __init__(self, part: int):
        self.part, self.tree, self.rows, self.bytes = part, RadixTree(), 0, 0
        self.first = self.last = b""
        self.out: list[tuple] = []

    def add(self, key: bytes, conv: int, lengths: list[int]) -> None:
        if not self.rows:
            self.first = key
        self.last = key
        self.tree.add(key, (conv, key, lengths))
        self.rows += 1
        self.bytes += len(key) + 4 * len(lengths)

    def batch(self) -> pa.RecordBatch:
        self._emit()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*self.out, strict=True), _FOUND, strict=True)], schema=_FOUND)

    def _emit(self) -> None:
        walked = list(self.tree.walk())
        first, last = _prefix_keys(self.first), _prefix_keys(self.last)
        edges = self._edges()
        sums = self._sums(walked, edges)
        above = {id(self.tree.root): None}
        for node, depth in walked:
            n, least, kids, leaves, saved, (key, lengths) = sums[id(node)]
            up, levels = above[id(node)], _levels(node, depth)
            turns = {level: (key[level - WIDTH : level], lengths[level // WIDTH - 1]) if level else (None, 0) for level in levels}
            ends = sorted(held[0] for held in node.held)
            if id(node) in edges:
                sides = edges[id(node)]
                keys = first if 0 in sides else last
                for level in levels:
                    below = (kids[0], leaves, saved) if level == levels[-1] else (0, 0, 0)
                    name, parent = keys[level // WIDTH], keys[level // WIDTH - 1] if level else None
                    turn, length = turns[level]
                    self.out.append((EDGE, self.part, min(sides), name, parent, turn, level // WIDTH, least, None, n, *below, length, None))
                    if len(sides) > 1:
                        self.out.append((EDGE, self.part, 1, name, parent, turn, level // WIDTH, least, None, 0, 0, 0, 0, length, None))
                if levels:
                    up = (True, keys[levels[-1] // WIDTH])
                if ends:
                    self.out.append((ENDS, self.part, 0, up[1], None, None, None, ends[0], None, *[None] * 5, ",".join(map(str, ends))))
            elif levels:
                below, rows = (kids[0], max(1, leaves), saved), []
                for level in reversed(levels):
                    turn, length = turns[level]
                    below = (below[0] if level == levels[-1] else 1, below[1], below[2] + (n - 1) * length)
                    rows.append((level, turn, length, below))
                for level, turn, length, below in reversed(rows):
                    digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest() if ends and level == levels[-1] else NO_ENDS
                    edge, known = (up[1], None) if up[0] else (None, up[1])
                    self.out.append((NODE, self.part, 0, None, edge, turn, level // WIDTH, least, known, n, *below, length, digest))
                    up = (False, least)
            for child in node.children():
                above[id(child)] = up

    def _edges(self) -> dict[int, set[int]]:
        """Nodes on the way to the first string (0) and to the last one (1)."""
        found: dict[int, set[int]] = {}
        for side, key in ((0, self.first), (1, self.last)):
            node, at = self.tree.root, 0
            found.setdefault(id(node), set()).add(side)
            while at < len(key):
                node = node.child(key[at])
                at += len(node.path)
                found.setdefault(id(node), set()).add(side)
        return found

    def _sums(self, walked: list, edges: dict) -> dict[int, tuple]:
        """By node: members, the least one, (finished, edge) nodes one turn below, leaves and saved tokens of finished nodes, string and lengths of a member.

        What lies below an edge node counts for that node alone.
        """
        sums: dict[int, tuple] = {}
        totals: dict[int, tuple] = {}
        for node, depth in reversed(walked):
            parts = [totals[id(c)] for c in node.children()]
            n = len(node.held) + sum(p[0] for p in parts)
            least = min([*(held[0] for held in node.held), *(p[1] for p in parts)])
            kids = (sum(p[2][0] for p in parts), sum(p[2][1] for p in parts))
            leaves, saved = sum(p[3] for p in parts), sum(p[4] for p in parts)
            member = node.held[0][1:] if node.held else parts[0][5]
            levels = _levels(node, depth)
            sums[id(node)] = totals[id(node)] = (n, least, kids, leaves, saved, member)
            if levels and id(node) in edges:
                totals[id(node)] = (n, least, (0, 1), 0, 0, member)
            elif levels:
                more = (n - 1) * sum(member[1][level // WIDTH - 1] for level in levels)
                totals[id(node)] = (n, least, (1, 0), max(1, leaves), saved + more, member)
        return sums


def _levels(node, depth: int) -> list[int]:
    """Whole-turn depths that a node's path reaches, in bytes; the root has its own."""
    begin = depth - len(node.path)
    return list(range((begin // WIDTH + 1) * WIDTH, depth + 1, WIDTH)) if node.path else [0]


def _prefix_keys(key: bytes) -> list[bytes]:
    """16 bytes of a digest of each whole-turn prefix, the empty one first."""
    running = hashlib.sha256()
    found = [running.digest()[:WIDTH]]
    for at in range(0, len(key), WIDTH):
        running.update(key[at : at + WIDTH])
        found.append(running.digest()[:WIDTH])
    return found


def _build(tree_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        chunk = _Chunk(part)
        for batch in batches:
            for conv, key, lengths in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                chunk.add(key, conv, lengths)
                if chunk.bytes >= TREE_BYTES or chunk.rows >= tree_rows:
                    yield chunk.batch()
                    part += 1
                    chunk = _Chunk(part)
        if chunk.rows:
            yield chunk.batch()

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the joined ends of each key; rows come by key and first end."""
    at, running = None, None
    for batch in batches:
        for key, ends in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != at:
                if at is not None:
                    yield _digest_row(at, running)
                at, running = key, hashlib.sha256(ends.encode())
            else:
                running.update(b"," + ends.encode())
    if at is not None:
        yield _digest_row(at, running)


def _digest_row(key: bytes, running) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([running.hexdigest()])], names=["key", "ends_sha256"])


def prefix_trie(sequences: DataFrame, tree_rows: int = TREE_ROWS) -> DataFrame:
    """The nodes of the trie of all sequences: RESULT, where turn_id names a node's last turn.

    sequences: conv_id, unique and not null, and turns, an array of (id, length) as of rebuilt(). A conversation is a unit: 16 bytes and a
    length for each of its turns go through one task. Copies may be any number. Without conversations there are no nodes.
    """
    strings = sequences.select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), "")).alias("ids"), F.transform("turns", lambda t: t["length"]).alias("lengths")
    )
    strings = settle(strings, "trie-strings")
    dealt = strings.repartitionByRange("ids", "conv_id").sortWithinPartitions("ids", "conv_id").select("conv_id", "ids", "lengths")
    found = settle(dealt.mapInArrow(_build(tree_rows), _FOUND_SQL), "trie-found")

    edges = found.where(F.col("kind") == EDGE).withColumn("way", F.col("part") * 2 + F.col("side"))
    one = [F.max(c).alias(c) for c in ("parent", "turn_id", "depth", "length")]
    added = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    joint = edges.groupBy("key").agg(*one, *added, F.min("conv_id").alias("conv_id"), F.min("way").alias("home"))
    joint = settle(joint, "trie-joint")
    branches = joint.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("more"))
    counted = joint.join(branches, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0))).drop("more")
    counted = settle(counted, "trie-counted")

    # Each joint node is charged to one way that leads to it; its ancestors all lie on that way.
    own_leaves = F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0)
    own_saved = F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("length")
    charged = counted.select("key", "home", own_leaves.alias("leaves"), own_saved.alias("saved"))
    steps = edges.select("key", "way", "depth").join(charged, "key")
    mine = F.col("home") == F.col("way")
    upward = Window.partitionBy("way").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    summed = steps.select("key", *[F.sum(F.when(mine, F.col(c)).otherwise(0)).over(upward).alias(c) for c in ("leaves", "saved")])
    summed = summed.groupBy("key").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))

    ends = found.where(F.col("kind") == ENDS).select("key", "conv_id", "ends")
    ends = ends.repartition("key").sortWithinPartitions("key", "conv_id").select("key", "ends").mapInArrow(_digests, "key binary, ends_sha256 string")
    owners = counted.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    top = counted.drop("n_leaves", "saved_tokens").join(summed, "key").join(ends, "key", "left").join(owners, "parent", "left")
    top = top.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS))).select(*_result())

    whole = found.where(F.col("kind") == NODE).withColumnRenamed("ends", "ends_sha256")
    inner = whole.where(F.col("parent").isNull()).select(*_result())
    local = edges.where(F.col("n_convs") > 0).select("part", F.col("key").alias("parent")).join(owners, "parent")
    outer = whole.where(F.col("parent").isNotNull()).drop("parent_conv_id").join(local, ["part", "parent"]).select(*_result())
    return top.unionByName(inner).unionByName(outer)


def _result() -> list[Column]:
    return [F.col(c) for c in RESULT]


def conversation_trie(conversations: DataFrame, family: int = FAMILY, shared: int = SHARED, tree_rows: int = TREE_ROWS) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations; see rebuilt() and prefix_trie().

    conversations: conv_id, turn, role and text; other columns are ignored. Null roles and texts are empty, null turns come first, turns
    with equal numbers are ordered by their ids, rows that repeat are turns of their own. Rows with a null conv_id take no part. An empty table gives
    no nodes. Two turns are equal if 16 bytes of their SHA-256 digests are.
    """
    return prefix_trie(rebuilt(conversations, family, shared), tree_rows)


def trie_sql(family: int = FAMILY, shared: int = SHARED) -> str:
    step = "xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))"
    zeros = ", ".join(["0::BIGINT"] * 7)
    bits = f"flatten(list_transform(range(1, len(conv_id::VARCHAR) + 1), lambda i: [ascii(substr(conv_id::VARCHAR, i::BIGINT, 1))::BIGINT, {zeros}]))"
    return f"""
WITH own AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS nth,
  coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda a, b: {step}), 4294967295) % {shared} AS h
 FROM (SELECT DISTINCT conv_id FROM own)),
r AS (SELECT c.conv_id, 0 AS side, nth, role, text FROM c JOIN own ON own.conv_id = c.conv_id - c.conv_id % {family} AND nth <= h
 UNION ALL SELECT c.conv_id, 1, nth, role, text FROM c JOIN own ON own.conv_id = c.conv_id AND nth > h),
d AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY side, nth) AS depth, len(text) AS size,
 sha256(len(role) || ':' || role || text) AS mark FROM r),
p AS (SELECT conv_id, depth, size, sha256(string_agg(mark, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node FROM d
 UNION ALL SELECT conv_id, 0, 0, '' FROM c),
l AS (SELECT conv_id, max(depth) AS depth FROM p GROUP BY conv_id),
n AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size FROM p GROUP BY node, depth),
u AS (SELECT n.node, n.conv_id, n.depth, q.node AS parent, q.conv_id AS parent_conv_id
 FROM n LEFT JOIN p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1 LEFT JOIN n q ON q.node = p.node AND q.depth = p.depth),
k AS (SELECT parent, count(*) AS kids FROM u WHERE parent IS NOT NULL GROUP BY parent),
own_sums AS (SELECT n.*, coalesce(kids, 0) AS kids, (n_convs - 1) * size AS saved FROM n LEFT JOIN k ON k.parent = n.node),
s AS (SELECT p.node, sum(CASE WHEN kids = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
 FROM own_sums o JOIN p ON p.conv_id = o.conv_id AND p.depth <= o.depth GROUP BY p.node),
e AS (SELECT p.node, sha256(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id)) AS ends FROM p JOIN l USING (conv_id, depth) GROUP BY p.node)
SELECT o.conv_id, o.depth::BIGINT AS depth, u.parent_conv_id, o.n_convs, o.kids::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves,
 s.saved_tokens::BIGINT AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
FROM own_sums o JOIN u USING (node) JOIN s USING (node) LEFT JOIN e USING (node)"""
