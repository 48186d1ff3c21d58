"""Cleaning comments out of the shell blocks of a Markdown corpus.

A document is one row, and every step is an array expression on that row, so a
corpus is cleaned in the tasks that read it: no shuffle and no Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as T


def once(df: DataFrame, *columns: Column) -> DataFrame:
    """Add costly columns behind a generator, so that no later filter makes Spark compute them twice."""
    return df.select("*", F.inline(F.array(F.struct(*columns))))


def _located(docs: DataFrame) -> DataFrame:
    """(path, value) with the lines of the text and the places of its shell blocks."""
    lines = once(docs.select("path", "value"), T.split_lines(F.col("value")).alias("lines"))
    return once(lines, T.shell_blocks(F.col("lines")).alias("blocks"))


def _part(start: Column, end: Column) -> Column:
    """Lines from start up to, not including, end."""
    return F.slice("lines", start + 1, F.greatest(end - start, F.lit(0)))


def _outer_parts() -> Column:
    """Bounds of the text around the block bodies, fences included: one more than there are blocks."""
    starts = F.concat(F.array(F.lit(0)), F.transform("blocks", lambda b: b["closing"]))
    ends = F.concat(F.transform("blocks", lambda b: b["opening"] + 1), F.array(F.size("lines")))
    return F.arrays_zip(starts.alias("start"), ends.alias("end"))


def _body(block: Column) -> Column:
    return _part(block["opening"] + 1, block["closing"])


def mark_fences(docs: DataFrame) -> DataFrame:
    """(path, value) to one row per line: (path, pos, line, role, block_id).

    `role` is open, body or close inside a shell block and text elsewhere;
    `block_id` numbers the blocks of a file from 1 and is null outside.
    """
    n_blocks = F.size("blocks")

    def item(line: Column, pos: Column, role: Column, block: Column) -> Column:
        return F.struct(pos.alias("pos"), line.alias("line"), role.alias("role"), block.cast("int").alias("block_id"))

    def outer(part: Column, k: Column) -> Column:
        closing = lambda i: (i == 0) & (k > 0)
        opening = lambda i: (i == part["end"] - part["start"] - 1) & (k < n_blocks)
        return F.transform(
            _part(part["start"], part["end"]),
            lambda line, i: item(
                line,
                part["start"] + i,
                F.when(closing(i), "close").when(opening(i), "open").otherwise("text"),
                F.when(closing(i), k).when(opening(i), k + 1),
            ),
        )

    def inner(block: Column, k: Column) -> Column:
        return F.transform(_body(block), lambda line, i: item(line, block["opening"] + 1 + i, F.lit("body"), k + 1))

    items = F.flatten(F.concat(F.transform(_outer_parts(), outer), F.transform("blocks", inner)))
    return _located(docs).select("path", F.inline(items)).select("path", "pos", "line", "role", "block_id")


def block_bodies(docs: DataFrame) -> DataFrame:
    """(path, value) to one row per shell block: (path, block_id, body) with body an array of lines."""
    return _located(docs).select("path", F.posexplode(F.transform("blocks", _body)).alias("n", "body")).select(
        "path", (F.col("n") + 1).alias("block_id"), "body"
    )


def replace_literals(text: Column, pairs: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """Ordered replacements over a whole text; gives the new text and the number of hits."""
    hits = F.lit(0).cast("long")
    for old, new in pairs:
        hits = hits + T.count_literal(text, old)
        text = F.replace(text, F.lit(old), F.lit(new))
    return text, hits


def clean_body(body: Column) -> Column:
    """The lines of a block to struct(text, n_changes)."""

    def rewrite(kept: Column) -> Column:
        changed = F.size(F.filter(kept, lambda line: F.contains(line, F.lit("#")) & (T.strip_inline_comment(line) != line)))
        return F.struct(
            F.array_join(T.trim_block(T.collapse_blank_lines(kept)), "").alias("text"),
            (F.size(body) - F.size(kept) + changed).cast("long").alias("n_changes"),
        )

    return T.let(T.drop_comment_lines(body), rewrite)


def clean_shell_blocks(docs: DataFrame, pairs: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """(path, value) to (path, value, n_changes).

    Comments go from the shell blocks, then the literal pairs are replaced in
    the whole text. A text with no counted change keeps its bytes, even where
    only blank lines would have gone.
    """
    outer = F.transform(_outer_parts(), lambda part: F.array_join(_part(part["start"], part["end"]), ""))
    inner = F.transform("blocks", lambda block: T.let(_body(block), clean_body))
    staged = once(_located(docs), outer.alias("outer"), inner.alias("inner"))
    joined = F.array_join(F.zip_with("outer", "inner", lambda o, b: F.concat(o, F.coalesce(b["text"], F.lit("")))), "")
    in_blocks = F.aggregate("inner", F.lit(0).cast("long"), lambda acc, b: acc + b["n_changes"])
    rebuilt = staged.select("path", "value", joined.alias("rebuilt"), in_blocks.alias("in_blocks"))
    cleaned, hits = replace_literals(F.col("rebuilt"), pairs)
    counted = once(rebuilt, cleaned.alias("cleaned"), (F.col("in_blocks") + hits).alias("n_changes"))
    return counted.select("path", F.when(F.col("n_changes") > 0, F.col("cleaned")).otherwise(F.col("value")).alias("value"), "n_changes")


def changes_report(cleaned: DataFrame) -> DataFrame:
    """Changed files, most changes first, ties in path order.

    The narrow rows are shuffled once before the sort, which samples its input
    and would otherwise clean every text a second time.
    """
    changed = cleaned.where("n_changes > 0").select("path", "n_changes").repartition("path")
    return changed.orderBy(F.desc("n_changes"), "path")
