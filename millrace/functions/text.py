"""Column expressions for Markdown text. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The link pattern, the prefixes that are not checked and the
# languages whose fences hold shell code.
LINK = r"\[([^\]]+)\]\(([^)]+)\)"
UNCHECKED_PREFIXES = ("http://", "https://", "mailto:", "computer://", "#")
SHELL_LANGUAGES = ("bash", "sh", "shell", "zsh", "console")

# Characters that end a line and characters that count as white
# space, as members of a regex class. A carriage return never gets here, see
# normalize_newlines.
LINE_ENDS = r"\n\x0b\x0c\x1c-\x1e\x85\u2028\u2029"
BLANKS = r"\t\r\x1f\x20\xa0\u1680\u2000-\u200a\u202f\u205f\u3000"
SPACES = LINE_ENDS + BLANKS

# The same white space as characters, for the trim functions.
SPACE_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"

FENCE = "```"
SHELL_FENCE = f"\\A[{SPACES}]*{FENCE}(?i:{'|'.join(SHELL_LANGUAGES)})[{SPACES}]*\\z"


def normalize_newlines(text: Column) -> Column:
    return F.regexp_replace(text, r"\r\n?", "\n")


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(SPACE_CHARS))


def rstrip(text: Column) -> Column:
    return F.rtrim(text, F.lit(SPACE_CHARS))


def is_blank(text: Column) -> Column:
    return F.ltrim(text, F.lit(SPACE_CHARS)) == ""


def split_lines(text: Column) -> Column:
    """Lines with their terminators, so that joining them gives the text back.

    A mark is put behind each terminator and the text cut at the marks, which is
    many times faster than matching lines; a text that holds the mark itself is matched.
    """
    mark = "\x00"
    cut = F.filter(F.split(F.regexp_replace(text, f"[{LINE_ENDS}]", f"$0{mark}"), mark, -1), lambda line: line != "")
    matched = F.regexp_extract_all(text, F.lit(f"[^{LINE_ENDS}]*+[{LINE_ENDS}]|[^{LINE_ENDS}]++"), F.lit(0))
    return F.when(F.contains(text, F.lit(mark)), matched).otherwise(cut)


def is_fence_close(line: Column) -> Column:
    return strip(line) == FENCE


def shell_blocks(lines: Column) -> Column:
    """Where the shell blocks of a text stand: structs (opening, closing) of line numbers from 0.

    An unclosed block has the number of lines as its closing. Fences of other
    languages are ordinary lines. Whether a mark counts is seen from the mark before it,
    since after any mark the kind of that mark alone says if a block is open.
    """
    kind = lambda line: F.when(
        F.contains(line, F.lit(FENCE)), F.when(line.rlike(SHELL_FENCE), "open").when(is_fence_close(line), "close")
    )
    marks = F.filter(
        F.transform(lines, lambda line, i: F.struct(i.alias("at"), kind(line).alias("kind"))), lambda m: m["kind"].isNotNull()
    )

    def that(bound: Column, kind: str, inside: bool) -> Column:
        """Lines of the marks of a kind that stand inside, or outside, a block."""
        opened = lambda i: F.coalesce(F.get(bound, i - 1)["kind"] == "open", F.lit(False))
        hits = F.filter(bound, lambda m, i: (m["kind"] == kind) & (opened(i) if inside else ~opened(i)))
        return F.transform(hits, lambda m: m["at"])

    def paired(bound: Column) -> Column:
        both = F.struct(that(bound, "open", False).alias("opens"), that(bound, "close", True).alias("closes"))
        return let(
            both,
            lambda b: F.transform(
                b["opens"],
                lambda at, i: F.struct(at.alias("opening"), F.coalesce(F.get(b["closes"], i), F.size(lines)).alias("closing")),
            ),
        )

    return let(marks, paired)


def strip_anchor(url: Column) -> Column:
    return strip(F.regexp_extract(url, r"\A[^#]*", 0))


def is_checkable(url: Column) -> Column:
    """True for links into the tree: not empty and not one of the fixed prefixes."""
    external = F.lit(False)
    for prefix in UNCHECKED_PREFIXES:
        external = external | F.startswith(url, F.lit(prefix))
    return (url != "") & ~external


def resolve_path(base: Column, url: Column) -> Column:
    """The path that `url` names when it stands in the file `base`.

    `.` and `..` are collapsed, `..` stops at the root and an absolute url
    replaces the base. Percent signs are taken literally.
    """
    steps = F.when(F.startswith(url, F.lit("/")), F.split(url, "/")).otherwise(
        F.concat(F.slice(F.split(base, "/"), F.lit(1), F.size(F.split(base, "/")) - 1), F.split(url, "/"))
    )
    kept = F.aggregate(
        F.filter(steps, lambda s: ~s.isin("", ".")),
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(
            F.concat(acc, F.array(s))
        ),
    )
    return F.concat(F.lit("/"), F.array_join(kept, "/"))


def has_part(path: Column, names: Sequence[str]) -> Column:
    """True when a whole component of the path is one of the names."""
    if not names:
        return F.lit(False)
    return F.arrays_overlap(F.split(path, "/"), F.array(*map(F.lit, names)))


def is_comment_line(line: Column) -> Column:
    """A full-line shell comment; a `#!` line is not one."""
    start = F.ltrim(line, F.lit(SPACE_CHARS))
    return F.startswith(start, F.lit("#")) & ~F.startswith(start, F.lit("#!"))


def strip_inline_comment(line: Column) -> Column:
    """Cut the line at its first comment that follows two or more spaces.

    The line keeps its terminator only when nothing is cut; a cut line always
    ends in a newline. Quotes are not looked at.
    """
    body = F.rtrim(line, F.lit("\n"))
    cut = rstrip(F.regexp_replace(body, f"[{SPACES}]{{2,}}#[^\\n]*\\z", ""))
    found = F.contains(line, F.lit("#")) & line.rlike(f"[{SPACES}]{{2,}}#[{SPACES}]")
    return F.when(found, F.concat(cut, F.lit("\n"))).otherwise(line)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind an array expression to a name, so that lambdas do not evaluate it per element."""
    return F.get(F.transform(F.array(value), body), 0)


def drop_comment_lines(lines: Column) -> Column:
    return F.filter(lines, lambda line: ~is_comment_line(line))


def strip_inline_comments(lines: Column) -> Column:
    return F.transform(lines, strip_inline_comment)


def collapse_blank_lines(lines: Column) -> Column:
    """Strip inline comments and drop a blank line whose cleaned predecessor is blank.

    A run of blanks shrinks to its first line, so looking one line back in the
    input of this step is the same as looking at the last kept line.
    """

    def keep(pairs: Column) -> Column:
        kept = F.filter(
            pairs,
            lambda p, i: ~((i > 0) & is_blank(p["line"]) & is_blank(F.get(pairs, F.greatest(i - 1, F.lit(0)))["clean"])),
        )
        return F.transform(kept, lambda p: p["clean"])

    return let(
        F.transform(lines, lambda line: F.struct(line.alias("line"), strip_inline_comment(line).alias("clean"))), keep
    )


def trim_block(lines: Column) -> Column:
    """Drop blank lines at both ends of a block."""

    def cut(bound: Column) -> Column:
        solid = F.transform(bound, lambda line: ~is_blank(line))
        first = F.array_position(solid, True).cast("int")
        after = F.size(bound) - F.array_position(F.reverse(solid), True).cast("int") + 2
        return F.when(first == 0, F.slice(bound, 1, 0)).otherwise(F.slice(bound, first, F.greatest(after - first, F.lit(0))))

    return let(lines, cut)


def count_literal(text: Column, literal: str) -> Column:
    """Non-overlapping occurrences of a literal."""
    removed = F.length(text) - F.length(F.replace(text, F.lit(literal), F.lit("")))
    return (removed / len(literal)).cast("long")
