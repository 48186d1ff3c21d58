"""Secret scans by assignment-aware lexing.

Source and configuration syntax is read as pairs of a name and a literal: from each sign of assignment back to its name, and on to its value, which may be
a string in any quotes, strings joined or in brackets over lines, arguments or defaults of a call, a plain word, or lines below a key. A name whose
value is another name takes that name's literal, from before or else from later in the text. Literals are scored by how sensitive the names are that hold
them and by how random they look. Plain patterns of known shapes run beside it. Nothing is cut off by length, and every step is linear in the text.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns, their least lengths and their order.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_ASSIGNED, LEAST_ACCESS = 8, 16
_IS_HEX = bytes(chr(i) in "0123456789abcdef" for i in range(256))
KINDS = ("assign", "access", "hex", "literal")
BASE_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: How much the words of a name say that its value is secret. The least ones reach the threshold with a random value of two kinds of characters.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "auth": 0.8, "bearer": 0.8, "private": 0.8, "access": 0.7, "signing": 0.8,
    "encryption": 0.8, "key": 0.7, "session": 0.7, "salt": 0.7, "cert": 0.7, "pass": 0.8,
    "accesskey": 0.9, "privatekey": 1.0, "encryptionkey": 0.9, "sessionkey": 0.9, "signingkey": 0.9, "authkey": 0.9,
}
#: Words of values that stand for a secret in examples, and words that go with them.
PLACEHOLDERS = {"changeme", "change", "example", "placeholder", "your", "todo", "none", "null", "true", "false", "test", "dummy", "redacted", "sample", "default"}
COMPANIONS = {"me", "my", "the", "here", "value", "insert", "enter", "replace", "this", "with", "a", "an", "api", "user", "id", "string", "some", "it", "not", "set", "please", "to", "for", "in"}
#: Calls that look a value up by a name: their first argument is that name, others are defaults.
LOOKUPS = {"get", "getenv", "env", "environ", "getproperty", "lookup", "getstring", "config", "setting", "fetch", "require"}
THRESHOLD = 0.6

NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
NAME_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-"
SIGN = re.compile(r":=|=>|=(?![=~])|:(?![:/])")
ELEMENT = re.compile(r"<(?P<name>[A-Za-z_][\w.\-]*+)>(?P<value>[^<>\s]++)</(?P=name)>")
PREFIX = re.compile(r"[rRbBuUfF]{0,2}(?=[\"'`])")
QUOTED = {q: re.compile(p) for q, p in (('"', r'"(?:[^"\\\n]|\\.)*+"'), ("'", r"'(?:[^'\\\n]|\\.)*+'"), ("`", r"`[^`\n]*+`"))}
WORD = re.compile(r"""[^\s"'`,;(){}\[\]<>|]++""")
CALL = re.compile(r"[ \t]*+(?:new[ \t]++)?[A-Za-z_$][\w.$:]*+(?:<[\w, ]*+>)?\(")
JOINED, LISTED = re.compile(r"[ \t]*+\+\s*+(?=[rRbBuUfF]{0,2}[\"'`])"), re.compile(r"\s*+\+?\s*+(?=[rRbBuUfF]{0,2}[\"'`])")
BRACKETS = re.compile(r"\[[^\[\]\n]*+\]")
FALLBACK = re.compile(r"[ \t]*+(?:\|\||\?\?|\?:|or\b)[ \t]*+")
SPACE = re.compile(r"\s*+")
CONTINUED = re.compile(r"[ \t]*+(?:\\\r?\n[ \t]*+)?")
BLOCK_SCALAR = re.compile(r"[|>][+\-0-9]*+[ \t]*+(?:#[^\n]*+)?\r?\n")
KEY_LINE = re.compile(r"""[ \t]*+(?:-[ \t]|["']?[\w.\-]++["']?[ \t]*+[:=](?:[ \t\r\n]|\Z)|#|\Z)""")
REFERENCE = re.compile(r"\$\{[^{}]*+\}|\{\{[^{}]*+\}\}|<[^<>]*+>|%[A-Za-z_]\w*+%|%\([^()]*+\)s|\$[A-Za-z_]\w*+")
# A PEM block over several lines; the body ends before the next header.
PEM_BODY = re.compile(r"-----BEGIN (?!PUBLIC)[A-Z0-9 ]+-----(?P<body>(?:[^-]|-(?!----))*+)(?:-----END [A-Z0-9 ]+-----)?")
BEFORE_PEM = re.compile(r"""(?:[rbuf]|[|>][+-]?)?["'`]{0,3}\s*+(?=-----BEGIN )""")
IDENTIFIER = re.compile(r"[$%{]{0,2}([A-Za-z_][A-Za-z0-9_.]*+)\}?\Z")


class Literal(NamedTuple):
    start: int
    end: int
    value: str


class Finding(NamedTuple):
    kind: str
    start: int
    end: int
    name: str
    score: float


def name_weight(name: str) -> float:
    """How sensitive a name is: its parts in camel, snake or dotted spelling, whole or joined in pairs."""
    parts = [p.lower() for p in NAME_PARTS.findall(name)]
    joined = [*parts, *(a + b for a, b in zip(parts, parts[1:]))]
    return max((SENSITIVE[p] for p in joined if p in SENSITIVE), default=0.0)


def is_placeholder(value: str) -> bool:
    """Whether a whole value is made of words that stand for a secret, or refers to another place, or repeats one character."""
    if len(set(value)) < 3 or REFERENCE.fullmatch(value):
        return True
    words = [p.lower() for p in NAME_PARTS.findall(value) if not p.isdigit()]
    known = [w in PLACEHOLDERS for w in words]
    return any(known) and all(k or w in COMPANIONS or w in SENSITIVE for k, w in zip(known, words))


def value_weight(value: str) -> float:
    """How much a literal looks like a secret: its length, the entropy of its characters and their mix; of a PEM block, those of its body."""
    if pem := PEM_BODY.search(value):
        value = "".join(re.sub(r"\\[nrt]", "", pem["body"]).split())
    if len(value) < 8 or any(c.isspace() for c in value) or is_placeholder(value):
        return 0.0
    counts = Counter(value).values()
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in counts)
    mixed = sum(any(test(c) for c in value) for test in (str.islower, str.isupper, str.isdigit))
    return min(1.0, entropy / 3.5) * (0.7 + 0.1 * mixed)


def dense(text: str, start: int, end: int) -> Literal:
    """A literal of one or several lines without the white space around them; lines of more than a word keep theirs."""
    inner = text[start:end]
    a, b = start + len(inner) - len(inner.lstrip()), end - (len(inner) - len(inner.rstrip()))
    lines = [line.strip() for line in text[a:b].split("\n")]
    several = any(c.isspace() for line in lines for c in line)
    return Literal(a, max(a, b), text[a:b] if several else "".join(lines))


def quoted(text: str, at: int) -> tuple[Literal, int] | None:
    """The string that begins at a place, in single, double, triple or back quotes, and the place behind it."""
    prefix = PREFIX.match(text, at)
    if not prefix:
        return None
    at = prefix.end()
    mark = text[at]
    if mark != "`" and text.startswith(mark * 3, at):
        end = text.find(mark * 3, at + 3)
        return (dense(text, at + 3, end), end + 3) if end >= 0 else None
    m = QUOTED[mark].match(text, at)
    return (Literal(at + 1, m.end() - 1, text[at + 1 : m.end() - 1]), m.end()) if m else None


def joined_strings(text: str, at: int, between: re.Pattern = JOINED) -> tuple[Literal, int] | None:
    """Strings that are added to each other, or stand side by side in brackets, as one literal."""
    found = quoted(text, at)
    if not found:
        return None
    first, at = found
    parts, end = [first.value], first.end
    while (m := between.match(text, at)) and (more := quoted(text, m.end())):
        parts.append(more[0].value)
        end, at = more[0].end, more[1]
    return Literal(first.start, end, "".join(parts)), at


def arguments(text: str, at: int, lookup: bool) -> list[Literal]:
    """The strings among the arguments of a call that begin at a place; of a lookup, those after the first argument."""
    found, depth, commas = [], 1, 0
    while depth and at < len(text):
        c = text[at]
        if c in "\"'`":
            one = joined_strings(text, at)
            if not one:
                return found
            if commas or not lookup:
                found.append(one[0])
            at = one[1]
            continue
        if c == "\n" and text.startswith("\n\n", at):  # no call goes over an empty line
            return found
        depth += (c in "([{") - (c in ")]}")
        commas += c == "," and depth == 1
        at += 1
    return found


def indent(text: str, at: int) -> int:
    """Blanks at the beginning of the line of a place."""
    line = text[text.rfind("\n", 0, at) + 1 : at]
    return len(line) - len(line.lstrip(" \t"))


def lines_below(text: str, at: int, depth: int, whole: bool) -> tuple[Literal, int] | None:
    """The lines from a place on that are indented deeper than their key; all of them, or else the first if it is a value."""
    end = last = at
    while end < len(text):
        stop = text.find("\n", end)
        stop = len(text) if stop < 0 else stop
        line = text[end:stop]
        if line.strip():
            if len(line) - len(line.lstrip(" \t")) <= depth:
                break
            if not whole:
                if KEY_LINE.match(line):
                    return None
                start = end + len(line) - len(line.lstrip())
                return joined_strings(text, start) or plain_word(text, start)
            last = stop
        end = stop + 1
    return (dense(text, at, last), last) if last > at else None


def plain_word(text: str, at: int) -> tuple[Literal, int] | None:
    m = WORD.match(text, at)
    if not m:
        return None
    value = m[0].rstrip(".:")
    return (Literal(at, at + len(value), value), m.end()) if value else None


def values_at(text: str, at: int, sign: str, depth: int) -> tuple[list[str | Literal], int]:
    """What stands behind a sign of assignment: literals, or names that are referred to, and the place up to which it is read.

    depth gives the blanks before the key, as lines below it may hold the value.
    """
    at = CONTINUED.match(text, at).end()
    if at >= len(text):
        return [], at
    found: list[str | Literal] = []
    c = text[at]
    if c in "\r\n" and sign == ":":
        below = lines_below(text, at + 1, depth, False)
        return ([below[0]], below[1]) if below else ([], at)
    if one := joined_strings(text, at):
        return [one[0]], one[1]
    if pem := BEFORE_PEM.match(text, at):
        body = PEM_BODY.match(text, pem.end())
        return ([Literal(body.start(), body.end(), body[0])], body.end()) if body else ([], at)
    if sign == ":" and (block := BLOCK_SCALAR.match(text, at)):
        below = lines_below(text, block.end(), depth, True)
        return ([below[0]], below[1]) if below else ([], at)
    if c == "(":
        one = joined_strings(text, SPACE.match(text, at + 1).end(), LISTED)
        return ([one[0]], one[1]) if one else ([], at + 1)
    if call := CALL.match(text, at):
        name = call[0][:-1].split(".")[-1].split(":")[-1].strip().lower()
        found += arguments(text, call.end(), name in LOOKUPS)
        return found, call.end()
    word = WORD.match(text, at)
    if not word:
        return [], at
    raw, end = word[0], word.end()
    if (same := IDENTIFIER.match(raw)) and not any(x.isdigit() for x in raw):
        found.append(same[1])
    else:
        value = raw.rstrip(".:")
        found.append(Literal(at, at + len(value), value))
    if key := BRACKETS.match(text, end):  # a lookup in brackets, perhaps with a default behind it
        end = key.end()
    if (or_else := FALLBACK.match(text, end)) and (one := joined_strings(text, or_else.end())):
        found.append(one[0])
        end = one[1]
    return found, end


def pairs(text: str) -> Iterator[tuple[str, str | Literal]]:
    """Names with their literal, or with the name that they refer to, in order of the text."""
    found: list[tuple[int, str, str | Literal]] = []
    if "</" in text:
        found += [(m.start(), m["name"], Literal(m.start("value"), m.end("value"), m["value"])) for m in ELEMENT.finditer(text)]
    last = read = 0
    for m in SIGN.finditer(text):
        before, last = text[last : m.start()].rstrip(" \t"), m.end()
        if m.start() < read:
            continue  # within a value
        for _ in range(2):
            before = before[:-1] if before[-1:] in ("\"", "'", "]") else before
        name = before[len(before.rstrip(NAME_LETTERS)) :].lstrip("0123456789.-")
        if not name:
            continue
        values, read = values_at(text, m.end(), m[0], indent(text, m.start()) if m[0] == ":" else 0)
        found += [(m.start(), name, value) for value in values]
    for _, name, value in sorted(found, key=lambda x: x[0]):
        yield name, value


def scan_literals(text: str, threshold: float = THRESHOLD) -> list[Finding]:
    """Literals that sensitive names hold, directly or by way of other names; one finding for each, with its best score."""
    if "=" not in text and ":" not in text and "</" not in text:
        return []
    lowered = text.lower()
    if not any(w in lowered for w in _ROOTS):
        return []  # no name here is sensitive
    listed = list(pairs(text))
    first: dict[str, str | Literal] = {}
    for name, value in listed:
        first.setdefault(name, value)

    def defined_later(name: str) -> Literal | None:
        seen = set()
        value = first.get(name)
        while isinstance(value, str) and value not in seen:
            seen.add(value)
            value = first.get(value)
        return value if isinstance(value, Literal) else None

    held: dict[str, Literal] = {}
    best: dict[tuple[int, int], Finding] = {}
    for name, value in listed:
        literal = (held.get(value) or defined_later(value)) if isinstance(value, str) else value
        if literal is None:
            continue  # refers to what the text does not define
        held[name] = literal
        weight = name_weight(name)
        score = weight * value_weight(literal.value) if weight else 0.0
        at = (literal.start, literal.end)
        if score >= threshold and (at not in best or best[at].score < score):
            best[at] = Finding("literal", *at, name, score)
    return list(best.values())


#: One of these is in every name that is sensitive; names are compared by whole parts afterwards.
_ROOTS = sorted({w for w in SENSITIVE if not any(other != w and other in w for other in SENSITIVE)})


def scan(text: str | None, threshold: float = THRESHOLD) -> list[Finding]:
    """All findings in a text by start, then kind, in code points with the end exclusive."""
    if not text:
        return []
    found = []
    lowered = text.lower()
    if any(w in lowered for w in BASE_WORDS):
        found += [Finding("assign", m.start(), m.end(), m[1], 1.0) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        found += [Finding("access", m.start(), m.end(), "", 1.0) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    if b"\1" * 32 in text.encode().translate(_IS_HEX):
        found += [Finding("hex", m.start(), m.end(), "", 1.0) for m in HEX.finditer(text)]
    found += scan_literals(text, threshold)
    return sorted(found, key=lambda f: (f.start, KINDS.index(f.kind), f.end))


def spelled(found: list[Finding]) -> str:
    return ",".join(f"{f.kind}:{f.start}:{f.end}" for f in found)


_FOUND = pa.schema([(f"n_{k}", pa.int64()) for k in KINDS] + [("base_sha256", pa.string()), ("spans", pa.string()), ("max_score", pa.float64())])


def scan_documents(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id and findings of every row: counts by kind, spans, digest of the base spans, best score of a literal.

    A null or empty text has no finding. Rows that repeat stay rows; a null id is kept; columns besides doc_id and text are ignored.
    Each text is scanned whole, in the task that reads it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in _FOUND]
            for text in batch.column(1):
                found = scan(text.as_py(), threshold)
                base = [f for f in found if f.kind != "literal"]
                row = [sum(f.kind == k for f in found) for k in KINDS]
                row += [hashlib.sha256(spelled(base).encode()).hexdigest(), spelled(found), max((f.score for f in found if f.kind == "literal"), default=0.0)]
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            arrays = [batch.column(0), *(pa.array(c, f.type) for c, f in zip(out, _FOUND, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, schema=pa.schema([batch.schema.field(0), *_FOUND]))

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, max_score double"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def redact(text: str | None, threshold: float = THRESHOLD, mark: str = "[SECRET]") -> str | None:
    """The text with each finding, overlapping ones together, replaced by a mark."""
    found = scan(text, threshold)
    if not found:
        return text
    out, at = [], 0
    for f in found:
        if f.start >= at:
            out += [text[at : f.start], mark]
        at = max(at, f.end)
    return "".join([*out, text[at:]])


def redact_column(text: Column, threshold: float = THRESHOLD) -> Column:
    """redact() over Arrow batches."""

    @F.arrow_udf("string")
    def each(column: pa.Array) -> pa.Array:
        return pa.array([redact(t.as_py(), threshold) for t in column], pa.string())

    return each(text)
