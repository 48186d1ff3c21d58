"""Whitening, byte-level BPE and the prefix trie beside plain restatements, on odd rows and small tables."""

import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from millrace.llm import bidiagonal, byte_bpe, conversation_trie, queries, radix_tree, whitening

CLASHES = "ids string, text_ string, n long, x string, turns string, key string, parent string, whitened string, place string"
EXTRA = ("x", "x", 1, "x", "x", "x", "x", "x", "x")

# Whitening


def matrices():
    r = np.random.default_rng(2)
    q, p = (np.linalg.qr(r.normal(size=(30, 30)))[0] for _ in range(2))
    tall = r.normal(size=(900, 24))
    close = np.ones(30)
    close[:8] = 2 + np.arange(8) * 1e-10
    twins = tall.copy()
    twins[:, 5], twins[:, 9] = twins[:, 6], 0
    graded = np.triu(np.full((10, 10), 1e-3) + np.diag(10.0 ** np.arange(0, -10, -1)))
    wilkinson = np.diag(np.abs(np.arange(-10.0, 11))) + np.diag(np.ones(20), 1)
    return {
        "one": np.array([[3.0]]), "zero": np.zeros((4, 4)), "identity": np.eye(5), "random": np.triu(r.normal(size=(24, 24))),
        "tall": np.linalg.qr(tall)[1], "equal values": 3 * q, "close values": (q * close) @ p, "deficient": np.linalg.qr(twins)[1],
        "graded": graded, "close pairs": wilkinson, "scaled": np.linalg.qr(tall * 10.0 ** -np.arange(0, 12, 0.5))[1],
    }


@pytest.mark.parametrize("name", sorted(matrices()))
def test_singular_values_and_vectors(name):
    m = matrices()[name]
    values, vectors = bidiagonal.right_singular(m)
    want = np.linalg.svd(m, compute_uv=False) ** 2
    assert np.allclose(values, want, rtol=1e-12, atol=1e-14 * max(want[0], 1e-300))
    assert np.abs(vectors.T @ vectors - np.eye(len(m))).max() < 1e-9
    assert np.abs(m.T @ (m @ vectors) - vectors * values).max() <= 1e-13 * max(want[0], 1e-300)


def test_qd_values_are_accurate_beside_large_ones():
    q = 10.0 ** np.arange(0, -40, -4)
    values = bidiagonal.qd_values(q, 1e-3 * q[1:])
    # The product of all values is that of q, and the least is found to nearly full accuracy.
    assert math.isclose(math.prod(values), math.prod(q), rel_tol=1e-12) and 0 < values[-1] <= q[-1]


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, *EXTRA) for i, v in rows], f"vec_id long, embedding array<float>, {CLASHES}").repartition(3)


def whitened_brute(rows, most=32):
    ok = [(i, [math.floor(64 * float(np.float32(c))) + 1000000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    n, sums = len(ok), [sum(c) for c in zip(*(x for _, x in ok), strict=True)]
    exact = [[n * x - s for x, s in zip(row, sums, strict=True)] for _, row in ok]
    centred = np.array([[x / n for x in row] for row in exact])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    return ok, exact, centred @ vectors[:, :most] / np.sqrt(values[:most]), values


def test_whitening_is_brute_force(spark):
    r = np.random.default_rng(5)
    rows = [(i, [float(x) for x in r.normal(size=36) * np.linspace(0.1, 4, 36) + 5]) for i in range(300)]
    odd = [(900, None), (901, []), (902, [None] * 36), (903, [float("nan")] * 36), (904, [float("inf")] * 36), (905, [1.0] * 35), (906, [3e38] * 36)]
    rows += [(5, rows[5][1]), (None, rows[6][1])]
    got = whitening.whitened_rows(vectors_of(spark, rows + odd)).collect()
    ok, exact, white, values = whitened_brute(rows)
    assert len(got) == 32 * len(ok) and {r["n"] for r in got} == {len(ok)} and max(r["identity_error"] for r in got) < 1e-9
    by_row = {(r["vec_id"], r["component"]): r for r in got}
    sign = [1 if abs(by_row[7, c + 1]["whitened"] - white[7, c]) < 1e-9 else -1 for c in range(32)]
    for k, (i, _) in enumerate(ok):
        assert by_row[i, 1]["deviation"] == sum(x * x for x in exact[k])
        assert np.allclose([sign[c] * by_row[i, c + 1]["whitened"] for c in range(32)], white[k], atol=1e-9)
    assert all(math.isclose(by_row[0, c + 1]["explained"], values[c] / values.sum(), rel_tol=1e-10) for c in range(32))


def test_whitening_of_rows_that_do_not_vary(spark):
    same = whitening.whitened_rows(vectors_of(spark, [(1, [1.0, 2.0])] * 3))
    assert same.count() == 0 and same.dtypes == whitening.whitened_rows(vectors_of(spark, [(1, [1.0, 2.0]), (2, [2.0, 2.5])])).dtypes
    assert whitening.whitened_rows(vectors_of(spark, [])).count() == 0
    r = np.random.default_rng(1)
    flat = whitening.whitened_rows(vectors_of(spark, [(i, [float(a), 3.0, float(a)]) for i, a in enumerate(r.normal(size=40))])).collect()
    assert {x["component"] for x in flat} == {1} and all(math.isclose(x["explained"], 1) for x in flat)


def test_deviations_beyond_long(spark):
    rows = [(i, [float(s) * 1e9, float(i)]) for i, s in enumerate((-1, 1) * 40)]
    got = whitening.whitened_rows(vectors_of(spark, rows)).collect()
    assert all(r["deviation"] is None for r in got) and max(r["identity_error"] for r in got) < 1e-4


def test_triangles_of_many_tasks_are_reduced(spark):
    r = np.random.default_rng(9)
    rows = spark.createDataFrame([(i, [int(x) for x in r.integers(-50, 50, 6)]) for i in range(200)], "vec_id long, x array<long>").repartition(30)
    model = whitening.fit(rows, 6)
    x = np.array([r["x"] for r in rows.collect()], "f8")
    assert np.allclose(model.eigenvalues, np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1], rtol=1e-12)


# Byte-level BPE


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.tokenizer_path())


def texts():
    r = random.Random(1)
    letters = "ab'sstmdrevll  \n\t1٣é中、.!　 𝔸́  "
    parts = ["<|endoftext|>", "<|endof", "text|>", "'s", "'re", " ", "a", "I'll", "\n", "' t", "中文", "'ll's", "''ve", "é", "don't 've"]
    out = ["".join(r.choice(letters) for _ in range(r.randint(0, 30))) for _ in range(3000)]
    out += ["".join(r.choice(parts) for _ in range(r.randint(0, 12))) for _ in range(3000)]
    out += ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(80, 3000))) for _ in range(40)]
    out += [chr(c) + "x" + chr(c) + chr(c) + " " for c in range(0x80, 0xD800, 23)] + [chr(c) for c in range(0x10000, 0x20000, 97)]
    return [*out, "", "a" * 5000, "ab" * 500, " " * 300, "\n" * 301 + "x", "=" * 257]


@pytest.mark.parametrize("block", [byte_bpe.BLOCK, 700])
def test_ids_and_texts_are_those_of_the_library(library, block):
    v, rows = byte_bpe.vocabulary(queries.tokenizer_path()), [*texts(), None]
    ids, offsets = byte_bpe.encode_column(pa.array(rows), v, block)
    decoded = byte_bpe.decode_lists(ids, offsets, v)
    for k, text in enumerate(rows):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert ids[offsets[k] : offsets[k + 1]].tolist() == want, repr(text)
        assert decoded[k] == library.decode(want, skip_special_tokens=False) == (text or "")


def test_long_texts_are_cut_at_seams(library):
    r = random.Random(3)
    long = "".join(r.choice(["word ", " it's", "中文。", "<|endoftext|>", "\n", "x1 ", "l'l "]) for _ in range(4000))
    ids, offsets = byte_bpe.encode_column(pa.array([long, "a", None, long]), byte_bpe.vocabulary(queries.tokenizer_path()), 500)
    want = library.encode(long, add_special_tokens=False).ids
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [want, [64], [], want]


def test_words_are_compared_not_only_hashed(monkeypatch, library):
    monkeypatch.setattr(byte_bpe.shingles, "mixed", lambda x: x % np.uint64(3))
    text = "one two three four five four three two one one1 zwei drei vier " * 3
    ids, _ = byte_bpe.encode_column(pa.array([text]), byte_bpe.vocabulary(queries.tokenizer_path()))
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_broken_bytes_and_unknown_ids(library):
    v = byte_bpe.vocabulary(queries.tokenizer_path())
    broken = pa.Array.from_buffers(pa.string(), 2, pa.array([b"ab\xff cd", b"\xe2\x82"], pa.binary()).buffers())
    ids, offsets = byte_bpe.encode_column(broken, v)
    assert byte_bpe.decode_lists(ids, offsets, v) == ["ab� cd", "�"]
    assert byte_bpe.decode_lists(np.array([64, 10**6, -3, 65], "i4"), np.array([0, 3, 4]), v) == ["a", "b"]


def test_bpe_rows(spark, library):
    rows = [(1, "it's <|endoftext|> all"), (2, None), (3, ""), (3, ""), (None, "x" * 4000), (4, "word " * 9000)]
    docs = spark.createDataFrame([(i, t, *EXTRA) for i, t in rows], f"doc_id long, text string, {CLASHES}").repartition(2)
    path = queries.tokenizer_path()
    got = byte_bpe.digest(byte_bpe.round_trip(docs, path, 1000)).collect()
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    back = byte_bpe.decode_documents(byte_bpe.encode_documents(docs, path), path).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in back) == sorted((str(i), t or "") for i, t in rows)
    assert byte_bpe.round_trip(docs.where("false"), path).count() == 0


def test_other_vocabularies_are_refused(tmp_path):
    with pytest.raises(ValueError):
        byte_bpe.Vocabulary(queries.tokenizer_path("word_bpe_49k.json"))


# Prefix trie


@pytest.mark.parametrize("letters", ["ab", "abcdefghijklmnopqrstuvwxyz", "".join(map(chr, range(256)))])
def test_radix_tree_holds_its_strings(letters):
    r = random.Random(len(letters))
    keys = ["".join(r.choice(letters) for _ in range(r.randint(0, 5))).encode("latin-1") for _ in range(3000)]
    tree = radix_tree.RadixTree()
    for k, key in enumerate(keys):
        tree.add(key, k)
    found, paths = {}, {id(tree.root): b""}
    for node, depth in tree.walk():
        whole = paths[id(node)]
        assert len(whole) == depth
        kids = list(node.children())
        assert [c.path[0] for c in kids] == sorted({c.path[0] for c in kids}) and len(kids) <= node.layout
        assert node is tree.root or node.held or len(kids) > 1  # chains are one path
        paths |= {id(c): whole + c.path for c in kids}
        if node.held:
            found[whole] = sorted(node.held)
    assert found == {key: [k for k, other in enumerate(keys) if other == key] for key in set(keys)}


def trie_brute(rows, family=100, shared=6):
    own = {}
    for c, t, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append((t is not None, t or 0, mark, role, text))
    own = {c: [x[3:] for x in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % shared
        whole[c] = own.get(c - int(math.fmod(c, family)), [])[:h] + turns[h:]
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids, sums = {}, {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    for node in sorted(members, key=len, reverse=True):
        below = [sums[k] for k in kids.get(node, [])]
        saved = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        sums[node] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(whole[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(kids.get(node, [])), *sums[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda x: (x[1], x[0]))


def conversations_of(spark, rows):
    return spark.createDataFrame([(*row, *EXTRA) for row in rows], f"conv_id long, turn long, role string, text string, {CLASHES}").repartition(4)


@pytest.mark.parametrize("tree_rows", [1 << 16, 3, 1])
def test_trie_is_brute_force(spark, tree_rows):
    r = random.Random(4)
    common = [("u", "x"), ("a", "yy"), ("u", "x"), (None, "q")] * 3
    rows = []
    for c in range(220):
        turns = common if r.random() < 0.3 else [(r.choice(["u", "a", None]), r.choice(["x", "yy", "zé𝔸", None, ""])) for _ in range(r.randint(1, 9))]
        name = r.choice([c, 7 * c, 100 * c])
        rows += [(name, r.choice([k, k, None]), *turn) for k, turn in enumerate(turns)]
    rows += [(None, 1, "u", "x"), (-5, 1, "u", "x"), (-105, 2, "u", "x"), (3, 1, "u", "x"), (3, 1, "u", "x")]
    got = conversation_trie.conversation_trie(conversations_of(spark, rows), tree_rows=tree_rows).drop("turn_id").collect()
    assert sorted(map(tuple, got), key=lambda x: (x[1], x[0])) == trie_brute(rows)


def test_trie_of_few_rows(spark):
    none = conversations_of(spark, [])
    assert conversation_trie.conversation_trie(none).count() == 0
    assert conversation_trie.conversation_trie(conversations_of(spark, [(None, 1, "u", "x")])).count() == 0
    # CRC-32 of 101 modulo 6 is above 0: its only turn is replaced by the template's, which is absent.
    lone = next(c for c in range(101, 199) if zlib.crc32(str(c).encode()) % 6)
    got = [tuple(r)[:7] for r in conversation_trie.conversation_trie(conversations_of(spark, [(lone, 1, "u", "x")])).collect()]
    assert got == [(lone, 0, None, 1, 0, 1, 0)]


def test_long_conversations_and_copies(spark):
    long = [("u" if k % 2 else "a", f"turn {k} " * 20) for k in range(300)]
    rows = [(c, k, *turn) for c in (100, 200, 300, 400) for k, turn in enumerate(long[: 300 - c // 100 * (c != 400)])]
    got = conversation_trie.conversation_trie(conversations_of(spark, rows), tree_rows=2).drop("turn_id").collect()
    assert sorted(map(tuple, got), key=lambda x: (x[1], x[0])) == trie_brute(rows)
