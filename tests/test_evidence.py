"""Digest trees, linked logs, median cuts, offset tracking and stored volume: planted changes are found, and only these."""

import json
import math
import os
import random
import subprocess
import sys
import time
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.operators import evidence, mondrian, profiling
from millrace.plans import trust
from millrace.streaming import jobs, offsets

# Trees and logs


@pytest.fixture(scope="module")
def people(spark):
    rows = [(i, f"name {i % 7}" if i % 5 else None, i / 4) for i in range(500)] + [(1, "name 1", 0.25)] * 40
    return spark.createDataFrame(rows, "id long, name string, amount double").repartition(5)


def test_equal_tables_have_equal_trees(people):
    tree = evidence.merkle_tree(people, 5)
    again = evidence.merkle_tree(people.repartition(3).orderBy("name"), 5)
    assert evidence.changed_nodes(tree, again).count() == 0
    counts = {r["level"]: (r["c"], r["n"]) for r in tree.groupBy("level").agg(F.count("*").alias("c"), F.sum("n").alias("n")).collect()}
    assert counts == {level: (1 << level, 540) for level in range(6)}


@pytest.mark.parametrize(
    "edit",
    [
        lambda df: df.withColumn("name", F.when(F.col("id") == 77, "other").otherwise(F.col("name"))),
        lambda df: df.withColumn("name", F.when(F.col("id") == 75, "").otherwise(F.col("name"))),  # null to empty
        lambda df: df.where("id <> 77"),
        lambda df: df.unionByName(df.where("id = 77")),
        lambda df: df.withColumn("amount", F.col("amount").cast("float")),  # a type is part of a row
    ],
)
def test_an_edited_row_is_located(people, edit):
    other = edit(people)
    diff = evidence.changed_nodes(evidence.merkle_tree(people, 5), evidence.merkle_tree(other, 5)).collect()
    assert any(d["level"] == 0 for d in diff)
    leaves = [d["node"] for d in diff if d["level"] == 5]
    for d in diff:  # changed nodes are the paths to changed leaves
        assert any(leaf >> (5 - d["level"]) == d["node"] for leaf in leaves)
    if other.schema == people.schema:
        assert len(leaves) <= 2
        buckets = people.sparkSession.createDataFrame([(n,) for n in leaves], "node long")
        seen = evidence.rows_of_buckets(people, buckets, 5).unionByName(evidence.rows_of_buckets(other, buckets, 5))
        assert seen.where("id in (75, 77)").count() > 0 and seen.count() < 200


def test_tree_of_an_empty_table(people):
    empty = evidence.merkle_tree(people.where("false"), 2).collect()
    assert len(empty) == 7 and all(r["n"] == 0 for r in empty)


@pytest.fixture(scope="module")
def log(spark):
    return evidence.numbered(spark.createDataFrame([(t % 90, i, f"did {t}") for i, t in enumerate(range(1000, 2050))], "at long, id long, what string").repartition(6), ["at", "id"])


def test_entries_are_numbered_in_order(log):
    rows = log.orderBy("sequence").collect()
    assert [r["sequence"] for r in rows] == list(range(1050)) and rows == sorted(rows, key=lambda r: (r["at"], r["id"]))


def test_log_blocks_and_root(log):
    blocks = evidence.log_blocks(log, "sequence", 100)
    listed = blocks.orderBy("block").collect()
    assert [(b["block"], b["n"], b["first"], b["last"]) for b in listed] == [(k, 100 if k < 10 else 50, 100 * k, min(100 * k + 99, 1049)) for k in range(11)]
    again = evidence.log_blocks(log.repartition(2), "sequence", 100)
    assert sorted(listed) == sorted(again.collect()) and evidence.damaged_blocks(blocks, log, "sequence", 100).count() == 0
    roots = {evidence.log_root(evidence.log_blocks(df, "sequence", 100), fan).first()["root"] for df in (log, log.repartition(3)) for fan in (4,)}
    assert len(roots) == 1
    cut = evidence.log_root(evidence.log_blocks(log.where("sequence < 1000"), "sequence", 100), 4).first()
    assert cut["root"] not in roots and cut["n_entries"] == 1000


@pytest.mark.parametrize(
    ("damage", "want"),
    [
        (lambda df: df.where("sequence <> 321"), [(3, "missing")]),
        (lambda df: df.withColumn("what", F.when(F.col("sequence") == 321, "nothing").otherwise(F.col("what"))), [(3, "changed")]),
        (lambda df: df.where("sequence not between 300 and 399"), [(3, "missing")]),
        (lambda df: df.where("sequence < 900"), [(9, "missing"), (10, "missing")]),
        (lambda df: df.unionByName(df.where("sequence = 5")), [(0, "added")]),
        # Two entries change places.
        (lambda df: df.withColumn("sequence", F.when(F.col("sequence") == 110, 111).when(F.col("sequence") == 111, 110).otherwise(F.col("sequence"))), [(1, "changed")]),
    ],
)
def test_damage_to_a_log_is_located(log, damage, want):
    kept = evidence.log_blocks(log, "sequence", 100)
    assert sorted(map(tuple, evidence.damaged_blocks(kept, damage(log), "sequence", 100).collect())) == want


def test_a_link_binds_the_block_before(log):
    kept = {b["block"]: b["link"] for b in evidence.log_blocks(log, "sequence", 100).collect()}
    other = {b["block"]: b["link"] for b in evidence.log_blocks(log.where("sequence <> 321"), "sequence", 100).collect()}
    assert {k for k in kept if kept[k] != other[k]} == {3, 4}


# Anonymity


def test_groups_are_large_and_no_row_is_lost(spark):
    r = random.Random(7)
    rows = [(i, 3 if i % 3 == 0 else r.randint(0, 30), r.gauss(100, 40), r.choice([1, 1, 1, 2])) for i in range(800)] + [(900, None, 1.0, 1), (901, 2, None, 1)]
    df = spark.createDataFrame(rows, "id long, a int, b double, c int").repartition(5)
    for k in (2, 7, 300, 801):
        grouped = mondrian.mondrian(df, ["a", "b", "c"], k, 14).collect()
        sizes = Counter(g["_group"] for g in grouped if g["_group"] is not None)
        assert len(grouped) == 802 and sum(sizes.values()) == 800 and min(sizes.values()) >= min(k, 800)
        assert {g["id"] for g in grouped if g["_group"] is None} == {900, 901}
        if k < 400:
            assert max(sizes.values()) < 800  # something was cut
    few = {g["id"]: g["_group"] for g in mondrian.mondrian(df, ["a", "b", "c"], 7, 14).collect()}
    again = {g["id"]: g["_group"] for g in mondrian.mondrian(df.repartition(2).orderBy("b"), ["a", "b", "c"], 7, 14).collect()}
    assert few == again
    # Closed groups really cannot be cut at the median of any column.
    by_group = {}
    for row in rows[:800]:
        by_group.setdefault(few[row[0]], []).append(row)
    for members in by_group.values():
        for column in (1, 2, 3):
            values = sorted(m[column] for m in members)
            left = sum(v <= values[(len(values) - 1) // 2] for v in values)
            assert left < 7 or len(values) - left < 7


def test_published_ranges_hold_their_rows(spark):
    df = spark.createDataFrame([(i, i % 13, float(i % 50)) for i in range(200)], "id long, a int, b double")
    grouped = mondrian.mondrian(df, ["a", "b"], 5, 10)
    both = grouped.join(mondrian.generalised(grouped, ["a", "b"]), "_group")
    assert both.where("a between a_low and a_high and b between b_low and b_high and n >= 5").count() == 200
    assert mondrian.mondrian(df.where("false"), ["a", "b"], 5, 3).count() == 0


def test_cuts_go_on_until_no_group_can_be_cut(spark, tmp_path):
    r = random.Random(3)
    rows = [(i, r.choice(["A", "B", "C"]), r.randint(0, 24), r.randint(-99_999, 999_999) / 100) for i in range(45_000)]
    customer = spark.createDataFrame(rows, "c_custkey long, c_mktsegment string, c_nationkey int, c_acctbal double").coalesce(1)
    customer.write.parquet(str(tmp_path / "customer.parquet"))
    published = {g["cuts"]: g["n"] for g in trust.g2_mondrian(spark, str(tmp_path)).collect()}
    # A group of ten different balances can be halved, which takes more than twelve rounds here.
    assert max(map(len, published)) > 12 and sum(published.values()) == 45_000 and 5 <= min(published.values()) and max(published.values()) < 12
    con = duckdb.connect()
    con.execute(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet/*.parquet'")
    assert published == {row[0]: row[1] for row in con.sql(trust.ORACLES["g2_mondrian"]).fetchall()}
    cuts = trust.g2_suppressed(spark, str(tmp_path)).where("method = 'cuts'").first()
    assert (cuts["suppressed"], cuts["n_groups"], cuts["least"]) == (0, len(published), min(published.values()))


def test_cuts_by_one_task_are_those_of_all_tasks(spark):
    r = random.Random(5)
    rows = [(i, r.choice([0, 0, 0, 1, 7]), round(r.gauss(0, 3), 1), r.choice([None, 1.5, 2.5, float("nan")]) if i % 9 == 0 else 2.0) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, a int, b double, c double")
    for columns, rounds in ((["a", "b"], None), (["a", "b", "c"], 3)):
        one, all_ = (mondrian.mondrian(df, columns, 20, rounds, local_rows) for local_rows in (1000, 60))
        assert {g["id"]: g["_group"] for g in one.collect()} == {g["id"]: g["_group"] for g in all_.collect()}


# Offsets


def test_covered_and_advanced():
    assert offsets.covered([(1, 5), (3, 4), (6, 6), (9, 9)]) == [(1, 2, 1), (3, 4, 2), (5, 6, 1), (9, 9, 1)]
    following, missing, rows = offsets.advanced(None, [], [(5, 6), (9, 9), (6, 6)], 10)
    assert (following, missing) == (10, [[7, 8, 10]]) and rows == [("gap", 7, 8, 1), ("repeat", 6, 6, 1)]
    following, missing, rows = offsets.advanced(following, missing, [(8, 8), (8, 8), (12, 13), (4, 4)], 20)
    assert (following, missing) == (14, [[7, 7, 10], [10, 11, 20]])
    assert rows == [("gap", 10, 11, 1), ("late", 8, 8, 1), ("repeat", 4, 4, 1), ("repeat", 8, 8, 1)]


def test_rows_of_offsets_do_not_depend_on_how_ranges_are_cut():
    r = random.Random(3)
    for _ in range(200):
        state, plain = (None, []), (None, [])
        for now in range(4):
            batch = [r.randint(0, 40) for _ in range(r.randint(1, 15))]
            cut = [(a, a) for a in batch]
            whole = [(a, b) for a, b, times in offsets.covered(cut) for _ in range(times)]
            *state, rows = offsets.advanced(*state, cut, now)
            *plain, other = offsets.advanced(*plain, whole, now)
            assert (state, rows) == (plain, other)
            held = {o for a, b, _ in state[1] for o in range(a, b + 1)}
            assert all(o < state[0] and o not in batch for o in held)


def test_many_gaps_are_walked_once():
    n = 30_000
    start = time.time()
    following, missing, rows = offsets.advanced(None, [], [(4 * i, 4 * i + 1) for i in range(n)], 10)
    assert following == 4 * n - 2 and len(missing) == n - 1
    # The first half of each gap comes late, and all but the last run come again.
    batch = [(4 * i, 4 * i + 2) for i in range(n - 1)]
    following, missing, rows = offsets.advanced(following, missing, batch, 20)
    assert missing == [[4 * i + 3, 4 * i + 3, 10] for i in range(n - 1)]
    assert rows == [("late", 4 * i + 2, 4 * i + 2, 1) for i in range(n - 1)] + [("repeat", 4 * i, 4 * i + 1, 1) for i in range(n - 1)]
    assert time.time() - start < 20


def test_offsets_on_a_stream(spark, tmp_path):
    schema = "topic string, partition int, offset long, timestamp timestamp"
    landings = [
        [("t", 0, o) for o in (10, 11, 11, 15, 13)] + [("t", 1, 0), ("u", 0, 5)],
        [("t", 0, o) for o in (12, 16, 10)] + [("t", 1, 4)],
        [("t", 0, 17), ("t", 1, 5)],
        [("t", 0, 18)],
        [("t", 0, 14)],
    ]
    out, checkpoint, bus = (str(tmp_path / p) for p in ("out", "checkpoint", "bus"))
    found = []
    for day, rows in enumerate(landings):
        frame = spark.createDataFrame([(*r, None) for r in rows], schema).withColumn("timestamp", F.lit(f"2024-01-0{day + 1}").cast("timestamp"))
        frame.repartition(3).write.mode("append").parquet(bus)
        jobs.run_available(offsets.track_offsets(jobs.stream_files(spark, bus, frame.schema), "36 hours"), out, checkpoint)
        now = sorted(tuple(r) for r in spark.read.parquet(out).drop("batch").select("topic", "partition", "kind", "first", "last", "times").collect())
        found.append(sorted((Counter(now) - Counter(x for part in found for x in part)).elements()))
    assert found[0] == [("t", 0, "gap", 12, 12, 1), ("t", 0, "gap", 14, 14, 1), ("t", 0, "repeat", 11, 11, 1)]
    assert found[1] == [("t", 0, "late", 12, 12, 1), ("t", 0, "repeat", 10, 10, 1), ("t", 1, "gap", 1, 3, 1)]
    assert found[2] == [("t", 0, "lost", 14, 14, 1)]  # noticed on the first day, given up when the third is seen
    assert found[3] == [("t", 1, "lost", 1, 3, 1)]
    assert found[4] == [("t", 0, "repeat", 14, 14, 1)]  # too late: it was lost


# Volume


def test_stored_bytes_of_a_tree(spark, tmp_path):
    path = str(tmp_path / "tree")
    for name, lines in (("a", ["one", "zwölf"]), ("b", []), ("c/d", ["x" * 1000])):
        os.makedirs(os.path.dirname(f"{path}/{name}"), exist_ok=True)
        with open(f"{path}/{name}.txt", "w", encoding="utf-8") as file:
            file.writelines(f"{line}\n" for line in lines)
    df = spark.read.option("recursiveFileLookup", "true").text(path)
    sizes = {os.path.basename(r["path"]): r["length"] for r in profiling.file_sizes(df).collect()}
    assert sizes == {"a.txt": 11, "d.txt": 1001}  # a file without rows is seen by no scan
    dated = df.withColumn("ts", F.lit("2024-01-01").cast("timestamp"))
    report = {r["measure"]: r["value"] for r in profiling.five_v(dated, "ts", F.lit(True), profiling.file_sizes(df)).collect()}
    assert report["volume_bytes"] == 1012 and report["volume_rows"] == 3 and math.isclose(report["value_used_share"], 1)


# Entry


def test_the_rest_works_without_the_training_data_folder(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as e, json; print('NAMES', json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"
    hide = "import importlib.util as u; f = u.find_spec; u.find_spec = lambda n, *a: None if n.startswith('millrace.llm') else f(n, *a); "
    said = subprocess.run([sys.executable, "-c", hide + code], cwd=root, capture_output=True, text=True, timeout=120, check=True).stdout
    names, oracles = json.loads(said.split("NAMES", 1)[1])
    assert "a4_word_count" in names and set(oracles) <= set(names) and not [n for n in names if n == "pipeline" or n.startswith("op")]
