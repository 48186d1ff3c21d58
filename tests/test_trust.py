"""Privacy, evidence, sketches and per-group Python."""

import hashlib
import hmac
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import groups, logs, privacy, profiling, sketches
from millrace.operators.privacy import Linked
from millrace.operators.relational import word_count
from millrace.session import setting


def test_fingerprint_ignores_order_but_no_edit(spark):
    df = spark.range(200).select("id", (F.col("id") * 2).alias("v"), F.when(F.col("id") % 5 == 0, None).otherwise("x").alias("s"))
    base = privacy.fingerprint(df).first()
    assert privacy.fingerprint(df.repartition(7).orderBy(F.desc("id")).select("s", "v", "id")).first() == base
    for edited in (df.where("id <> 3"), df.withColumn("v", F.when(F.col("id") == 9, 0).otherwise(F.col("v"))), df.fillna(""), df.union(df.limit(1)), df.withColumnRenamed("v", "w"), df.withColumn("v", F.col("v").cast("int"))):
        assert privacy.fingerprint(edited).first() != base


def test_pseudonyms_join_and_depend_on_the_key(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "id long, n string")
    one, two = privacy.pseudonymize(a, ["id", "n"], "k1"), privacy.pseudonymize(a, ["id", "n"], "k2")
    assert one.join(privacy.pseudonymize(a, ["id"], "k1").withColumnRenamed("n", "m"), "id").count() == 2
    assert one.join(two, "id").count() == 0
    assert one.where("n is null").count() == 1
    for key in ("k", "k" * 100):
        name = privacy.pseudonymize(a, ["n"], key).where("id = 1").first()["n"]
        assert name == hmac.new(key.encode(), b"x", hashlib.sha256).hexdigest()


def test_the_key_comes_from_the_session(spark):
    with pytest.raises(ValueError):
        privacy.pseudonym_key(spark)
    with setting(spark, privacy.PSEUDONYM_KEY_CONF, "abc"):
        assert privacy.pseudonym_key(spark) == "abc"


def test_small_groups_are_suppressed(spark):
    df = spark.createDataFrame([("a", 1)] * 5 + [("b", 1)] * 2 + [(None, 1)] * 3, "q string, v int")
    got = privacy.anonymize(df, {"q": F.col("q")}, 3).groupBy("q").count().collect()
    assert {r["q"]: r["count"] for r in got} == {"a": 5, None: 3}


def test_erasure_reaches_the_leaves(spark):
    people = spark.createDataFrame([(1,), (2,)], "p long")
    orders = spark.createDataFrame([(10, 1), (11, 2), (12, None)], "o long, p long")
    lines = spark.createDataFrame([(10,), (10,), (11,)], "o long")
    tables = {"people": Linked(people, "p"), "orders": Linked(orders, "p", "people", "p"), "lines": Linked(lines, "o", "orders", "o")}
    kept, proof = privacy.erase_subjects(tables, spark.createDataFrame([(1,), (1,)], "id long"), "id")
    assert {r["table"]: tuple(r)[1:] for r in proof.collect()} == {"people": (2, 1, 0), "orders": (3, 1, 0), "lines": (3, 2, 0)}
    assert kept["orders"].count() == 2 and [r["o"] for r in kept["lines"].collect()] == [11]


def test_only_affected_partitions_are_rewritten(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (1, "c")], "id long, part string")
    path = str(tmp_path / "out")
    affected = privacy.rewrite_affected(df, "id", spark.createDataFrame([(1,)], "i long"), "i", "part", path)
    assert sorted(tuple(r) for r in affected.collect()) == [("a", 2, 1), ("c", 1, 0)]
    assert [(r["id"], r["part"]) for r in spark.read.parquet(path).collect()] == [(2, "a")]


def test_consents_in_force(spark):
    events = spark.createDataFrame([(1, 5), (1, 10), (1, 20), (2, 5)], "u long, t long")
    consents = spark.createDataFrame([(1, 5, 10), (1, 4, 6), (1, 20, None)], "subject long, valid_from long, valid_to long")
    got = privacy.consent_filter(events, "u", "t", consents).collect()
    assert sorted(tuple(r) for r in got) == [(1, 5), (1, 20)]


def test_roles_see_what_they_may(spark):
    df = spark.createDataFrame([(1, "Ann-7", 2.5), (2, "Bob", 3.5)], "k long, n string, x double")
    grants = spark.createDataFrame([("r", 1), ("r", 1), ("s", 2)], "role string, key long")
    policy = privacy.Policy(masked=("n",), hidden=("x",), row_key="k")
    assert [tuple(r) for r in privacy.role_view(df, "r", policy, grants).collect()] == [(1, "Xxx-n", None)]
    assert privacy.role_view(df, "t", policy, grants).count() == 0


def test_redaction_covers_the_whole_text(spark):
    text = "x " * 50_000 + "mail a.b@c.org or 10.0.0.1 card 4111111111111111 api_key = zz9"
    row = privacy.redact_text(spark.createDataFrame([(text,)], "t string"), "t").first()
    assert row["t"].endswith("mail [email] or [ipv4] card [number] [secret]")
    assert (row["n_email"], row["n_ipv4"], row["n_number"], row["n_secret"]) == (1, 1, 1, 1)


def test_synthetic_rows_do_not_depend_on_partitions(spark):
    one = privacy.synth_rows(spark.range(500), "id", 3)
    assert one.exceptAll(privacy.synth_rows(spark.range(500).repartition(13), "id", 3)).count() == 0
    assert one.exceptAll(privacy.synth_rows(spark.range(500), "id", 4)).count() > 400


def test_audit_log_grows(spark, tmp_path):
    for run in ("a", "b"):
        log = privacy.audit_log(spark.range(3), str(tmp_path / "log"), run, "me", "test")
    assert log.count() == 2 and log.select("fingerprint").distinct().count() == 1


def test_bloom_has_no_false_negatives(spark):
    members, probes = spark.range(5000), spark.range(20_000)
    tested = sketches.bloom_member(probes, "id", sketches.bloom_filter(members, "id", 4), 4)
    assert tested.where("id < 5000 and not maybe").count() == 0
    assert tested.where("id >= 5000 and maybe").count() < 300
    bloom = sketches.bloom_filter(members, "id", 4)
    assert bloom.count() == 4 and bloom.agg(F.max(F.octet_length("bits"))).first()[0] == 4096


def test_bloom_keeps_its_bound_with_many_members(spark):
    members = spark.range(1_000_000)
    blocks = sketches.bloom_blocks(1_000_000, 0.01)
    bloom = sketches.bloom_filter(members, "id", blocks)
    tested = sketches.bloom_member(spark.range(900_000, 1_100_000), "id", bloom, blocks)
    assert tested.where("id < 1000000 and not maybe").count() == 0
    assert tested.where("id >= 1000000 and maybe").count() < 1_000


def test_count_min_never_underestimates_a_hot_item(spark):
    items = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("x"))
    table = sketches.count_min(items, "x", 4, 512)
    assert table.count() <= 4 * 512
    estimate = sketches.count_min_estimate(table, items.distinct(), "x", 4, 512)
    true = items.groupBy("x").count()
    off = estimate.join(true, "x").select((F.col("estimate") - F.col("count")).alias("d"))
    assert off.where("d < 0").count() == 0 and off.agg(F.avg("d")).first()[0] < 12


def test_distinct_sketches_merge(spark):
    df = spark.range(20_000).select((F.col("id") % 5000).alias("u"), (F.col("id") % 7).alias("day"))
    merged = sketches.merge_distinct(sketches.distinct_sketches(df, ["day"], "u")).first()["approx"]
    assert abs(merged - 5000) < 200


def test_group_models_match_numpy(spark):
    rng = np.random.default_rng(1)
    rows = [(g, float(a), float(b), float(3 + g * a - 2 * b + e)) for g, n in ((1, 400), (2, 30), (0, 20)) for a, b, e in rng.normal(size=(n, 3))]
    df = spark.createDataFrame(rows, "g int, a double, b double, y double").withColumn("g", F.nullif("g", F.lit(0)))
    fitted = groups.per_group_model(df, "g", ["a", "b"], "y").collect()
    assert len(fitted) == 3
    for r in fitted:
        data = np.array([x[1:] for x in rows if x[0] == (r["g"] or 0)])
        want = np.linalg.lstsq(np.c_[np.ones(len(data)), data[:, :2]], data[:, 2], rcond=None)[0]
        assert np.allclose([r["intercept"], r["a"], r["b"]], want)


def test_mapreduce_equals_word_count(spark):
    docs = spark.createDataFrame([("to be or not to be",), ("be",)], "text string")
    got = groups.mapreduce(docs, lambda t: ((w, 1) for w in re.findall("[a-z]+", t)))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, word_count(docs).collect()))
    longest = groups.mapreduce(docs, lambda t: ((w[0], len(w)) for w in t.split()), max)
    assert dict(map(tuple, longest.collect())) == {"t": 2, "b": 2, "o": 2, "n": 3}


def test_log_lines(spark):
    lines = ['10.0.0.1 - bob [01/Feb/2024:10:00:00 +0200] "GET /a?b=1 HTTP/1.1" 200 12', '1.2.3.4 - - [x] "GET / HTTP/1.0" 404 -', "junk"]
    log = logs.parse_access_log(spark.createDataFrame([(x,) for x in lines], "line string"))
    rows = log.withColumn("ts", F.date_format("ts", "HH:mm")).collect()
    assert tuple(rows[0]) == ("10.0.0.1", "08:00", "GET", "/a?b=1", 200, 12, False)
    assert tuple(rows[1]) == ("1.2.3.4", None, "GET", "/", 404, None, False)
    assert rows[2]["malformed"] and rows[2]["ip"] is None


def test_quality_gate_on_empty_and_failing_rows(spark):
    df = spark.createDataFrame([(1, 5.0), (1, None), (None, 9.0)], "k long, v double")
    rules = [profiling.NotNull("k"), profiling.InRange("v", 0, 6), profiling.Unique(("k",)), profiling.References("k", spark.range(1), "id")]
    got = {r["rule"]: (r["n_checked"], r["n_failed"]) for r in profiling.quality_gate(df, rules).collect()}
    assert got == {"not_null(k)": (3, 1), "in_range(v)": (3, 1), "unique(k)": (3, 1), "references(k)": (2, 2)}
    assert profiling.quality_gate(df.limit(0), rules).where("passed").count() == 4


def test_profile_with_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, "a"), (None, None)], "n int, s string")
    rows = {r["column"]: r for r in profiling.profile(df).collect()}
    assert (rows["n"]["n_null"], rows["n"]["n_distinct"], rows["n"]["mean"], rows["n"]["q50"]) == (2, 2, 2.0, 2.0)
    assert (rows["s"]["n_null"], rows["s"]["top"], rows["s"]["top_count"]) == (1, "a", 2)
