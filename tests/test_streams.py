"""Streams that arrive in parts, restart and repeat."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.session import scratch_dir, setting
from millrace.streaming import jobs

SCHEMA = "id long, ts timestamp_ntz, user string, v double"


def land(spark, path, rows):
    base = dt.datetime(2024, 1, 1)
    data = [(i, base + dt.timedelta(minutes=m), u, float(i)) for i, m, u in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def places(spark):
    return [scratch_dir(spark, name) for name in ("in", "out", "ck")]


def test_duplicates_across_restarts(spark, places):
    source, out, ck = places
    land(spark, source, [(i % 3, i, "a") for i in range(60)])
    jobs.run_available(jobs.drop_duplicates(jobs.stream_files(spark, source, SCHEMA), "ts", "id", "1 day"), out, ck)
    land(spark, source, [(1, 70, "a"), (5, 71, "a")])
    jobs.run_available(jobs.drop_duplicates(jobs.stream_files(spark, source, SCHEMA), "ts", "id", "1 day"), out, ck)
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [0, 1, 2, 5]


def test_duplicates_are_those_of_the_plain_operator(spark):
    parts = [[(1, 0, "a")], [(1, 22 * 60, "a")] * 30 + [(2, 22 * 60, "a")], [(9, 49 * 60, "a")], [(9, 49 * 60, "a")], [(1, 36 * 60, "a"), (2, 37 * 60, "a")]]

    def kept(build):
        source, out, ck = (scratch_dir(spark, name) for name in ("in", "out", "ck"))
        for part in parts:
            land(spark, source, part)
            jobs.run_available(build(jobs.stream_files(spark, source, SCHEMA)), out, ck)
        return sorted((r["id"], r["ts"]) for r in spark.read.parquet(out).collect())

    plain = kept(lambda s: jobs.with_event_time(s, "ts", "1 day").dropDuplicatesWithinWatermark(["id"]))
    assert [i for i, _ in plain] == [1, 1, 2, 9]
    assert kept(lambda s: jobs.drop_duplicates(s, "ts", "id", "1 day")) == plain


def test_state_survives_a_restart(spark, places):
    source, out, ck = places
    with setting(spark, jobs.STATE_STORE_CONF, jobs.ROCKSDB):
        for rows in ([(1, 1, "hot")] * 50 + [(2, 2, "cold")], [(3, 3, "hot")] * 7):
            land(spark, source, rows)
            jobs.run_available(jobs.running_counts(jobs.stream_files(spark, source, SCHEMA), "user", lanes=4), out, ck, "update")
    lanes = jobs.latest(spark.read.parquet(out), ["key", "lane"], "n")
    got = {r["key"]: r["n"] for r in lanes.groupBy("key").agg(F.sum("n").alias("n")).collect()}
    assert got == {"hot": 57, "cold": 1}


def test_only_busy_keys_have_many_states(spark, places):
    source, out, ck = places
    rows = [(i, i, f"user {i % 50}") for i in range(1000)]
    with setting(spark, jobs.STATE_STORE_CONF, jobs.ROCKSDB):
        for part in (rows + [(i, i, "hot") for i in range(5000)], rows + [(1, 1, None)]):
            land(spark, source, part)
            jobs.run_available(jobs.running_counts(jobs.stream_files(spark, source, SCHEMA), "user"), out, ck, "update")
    lanes = jobs.latest(spark.read.parquet(out), ["key", "lane"], "n").collect()
    assert sorted((r["key"], r["lane"], r["n"]) for r in lanes if r["key"] not in (None, "hot")) == sorted((f"user {i}", 0, 40) for i in range(50))
    assert sum(r["n"] for r in lanes if r["key"] == "hot") == 5000 and sum(r["n"] for r in lanes if r["key"] is None) == 1


def test_late_rows_are_counted(spark, places):
    source, out, ck = places
    build = lambda: jobs.tumbling_counts(jobs.stream_files(spark, source, SCHEMA), "ts", "user", "1 hour", "10 minutes")
    land(spark, source, [(1, 0, "a"), (2, 300, "a")])
    first = jobs.run_available(build(), out, ck)
    land(spark, source, [(3, 5, "a"), (4, 310, "a")])
    second = jobs.run_available(build(), out, ck)
    report = jobs.late_rows(spark, [first, second]).groupBy("run").agg(F.sum("late_dropped").alias("n")).collect()
    assert {r["run"]: r["n"] for r in report} == {0: 0, 1: 1}
    assert [(r["user"], r["n"]) for r in spark.read.parquet(out).select("user", "n").collect()] == [("a", 1)]


def test_late_rows_of_more_batches_than_a_query_remembers(spark, places):
    source, out, ck = places
    with setting(spark, "spark.sql.streaming.numRecentProgressUpdates", "2"):
        land(spark, source, [(1, 9000, "a")])
        build = lambda: jobs.with_event_time(jobs.stream_files(spark, source, SCHEMA, 1), "ts", "10 minutes").dropDuplicatesWithinWatermark(["id"])
        first = jobs.run_available(build(), out, ck)
        for i in range(5):
            land(spark, source, [(10 + i, i, "a")])
        second = jobs.run_available(build(), out, ck)
    report = jobs.late_rows(spark, [first, second]).groupBy("run").agg(F.sum("input_rows").alias("rows"), F.sum("late_dropped").alias("n")).collect()
    assert {r["run"]: (r["rows"], r["n"]) for r in report} == {0: (1, 0), 1: (5, 5)}


def test_sessions_merge_and_split(spark, places):
    source = places[0]
    land(spark, source, [(1, 0, "a"), (2, 100, "a"), (3, 230, "a"), (4, 1, "b")])
    schema = spark.read.parquet(source).schema
    got, _ = jobs.drain(spark, source, schema, "ts", lambda s: jobs.sessions(s, "ts", "user", "2 hours", "1 hour"), "s")
    assert sorted((r["user"], r["n"]) for r in got.collect()) == [("a", 1), ("a", 2), ("b", 1)]


def test_file_order_does_not_matter(spark, places):
    source = places[0]
    for day in (5, 1, 3):
        land(spark, source, [(day, day * 1440, "a")])
    schema = spark.read.parquet(source).schema
    got, runs = jobs.drain(spark, source, schema, "ts", lambda s: jobs.tumbling_counts(s, "ts", "user", "1 day", "1 hour"), "t")
    assert got.count() == 3
    assert jobs.late_rows(spark, runs).agg(F.sum("late_dropped")).first()[0] == 0


def test_a_batch_replaces_itself(spark, places):
    out = places[1]
    write = jobs.into_folder(out)
    for _ in range(2):
        write(spark.range(5), 0)
    write(spark.range(2), 1)
    assert spark.read.parquet(out).count() == 7
