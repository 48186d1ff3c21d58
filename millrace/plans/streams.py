"""Streams over the events table. Each result equals that of the batch query beside it."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.session import scratch_dir, setting, settle, table
from millrace.sources.tabular import to_envelope
from millrace.streaming import jobs, offsets

FORMAT = "yyyy-MM-dd HH:mm:ss"


def _source(sf_dir: str) -> str:
    """A glob, so that the table may be one file or a folder of files."""
    return f"{sf_dir}/events.parque[t]"


def _schema(spark, sf_dir):
    return table(spark, sf_dir, "events").schema


def _drain(spark, sf_dir, build, label):
    return jobs.drain(spark, _source(sf_dir), _schema(spark, sf_dir), "ts", build, label)


def s8_stream_files(spark, sf_dir):
    out, checkpoint = scratch_dir(spark, "files-out"), scratch_dir(spark, "files-checkpoint")
    stream = jobs.stream_files(spark, _source(sf_dir), _schema(spark, sf_dir))
    jobs.run_available(stream.select("event_id", "user_id", "value"), out, checkpoint)
    return spark.read.parquet(out).drop("batch")


LANDINGS, LANES = 3, 4


def _arrivals(spark, sf_dir):
    """Event records as a bus delivers them, by rule: landing after landing, with some dropped, late, doubled or sent again.

    An event's offset grows with its id within one of four partitions. The last landing repeats the second one, as a replay would.
    """
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    offset = F.call_function("div", F.col("event_id"), F.lit(LANES))
    size = events.agg(F.call_function("div", F.call_function("div", F.max("event_id"), F.lit(LANES)), F.lit(LANDINGS)) + 1).scalar()
    rows = events.withColumn("o", offset).where("o % 97 <> 13").withColumn("home", F.call_function("div", F.col("o"), size))
    late, again, double = (F.col("o") % m == r for m, r in ((89, 7), (83, 5), (79, 3)))
    nothing = F.array().cast("array<bigint>")
    first = F.col("home") + late.cast("int")
    times = F.concat(F.array(first), F.when(double, F.array(first)).otherwise(nothing), F.when(again, F.array(F.col("home") + 1)).otherwise(nothing))
    landed = rows.select("event_id", "event_type", "value", "o", F.explode(times).alias("landing"))
    return landed.unionByName(landed.where("landing = 1").withColumn("landing", F.lit(LANDINGS + 1).cast("long")))


def s9_track_offsets(spark, sf_dir):
    """Gaps, late arrivals, repeats and losses of each partition; the job stops after each landing and is started again from its checkpoint."""
    out, checkpoint, bus = (scratch_dir(spark, f"offsets-{p}") for p in ("out", "checkpoint", "bus"))
    arrivals = settle(_arrivals(spark, sf_dir), "arrivals")
    for landing in range(LANDINGS + 2):
        rows = arrivals.where(F.col("landing") == landing)
        when = F.lit(f"2024-01-0{landing + 1} 00:00:00").cast("timestamp")
        records = to_envelope(rows, "events", F.col("event_id"), F.col("event_id") % LANES, F.col("o"), when)
        records.write.mode("append").parquet(bus)
        stream = jobs.stream_files(spark, bus, records.schema)
        jobs.run_available(offsets.track_offsets(stream, "36 hours"), out, checkpoint)
    return spark.read.schema(f"{offsets.SCHEMA}, batch int").parquet(out).select("partition", "kind", "first", "last", "times")


def t1_tumbling_counts(spark, sf_dir):
    result, _ = _drain(spark, sf_dir, lambda s: jobs.tumbling_counts(s, "ts", "event_type", "1 day", "1 hour"), "tumbling")
    return result.select(F.date_format("start", FORMAT).alias("start"), "event_type", "n")


def t2_sliding_sums(spark, sf_dir):
    result, _ = _drain(spark, sf_dir, lambda s: jobs.sliding_sums(s, "ts", "value", "1 day", "6 hours", "1 hour"), "sliding")
    return result.select(F.date_format("start", FORMAT).alias("start"), F.col("total").cast("double").alias("total"), "n")


def t3_sessions(spark, sf_dir):
    with setting(spark, jobs.LOCAL_SESSIONS_CONF, "true"):
        result, _ = _drain(spark, sf_dir, lambda s: jobs.sessions(s, "ts", "user_id", "2 hours", "1 hour"), "sessions")
    return result.select(
        "user_id", F.date_format("start", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("start"), F.date_format("end", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("end"), "n"
    )


def t4_drop_duplicates(spark, sf_dir):
    """The whole table arrives twice; each event is kept once."""
    out, checkpoint = scratch_dir(spark, "dedup-out"), scratch_dir(spark, "dedup-checkpoint")
    schema = _schema(spark, sf_dir)
    twice = jobs.stream_files(spark, _source(sf_dir), schema).unionByName(jobs.stream_files(spark, _source(sf_dir), schema))
    jobs.run_available(jobs.drop_duplicates(twice, "ts", "event_id", "40 days"), out, checkpoint)
    return spark.read.parquet(out).select("event_id", "user_id", "event_type", "value")


def t5_late_rows(spark, sf_dir):
    """Events come once, then all come again when the watermark has passed them: all of the second are late."""
    out, checkpoint, again = (scratch_dir(spark, f"late-{p}") for p in ("out", "checkpoint", "again"))
    events, schema = table(spark, sf_dir, "events"), _schema(spark, sf_dir)
    spark.createDataFrame([], schema).write.parquet(again)

    def query():
        rows = jobs.stream_files(spark, _source(sf_dir), schema).unionByName(jobs.stream_files(spark, again, schema))
        return jobs.with_event_time(rows, "ts", "0 seconds").dropDuplicatesWithinWatermark(["event_id"])

    runs = [jobs.run_available(query(), out, checkpoint)]
    # A second arrival of every event, none of them newer than the watermark.
    events.write.mode("append").parquet(again)
    runs.append(jobs.run_available(query(), out, checkpoint))
    return jobs.late_rows(spark, runs).groupBy("run").agg(F.sum("input_rows").alias("input_rows"), F.sum("late_dropped").alias("late_dropped"))


def t6_running_counts(spark, sf_dir):
    out, checkpoint = scratch_dir(spark, "counts-out"), scratch_dir(spark, "counts-checkpoint")
    with setting(spark, jobs.STATE_STORE_CONF, jobs.ROCKSDB):
        stream = jobs.stream_files(spark, _source(sf_dir), _schema(spark, sf_dir))
        jobs.run_available(jobs.running_counts(stream, "user_id"), out, checkpoint, "update")
    lanes = jobs.latest(spark.read.parquet(out), ["key", "lane"], "n")
    return lanes.groupBy(F.col("key").alias("user_id")).agg(F.sum("n").alias("n"))


def t7_enrich(spark, sf_dir):
    out, checkpoint = scratch_dir(spark, "enrich-out"), scratch_dir(spark, "enrich-checkpoint")
    stream = jobs.stream_files(spark, _source(sf_dir), _schema(spark, sf_dir)).select("event_id", "user_id", "value")
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment", "c_nationkey")
    jobs.run_available(jobs.enrich(stream, customer, "user_id"), out, checkpoint)
    return spark.read.parquet(out).drop("batch")


def t8_idempotent_sink(spark, sf_dir):
    """The same batch is delivered twice, as after a lost commit; the table holds it once."""
    out = scratch_dir(spark, "sink-out")
    for attempt in range(2):
        stream = jobs.stream_files(spark, _source(sf_dir), _schema(spark, sf_dir))
        jobs.run_available(stream.select("event_id", "event_type", "value"), out, scratch_dir(spark, f"sink-checkpoint-{attempt}"))
    return spark.read.parquet(out).groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("n_events"))


QUERIES = {
    f.__name__: f
    for f in (
        s8_stream_files, s9_track_offsets, t1_tumbling_counts, t2_sliding_sums, t3_sessions, t4_drop_duplicates, t5_late_rows,
        t6_running_counts, t7_enrich, t8_idempotent_sink,
    )
}

_TRACKED = f"""WITH e AS (SELECT CAST(event_id % {LANES} AS INTEGER) AS p, event_id // {LANES} AS o, (event_id // {LANES}) // ((SELECT max(event_id) FROM events) // {LANES} // {LANDINGS} + 1) AS home FROM events WHERE (event_id // {LANES}) % 97 <> 13),
        a AS (SELECT p, o, home + CASE WHEN o % 89 = 7 THEN 1 ELSE 0 END AS l FROM e UNION ALL SELECT p, o, home + CASE WHEN o % 89 = 7 THEN 1 ELSE 0 END FROM e WHERE o % 79 = 3
          UNION ALL SELECT p, o, home + 1 FROM e WHERE o % 83 = 5),
        b AS (SELECT * FROM a UNION ALL SELECT p, o, {LANDINGS + 1} FROM a WHERE l = 1),
        f AS (SELECT p, o, l, count(*) AS times FROM b GROUP BY p, o, l), c AS (SELECT *, min(l) OVER (PARTITION BY p, o) AS came FROM f),
        z AS (SELECT p, l, min(o) AS low, max(o) AS high FROM c GROUP BY p, l),
        t AS (SELECT *, max(high) OVER (PARTITION BY p ORDER BY l ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 AS following FROM z),
        g AS (SELECT p, l, unnest(range(coalesce(following, low), high)) AS o FROM t WHERE high >= coalesce(following, low)),
        h AS (SELECT p, l, o FROM g WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.p = g.p AND c.l = g.l AND c.o = g.o)),
        n AS (SELECT c.*, o >= coalesce(following, low) AS fresh, EXISTS (SELECT 1 FROM h WHERE h.p = c.p AND h.o = c.o AND h.l < c.l) AND came = c.l AS late FROM c JOIN t USING (p, l)),
        x AS (SELECT 'gap' AS kind, p, l, o, 1 AS times FROM h UNION ALL SELECT 'late', p, l, o, 1 FROM n WHERE late
          UNION ALL SELECT 'repeat', p, l, o, times - CASE WHEN fresh OR late THEN 1 ELSE 0 END FROM n WHERE times > CASE WHEN fresh OR late THEN 1 ELSE 0 END
          UNION ALL SELECT 'lost', p, l, o, 1 FROM h WHERE l <= {LANDINGS - 1} AND NOT EXISTS (SELECT 1 FROM c WHERE c.p = h.p AND c.o = h.o AND c.l > h.l)),
        y AS (SELECT *, o - row_number() OVER (PARTITION BY kind, p, l, times ORDER BY o) AS run FROM x)
        SELECT p AS partition, kind, CAST(min(o) AS BIGINT) AS first, CAST(max(o) AS BIGINT) AS last, CAST(times AS BIGINT) AS times FROM y GROUP BY kind, p, l, times, run"""

ORACLES = {
    "s9_track_offsets": _TRACKED,
    "s8_stream_files": "SELECT event_id, user_id, value FROM events",
    "t1_tumbling_counts": "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "t2_sliding_sums": """SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS start, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS n
        FROM (SELECT value, time_bucket(INTERVAL 6 HOURS, ts) - to_hours(6 * k) AS s FROM events, range(4) AS r(k)) GROUP BY 1""",
    "t3_sessions": """WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 2 HOURS THEN 0 ELSE 1 END AS fresh
          FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
        s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS number FROM g)
        SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS start, strftime(max(ts) + INTERVAL 2 HOURS, '%Y-%m-%d %H:%M:%S.%f') AS "end",
          count(*) AS n FROM s GROUP BY user_id, number""",
    "t4_drop_duplicates": "SELECT event_id, user_id, event_type, value FROM events",
    "t5_late_rows": """SELECT 0 AS run, count(*) AS input_rows, CAST(0 AS BIGINT) AS late_dropped FROM events
        UNION ALL SELECT 1, count(*), count(*) FILTER (date_trunc('millisecond', ts) < (SELECT date_trunc('millisecond', max(ts)) FROM events)) FROM events""",
    "t6_running_counts": "SELECT user_id, count(*) AS n FROM events GROUP BY user_id",
    "t7_enrich": "SELECT event_id, user_id, value, c_mktsegment, c_nationkey FROM events LEFT JOIN customer ON user_id = c_custkey",
    "t8_idempotent_sink": "SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS n_events FROM events GROUP BY event_type",
}
