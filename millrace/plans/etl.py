"""Ingest, joins, aggregates, windows and reports over the star tables, events and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import logs, ordered, profiling
from millrace.operators import relational as R
from millrace.session import scratch_dir, spread, table
from millrace.sources import sinks, tabular

ORDERS_DDL = (
    "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string"
)
EVENTS_DDL = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _star(spark, sf_dir):
    return [table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "nation", "region")]


def _raw_orders_csv(spark, sf_dir):
    """Orders as raw CSV text, in which pending orders carry a price that is no number."""
    path = scratch_dir(spark, "orders-csv")
    price = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_totalprice").cast("string"))
    table(spark, sf_dir, "orders").withColumns(
        {"o_totalprice": price, "o_orderdate": F.date_format("o_orderdate", "yyyy-MM-dd")}
    ).write.option("header", True).csv(path)
    return path


def s3_read_csv(spark, sf_dir):
    rows = tabular.read_csv(spark, _raw_orders_csv(spark, sf_dir), ORDERS_DDL)
    return rows.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("string").alias("o_orderdate"),
        "o_orderpriority", F.col(tabular.CORRUPT).isNotNull().cast("int").alias("bad_row"),
    )


def s3b_infer_csv_schema(spark, sf_dir):
    return tabular.infer_csv_schema(spark, _raw_orders_csv(spark, sf_dir))


def partitioned_orders(spark, sf_dir):
    path = scratch_dir(spark, "orders-by-year")
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    sinks.write_partitioned(orders, path, ["year"])
    return spark.read.schema(orders.schema).parquet(path)


def s4_write_partitioned(spark, sf_dir):
    return partitioned_orders(spark, sf_dir).select("o_orderkey", "year", "o_totalprice", "o_orderstatus")


def s5_roundtrip_orc(spark, sf_dir):
    path, customer = scratch_dir(spark, "customer-orc"), table(spark, sf_dir, "customer")
    customer.write.orc(path)
    return tabular.read_orc(spark, path, customer.schema)


def s6_read_json(spark, sf_dir):
    path = scratch_dir(spark, "events-json")
    table(spark, sf_dir, "events").write.options(**tabular.MICROS).json(path)
    rows = tabular.read_json(spark, path, EVENTS_DDL)
    return rows.select("event_id", F.date_format("ts", TS_TEXT).alias("ts"), "user_id", "event_type", "value", "props")


def enveloped_events(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return tabular.to_envelope(
        events, "events", F.col("user_id"), F.pmod("user_id", F.lit(6)), F.col("event_id"), F.col("ts").cast("timestamp")
    )


def s9_decode_envelope(spark, sf_dir):
    rows = tabular.decode_envelope(enveloped_events(spark, sf_dir), EVENTS_DDL)
    return rows.select("key", "topic", "partition", "offset", "event_id", "user_id", "event_type", "value",
                       F.date_format("ts", TS_TEXT).alias("ts"), F.col("malformed").cast("int").alias("malformed"))


def p13_filter_rows(spark, sf_dir):
    return R.filter_rows(table(spark, sf_dir, "lineitem"), "1998-06-01 00:00:00")


def j2_join_star(spark, sf_dir):
    return R.join_star(*_star(spark, sf_dir))


def j3_enrich_left(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return R.enrich_left(docs, table(spark, sf_dir, "labels"), "doc_id")


def j4_semi_filter(spark, sf_dir):
    """Events of customers with a positive balance."""
    customer = table(spark, sf_dir, "customer").where("c_acctbal > 0").withColumnRenamed("c_custkey", "user_id")
    return R.semi_filter(table(spark, sf_dir, "events").select("user_id", "event_id", "value"), customer, "user_id")


def a3_group_agg(spark, sf_dir):
    return R.group_agg(table(spark, sf_dir, "lineitem"))


def a4_word_count(spark, sf_dir):
    return R.word_count(spread(table(spark, sf_dir, "documents"), "doc_id"))


def a4_top_words(spark, sf_dir):
    return R.top_k(R.word_count(spread(table(spark, sf_dir, "documents"), "doc_id")), "n", ["word"], 20)


# Events as access-log lines; expensive errors give lines that are no log lines.
LOG_SQL = """CASE WHEN event_type = 'error' AND value > 20 THEN concat('broken line ', CAST(event_id AS STRING)) ELSE
  concat('10.', CAST(user_id % 7 AS STRING), '.', CAST(user_id % 250 AS STRING), '.9 - - [', {clock}, ' +0000] "',
    CASE event_type WHEN 'purchase' THEN 'POST' ELSE 'GET' END, ' /', event_type, '/', CAST(user_id AS STRING), ' HTTP/1.1" ',
    CASE event_type WHEN 'error' THEN '500' WHEN 'purchase' THEN '201' WHEN 'view' THEN '304' ELSE '200' END, ' ',
    CASE event_type WHEN 'view' THEN '-' ELSE CAST(CAST(round(value * 100) AS BIGINT) AS STRING) END) END"""


def access_log(spark, sf_dir):
    clock = LOG_SQL.format(clock="date_format(ts, 'dd/MMM/yyyy:HH:mm:ss')")
    return logs.parse_access_log(table(spark, sf_dir, "events").select(F.expr(clock).alias("line")))


def a5_parse_access_log(spark, sf_dir):
    return access_log(spark, sf_dir).select(
        "ip", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "method", "path", "status", "bytes",
        F.col("malformed").cast("int").alias("malformed"),
    )


def a5_top_ips(spark, sf_dir):
    return logs.top_ips(access_log(spark, sf_dir), 10)


def a6_status_counts(spark, sf_dir):
    return logs.status_counts(access_log(spark, sf_dir))


def a7_mean_length(spark, sf_dir):
    return logs.mean_length(access_log(spark, sf_dir))


def a8_combined_counts(spark, sf_dir):
    return R.combined_counts(table(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderstatus"])


def a10_profile_orders(spark, sf_dir):
    return profiling.profile(table(spark, sf_dir, "orders"))


def a10_profile_events(spark, sf_dir):
    return profiling.profile(table(spark, sf_dir, "events"))


def a11_five_v(spark, sf_dir):
    return profiling.five_v(table(spark, sf_dir, "events"), "ts", F.col("event_type") == "purchase")


def a11_stored_volume(spark, sf_dir):
    """Rows and bytes of the documents as a tree of text files, one document a line: the bytes are what the file system says."""
    path = scratch_dir(spark, "volume")
    line = F.regexp_replace(F.coalesce("text", F.lit("")), "[\r\n]", " ")
    spread(table(spark, sf_dir, "documents"), "doc_id").select(line.alias("value")).write.text(path)
    written = spark.read.text(path)
    volume = profiling.file_sizes(written).agg(F.sum("length").alias("volume_bytes"))
    return written.agg(F.count("*").alias("volume_rows"), F.max(volume.scalar()).alias("volume_bytes"))


def a12_regular_report(spark, sf_dir):
    return R.regular_report(*_star(spark, sf_dir)[1:])


def a13_quality_gate(spark, sf_dir):
    P = profiling
    return P.quality_gate(
        table(spark, sf_dir, "lineitem"),
        [
            P.NotNull("l_orderkey"),
            P.InRange("l_discount", 0.0, 0.09),
            P.InRange("l_quantity", 1.0, 50.0),
            P.Unique(("l_orderkey", "l_linenumber")),
            P.References("l_orderkey", table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'"), "o_orderkey"),
            P.References("l_partkey", table(spark, sf_dir, "part"), "p_partkey"),
        ],
    ).withColumn("passed", F.col("passed").cast("int"))


def w1_rank_within(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return ordered.rank_within(orders, ["o_custkey"], "o_totalprice", ["o_orderkey"])


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "value")


def w2_lag_delta(spark, sf_dir):
    rows = ordered.lag_delta(_events(spark, sf_dir), ["user_id"], "ts", "event_id", "value")
    return rows.select(
        "event_id", "user_id", "prev_value", "next_value", F.round("delta", 4).alias("delta"), F.round("gap_seconds", 3).alias("gap_seconds")
    )


def w3_running_total(spark, sf_dir):
    value = R.exact(F.col("value"))
    rows = ordered.running_totals(_events(spark, sf_dir), ["user_id"], ["ts", "event_id"], {"running": value})
    return rows.select("event_id", F.col("running").cast("double").alias("running"))


def w3_moving_mean(spark, sf_dir):
    value = R.exact(F.col("value"))
    rows = ordered.over_last_rows(
        _events(spark, sf_dir), ["user_id"], ["ts", "event_id"], 4, 0, {"s": F.sum(value), "n": F.count("*")}
    )
    return rows.select("event_id", F.round(F.col("s").cast("double") / F.col("n"), 6).alias("mean5"))


def w3_trailing_week(spark, sf_dir):
    sums = {"s": R.exact(F.col("value")), "n": F.lit(1).cast("long")}
    rows = ordered.over_last_span(_events(spark, sf_dir), ["user_id"], "ts", "event_id", 7 * 86_400, sums)
    return rows.select("event_id", F.col("s").cast("double").alias("week_sum"), F.col("n").alias("week_n"))


def o2_top_k(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return R.top_k(orders, "o_totalprice", ["o_orderkey"], 25)


QUERIES = {
    f.__name__: f
    for f in (
        a4_word_count, a4_top_words, s3_read_csv, s3b_infer_csv_schema, s4_write_partitioned, s5_roundtrip_orc, s6_read_json,
        s9_decode_envelope, p13_filter_rows, j2_join_star, j3_enrich_left, j4_semi_filter, a3_group_agg,
        a5_parse_access_log, a5_top_ips, a6_status_counts, a7_mean_length, a8_combined_counts, a10_profile_orders,
        a10_profile_events, a11_five_v, a11_stored_volume, a12_regular_report, a13_quality_gate, w1_rank_within, w2_lag_delta,
        w3_running_total, w3_moving_mean, w3_trailing_week, o2_top_k,
    )
}

_LOG = "log AS (SELECT " + LOG_SQL.format(clock="strftime(ts, '%d/%b/%Y:%H:%M:%S')") + r""" AS line FROM events),
cut AS (SELECT regexp_extract(line, '^(\S+) \S+ \S+ \[([^\]]+)\] "([A-Z]+) (\S+) [^"]*" (\d{3}) (\d+|-)$',
  ['ip', 'ts', 'method', 'path', 'status', 'bytes']) AS f, NOT regexp_matches(line, '" \d{3} ') AS bad FROM log),
parsed AS (SELECT CASE WHEN NOT bad THEN f.ip END AS ip, CASE WHEN NOT bad THEN
    strftime(strptime(f.ts, '%d/%b/%Y:%H:%M:%S +0000'), '%Y-%m-%d %H:%M:%S') END AS ts,
  CASE WHEN NOT bad THEN f.method END AS method, CASE WHEN NOT bad THEN f.path END AS path,
  TRY_CAST(f.status AS INTEGER) AS status,
  TRY_CAST(f.bytes AS BIGINT) AS bytes, CAST(bad AS INTEGER) AS malformed FROM cut)"""

_D2 = "DECIMAL(18,2)"


def _profile(columns: dict[str, bool], source: str) -> str:
    parts = []
    for name, number in columns.items():
        numeric = (
            f"""CAST(min({name}) AS DOUBLE) AS min_num, CAST(max({name}) AS DOUBLE) AS max_num,
  CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text, round(avg({name}), 4) AS mean,
  round(stddev_samp({name}), 4) AS std, round(quantile_cont(CAST({name} AS DOUBLE), 0.25), 4) AS q25,
  round(quantile_cont(CAST({name} AS DOUBLE), 0.5), 4) AS q50, round(quantile_cont(CAST({name} AS DOUBLE), 0.75), 4) AS q75"""
            if number
            else f"""CAST(NULL AS DOUBLE) AS min_num, CAST(NULL AS DOUBLE) AS max_num, CAST(min({name}) AS VARCHAR) AS min_text,
  CAST(max({name}) AS VARCHAR) AS max_text, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std, CAST(NULL AS DOUBLE) AS q25,
  CAST(NULL AS DOUBLE) AS q50, CAST(NULL AS DOUBLE) AS q75"""
        )
        top = f"(SELECT CAST({name} AS VARCHAR) AS t, count(*) AS c FROM {source} WHERE {name} IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 DESC LIMIT 1)"
        parts.append(f"""SELECT '{name}' AS "column", count(*) AS n_rows, count(*) - count({name}) AS n_null,
  count(DISTINCT {name}) AS n_distinct, {numeric}, (SELECT t FROM {top}) AS top, (SELECT c FROM {top}) AS top_count FROM {source}""")
    return "\nUNION ALL\n".join(parts)


ORACLES = {
    "s3b_infer_csv_schema": """SELECT * FROM (VALUES (0, 'o_orderkey', 'int'), (1, 'o_custkey', 'int'), (2, 'o_orderstatus', 'string'),
        (3, 'o_totalprice', 'string'), (4, 'o_orderdate', 'date'), (5, 'o_orderpriority', 'string')) t(position, "column", type)""",
    "a4_word_count": "SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents) GROUP BY word",
    "a4_top_words": """SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents)
        GROUP BY word ORDER BY n DESC, word LIMIT 20""",
    "s3_read_csv": """SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS o_totalprice,
        strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS bad_row FROM orders""",
    "s4_write_partitioned": """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_totalprice, o_orderstatus FROM orders""",
    "s5_roundtrip_orc": "SELECT * FROM customer",
    "s6_read_json": "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props FROM events",
    "s9_decode_envelope": """SELECT CAST(user_id AS VARCHAR) AS key, 'events' AS topic, CAST(user_id % 6 AS INTEGER) AS partition,
        event_id AS "offset", event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, 0 AS malformed FROM events""",
    "p13_filter_rows": f"""SELECT l_orderkey, l_partkey, l_returnflag, strftime(l_shipdate, '%Y-%m') AS month,
        CAST(CAST(l_extendedprice AS {_D2}) * (1 - CAST(l_discount AS {_D2})) AS DOUBLE) AS net
        FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-06-01 00:00:00'""",
    "j2_join_star": f"""SELECT r_name, n_name, CAST(year(o_orderdate) AS INTEGER) AS year,
        CAST(sum(CAST(l_extendedprice AS {_D2}) * (1 - CAST(l_discount AS {_D2}))) AS DOUBLE) AS revenue, count(*) AS n_lines
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3""",
    "j3_enrich_left": """SELECT d.doc_id, lang, source, n_chars, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "j4_semi_filter": """SELECT user_id, event_id, value FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
    "a3_group_agg": f"""SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS {_D2})) AS DOUBLE) AS sum_qty,
        CAST(sum(CAST(l_extendedprice AS {_D2}) * (1 - CAST(l_discount AS {_D2}))) AS DOUBLE) AS sum_net,
        round(CAST(sum(CAST(l_extendedprice AS {_D2})) AS DOUBLE) / count(*), 4) AS avg_price, count(*) AS n_lines,
        count(DISTINCT l_orderkey) AS n_orders FROM lineitem GROUP BY 1, 2""",
    "a5_parse_access_log": f"WITH {_LOG} SELECT * FROM parsed",
    "a5_top_ips": f"WITH {_LOG} SELECT ip, count(*) AS n FROM parsed WHERE ip IS NOT NULL GROUP BY ip ORDER BY n DESC, ip LIMIT 10",
    "a6_status_counts": f"WITH {_LOG} SELECT status, count(*) AS n FROM parsed GROUP BY status",
    "a7_mean_length": f"WITH {_LOG} SELECT round(avg(bytes), 4) AS mean_bytes, count(bytes) AS n FROM parsed",
    "a8_combined_counts": "SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2",
    "a10_profile_orders": _profile(
        {"o_orderkey": True, "o_custkey": True, "o_orderstatus": False, "o_totalprice": True, "o_orderdate": False, "o_orderpriority": False}, "orders"
    ),
    "a10_profile_events": _profile(
        {"event_id": True, "ts": False, "user_id": True, "event_type": False, "value": True, "props": False}, "events"
    ),
    "a11_five_v": """WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1)
        SELECT 'volume_rows' AS measure, CAST(count(*) AS DOUBLE) AS value FROM events
        UNION ALL SELECT 'variety_columns', 6.0 UNION ALL SELECT 'variety_types', 4.0
        UNION ALL SELECT 'veracity_null_share', round(sum(CASE WHEN event_id IS NULL THEN 1 ELSE 0 END + CASE WHEN ts IS NULL THEN 1 ELSE 0 END
          + CASE WHEN user_id IS NULL THEN 1 ELSE 0 END + CASE WHEN event_type IS NULL THEN 1 ELSE 0 END
          + CASE WHEN value IS NULL THEN 1 ELSE 0 END + CASE WHEN props IS NULL THEN 1 ELSE 0 END) / (count(*) * 6), 6) FROM events
        UNION ALL SELECT 'value_used_share', round(count(*) FILTER (event_type = 'purchase') / count(*), 6) FROM events
        UNION ALL SELECT 'veracity_repeated_rows', (SELECT count(*) FROM events) - (SELECT count(*) FROM (SELECT DISTINCT * FROM events))
        UNION ALL SELECT 'velocity_day_min', min(n) FROM d UNION ALL SELECT 'velocity_day_max', max(n) FROM d
        UNION ALL SELECT 'velocity_days', count(*) FROM d""",
    "a11_stored_volume": "SELECT count(*) AS volume_rows, CAST(sum(strlen(regexp_replace(coalesce(text, ''), '[\r\n]', ' ', 'g')) + 1) AS BIGINT) AS volume_bytes FROM documents",
    "a12_regular_report": f"""SELECT strftime(o_orderdate, '%Y-%m') AS month, r_name AS region, c_mktsegment AS segment, count(*) AS n_orders,
        CAST(sum(CAST(o_totalprice AS {_D2})) AS DOUBLE) AS turnover,
        CAST(grouping(strftime(o_orderdate, '%Y-%m'), r_name, c_mktsegment) AS INTEGER) AS level
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        GROUP BY ROLLUP (strftime(o_orderdate, '%Y-%m'), r_name, c_mktsegment)""",
    "a13_quality_gate": """WITH r AS (
        SELECT 'not_null(l_orderkey)' AS rule, count(*) AS n_checked, count(*) FILTER (l_orderkey IS NULL) AS n_failed FROM lineitem
        UNION ALL SELECT 'in_range(l_discount)', count(*), count(*) FILTER (NOT l_discount BETWEEN 0.0 AND 0.09) FROM lineitem
        UNION ALL SELECT 'in_range(l_quantity)', count(*), count(*) FILTER (NOT l_quantity BETWEEN 1 AND 50) FROM lineitem
        UNION ALL SELECT 'unique(l_orderkey,l_linenumber)', count(*), count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
        UNION ALL SELECT 'references(l_orderkey)', count(*), count(*) FILTER (l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')) FROM lineitem
        UNION ALL SELECT 'references(l_partkey)', count(*), count(*) FILTER (l_partkey NOT IN (SELECT p_partkey FROM part)) FROM lineitem)
        SELECT *, CASE WHEN n_failed = 0 THEN 1 ELSE 0 END AS passed FROM r""",
    "w1_rank_within": """SELECT o_custkey, o_orderkey, o_totalprice,
        row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS row_number,
        rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS rank,
        dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS dense_rank,
        CAST(ntile(4) OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS ntile FROM orders""",
    "w2_lag_delta": """SELECT event_id, user_id, lag(value) OVER w AS prev_value, lead(value) OVER w AS next_value,
        round(value - lag(value) OVER w, 4) AS delta, round((epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1000000.0, 3) AS gap_seconds
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
    "w3_running_total": f"""SELECT event_id, CAST(sum(CAST(value AS {_D2})) OVER (PARTITION BY user_id ORDER BY ts, event_id
        ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running FROM events""",
    "w3_moving_mean": f"""SELECT event_id, round(CAST(sum(CAST(value AS {_D2})) OVER w AS DOUBLE) / count(*) OVER w, 6) AS mean5
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
    "w3_trailing_week": f"""SELECT event_id, CAST(sum(CAST(value AS {_D2})) OVER w AS DOUBLE) AS week_sum, count(*) OVER w AS week_n
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW)""",
    "o2_top_k": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25",
}
