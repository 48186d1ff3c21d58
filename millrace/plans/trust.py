"""Sketches, privacy operations, evidence and per-group Python."""

from __future__ import annotations

import re
import secrets

from pyspark.sql import functions as F

from millrace.operators import evidence, groups, mondrian, privacy, sketches
from millrace.operators.privacy import Linked, Policy
from millrace.operators.relational import top_k, word_count
from millrace.session import scratch_dir, spread, table

# Bounds of the sketches: count-min as a share of all items with a confidence, Bloom as a share of strangers let through.
COUNT_MIN_ERROR, COUNT_MIN_CONFIDENCE = 1e-4, 0.99
BLOOM_RATE = 0.01
ANONYMITY, QUASI = 5, ("segment", "c_nationkey", "cents")
TREE_DEPTH, BLOCK = 6, 1000


def _words(spark, sf_dir):
    found = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))
    return spread(table(spark, sf_dir, "documents"), "doc_id").select(F.explode(found).alias("word"))


def a9a_approx_distinct(spark, sf_dir):
    """Users per event type from one-pass estimates and from daily sketches merged later."""
    events = table(spark, sf_dir, "events")
    exact = events.groupBy("event_type").agg(F.countDistinct("user_id").alias("exact"))
    direct = sketches.approx_distinct(events, ["event_type"], "user_id").withColumnRenamed("approx", "direct")
    daily = sketches.distinct_sketches(events.withColumn("day", F.to_date("ts")), ["event_type", "day"], "user_id")
    merged = sketches.merge_distinct(daily, ["event_type"]).withColumnRenamed("approx", "merged")
    near = lambda c: (F.abs(F.col(c) - F.col("exact")) <= 0.08 * F.col("exact")).cast("int")
    joined = exact.join(direct, "event_type").join(merged, "event_type")
    return joined.select("event_type", "exact", near("direct").alias("direct_near"), near("merged").alias("merged_near"))


def a9b_heavy_hitters(spark, sf_dir):
    """The 20 most frequent words, and whether the bounded sketch reports each among its top 40."""
    words = _words(spark, sf_dir)
    exact = top_k(word_count(spread(table(spark, sf_dir, "documents"), "doc_id")), "n", ["word"], 20)
    found = sketches.heavy_hitters(words, "word", 40)
    return exact.join(found, "word", "left").select("word", "n", F.col("estimate").isNotNull().cast("int").alias("reported"))


def a9b_count_min(spark, sf_dir):
    """All words: totals, estimates below the truth (none may be), and whether as few lie above the error bound as promised."""
    counts = word_count(spread(table(spark, sf_dir, "documents"), "doc_id"))
    depth, width = sketches.count_min_size(COUNT_MIN_ERROR, COUNT_MIN_CONFIDENCE)
    cells = sketches.count_min(_words(spark, sf_dir), "word", depth, width)
    both = counts.join(sketches.count_min_estimate(cells, counts, "word", depth, width), "word")
    all_items = counts.agg(F.sum("n")).scalar()
    above = F.col("estimate") > F.col("n") + COUNT_MIN_ERROR * all_items
    return both.agg(
        F.count("*").alias("n_words"),
        F.sum("n").alias("n_total"),
        F.sum((F.col("estimate") < F.col("n")).cast("int")).alias("n_below"),
        (F.avg(above.cast("int")) <= 1 - COUNT_MIN_CONFIDENCE).cast("int").alias("within_bound"),
    )


def a9c_quantile_sketch(spark, sf_dir):
    """Quantiles of daily sketches merged per type; `near` says the true rank is within 0.02."""
    events = table(spark, sf_dir, "events")
    daily = sketches.quantile_sketches(events.withColumn("day", F.to_date("ts")), ["event_type", "day"], "value")
    merged = daily.groupBy("event_type").agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    approx = sketches.sketch_quantiles(merged, ["event_type"], (0.25, 0.5, 0.9))
    # Three rows per type: a join by equality on the type, then one aggregate.
    ranked = events.select("event_type", "value").join(approx, "event_type").groupBy("event_type", "p")
    shares = ranked.agg(
        F.avg((F.col("value") < F.col("approx")).cast("int")).alias("under"),
        F.avg((F.col("value") <= F.col("approx")).cast("int")).alias("upto"),
    )
    near = (F.col("under") <= F.col("p") + 0.02) & (F.col("upto") >= F.col("p") - 0.02)
    return shares.select("event_type", "p", near.cast("int").alias("near"))


def a9d_bloom_member(spark, sf_dir):
    """Customers with a pricey order as a filter of a size that follows from their number, all customers as probes."""
    members = table(spark, sf_dir, "orders").where("o_totalprice > 490000").select(F.col("o_custkey").alias("k")).distinct()
    blocks = sketches.bloom_blocks(members.count(), BLOOM_RATE)
    bloom = sketches.bloom_filter(members, "k", blocks)
    probes = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    tested = sketches.bloom_member(probes, "k", bloom, blocks)
    marked = tested.join(members.withColumn("inside", F.lit(1)), "k", "left").na.fill(0, ["inside"])
    return marked.agg(
        F.sum("inside").alias("n_members"),
        F.sum(F.when(F.col("maybe"), F.col("inside")).otherwise(0)).alias("n_found"),
        (F.avg(F.when(F.col("inside") == 0, F.col("maybe").cast("int"))) < 0.02).cast("int").alias("few_false"),
    )


def _key(spark):
    """The configured key; without one a random key that nobody learns, so that two runs cannot be linked."""
    configured = spark.conf.get(privacy.PSEUDONYM_KEY_CONF, None)
    return privacy.pseudonym_key(spark) if configured else secrets.token_hex(32)


def g1_pseudonymize(spark, sf_dir):
    """What a join on pseudonyms keeps, whatever the key: people, names and orders of each nation and segment."""
    key = _key(spark)
    customer = privacy.pseudonymize(table(spark, sf_dir, "customer"), ["c_custkey", "c_name"], key)
    orders = privacy.pseudonymize(table(spark, sf_dir, "orders").select("o_custkey"), ["o_custkey"], key)
    counts = orders.groupBy("o_custkey").agg(F.count("*").alias("n_orders"))
    joined = customer.join(counts, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.groupBy("c_nationkey", "c_mktsegment").agg(
        F.countDistinct("c_custkey").alias("n_people"), F.countDistinct("c_name").alias("n_names"),
        F.count("n_orders").alias("n_buyers"), F.coalesce(F.sum("n_orders"), F.lit(0)).alias("n_orders"),
        F.min(F.length("c_custkey")).alias("length"),
    )


def g2_anonymize(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_mktsegment", "c_nationkey", "c_acctbal")
    quasi = {
        "c_mktsegment": F.col("c_mktsegment"),
        "c_nationkey": F.col("c_nationkey"),
        "c_acctbal": F.floor(F.col("c_acctbal") / 2500) * 2500,
    }
    rows = privacy.anonymize(customer, quasi, 5)
    return rows.groupBy("c_mktsegment", "c_nationkey", "c_acctbal").agg(F.count("*").alias("n"))


def _quasi_rows(spark, sf_dir):
    """Customers with ordered quasi-identifiers: segment by name, nation, balance in cents."""
    customer = table(spark, sf_dir, "customer")
    names = customer.select("c_mktsegment").distinct().agg(F.array_sort(F.collect_list("c_mktsegment"))).scalar()
    return customer.select("c_custkey", F.array_position(names, F.col("c_mktsegment")).alias("segment"), "c_nationkey", F.rint(F.col("c_acctbal") * 100).cast("long").alias("cents"))


def g2_mondrian(spark, sf_dir):
    """What is published of each group of at least five customers: ranges that follow the data."""
    grouped = mondrian.mondrian(_quasi_rows(spark, sf_dir), QUASI, ANONYMITY)
    return mondrian.generalised(grouped, QUASI).withColumnRenamed("_group", "cuts")


def g2_suppressed(spark, sf_dir):
    """Rows that fixed steps and cuts suppress for the same anonymity, groups, and the least group."""
    customer = table(spark, sf_dir, "customer")
    everyone = customer.agg(F.count("*")).scalar()
    measured = lambda df, name: df.agg(
        F.lit(name).alias("method"), (everyone - F.coalesce(F.sum("n"), F.lit(0))).alias("suppressed"), F.count("*").alias("n_groups"), F.min("n").alias("least")
    )
    return measured(g2_anonymize(spark, sf_dir), "steps").unionByName(measured(g2_mondrian(spark, sf_dir), "cuts"))


def _subject_tables(spark, sf_dir):
    return {
        "customer": Linked(table(spark, sf_dir, "customer"), "c_custkey"),
        "orders": Linked(table(spark, sf_dir, "orders"), "o_custkey", "customer", "c_custkey"),
        "lineitem": Linked(table(spark, sf_dir, "lineitem"), "l_orderkey", "orders", "o_orderkey"),
        "events": Linked(table(spark, sf_dir, "events"), "user_id", "customer", "c_custkey"),
    }


def _erasure_requests(spark, sf_dir):
    return table(spark, sf_dir, "customer").where("c_acctbal < -500").select(F.col("c_custkey").alias("id"))


def g3_erase_subjects(spark, sf_dir):
    return privacy.erase_subjects(_subject_tables(spark, sf_dir), _erasure_requests(spark, sf_dir), "id")[1]


def g3_remaining_lines(spark, sf_dir):
    kept, _ = privacy.erase_subjects(_subject_tables(spark, sf_dir), _erasure_requests(spark, sf_dir), "id")
    return kept["lineitem"].groupBy("l_returnflag").agg(F.count("*").alias("n"), F.countDistinct("l_orderkey").alias("n_orders"))


def g3_rewrite_affected(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    path = scratch_dir(spark, "erased-orders")
    return privacy.rewrite_affected(orders, "o_custkey", _erasure_requests(spark, sf_dir), "id", "month", path)


def g4_consent_filter(spark, sf_dir):
    """Consents by rule: customers with a positive balance agree for twenty days."""
    since = "TIMESTAMP_NTZ '{}' + make_dt_interval(CAST(c_custkey % 10 AS INT))"
    consents = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(
        F.col("c_custkey").alias("subject"),
        F.expr(since.format("2024-01-01 00:00:00")).alias("valid_from"),
        F.expr(since.format("2024-01-21 00:00:00")).alias("valid_to"),
    )
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    return privacy.consent_filter(events, "user_id", "ts", consents).select("event_id", "user_id", "value")


def g5_role_view(spark, sf_dir):
    grants = table(spark, sf_dir, "nation").select(
        F.when(F.col("n_regionkey") < 2, "analyst").otherwise("auditor").alias("role"), F.col("n_nationkey").alias("key")
    )
    policy = Policy(masked=("c_name",), hidden=("c_acctbal",), row_key="c_nationkey")
    return privacy.role_view(table(spark, sf_dir, "customer"), "analyst", policy, grants)


def g6_audit_log(spark, sf_dir):
    path = scratch_dir(spark, "audit")
    for name in ("customer", "orders"):
        log = privacy.audit_log(table(spark, sf_dir, name), path, f"run-{name}", "analyst", "monthly report")
    return log.select("run_id", "actor", "purpose", "n_rows")


def _log(spark, sf_dir):
    """Events as entries of a log, numbered in the order of their time."""
    return evidence.numbered(table(spark, sf_dir, "events").select("ts", "event_id", "user_id", "event_type"), ["ts", "event_id"]).drop("ts")


def g6_log_chain(spark, sf_dir):
    return evidence.log_blocks(_log(spark, sf_dir), "sequence", BLOCK)


def g6_log_root(spark, sf_dir):
    return evidence.log_root(g6_log_chain(spark, sf_dir), 16)


def g6_log_damage(spark, sf_dir):
    """Blocks that no longer agree after some entries were removed and some rewritten, by rule."""
    entries = _log(spark, sf_dir)
    kept = evidence.log_blocks(entries, "sequence", BLOCK)
    rewritten = F.when(F.col("sequence") % 5000 == 1700, F.lit("other")).otherwise(F.col("event_type"))
    damaged = entries.where("sequence % 4000 <> 3").withColumn("event_type", rewritten)
    return evidence.damaged_blocks(kept, damaged, "sequence", BLOCK)


def g7_merkle_tree(spark, sf_dir):
    return evidence.merkle_tree(table(spark, sf_dir, "customer"), TREE_DEPTH)


def g7_changed_buckets(spark, sf_dir):
    """The nodes that differ after the last customer was renamed and the first one removed, and the rows to look at in each bucket."""
    customer = table(spark, sf_dir, "customer")
    ends = customer.agg(F.struct(F.min("c_custkey").alias("first"), F.max("c_custkey").alias("last"))).scalar()
    renamed = F.when(F.col("c_custkey") == ends["last"], F.concat("c_name", F.lit("!"))).otherwise(F.col("c_name"))
    other = customer.where(F.col("c_custkey") != ends["first"]).withColumn("c_name", renamed)
    return evidence.changed_nodes(evidence.merkle_tree(customer, TREE_DEPTH), evidence.merkle_tree(other, TREE_DEPTH))


def g7_fingerprint(spark, sf_dir):
    return privacy.fingerprint(table(spark, sf_dir, "customer"))


def g8_redact_text(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return privacy.redact_text(docs, "text")


def g9_synth_rows(spark, sf_dir):
    """One synthetic customer for every order key."""
    return privacy.synth_rows(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 7)


def u1_per_group_model(spark, sf_dir):
    """Price against quantity, one line per return flag."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity", "l_extendedprice")
    fitted = groups.per_group_model(lines, "l_returnflag", ["l_quantity"], "l_extendedprice")
    return fitted.select("l_returnflag", "n", F.round("intercept", 3).alias("intercept"), F.round("l_quantity", 4).alias("slope"))


def u2_mapreduce(spark, sf_dir):
    word = re.compile("[a-z]+")
    lines = spread(table(spark, sf_dir, "documents"), "doc_id").select("text")
    counted = groups.mapreduce(lines, lambda text: ((w, 1) for w in word.findall(text.lower())))
    return counted.select(F.col("key").alias("word"), F.col("value").alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        a9a_approx_distinct, a9b_heavy_hitters, a9b_count_min, a9c_quantile_sketch, a9d_bloom_member, g1_pseudonymize,
        g2_anonymize, g2_mondrian, g2_suppressed, g3_erase_subjects, g3_remaining_lines, g3_rewrite_affected, g4_consent_filter, g5_role_view,
        g6_audit_log, g6_log_chain, g6_log_root, g6_log_damage, g7_fingerprint, g7_merkle_tree, g7_changed_buckets, g8_redact_text, g9_synth_rows, u1_per_group_model, u2_mapreduce,
    )
}

_WORDS = "words AS (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents)"
_DOOMED = "doomed AS (SELECT c_custkey FROM customer WHERE c_acctbal < -500)"
_HEX = "CAST('0x' || substr(md5(concat('7/', '{c}', '/', CAST(o_orderkey AS VARCHAR))), 1, 12) AS BIGINT)"
_AGE, _BALANCE = f"({_HEX.format(c='age')} % 73 + 18)", f"({_HEX.format(c='balance')} % 1000000 / 100)"


def _redacted(upto: int) -> str:
    text = "text"
    for kind, pattern in list(privacy.REDACTIONS.items())[:upto]:
        text = f"regexp_replace({text}, '{_re2(pattern)}', '[{kind}]', 'g')"
    return text


def _re2(pattern: str) -> str:
    return pattern.replace("'", "''")


def _hits(i: int) -> str:
    kind, pattern = list(privacy.REDACTIONS.items())[i]
    return f"len(regexp_extract_all({_redacted(i)}, '{_re2(pattern)}')) AS n_{kind}"


def _cell(column: str, kind: str) -> str:
    cell = f"coalesce('{column}:{kind}=' || CAST({column} AS VARCHAR), '{column}:{kind}-')"
    return f"CAST(length({cell}) AS VARCHAR) || {cell}"


_CUSTOMER = {"c_acctbal": "double", "c_custkey": "bigint", "c_mktsegment": "string", "c_name": "string", "c_nationkey": "int"}
_ROW_HASH = f"sha256({' || '.join(_cell(c, kind) for c, kind in _CUSTOMER.items())})"

_QUASI = f"""q AS (SELECT c_custkey, CAST(list_position((SELECT list(DISTINCT c_mktsegment ORDER BY c_mktsegment) FROM customer), c_mktsegment) AS BIGINT) AS segment, c_nationkey,
          CAST(round(c_acctbal * 100) AS BIGINT) AS cents FROM customer),
        {mondrian.mondrian_sql('q', QUASI, ANONYMITY)}"""
_STEPS = "steps AS (SELECT count(*) AS n FROM customer GROUP BY c_mktsegment, c_nationkey, floor(c_acctbal / 2500) HAVING count(*) >= 5)"


def _digest(columns: dict[str, str]) -> str:
    return f"sha256({' || '.join(_cell(c, columns[c]) for c in sorted(columns))})"


_LOG_COLUMNS = {"event_id": "bigint", "event_type": "string", "sequence": "bigint", "user_id": "bigint"}
_LOG = "g AS (SELECT event_id, user_id, event_type, row_number() OVER (ORDER BY ts, event_id) - 1 AS sequence FROM events)"


def _blocks(name: str, source: str) -> str:
    return f"""{name} AS (SELECT *, sha256(coalesce(b.content, repeat('0', 64)) || a.content) AS link FROM
          (SELECT sequence // {BLOCK} AS block, count(*) AS n, min(sequence) AS first, max(sequence) AS last, sha256(string_agg(CAST(sequence AS VARCHAR) || '=' || {_digest(_LOG_COLUMNS)}, ',' ORDER BY sequence)) AS content
           FROM {source} GROUP BY 1) a LEFT JOIN (SELECT sequence // {BLOCK} + 1 AS block, sha256(string_agg(CAST(sequence AS VARCHAR) || '=' || {_digest(_LOG_COLUMNS)}, ',' ORDER BY sequence)) AS content
           FROM {source} GROUP BY 1) b USING (block))""".replace("SELECT *,", "SELECT a.*,")


def _tree(name: str, source: str) -> str:
    """Levels t0 (the root) to t<depth>."""
    parts = [
        f"""{name}{TREE_DEPTH} AS (SELECT node, CAST(coalesce(n, 0) AS BIGINT) AS n, coalesce(digest, repeat('0', 64)) AS digest FROM (SELECT unnest(range({1 << TREE_DEPTH})) AS node) LEFT JOIN
          (SELECT CAST('0x' || substr(d, 1, 8) AS BIGINT) >> {32 - TREE_DEPTH} AS node, sum(c) AS n, sha256(string_agg(d || '*' || c, ',' ORDER BY d)) AS digest
           FROM (SELECT {_digest(_CUSTOMER)} AS d, count(*) AS c FROM {source} GROUP BY 1) GROUP BY 1) USING (node))"""
    ]
    for level in range(TREE_DEPTH - 1, -1, -1):
        parts.append(f"{name}{level} AS (SELECT node >> 1 AS node, CAST(sum(n) AS BIGINT) AS n, sha256(string_agg(digest, '' ORDER BY node)) AS digest FROM {name}{level + 1} GROUP BY 1)")
    parts.append(f"{name} AS ({' UNION ALL '.join(f'SELECT {level} AS level, * FROM {name}{level}' for level in range(TREE_DEPTH + 1))})")
    return ", ".join(parts)


ORACLES = {
    "g2_mondrian": f"""WITH RECURSIVE {_QUASI} SELECT _group AS cuts, count(*) AS n, {', '.join(f"min({c}) AS {c}_low, max({c}) AS {c}_high" for c in QUASI)} FROM grouped GROUP BY 1""",
    "g2_suppressed": f"""WITH RECURSIVE {_QUASI}, {_STEPS}, cuts AS (SELECT count(*) AS n FROM grouped GROUP BY _group)
        SELECT 'steps' AS method, CAST((SELECT count(*) FROM customer) - sum(n) AS BIGINT) AS suppressed, count(*) AS n_groups, min(n) AS least FROM steps
        UNION ALL SELECT 'cuts', CAST((SELECT count(*) FROM customer) - sum(n) AS BIGINT), count(*), min(n) FROM cuts""",
    "g6_log_chain": f"WITH {_LOG}, {_blocks('k', 'g')} SELECT * FROM k",
    "g6_log_root": f"""WITH {_LOG}, {_blocks('k', 'g')}, l1 AS (SELECT block // 16 AS a, sha256(string_agg(block || '=' || link, ',' ORDER BY block)) AS d FROM k GROUP BY 1),
        l2 AS (SELECT a // 16 AS a, sha256(string_agg(a || '=' || d, ',' ORDER BY a)) AS d FROM l1 GROUP BY 1),
        l3 AS (SELECT a // 16 AS a, sha256(string_agg(a || '=' || d, ',' ORDER BY a)) AS d FROM l2 GROUP BY 1),
        b AS (SELECT CAST(sum(n) AS BIGINT) AS n_entries, count(*) AS n_blocks, max(block) + 1 AS reach FROM k)
        SELECT n_entries, n_blocks, CASE WHEN reach <= 16 THEN (SELECT d FROM l1) WHEN reach <= 256 THEN (SELECT d FROM l2) ELSE (SELECT d FROM l3) END AS root FROM b""",
    "g6_log_damage": f"""WITH {_LOG}, {_blocks('k', 'g')}, h AS (SELECT * REPLACE (CASE WHEN sequence % 5000 = 1700 THEN 'other' ELSE event_type END AS event_type) FROM g WHERE sequence % 4000 <> 3),
        {_blocks('j', 'h')} SELECT block, CASE WHEN coalesce(j.n, 0) < k.n THEN 'missing' ELSE 'changed' END AS kind FROM k LEFT JOIN j USING (block) WHERE j.content IS DISTINCT FROM k.content""",
    "g7_merkle_tree": f"WITH {_tree('t', 'customer')} SELECT level, node, n, digest FROM t",
    "g7_changed_buckets": f"""WITH o AS (SELECT * REPLACE (CASE WHEN c_custkey = (SELECT max(c_custkey) FROM customer) THEN c_name || '!' ELSE c_name END AS c_name) FROM customer
          WHERE c_custkey <> (SELECT min(c_custkey) FROM customer)), {_tree('t', 'customer')}, {_tree('u', 'o')}
        SELECT level, node, t.n AS n_before, u.n AS n_after FROM t JOIN u USING (level, node) WHERE t.digest <> u.digest""",
    "a9a_approx_distinct": """SELECT event_type, count(DISTINCT user_id) AS exact, 1 AS direct_near, 1 AS merged_near FROM events GROUP BY event_type""",
    "a9b_heavy_hitters": f"WITH {_WORDS} SELECT word, count(*) AS n, 1 AS reported FROM words GROUP BY word ORDER BY n DESC, word LIMIT 20",
    "a9b_count_min": f"WITH {_WORDS} SELECT count(DISTINCT word) AS n_words, count(*) AS n_total, CAST(0 AS BIGINT) AS n_below, 1 AS within_bound FROM words",
    "a9c_quantile_sketch": "SELECT event_type, p, 1 AS near FROM (SELECT DISTINCT event_type FROM events), (SELECT CAST(unnest([0.25, 0.5, 0.9]) AS DOUBLE) AS p)",
    "a9d_bloom_member": """SELECT count(DISTINCT o_custkey) AS n_members, count(DISTINCT o_custkey) AS n_found, 1 AS few_false
        FROM orders WHERE o_totalprice > 490000""",
    "g1_pseudonymize": """SELECT c_nationkey, c_mktsegment, count(DISTINCT c_custkey) AS n_people, count(DISTINCT c_name) AS n_names, count(n_orders) AS n_buyers,
        CAST(coalesce(sum(n_orders), 0) AS BIGINT) AS n_orders, 64 AS length
        FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1) ON c_custkey = o_custkey GROUP BY 1, 2""",
    "g2_anonymize": """SELECT c_mktsegment, c_nationkey, CAST(floor(c_acctbal / 2500) * 2500 AS BIGINT) AS c_acctbal, count(*) AS n
        FROM customer GROUP BY 1, 2, 3 HAVING count(*) >= 5""",
    "g3_erase_subjects": f"""WITH {_DOOMED}, o AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM doomed))
        SELECT 'customer' AS "table", count(*) AS rows_before, (SELECT count(*) FROM doomed) AS rows_erased, CAST(0 AS BIGINT) AS rows_left_of_subjects FROM customer
        UNION ALL SELECT 'orders', count(*), (SELECT count(*) FROM o), 0 FROM orders
        UNION ALL SELECT 'lineitem', count(*), count(*) FILTER (l_orderkey IN (SELECT o_orderkey FROM o)), 0 FROM lineitem
        UNION ALL SELECT 'events', count(*), count(*) FILTER (user_id IN (SELECT c_custkey FROM doomed)), 0 FROM events""",
    "g3_remaining_lines": f"""WITH {_DOOMED} SELECT l_returnflag, count(*) AS n, count(DISTINCT l_orderkey) AS n_orders FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM doomed)) GROUP BY 1""",
    "g3_rewrite_affected": f"""WITH {_DOOMED} SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS rows_before,
        count(*) FILTER (o_custkey NOT IN (SELECT c_custkey FROM doomed)) AS rows_after FROM orders GROUP BY 1
        HAVING count(*) FILTER (o_custkey IN (SELECT c_custkey FROM doomed)) > 0""",
    "g4_consent_filter": """SELECT event_id, user_id, value FROM events e WHERE EXISTS (SELECT 1 FROM customer WHERE c_acctbal > 0 AND c_custkey = user_id
        AND ts >= TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 10 AS INTEGER)) AND ts < TIMESTAMP '2024-01-21' + to_days(CAST(c_custkey % 10 AS INTEGER)))""",
    "g5_role_view": """SELECT c_custkey, regexp_replace(regexp_replace(regexp_replace(c_name, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS c_name,
        c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal, c_mktsegment FROM customer
        WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 2)""",
    "g6_audit_log": """SELECT 'run-customer' AS run_id, 'analyst' AS actor, 'monthly report' AS purpose, count(*) AS n_rows FROM customer
        UNION ALL SELECT 'run-orders', 'analyst', 'monthly report', count(*) FROM orders""",
    "g7_fingerprint": f"""SELECT count(*) AS n_rows, CAST(sum(CAST(CAST('0x' || substr(h, 1, 15) AS BIGINT) AS DECIMAL(38,0))) AS VARCHAR) AS sum_a,
        CAST(sum(CAST(CAST('0x' || substr(h, 16, 15) AS BIGINT) AS DECIMAL(38,0))) AS VARCHAR) AS sum_b FROM (SELECT {_ROW_HASH} AS h FROM customer)""",
    "g8_redact_text": f"SELECT doc_id, {_redacted(4)} AS text, {', '.join(_hits(i) for i in range(4))} FROM documents",
    "g9_synth_rows": f"""SELECT o_orderkey AS id, {_AGE} AS age, {_BALANCE} AS balance,
        ['north', 'south', 'east', 'west'][CAST({_HEX.format(c='area')} % 4 + 1 AS INTEGER)] AS area,
        CASE WHEN {_BALANCE} + 50 * {_AGE} > 7500 THEN 1 ELSE 0 END AS large FROM orders""",
    "u1_per_group_model": """SELECT l_returnflag, count(*) AS n, round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept,
        round(regr_slope(l_extendedprice, l_quantity), 4) AS slope FROM lineitem GROUP BY 1""",
    "u2_mapreduce": f"WITH {_WORDS} SELECT word, count(*) AS n FROM words GROUP BY word",
}
