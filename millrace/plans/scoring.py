"""Learning whose results SQL can say row by row: naive Bayes, measures, clusters, folds, splits and drift.

Everything is sums of whole numbers or of few doubles, so that each predicted label, centre and threshold has a twin.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.ml import drift, insight, lloyd, metrics, models, naive_bayes, relations, ridge, splits
from millrace.session import settle, spread, table

SEGMENT_KS, SEGMENT_STEPS, SEGMENT_ROUNDS = (2, 3, 4, 5, 6), 1000, 6
VECTOR_K, VECTOR_SCALE, VECTOR_ROUNDS = 10, 4096, 4
PENALTIES = (0.0, 0.01, 0.1, 1.0)
SPLIT_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "days_to_ship")
DRIFT_BINS = 10


def m8_message_bayes(spark, sf_dir):
    """The role that a message's words speak for, for the conversations of a held-out fold."""
    train, test = models.split(table(spark, sf_dir, "conversations"), "conv_id")
    model = naive_bayes.fit(train, "role", "text")
    found = naive_bayes.predict(test, ["conv_id", "turn"], "text", model)
    return found.select("conv_id", "turn", "predicted", "margin")


def m8_message_report(spark, sf_dir):
    """How well the roles of held-out messages are predicted, beside the share of the most frequent one."""
    test = models.split(table(spark, sf_dir, "conversations"), "conv_id")[1].select("conv_id", "turn", "role")
    pred = test.join(m8_message_bayes(spark, sf_dir), ["conv_id", "turn"])
    return metrics.rounded(metrics.class_metrics(pred, "role", "predicted"), 6)


def _languages(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), "doc_id")
    train, test = models.split(docs, "doc_id")
    return naive_bayes.fit(train, "lang", "text"), test


def m19_language_bayes(spark, sf_dir):
    """Many classes from text: the language of each held-out document, with its lead in billionths of a logarithm."""
    model, test = _languages(spark, sf_dir)
    return naive_bayes.predict(test, ["doc_id"], "text", model)


def m17_word_contributions(spark, sf_dir):
    """Per held-out document: its five words that speak most for the predicted language against the classes on average, in billionths."""
    model, test = _languages(spark, sf_dir)
    found = naive_bayes.predict(test, ["doc_id"], "text", model)
    tf = naive_bayes.term_counts(test, ["doc_id"], "text")
    return naive_bayes.word_contributions(tf, ["doc_id"], found, model, 5)


def m17_text_margins(spark, sf_dir):
    """Whether the contributions of hashed words and the intercepts add up to the margins of all languages."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), "doc_id")
    labelled = models.indexed(docs, "lang", "label")
    train, test = models.split(labelled, "doc_id")
    model = models.fit(train, models.text_stages("text", 1 << 12), models.logistic(regParam=0.1, maxIter=10))
    pred = settle(model.transform(test).select("doc_id", "features", "rawPrediction"), "margins")
    both = insight.explained_margins(pred, model.stages[-1], "doc_id")
    off = F.abs(F.col("explained") - F.col("margin")) > 1e-6 * F.greatest(F.lit(1.0), F.abs("margin"))
    return both.groupBy("class").agg(F.count("*").alias("n_test"), F.count_if(off).alias("n_off"))


def _rule_scores(spark, sf_dir):
    """Scores that grow with the length of a document, beside its quality: many ties, one row a labelled document."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    size = F.col("n_chars").cast("long")
    return docs.select("lang", F.col("quality").alias("label"), (F.call_function("div", 1000 * size, size + 1000) / 1000).alias("score"))


def m14_roc_curve(spark, sf_dir):
    return metrics.roc_curve(_rule_scores(spark, sf_dir), ["lang"], "score", "label")


def m14_binary_metrics(spark, sf_dir):
    return metrics.rounded(metrics.binary_metrics(_rule_scores(spark, sf_dir), ["lang"], "score", "label"))


def m14_regression_metrics(spark, sf_dir):
    """The price of a line as a fixed rate of its quantity, by return flag."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice", (F.col("l_quantity") * 1500.0).alias("value"))
    return metrics.rounded(metrics.regression_metrics(lines, ["l_returnflag"], "value", "l_extendedprice"), 4)


def segments(spark, sf_dir):
    """Customers with orders as whole-number vectors of recency, frequency and money."""
    rfm = relations.rfm(table(spark, sf_dir, "orders"))
    cents = rfm.select("o_custkey", "recency", "frequency", F.rint(F.col("money") * 100).cast("long").alias("money"))
    return settle(lloyd.whole_vectors(cents, "o_custkey", ["recency", "frequency", "money"], SEGMENT_STEPS), "segments")


def m7_choose_k(spark, sf_dir):
    """Cost and silhouette of each number of segments, and the one with the best silhouette."""
    rows = segments(spark, sf_dir)
    centres = lloyd.lloyd(rows, "o_custkey", SEGMENT_KS, SEGMENT_ROUNDS)
    moments = settle(lloyd.cluster_moments(rows, "o_custkey", centres, SEGMENT_KS), "moments")
    rounded = moments.select("k", "n", "cost", F.round("silhouette", 6).alias("silhouette"), "largest")
    best = rounded.agg(F.max_by("k", F.struct("silhouette", -F.col("k")))).scalar()
    return rounded.withColumn("chosen", (F.col("k") == best).cast("int"))


def m7_segments(spark, sf_dir):
    """The segment of every customer among four."""
    rows = segments(spark, sf_dir)
    centres = lloyd.lloyd(rows, "o_custkey", [4], SEGMENT_ROUNDS)
    return lloyd.distances(rows.where("x is not null"), "o_custkey", centres, [4]).select("o_custkey", "number", "own")


def m18_cluster_distance(spark, sf_dir):
    """Vectors unusually far from the centre of their cluster."""
    whole = F.transform(F.col("embedding").cast("array<double>"), lambda c: F.floor(c * VECTOR_SCALE))
    rows = settle(table(spark, sf_dir, "embeddings").select("vec_id", whole.alias("x")), "vectors")
    centres = lloyd.lloyd(rows, "vec_id", [VECTOR_K], VECTOR_ROUNDS)
    far = lloyd.far_rows(rows, "vec_id", centres, VECTOR_K, 2.0)
    return far.select("vec_id", "number", F.round("distance", 4).alias("distance"))


def m10_ridge_grid(spark, sf_dir):
    """Price from quantity and discount: the error on each held-out fold of orders for each penalty, in one scan."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_quantity").cast("long").alias("quantity"), F.rint(F.col("l_discount") * 100).cast("long").alias("discount"),
        F.rint(F.col("l_extendedprice") * 100).cast("long").alias("cents"),
    )
    grid = ridge.ridge_grid(lines, models.fold("l_orderkey", 5), ["quantity", "discount"], "cents", PENALTIES)
    weight = lambda i: F.round(F.col("weights")[i], 3)
    return grid.select(
        "fold", "penalty", "n_train", "n_test", F.round(F.sqrt("mse"), 2).alias("rmse"), F.round("intercept", 2).alias("intercept"),
        weight(0).alias("w_quantity"), weight(1).alias("w_discount"),
    )


def _line_features(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.withColumn("days_to_ship", F.datediff("l_shipdate", "o_orderdate"))


def m3_best_splits(spark, sf_dir):
    """The split of each feature of a line that tells its return flags apart best, and the features in that order."""
    found = splits.best_splits(_line_features(spark, sf_dir), SPLIT_FEATURES, "l_returnflag", ["A", "N", "R"], digits=9)
    return found.withColumnRenamed("value", "threshold")


def m4_residual_splits(spark, sf_dir):
    """Best splits of large orders within each status, as the first step of boosting sees them."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderstatus", (F.col("o_totalprice") > 250000).cast("int").alias("large"), F.month("o_orderdate").alias("month"), F.dayofmonth("o_orderdate").alias("day"),
        (F.col("o_custkey") % 97).alias("customer_group"),
    )
    found = splits.best_splits(orders, ["month", "day", "customer_group"], "large", [0, 1], ["o_orderstatus"], digits=9)
    return found.withColumnRenamed("value", "threshold")


def _halves(spark, sf_dir):
    """Events of the first half of the days and of the others."""
    events = table(spark, sf_dir, "events")
    day = lambda f: F.to_date(f("ts"))
    middle = events.agg(F.date_add(day(F.min), F.floor(F.datediff(day(F.max), day(F.min)) / 2).cast("int")).cast("timestamp_ntz")).scalar()
    return events.where(F.col("ts") < middle), events.where(F.col("ts") >= middle)


def m20_numeric_drift(spark, sf_dir):
    """Drift of the values and users of events, in bins cut by the quantiles of the first half of the days."""
    found = drift.numeric_drift(*_halves(spark, sf_dir), ["value", "user_id"], DRIFT_BINS)
    return found.select("feature", "bin", "low", "n_ref", "n_cur", F.round("psi_part", 8).alias("psi_part"))


def m20_ks_distance(spark, sf_dir):
    found = drift.ks_distance(*_halves(spark, sf_dir), ["value", "user_id"])
    return found.select("feature", "n_ref", "n_cur", F.round("distance", 9).alias("distance"), "at")


QUERIES = {
    f.__name__: f
    for f in (
        m3_best_splits, m4_residual_splits, m7_choose_k, m7_segments, m8_message_bayes, m8_message_report, m10_ridge_grid, m14_roc_curve, m14_binary_metrics,
        m14_regression_metrics, m17_word_contributions, m17_text_margins, m18_cluster_distance, m19_language_bayes, m20_numeric_drift, m20_ks_distance,
    )
}


def _fold(key: str) -> str:
    return f"(CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) % 5)"


def _units(value: str) -> str:
    return f"CAST(round(ln({value}) * 1e9) AS BIGINT)"


def _bayes(source: str, key: str, label: str, fold: str) -> str:
    """Common table expressions: k counts, c classes, tf words of held-out texts, s scores, r predictions."""
    return f"""d AS (SELECT {key}, {label} AS label, text, {_fold(fold)} = 0 AS held FROM {source}),
        w AS (SELECT {key}, label, held, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS term FROM d),
        k AS (SELECT label, term, count(*) AS n FROM w WHERE NOT held AND label IS NOT NULL GROUP BY ALL),
        g AS (SELECT label, count(*) AS n_docs FROM d WHERE NOT held AND label IS NOT NULL AND text IS NOT NULL GROUP BY 1),
        c AS (SELECT label, n_docs, {_units('n_docs')} - {_units('(SELECT sum(n_docs) FROM g)')} AS prior,
          {_units('1')} - {_units('coalesce((SELECT sum(n) FROM k WHERE k.label = g.label), 0) + (SELECT count(DISTINCT term) FROM k)')} AS unseen FROM g),
        tf AS (SELECT {key}, term, count(*) AS tf FROM w WHERE held AND term IN (SELECT term FROM k) GROUP BY ALL),
        s AS (SELECT {key}, c.label, any_value(prior) + sum(tf) * any_value(unseen) + sum(tf * coalesce({_units('k.n + 1')}, 0)) AS score
          FROM tf CROSS JOIN c LEFT JOIN k ON k.term = tf.term AND k.label = c.label GROUP BY {key}, c.label),
        o AS (SELECT {key}, label, CAST(score - lead(score) OVER v AS BIGINT) AS margin, row_number() OVER v AS r FROM s
          WINDOW v AS (PARTITION BY {key} ORDER BY score DESC, label)),
        r AS (SELECT {key}, coalesce(o.label, (SELECT label FROM c ORDER BY n_docs DESC, label LIMIT 1)) AS predicted, margin
          FROM (SELECT DISTINCT {key} FROM d WHERE held) LEFT JOIN (SELECT * FROM o WHERE r = 1) o USING ({key}))"""


_MESSAGES = _bayes("conversations", "conv_id, turn", "role", "conv_id")
_LANGUAGES = _bayes("documents", "doc_id", "lang", "doc_id")
_SCORES = """p AS (SELECT lang, quality AS label, (1000 * n_chars // (n_chars + 1000)) / 1000 AS score FROM documents JOIN labels USING (doc_id)),
        n AS (SELECT lang, score, CAST(sum(label) AS BIGINT) AS pos, CAST(count(*) - sum(label) AS BIGINT) AS neg FROM p GROUP BY ALL),
        u AS (SELECT *, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp FROM n WINDOW w AS (PARTITION BY lang ORDER BY score DESC))"""
_SEGMENTS = f"""rfm AS (SELECT o_custkey, date_diff('day', max(o_orderdate), (SELECT max(o_orderdate) FROM orders)) AS recency, count(*) AS frequency,
          CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) * 100 AS BIGINT) AS money FROM orders GROUP BY 1),
        b AS (SELECT min(recency) AS a1, greatest(max(recency) - a1, 1) AS z1, min(frequency) AS a2, greatest(max(frequency) - a2, 1) AS z2, min(money) AS a3, greatest(max(money) - a3, 1) AS z3 FROM rfm),
        v AS (SELECT o_custkey, [CAST((recency - a1) * {SEGMENT_STEPS} // z1 AS BIGINT), CAST((frequency - a2) * {SEGMENT_STEPS} // z2 AS BIGINT), CAST((money - a3) * {SEGMENT_STEPS} // z3 AS BIGINT)] AS x FROM rfm, b)"""
_HALF = """m AS (SELECT CAST(min(ts) AS DATE) + CAST(date_diff('day', min(ts), max(ts)) // 2 AS INTEGER) AS middle FROM events),
        l AS (SELECT 'value' AS feature, value, ts >= (SELECT middle FROM m) AS cur FROM events
          UNION ALL SELECT 'user_id', CAST(user_id AS DOUBLE), ts >= (SELECT middle FROM m) FROM events)"""


def _splits(source: str, features: dict[str, str], label: str, classes: list[str], by: str = "") -> str:
    keys = f"{by}, feature" if by else "feature"
    long = " UNION ALL ".join(f"SELECT {by + ', ' if by else ''}'{f}' AS feature, CAST({e} AS DOUBLE) AS value, {label} AS label FROM {source}" for f, e in features.items())
    n = range(len(classes))
    impurity = lambda c: "(1 - (" + " + ".join(f"{c}{i} * {c}{i}" for i in n) + ") / ((" + " + ".join(f"{c}{i}" for i in n) + ") * (" + " + ".join(f"CAST({c}{i} AS DOUBLE)" for i in n) + ")))"
    total = lambda c: "(" + " + ".join(f"{c}{i}" for i in n) + ")"
    return f"""WITH x AS ({long}),
        q AS (SELECT {keys}, value, {', '.join(f"count(*) FILTER (label = {c}) AS n{i}" for i, c in enumerate(classes))} FROM x WHERE value IS NOT NULL GROUP BY ALL),
        a AS (SELECT {keys}, value, {', '.join(f"CAST(sum(n{i}) OVER (PARTITION BY {keys} ORDER BY value) AS BIGINT) AS l{i}, CAST(sum(n{i}) OVER (PARTITION BY {keys}) AS BIGINT) AS t{i}" for i in n)} FROM q),
        s AS (SELECT *, {', '.join(f"t{i} - l{i} AS r{i}" for i in n)} FROM a),
        e AS (SELECT {keys}, value AS threshold, {total('l')} AS n_left, {total('r')} AS n_right,
          round({impurity('t')} - ({total('l')} * {impurity('l')} + {total('r')} * {impurity('r')}) / {total('t')}, 9) AS gain FROM s WHERE {total('r')} > 0),
        f AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY gain DESC, threshold) = 1)
        SELECT *, CAST(row_number() OVER ({'PARTITION BY ' + by if by else ''} ORDER BY gain DESC, feature) AS INTEGER) AS place FROM f"""


def _ridge_sql() -> str:
    """Two features: centred and scaled sums of the training rows, solved by determinants."""
    names = ["x", "z", "y"]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    sums = ", ".join([f"sum({a}) AS s{a}" for a in names] + [f"sum({a} * {b}) AS s{a}{b}" for a, b in pairs])
    train = ", ".join([f"CAST(t.n - f.n AS DOUBLE) AS n", *[f"CAST(t.s{a} - f.s{a} AS DOUBLE) / (t.n - f.n) AS m{a}" for a in names], *[f"CAST(t.s{a}{b} - f.s{a}{b} AS DOUBLE) AS p{a}{b}" for a, b in pairs]])
    centred = ", ".join(f"p{a}{b} / n - m{a} * m{b} AS c{a}{b}" for a, b in pairs)
    return f"""WITH l AS (SELECT {_fold('l_orderkey')} AS fold, CAST(l_quantity AS HUGEINT) AS x, CAST(round(l_discount * 100) AS HUGEINT) AS z, CAST(round(l_extendedprice * 100) AS HUGEINT) AS y FROM lineitem),
        f AS (SELECT CAST(fold AS INTEGER) AS fold, count(*) AS n, {sums} FROM l GROUP BY 1), t AS (SELECT count(*) AS n, {sums} FROM l),
        a AS (SELECT f.*, t.n - f.n AS n_train, {train.replace(' AS n,', ' AS nt,', 1)} FROM f, t),
        c AS (SELECT *, {centred.replace('/ n', '/ nt')} FROM a),
        g AS (SELECT *, 1 + penalty AS d, cxz / sqrt(cxx * czz) AS o, cxy / sqrt(cxx) AS bx, czy / sqrt(czz) AS bz FROM c, (SELECT CAST(unnest({list(PENALTIES)}) AS DOUBLE) AS penalty)),
        w AS (SELECT *, (d * bx - o * bz) / (d * d - o * o) / sqrt(cxx) AS wx, (d * bz - o * bx) / (d * d - o * o) / sqrt(czz) AS wz FROM g),
        i AS (SELECT *, my - wx * mx - wz * mz AS b FROM w)
        SELECT fold, penalty, n_train, n AS n_test, round(sqrt((syy + n * b * b + wx * wx * sxx + wz * wz * szz - 2 * b * sy - 2 * wx * sxy - 2 * wz * szy + 2 * b * wx * sx + 2 * b * wz * sz + 2 * wx * wz * sxz) / n), 2) AS rmse,
          round(b, 2) AS intercept, round(wx, 3) AS w_quantity, round(wz, 3) AS w_discount FROM i"""


ORACLES = {
    "m3_best_splits": _splits(
        "(SELECT *, date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS days_to_ship FROM lineitem JOIN orders ON l_orderkey = o_orderkey)",
        {f: f for f in SPLIT_FEATURES}, "l_returnflag", ["'A'", "'N'", "'R'"],
    ),
    "m4_residual_splits": _splits(
        "orders", {"month": "month(o_orderdate)", "day": "day(o_orderdate)", "customer_group": "o_custkey % 97"}, "CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END", ["0", "1"], "o_orderstatus"
    ),
    "m7_choose_k": f"""WITH {_SEGMENTS},
        {lloyd.lloyd_sql('v', 'o_custkey', SEGMENT_KS, SEGMENT_ROUNDS)},
        y AS (SELECT k, number, count(*) AS n, CAST(sum(d) AS BIGINT) AS cost, sum(CASE WHEN other > 0 THEN (sqrt(other) - sqrt(d)) / sqrt(other) ELSE 0.0 END) AS lead FROM p GROUP BY ALL),
        z AS (SELECT k, CAST(sum(n) AS BIGINT) AS n, CAST(sum(cost) AS BIGINT) AS cost, round(sum(lead) / sum(n), 6) AS silhouette, max(n) AS largest FROM y GROUP BY k)
        SELECT *, CASE WHEN k = (SELECT k FROM z ORDER BY silhouette DESC, k LIMIT 1) THEN 1 ELSE 0 END AS chosen FROM z""",
    "m7_segments": f"WITH {_SEGMENTS}, {lloyd.lloyd_sql('v', 'o_custkey', [4], SEGMENT_ROUNDS)} SELECT o_custkey, number, d AS own FROM p",
    "m8_message_bayes": f"WITH {_MESSAGES} SELECT conv_id, turn, predicted, margin FROM r",
    "m8_message_report": f"""WITH {_MESSAGES}, e AS (SELECT label, predicted FROM d JOIN r USING (conv_id, turn) WHERE held AND label IS NOT NULL),
        h AS (SELECT q.label, count(*) FILTER (e.label = q.label) AS support, count(*) FILTER (e.predicted = q.label) AS predicted,
          count(*) FILTER (e.label = q.label AND e.predicted = q.label) AS hits FROM (SELECT label FROM e UNION SELECT predicted FROM e) q, e GROUP BY 1)
        SELECT CAST(sum(support) AS BIGINT) AS n, round(sum(hits) / sum(support), 6) AS accuracy, round(avg(2 * hits / (support + predicted)) FILTER (support > 0), 6) AS macro_f1,
          round(sum(2 * hits / (support + predicted) * support) / sum(support), 6) AS weighted_f1,
          round((sum(hits) / sum(support) - sum(support * predicted) / (sum(support) * sum(support))) / (1 - sum(support * predicted) / (sum(support) * sum(support))), 6) AS kappa FROM h""",
    "m10_ridge_grid": _ridge_sql(),
    "m14_roc_curve": f"WITH {_SCORES} SELECT lang, score, pos, neg, tp, fp FROM u",
    "m14_binary_metrics": f"""WITH {_SCORES}, r AS (SELECT lang, CAST(sum(pos) + sum(neg) AS BIGINT) AS n, CAST(sum(pos) AS BIGINT) AS positives,
          sum(neg * (2 * tp - pos)) / (2.0::DOUBLE * sum(pos) * sum(neg)) AS auc, sum(pos * (tp / (tp + fp))) / sum(pos) AS average_precision FROM u GROUP BY 1),
        t AS (SELECT lang, sum(CASE WHEN score >= 0.5 THEN pos ELSE 0 END) AS a, sum(CASE WHEN score >= 0.5 THEN neg ELSE 0 END) AS b, sum(CASE WHEN score < 0.5 THEN pos ELSE 0 END) AS c,
          sum(CASE WHEN score < 0.5 THEN neg ELSE 0 END) AS d, -sum(pos * ln(least(greatest(score, 1e-15), 1 - 1e-15)) + neg * ln(1 - least(greatest(score, 1e-15), 1 - 1e-15))) AS loss,
          sum(pos * (1 - score) ** 2 + neg * score ** 2) AS square FROM n GROUP BY 1)
        SELECT lang, n, positives, round(auc, 6) AS auc, round(average_precision, 6) AS average_precision, CAST(a + d AS BIGINT) AS hits, round((a + d) / (a + b + c + d), 6) AS accuracy,
          round(CASE WHEN a + b > 0 THEN a / (a + b) END, 6) AS precision, round(CASE WHEN a + c > 0 THEN a / (a + c) END, 6) AS recall, round(2 * a / (2 * a + b + c), 6) AS f1,
          round(loss / (a + b + c + d), 6) AS log_loss, round(square / (a + b + c + d), 6) AS brier FROM r JOIN t USING (lang)""",
    "m14_regression_metrics": """WITH p AS (SELECT l_returnflag, l_extendedprice AS y, l_quantity * 1500.0 AS v, avg(l_extendedprice) OVER (PARTITION BY l_returnflag) AS m FROM lineitem)
        SELECT l_returnflag, count(*) AS n, round(sqrt(avg((y - v) ** 2)), 4) AS rmse, round(avg(abs(y - v)), 4) AS mae, round(avg(v - y), 4) AS bias,
          round(1 - sum((y - v) ** 2) / sum((y - m) ** 2), 4) AS r2 FROM p GROUP BY 1""",
    "m17_word_contributions": f"""WITH {_LANGUAGES},
        t AS (SELECT doc_id, term, tf, r.predicted, margin FROM tf JOIN r USING (doc_id)),
        h AS (SELECT t.doc_id, t.term, any_value(tf) AS tf, any_value(predicted) AS predicted, any_value(margin) AS margin,
          coalesce(sum(CASE WHEN k.label = predicted THEN {_units('k.n + 1')} END), 0) AS own, sum({_units('k.n + 1')}) AS every FROM t JOIN k ON k.term = t.term GROUP BY 1, 2),
        i AS (SELECT doc_id, predicted, term, tf, CAST(tf * ((SELECT count(*) FROM c) * (own + (SELECT unseen FROM c WHERE c.label = predicted)) - every - (SELECT sum(unseen) FROM c)) AS BIGINT) AS contribution FROM h)
        SELECT doc_id, predicted, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY contribution DESC, term) AS INTEGER) AS place, term, tf, contribution FROM i
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY contribution DESC, term) <= 5""",
    "m17_text_margins": f"""SELECT CAST(number AS INTEGER) AS class, count(*) AS n_test, CAST(0 AS BIGINT) AS n_off
        FROM documents, (SELECT unnest(range(0, (SELECT count(DISTINCT lang) FROM documents))) AS number) WHERE {_fold('doc_id')} = 0 AND lang IS NOT NULL GROUP BY number""",
    "m18_cluster_distance": f"""WITH v AS (SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(CAST(c AS DOUBLE) * {VECTOR_SCALE}) AS BIGINT)) AS x FROM embeddings),
        {lloyd.lloyd_sql('v', 'vec_id', [VECTOR_K], VECTOR_ROUNDS)},
        y AS (SELECT vec_id, number, sqrt(d) AS distance, avg(sqrt(d)) OVER w AS m, stddev_samp(sqrt(d)) OVER w AS s FROM p WINDOW w AS (PARTITION BY number))
        SELECT vec_id, number, round(distance, 4) AS distance FROM y WHERE distance > m + 2 * s""",
    "m19_language_bayes": f"WITH {_LANGUAGES} SELECT doc_id, predicted, margin FROM r",
    "m20_numeric_drift": f"""WITH {_HALF}, q AS (SELECT feature, list(value ORDER BY value) AS a FROM l WHERE NOT cur AND value IS NOT NULL GROUP BY 1),
        e AS (SELECT feature, list_distinct(list_transform(range(1, {DRIFT_BINS}), lambda i: a[CAST(floor((len(a) - 1) * (i / {DRIFT_BINS})) AS BIGINT) + 1])) AS edges FROM q),
        b AS (SELECT l.feature, CASE WHEN value IS NULL THEN -1 ELSE len(list_filter(edges, lambda g: g < value)) END AS bin, list_max(list_filter(edges, lambda g: g < value)) AS low, cur FROM l LEFT JOIN e USING (feature)),
        c AS (SELECT feature, CAST(bin AS INTEGER) AS bin, max(low) AS low, count(*) FILTER (NOT cur) AS n_ref, count(*) FILTER (cur) AS n_cur FROM b GROUP BY 1, 2),
        s AS (SELECT *, greatest(n_ref / sum(n_ref) OVER (PARTITION BY feature), 1e-6) AS p, greatest(n_cur / sum(n_cur) OVER (PARTITION BY feature), 1e-6) AS r FROM c)
        SELECT feature, bin, low, n_ref, n_cur, round((r - p) * ln(r / p), 8) AS psi_part FROM s""",
    "m20_ks_distance": f"""WITH {_HALF}, n AS (SELECT feature, value, count(*) FILTER (NOT cur) AS a, count(*) FILTER (cur) AS b FROM l WHERE value IS NOT NULL GROUP BY 1, 2),
        t AS (SELECT feature, sum(a) AS n_ref, sum(b) AS n_cur FROM n GROUP BY 1),
        u AS (SELECT feature, value, round(abs(sum(a) OVER w / n_ref - sum(b) OVER w / n_cur), 12) AS gap, n_ref, n_cur FROM n JOIN t USING (feature) WINDOW w AS (PARTITION BY feature ORDER BY value))
        SELECT feature, CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur, round(gap, 9) AS distance, value AS at FROM u QUALIFY row_number() OVER (PARTITION BY feature ORDER BY gap DESC, value) = 1""",
}
