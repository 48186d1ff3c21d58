"""Machine learning over documents, orders, customers, embeddings and events.

The fixtures carry signal for document quality and language. They carry none
for large orders or credit: those labels are proxies of our own, and their
results say so.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from millrace.ml import insight, metrics, models, relations
from millrace.operators.quantiles import quantiles
from millrace.operators.relational import exact
from millrace.session import scratch_dir, settle, spread, table

TEXT_NUMBERS = ["n_words", "word_length", "letter_share", "digit_share", "mark_share", "upper_share", "n_lines", "line_repeat"]


def labelled_documents(spark, sf_dir):
    """Documents that have labels, with measurements of their whole text."""
    docs = spread(table(spark, sf_dir, "documents"), "doc_id").join(table(spark, sf_dir, "labels"), "doc_id")
    size = F.greatest(F.length("text"), F.lit(1))
    words, lines = F.regexp_count("text", F.lit(r"\p{L}+")), F.split("text", "\n")
    return docs.select(
        "doc_id", "lang", "text", "quality", "toxic",
        words.alias("n_words"),
        (F.regexp_count("text", F.lit(r"\p{L}")) / F.greatest(words, F.lit(1))).alias("word_length"),
        (F.regexp_count("text", F.lit(r"\p{L}")) / size).alias("letter_share"),
        (F.regexp_count("text", F.lit("[0-9]")) / size).alias("digit_share"),
        (F.regexp_count("text", F.lit(r"[^\p{L}\p{N}\s]")) / size).alias("mark_share"),
        (F.regexp_count("text", F.lit(r"\p{Lu}")) / size).alias("upper_share"),
        F.size(lines).alias("n_lines"),
        (1 - F.size(F.array_distinct(lines)) / F.size(lines)).alias("line_repeat"),
        F.col("quality").cast("double").alias("label"),
    )


def _quality_model(spark, sf_dir, estimator):
    measured = settle(labelled_documents(spark, sf_dir).drop("text"), "measured")
    train, test = models.split(measured, "doc_id")
    model = models.fit(train, models.feature_stages(["lang"], TEXT_NUMBERS), estimator)
    return model, train, test


def _report(spark, train, pred, good):
    """Row counts and whether held-out rows are predicted better than chance allows."""
    measured = models.classification_metrics(pred)
    row = [(train.count(), pred.count(), int(good(measured)))]
    return spark.createDataFrame(row, "n_train long, n_test long, learned int")


def m1_features(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    cat = ["c_mktsegment", "c_nationkey"]
    vectors = Pipeline(stages=models.feature_stages(cat, ["c_acctbal"])).fit(customer).transform(customer)
    slots = vectors.select(F.size(vector_to_array("features")).alias("slots"))
    return slots.groupBy("slots").agg(F.count("*").alias("n"))


def m2_logistic(spark, sf_dir):
    model, train, test = _quality_model(spark, sf_dir, models.logistic())
    return _report(spark, train, model.transform(test), lambda m: m["auc"] > 0.6)


def m3_forest(spark, sf_dir):
    model, train, test = _quality_model(spark, sf_dir, models.forest())
    return _report(spark, train, model.transform(test), lambda m: m["auc"] > 0.6)


def m4_boosted_trees(spark, sf_dir):
    model, train, test = _quality_model(spark, sf_dir, models.boosted())
    return _report(spark, train, model.transform(test), lambda m: m["auc"] > 0.6)


def m5_linear_regression(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_quantity", F.col("l_extendedprice").alias("label"))
    model = models.fit(rows, models.feature_stages([], ["l_quantity"], scale=False), models.linear(solver="normal"))
    last = model.stages[-1]
    row = [(round(float(last.coefficients[0]), 4), round(float(last.intercept), 3), last.summary.numInstances)]
    return spark.createDataFrame(row, "slope double, intercept double, n long")


def m5_forest_regression(spark, sf_dir):
    """Length of a document from its counts of words and lines, scored on held-out documents."""
    docs = spread(table(spark, sf_dir, "documents"), "doc_id").select(
        "doc_id", "lang", F.col("n_chars").cast("double").alias("label"),
        F.regexp_count("text", F.lit(r"\p{L}+")).alias("n_words"), F.size(F.split("text", "\n")).alias("n_lines"),
    )
    train, test = models.split(docs, "doc_id")
    model = models.fit(train, models.feature_stages(["lang"], ["n_words", "n_lines"], scale=False), models.forest_regressor())
    measured = models.regression_metrics(model.transform(test))
    return spark.createDataFrame([(train.count(), test.count(), int(measured["r2"] > 0.7))], "n_train long, n_test long, learned int")


def _vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


def m6_kmeans(spark, sf_dir):
    """Vectors, clusters in use, and vectors that do not lie in the cluster of their nearest centre."""
    rows = _vectors(spark, sf_dir)
    model = models.fit_kmeans(rows, 10)
    centres = F.array(*[F.struct(F.array(*[F.lit(float(x)) for x in c]).alias("at"), F.lit(i).alias("number")) for i, c in enumerate(model.clusterCenters())])
    own = vector_to_array("features")
    squared = lambda at: F.aggregate(F.zip_with(own, at, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    distances = F.transform(centres, lambda c: squared(c["at"]))
    placed = model.transform(rows).select("prediction", distances.alias("d"))
    off = F.get("d", "prediction") > F.array_min("d") + 1e-6
    return placed.agg(F.count("*").alias("n"), F.countDistinct("prediction").alias("n_clusters"), F.count_if(off).alias("n_misplaced"))


def m7_rfm(spark, sf_dir):
    return relations.rfm(table(spark, sf_dir, "orders"))


def m8_text_classifier(spark, sf_dir):
    train, test = models.split(labelled_documents(spark, sf_dir).select("doc_id", "text", "label"), "doc_id")
    model = models.fit(train, models.text_stages("text"), models.logistic(regParam=0.1))
    return _report(spark, train, model.transform(test), lambda m: m["auc"] > 0.6)


def m9_tfidf(spark, sf_dir):
    """Per document: its number of terms, the sum of weights and the heaviest weight."""
    weighted = relations.tfidf(spread(table(spark, sf_dir, "documents"), "doc_id").select("doc_id", "text"), "doc_id", "text")
    return weighted.groupBy("doc_id").agg(
        F.count("*").alias("n_terms"), F.round(F.sum("tfidf"), 3).alias("total"), F.round(F.max("tfidf"), 6).alias("top")
    )


def m10_cross_validate(spark, sf_dir):
    rows = labelled_documents(spark, sf_dir).drop("text")
    stages = models.feature_stages(["lang"], TEXT_NUMBERS)
    prepared = Pipeline(stages=stages).fit(rows).transform(rows).select("doc_id", "label", "features")
    lr = models.logistic(maxIter=20)
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.001, 0.01, 0.1]).addGrid(lr.elasticNetParam, [0.0, 0.5]).build()
    return models.cross_validate(prepared, "doc_id", lr, grid, BinaryClassificationEvaluator())[1]


def transactions(spark, sf_dir):
    """Orders with what is known besides their amount."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("n_lines"),
        (F.sum(exact(F.col("l_discount"))).cast("double") / F.count("*")).alias("mean_discount"),
        F.sum(exact(F.col("l_quantity"))).cast("double").alias("quantity"),
    )
    orders = table(spark, sf_dir, "orders")
    joined = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select(
        "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority",
        F.month("o_orderdate").cast("double").alias("month"),
        F.coalesce(F.col("n_lines").cast("double"), F.lit(0.0)).alias("n_lines"), "mean_discount", "quantity",
    )


def _large(spark, sf_dir):
    """Training and test transactions, and the training rows' 90th percentile of the amount."""
    # Every stage of a pipeline reads its rows anew, so lines are summed and joined once.
    train, test = models.split(settle(transactions(spark, sf_dir), "transactions"), "o_orderkey")
    cut = quantiles(train.withColumn("_all", F.lit(0)), ["_all"], "o_totalprice", [0.9]).first()["quantile"]
    return train, test, cut


def m11_large_transactions(spark, sf_dir):
    """LR and RF for "large": above the training rows' 90th percentile. The amount itself is no feature.

    All measures of each model on the test rows, beside the share of the most frequent label.
    """
    train, test, cut = _large(spark, sf_dir)
    label = (F.col("o_totalprice") > cut).cast("double").alias("label")
    cat, num = ["o_orderstatus", "o_orderpriority"], ["month", "n_lines", "mean_discount", "quantity"]
    out = []
    for name, estimator in (("logistic", models.logistic()), ("forest", models.forest())):
        model = models.fit(train.select("o_orderkey", *cat, *num, label), models.feature_stages(cat, num), estimator)
        pred = model.transform(test.select("o_orderkey", *cat, *num, label)).select("label", F.get(vector_to_array("probability"), 1).alias("score"))
        measured = metrics.binary_metrics(settle(pred, "large"), [], "score", "label")
        out.append(measured.select(F.lit(name).alias("model"), F.lit(cut).alias("cut"), "*", (F.greatest("positives", F.col("n") - F.col("positives")) / F.col("n")).alias("majority")))
    return metrics.rounded(out[0].unionByName(out[1]))


def m11_transaction_counts(spark, sf_dir):
    """The cut, and the rows and the large ones that the models of large transactions learn from and are tested on."""
    train, test, cut = _large(spark, sf_dir)
    large = F.col("o_totalprice") > cut
    sides = [df.agg(F.lit(side).alias("side"), F.count("*").alias("n"), F.count_if(large).alias("large")) for side, df in (("train", train), ("test", test))]
    return sides[0].unionByName(sides[1]).withColumn("cut", F.round(F.lit(cut), 4))


def applicants(spark, sf_dir):
    """Customers with their order history. The label is a proxy: a negative balance, which is no feature."""
    customer = table(spark, sf_dir, "customer")
    history = relations.rfm(table(spark, sf_dir, "orders"))
    joined = customer.join(history, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select(
        "c_custkey", "c_mktsegment", "c_nationkey", "recency", "frequency", "money",
        (F.col("c_acctbal") < 0).cast("double").alias("label"),
    )


def m12_credit_score(spark, sf_dir):
    """The card of a credit model: purpose, limits, rows, measures, the verdict against chance, and rates of each segment."""
    train, test = models.split(applicants(spark, sf_dir), "c_custkey")
    cat, num = ["c_mktsegment", "c_nationkey"], ["recency", "frequency", "money"]
    model = models.fit(train, models.feature_stages(cat, num), models.logistic())
    return insight.model_card(
        model.transform(test), "credit-score", "demonstration of scoring with documentation",
        "proxy label; not for decisions on people", "label", "c_mktsegment", train.count(),
    )


def m12_credit_counts(spark, sf_dir):
    """What the card of the credit model counts, and whether its rates are shares."""
    return _counts_of(m12_credit_score(spark, sf_dir))


def _counts_of(card):
    """The rows of a card that count something."""
    share = F.coalesce(F.col("value").between(0, 1), F.lit(True)).cast("int").alias("is_share")
    return card.where("n is not null").select("name", "section", "item", "n", share)


def m13_save_load(spark, sf_dir):
    """Predictions of a stored and reloaded model next to the original's."""
    model, _, test = _quality_model(spark, sf_dir, models.logistic())
    root = scratch_dir(spark, "registry")
    pred = model.transform(test)
    models.save_version(model, root, "quality", {"accuracy": models.classification_metrics(pred)["accuracy"]})
    again = models.load_version(spark, root, "quality").transform(test)
    both = pred.select("doc_id", F.col("prediction").alias("a")).join(again.select("doc_id", F.col("prediction").alias("b")), "doc_id")
    return both.agg(F.count("*").alias("n_test"), F.sum((F.col("a") != F.col("b")).cast("long")).alias("n_differing"))


def _rule_predictions(spark, sf_dir):
    """Long documents are predicted to be good ones."""
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id").select(
        F.col("quality").cast("double").alias("label"), (F.col("n_chars") > 1000).cast("double").alias("prediction")
    )


def m14_confusion(spark, sf_dir):
    return models.confusion(_rule_predictions(spark, sf_dir))


def m14_precision_recall(spark, sf_dir):
    return models.precision_recall(_rule_predictions(spark, sf_dir))


def m15_data_card(spark, sf_dir):
    return insight.data_card(table(spark, sf_dir, "documents"), "documents", "source")


def m15_model_card(spark, sf_dir):
    model, train, test = _quality_model(spark, sf_dir, models.forest())
    return insight.model_card(
        model.transform(test), "quality-forest", "sorting documents for review", "trained on invented prose", "label", "lang", train.count()
    )


def m15_model_counts(spark, sf_dir):
    """What the card of the quality model counts, and whether its rates are shares."""
    return _counts_of(m15_model_card(spark, sf_dir))


def m16_disparate_impact(spark, sf_dir):
    """Selection by a fixed rule, a balance above 6000, compared between segments."""
    return relations.disparate_impact(table(spark, sf_dir, "customer"), "c_mktsegment", F.col("c_acctbal") > 6000)


def m17_contributions(spark, sf_dir):
    """Whether the contributions and the intercept of every row add up to its margin."""
    model, _, test = _quality_model(spark, sf_dir, models.logistic())
    last = model.stages[-1]
    parts = insight.contributions(model.transform(test), last, "doc_id")
    sums = parts.groupBy("doc_id").agg(F.sum("contribution").alias("s"), F.first("margin").alias("margin"))
    gap = F.abs(F.col("s") + float(last.intercept) - F.col("margin"))
    return sums.agg(F.count("*").alias("n_test"), F.sum((gap > 1e-6).cast("long")).alias("n_off"))


def m17_weights(spark, sf_dir):
    model, _, test = _quality_model(spark, sf_dir, models.forest())
    return insight.weights(model, insight.feature_names(model.transform(test), "raw_features"))


def m17_permutation_importance(spark, sf_dir):
    model, _, test = _quality_model(spark, sf_dir, models.logistic())
    evaluator = BinaryClassificationEvaluator()
    return insight.permutation_importance(model, test, "doc_id", TEXT_NUMBERS, evaluator.evaluate, buckets=64)


def m18_rolling_anomalies(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    found = relations.rolling_anomalies(events, ["event_type"], ["ts", "event_id"], "value", 50, 4.0)
    return found.select("event_id", "event_type", F.round("z", 4).alias("z"))


def m18_iqr_anomalies(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    found = relations.iqr_anomalies(events, ["event_type"], "value")
    return found.select("event_id", "event_type", "value", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


def m19_language_classifier(spark, sf_dir):
    """Many classes from text: the language of all documents, as a stand-in for kinds of legal text."""
    docs = spread(table(spark, sf_dir, "documents"), "doc_id").select("doc_id", "text", "lang")
    labelled = models.indexed(docs, "lang", "label")
    train, test = models.split(labelled, "doc_id")
    model = models.fit(train, models.text_stages("text", 1 << 12), models.logistic(regParam=0.1, maxIter=20))
    return _report(spark, train, model.transform(test), lambda m: m["accuracy"] > m["majority"] + 0.1)


def m20_drift_report(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    day = lambda f: F.to_date(f("ts"))
    # The first half of the days is the reference.
    middle = events.agg(F.date_add(day(F.min), F.floor(F.datediff(day(F.max), day(F.min)) / 2).cast("int")).cast("timestamp_ntz")).scalar()
    bins = {
        "event_type": F.col("event_type"),
        "value": F.when(F.col("value") >= 100, 10).otherwise(F.floor(F.col("value") / 10)).cast("int"),
    }
    report = relations.drift_report(events.where(F.col("ts") < middle), events.where(F.col("ts") >= middle), bins)
    return report.select("feature", "bin", "n_ref", "n_cur", F.round("psi_part", 8).alias("psi_part"))


QUERIES = {
    f.__name__: f
    for f in (
        m1_features, m2_logistic, m3_forest, m4_boosted_trees, m5_linear_regression, m5_forest_regression, m6_kmeans, m7_rfm,
        m8_text_classifier, m9_tfidf, m10_cross_validate, m11_large_transactions, m11_transaction_counts, m12_credit_score, m12_credit_counts,
        m13_save_load, m14_confusion, m14_precision_recall, m15_data_card, m15_model_card, m15_model_counts, m16_disparate_impact,
        m17_contributions, m17_weights, m17_permutation_importance, m18_rolling_anomalies, m18_iqr_anomalies,
        m19_language_classifier, m20_drift_report,
    )
}

_FOLD = "CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 5"
_LABELLED = "documents JOIN labels USING (doc_id)"
_COUNTS = f"SELECT count(*) FILTER ({_FOLD} <> 0) AS n_train, count(*) FILTER ({_FOLD} = 0) AS n_test, 1 AS learned FROM "
_RULE = f"rule AS (SELECT CAST(quality AS DOUBLE) AS label, CASE WHEN n_chars > 1000 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM {_LABELLED})"



def _card(name: str, source: str, key: str, group: str) -> str:
    test = _FOLD.replace("doc_id", key) + " = 0"
    groups = "".join(
        f"UNION ALL SELECT '{name}', 'group {m}', CAST({group} AS VARCHAR), count(*), 1 FROM {source} WHERE {test} GROUP BY {group} "
        for m in ("accuracy", "selection_rate")
    )
    return f"""SELECT '{name}' AS name, 'rows' AS section, 'train' AS item, count(*) FILTER (NOT ({test})) AS n, 1 AS is_share FROM {source}
        UNION ALL SELECT '{name}', 'rows', 'test', count(*) FILTER ({test}), 1 FROM {source} {groups}"""


ORACLES = {
    "m1_features": """SELECT CAST(count(DISTINCT c_mktsegment) + count(DISTINCT c_nationkey) + 1 AS INTEGER) AS slots, count(*) AS n FROM customer""",
    "m2_logistic": _COUNTS + _LABELLED,
    "m3_forest": _COUNTS + _LABELLED,
    "m4_boosted_trees": _COUNTS + _LABELLED,
    "m5_linear_regression": """SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept,
        count(*) AS n FROM lineitem""",
    "m5_forest_regression": _COUNTS + "documents",
    "m6_kmeans": "SELECT count(*) AS n, CAST(10 AS BIGINT) AS n_clusters, CAST(0 AS BIGINT) AS n_misplaced FROM embeddings",
    "m7_rfm": """SELECT o_custkey, CAST(date_diff('day', max(o_orderdate), (SELECT max(o_orderdate) FROM orders)) AS INTEGER) AS recency,
        count(*) AS frequency, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS money FROM orders GROUP BY 1""",
    "m8_text_classifier": _COUNTS + _LABELLED,
    "m9_tfidf": """WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS term FROM documents),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM w GROUP BY 1, 2), df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1)
        SELECT doc_id, count(*) AS n_terms, round(sum(tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1))), 3) AS total,
          round(max(tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1))), 6) AS top FROM tf JOIN df USING (term) GROUP BY 1""",
    "m11_transaction_counts": f"""WITH s AS (SELECT o_totalprice AS x, {_FOLD.replace('doc_id', 'o_orderkey')} = 0 AS test FROM orders),
        c AS (SELECT quantile_cont(x, 0.9) AS cut FROM s WHERE NOT test)
        SELECT CASE WHEN test THEN 'test' ELSE 'train' END AS side, count(*) AS n, count(*) FILTER (x > cut) AS large, round(any_value(cut), 4) AS cut FROM s, c GROUP BY test""",
    "m12_credit_counts": _card("credit-score", "customer", "c_custkey", "c_mktsegment"),
    "m15_model_counts": _card("quality-forest", _LABELLED, "doc_id", "lang"),
    "m15_data_card": """SELECT 'documents' AS name, 'rows' AS section, 'all' AS item, count(*) AS n FROM documents
        UNION ALL SELECT 'documents', 'nulls', 'doc_id bigint', count(*) FILTER (doc_id IS NULL) FROM documents
        UNION ALL SELECT 'documents', 'nulls', 'text string', count(*) FILTER (text IS NULL) FROM documents
        UNION ALL SELECT 'documents', 'nulls', 'lang string', count(*) FILTER (lang IS NULL) FROM documents
        UNION ALL SELECT 'documents', 'nulls', 'source string', count(*) FILTER (source IS NULL) FROM documents
        UNION ALL SELECT 'documents', 'nulls', 'n_chars bigint', count(*) FILTER (n_chars IS NULL) FROM documents
        UNION ALL SELECT 'documents', 'label_balance', source, count(*) FROM documents GROUP BY source""",
    "m13_save_load": f"SELECT count(*) FILTER ({_FOLD} = 0) AS n_test, CAST(0 AS BIGINT) AS n_differing FROM {_LABELLED}",
    "m14_confusion": f"WITH {_RULE} SELECT label, prediction, count(*) AS n FROM rule GROUP BY 1, 2",
    "m14_precision_recall": f"""WITH {_RULE}, c AS (SELECT unnest([0.0::DOUBLE, 1.0::DOUBLE]) AS class),
        s AS (SELECT class, count(*) FILTER (label = class) AS support, count(*) FILTER (label = class AND prediction = class) AS hits,
          count(*) FILTER (prediction = class) AS predicted FROM c, rule GROUP BY class)
        SELECT class, support, round(hits / predicted, 6) AS precision, round(hits / support, 6) AS recall,
          round(2 * (hits / predicted) * (hits / support) / (hits / predicted + hits / support), 6) AS f1 FROM s""",
    "m16_disparate_impact": """WITH r AS (SELECT c_mktsegment, count(*) AS n, avg(CASE WHEN c_acctbal > 6000 THEN 1 ELSE 0 END) AS rate FROM customer GROUP BY 1)
        SELECT c_mktsegment, n, round(rate, 6) AS rate, round(rate / (SELECT max(rate) FROM r), 6) AS ratio,
          CASE WHEN rate / (SELECT max(rate) FROM r) < 0.8 THEN 1 ELSE 0 END AS flagged FROM r""",
    "m17_contributions": f"SELECT count(*) FILTER ({_FOLD} = 0) AS n_test, CAST(0 AS BIGINT) AS n_off FROM {_LABELLED}",
    "m18_rolling_anomalies": """WITH s AS (SELECT event_id, event_type, value, count(*) OVER w AS n, avg(value) OVER w AS m, stddev_samp(value) OVER w AS d
          FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING))
        SELECT event_id, event_type, round((value - m) / d, 4) AS z FROM s WHERE n = 50 AND abs((value - m) / d) > 4""",
    "m18_iqr_anomalies": """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events GROUP BY 1)
        SELECT event_id, e.event_type, value, round(a - 1.5 * (b - a), 6) AS low, round(b + 1.5 * (b - a), 6) AS high
        FROM events e JOIN q ON e.event_type = q.event_type WHERE value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a)""",
    "m19_language_classifier": _COUNTS + "documents",
    "m20_drift_report": """WITH m AS (SELECT CAST(min(ts) AS DATE) + CAST(date_diff('day', min(ts), max(ts)) // 2 AS INTEGER) AS middle FROM events),
        c AS (SELECT 'event_type' AS feature, event_type AS bin, ts FROM events UNION ALL SELECT 'value',
          CAST(CASE WHEN value >= 100 THEN 10 ELSE CAST(floor(value / 10) AS INTEGER) END AS VARCHAR), ts FROM events),
        b AS (SELECT feature, bin, count(*) FILTER (ts < (SELECT middle FROM m)) AS n_ref, count(*) FILTER (ts >= (SELECT middle FROM m)) AS n_cur FROM c GROUP BY 1, 2),
        s AS (SELECT *, greatest(n_ref / sum(n_ref) OVER (PARTITION BY feature), 1e-6) AS p, greatest(n_cur / sum(n_cur) OVER (PARTITION BY feature), 1e-6) AS q FROM b)
        SELECT feature, bin, n_ref, n_cur, round((q - p) * ln(q / p), 8) AS psi_part FROM s""",
}
