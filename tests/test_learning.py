"""Learning jobs on synthetic rows with a planted signal."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from millrace.ml import insight, models, relations
from millrace.operators.privacy import synth_rows

CAT, NUM = ["area"], ["age", "balance"]


@pytest.fixture(scope="module")
def rows(spark):
    return synth_rows(spark.range(3000), "id", 11).withColumn("label", F.col("large").cast("double")).cache()


@pytest.fixture(scope="module")
def fitted(rows):
    train, test = models.split(rows, "id")
    return models.fit(train, models.feature_stages(CAT, NUM), models.logistic()), train, test


@pytest.mark.parametrize("make", [models.logistic, models.forest, models.boosted])
def test_classifiers_find_the_signal(rows, make):
    train, test = models.split(rows, "id")
    metrics = models.classification_metrics(models.fit(train, models.feature_stages(CAT, NUM), make()).transform(test))
    assert metrics["auc"] > 0.95 and metrics["accuracy"] > metrics["majority"] + 0.1


def test_the_same_seed_gives_the_same_forest(rows):
    one, two = (models.fit(rows, models.feature_stages(CAT, NUM), models.forest(numTrees=5)).stages[-1] for _ in range(2))
    assert one.toDebugString.split("\n")[1:] == two.toDebugString.split("\n")[1:]


def test_folds_do_not_depend_on_order(rows):
    a = {r["id"]: r["f"] for r in rows.select("id", models.fold("id", 5).alias("f")).collect()}
    b = {r["id"]: r["f"] for r in rows.repartition(5).orderBy(F.desc("id")).select("id", models.fold("id", 5).alias("f")).collect()}
    assert a == b and set(a.values()) == set(range(5))


def test_many_categories_are_hashed(rows):
    hashed = models.feature_stages(["area"], ["age"], hashed=["id"])
    assert Pipeline(stages=hashed).fit(rows).transform(rows).count() == 3000


def test_versions(spark, fitted, tmp_path):
    model, _, test = fitted
    root = str(tmp_path)
    assert [models.save_version(model, root, "m", {"auc": 0.5}) for _ in range(2)] == [1, 2]
    again = models.load_version(spark, root, "m", 1).transform(test)
    joined = again.select("id", F.col("prediction").alias("p")).join(model.transform(test), "id")
    assert joined.where("p <> prediction").count() == 0
    with pytest.raises(LookupError):
        models.load_version(spark, root, "m", 7)


def test_contributions_add_up(fitted):
    model, _, test = fitted
    last = model.stages[-1]
    parts = insight.contributions(model.transform(test), last, "id").groupBy("id").agg(F.sum("contribution").alias("s"), F.first("margin").alias("m"))
    assert parts.where(F.abs(F.col("s") + last.intercept - F.col("m")) > 1e-6).count() == 0


def test_permutation_keeps_values_and_finds_the_column(fitted):
    model, _, test = fitted
    moved = insight.permuted(test, "id", "balance", 3)
    assert moved.select("balance").exceptAll(test.select("balance")).count() == 0
    assert moved.join(test.select("id", F.col("balance").alias("b")), "id").where("b = balance").count() < 30
    drops = {r["column"]: r["drop"] for r in insight.permutation_importance(model, test, "id", ["balance", "area"], BinaryClassificationEvaluator().evaluate, 3).collect()}
    assert drops["balance"] > 0.1 > abs(drops["area"])


def test_grid_search(rows):
    ready = Pipeline(stages=models.feature_stages(CAT, NUM)).fit(rows).transform(rows).select("id", "label", "features")
    lr = models.logistic()
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.001, 10.0]).build()
    model, table = models.cross_validate(ready, "id", lr, grid, BinaryClassificationEvaluator(metricName="areaUnderPR"))
    assert table.count() == 2 and model.bestModel.getRegParam() == 0.001


def test_choose_k_finds_the_planted_groups(spark):
    from pyspark.ml.feature import VectorAssembler

    points = spark.range(600).select(((F.col("id") % 3) * 100 + F.rand(1)).alias("x"), F.rand(2).alias("y"))
    table, best = models.choose_k(VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(points), [2, 3, 4])
    assert len(best.clusterCenters()) == 3 and table.count() == 3


def test_cards(fitted):
    model, train, test = fitted
    card = insight.model_card(model.transform(test), "m", "use", "limits", "label", "area", train.count()).collect()
    facts = {(r["section"], r["item"]): r for r in card}
    assert facts["metrics", "verdict"]["text"] == "better than chance" and facts["metrics", "auc"]["value"] > 0.95
    groups = [r for r in card if r["section"] == "group accuracy"]
    assert {r["item"] for r in groups} == {"north", "south", "east", "west"}
    right = sum(r["n"] * r["value"] for r in groups) / facts["rows", "test"]["n"]
    assert abs(right - facts["metrics", "accuracy"]["value"]) < 1e-3


def test_a_data_card_has_a_row_for_each_of_very_many_labels(spark):
    df = spark.range(12_000).select("id", F.nullif(F.col("id") % 3, F.lit(0)).alias("x"))
    card = insight.data_card(df, "d", "id")
    assert card.where("section = 'label_balance'").agg(F.count("*"), F.sum("n")).first()[:] == (12_000, 12_000)
    assert {r["item"]: r["n"] for r in card.where("section in ('rows', 'nulls')").collect()} == {"all": 12_000, "id bigint": 0, "x bigint": 4_000}


def test_disparate_impact_flags_a_group(spark):
    df = spark.createDataFrame([("a", 1)] * 8 + [("a", 0)] * 2 + [("b", 1)] * 5 + [("b", 0)] * 5, "g string, p int")
    got = {r["g"]: (r["rate"], r["ratio"], r["flagged"]) for r in relations.disparate_impact(df, "g", F.col("p") == 1).collect()}
    assert got == {"a": (0.8, 1.0, 0), "b": (0.5, 0.625, 1)}
    nobody = relations.disparate_impact(df, "g", F.col("p") == 2).collect()
    assert [r["ratio"] for r in nobody] == [None, None]


def test_no_drift_against_itself(rows):
    same = relations.drift_report(rows, rows, {"area": F.col("area")})
    assert same.agg(F.sum("psi_part")).first()[0] == 0
    moved = relations.drift_report(rows, rows.where("area <> 'north'"), {"area": F.col("area")})
    assert moved.agg(F.sum("psi_part")).first()[0] > 0.25


def test_tfidf(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "b")], "d long, t string")
    got = {(r["d"], r["term"]): (r["tf"], round(r["tfidf"], 6)) for r in relations.tfidf(docs, "d", "t").collect()}
    assert got == {(1, "a"): (2, round(2 * 0.4054651, 6)), (1, "b"): (1, 0.0), (2, "b"): (1, 0.0)}


def test_fences_find_the_outlier(spark):
    df = spark.range(100).select(F.nullif(F.col("id") % 2, F.lit(1)).alias("g"), F.when(F.col("id") == 7, 1e6).otherwise(F.col("id") * 1.0).alias("v"))
    assert [r["v"] for r in relations.iqr_anomalies(df, ["g"], "v").collect()] == [1e6]
