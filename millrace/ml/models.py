"""Feature preparation, training, tuning and storage of MLlib pipelines.

Training runs as Spark jobs over partitioned rows; the driver holds fitted
parameters only. Input that is scanned by many jobs is persisted with spill to disk.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from itertools import takewhile

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    ClusteringEvaluator,
    Evaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.feature import (
    IDF,
    FeatureHasher,
    HashingTF,
    Imputer,
    OneHotEncoder,
    RegexTokenizer,
    StandardScaler,
    StopWordsRemover,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@contextmanager
def kept(df: DataFrame):
    """Persist input for the length of a block."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def fold(key: str, folds: int) -> Column:
    """A fold number from a hash of the key: fixed across runs, clusters and row orders."""
    digits = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long")
    return (digits % folds).cast("int")


def split(df: DataFrame, key: str, folds: int = 5) -> tuple[DataFrame, DataFrame]:
    """Training rows and the held-out fold 0."""
    numbered = df.withColumn("fold", fold(key, folds))
    return numbered.where("fold <> 0"), numbered.where("fold = 0")


def feature_stages(cat: Sequence[str], num: Sequence[str], hashed: Sequence[str] = (), scale: bool = True) -> list:
    """Index, one-hot, impute, assemble and scale.

    The categories of `cat` are part of the model, which the driver holds; columns whose categories
    grow with the data go to `hashed`, which keeps none.
    """
    stages: list = []
    parts: list[str] = []
    if cat:
        indexed = [f"{c}_index" for c in cat]
        encoded = [f"{c}_onehot" for c in cat]
        stages += [
            StringIndexer(inputCols=list(cat), outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded),
        ]
        parts += encoded
    if num:
        filled = [f"{c}_filled" for c in num]
        stages.append(Imputer(inputCols=list(num), outputCols=filled, strategy="median"))
        parts += filled
    if hashed:
        stages.append(FeatureHasher(inputCols=list(hashed), outputCol="hashed", numFeatures=1 << 16, categoricalCols=list(hashed)))
        parts.append("hashed")
    stages.append(VectorAssembler(inputCols=parts, outputCol="raw_features" if scale else "features"))
    if scale:
        # No centring: it would make sparse vectors dense.
        stages.append(StandardScaler(inputCol="raw_features", outputCol="features", withMean=False))
    return stages


def indexed(df: DataFrame, column: str, output: str) -> DataFrame:
    """df with a number for each category, the most frequent one first; rows without a category go."""
    return StringIndexer(inputCol=column, outputCol=output, handleInvalid="skip").fit(df).transform(df)


def text_stages(column: str, features: int = 1 << 14) -> list:
    """Whole texts to TF-IDF vectors. Hashing keeps no vocabulary anywhere."""
    return [
        RegexTokenizer(inputCol=column, outputCol="tokens", pattern=r"[\p{L}\p{N}]+", gaps=False),
        StopWordsRemover(inputCol="tokens", outputCol="words", locale="en_US"),
        HashingTF(inputCol="words", outputCol="tf", numFeatures=features),
        IDF(inputCol="tf", outputCol="features"),
    ]


def fit(df: DataFrame, stages: list, estimator: Estimator) -> PipelineModel:
    """A fitted pipeline. What leading stages that learn nothing make of the rows, such as counts of hashed words, is persisted, never raw texts."""
    lead = list(takewhile(lambda stage: isinstance(stage, Transformer), stages))
    rest, label = Pipeline(stages=[*stages[len(lead) :], estimator]), estimator.getLabelCol()
    if not lead:
        return rest.fit(df)
    with kept(PipelineModel(lead).transform(df).select(lead[-1].getOutputCol(), label)) as rows:
        return PipelineModel([*lead, *rest.fit(rows).stages])


def logistic(label: str = "label", **params) -> LogisticRegression:
    return LogisticRegression(labelCol=label, **{"maxIter": 50, "regParam": 0.01, **params})


def forest(label: str = "label", **params) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol=label, **{"numTrees": 20, "maxDepth": 5, "seed": 42, **params})


def boosted(label: str = "label", **params) -> GBTClassifier:
    return GBTClassifier(labelCol=label, **{"maxIter": 10, "maxDepth": 3, "seed": 42, **params})


def linear(label: str = "label", **params) -> LinearRegression:
    return LinearRegression(labelCol=label, **params)


def forest_regressor(label: str = "label", **params) -> RandomForestRegressor:
    return RandomForestRegressor(labelCol=label, **{"numTrees": 20, "maxDepth": 6, "seed": 42, **params})


def fit_kmeans(df: DataFrame, k: int, seed: int = 42, features: str = "features") -> KMeansModel:
    return KMeans(k=k, seed=seed, featuresCol=features).fit(df)


def choose_k(df: DataFrame, ks: Sequence[int], seed: int = 42) -> tuple[DataFrame, KMeansModel]:
    """(k, silhouette, cost) for each k, and the model with the best silhouette; the input is read once."""
    rows, best = [], None
    evaluator = ClusteringEvaluator()
    with kept(df):
        for k in ks:
            model = fit_kmeans(df, k, seed)
            score = evaluator.evaluate(model.transform(df))
            rows.append((k, float(score), float(model.summary.trainingCost)))
            if best is None or score > best[0]:
                best = (score, model)
    return df.sparkSession.createDataFrame(rows, "k int, silhouette double, cost double"), best[1]


def cross_validate(
    df: DataFrame, key: str, estimator: Estimator, grid: list, evaluator: Evaluator, folds: int = 3, parallelism: int = 4
) -> tuple[CrossValidatorModel, DataFrame]:
    """Grid search over hashed folds: (setting, mean_metric, std_metric), and the model refitted on all rows."""
    rows = df.withColumn("fold", fold(key, folds))
    search = CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds, foldCol="fold", parallelism=parallelism
    )
    with kept(rows):
        model = search.fit(rows)
    spark = df.sparkSession
    named = [", ".join(sorted(f"{p.name}={v}" for p, v in setting.items())) for setting in grid]
    table = [(n, float(a), float(s)) for n, a, s in zip(named, model.avgMetrics, model.stdMetrics)]
    return model, spark.createDataFrame(table, "setting string, mean_metric double, std_metric double")


def classification_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> dict[str, float]:
    """Area under the curve (when there are scores), accuracy, F1 and the share of the most frequent label."""
    out = {}
    multi = MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction)
    with kept(pred):
        for name in ("accuracy", "f1"):
            out[name] = float(multi.evaluate(pred, {multi.metricName: name}))
        if "rawPrediction" in pred.columns and pred.select(label).distinct().limit(3).count() == 2:
            out["auc"] = float(BinaryClassificationEvaluator(labelCol=label).evaluate(pred))
        counts = pred.groupBy(label).agg(F.count("*").alias("n")).agg((F.max("n") / F.sum("n")).alias("share"))
        out["majority"] = float(counts.first()["share"])
    return out


def regression_metrics(pred: DataFrame, label: str = "label") -> dict[str, float]:
    evaluator = RegressionEvaluator(labelCol=label)
    with kept(pred):
        return {name: float(evaluator.evaluate(pred, {evaluator.metricName: name})) for name in ("rmse", "mae", "r2")}


def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return pred.groupBy(label, prediction).agg(F.count("*").alias("n"))


def precision_recall(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per class: support, precision, recall and F1, from the confusion table."""
    cells = confusion(pred, label, prediction)
    sides = cells.select(
        F.inline(
            F.array(
                F.struct(F.col(label).cast("double").alias("class"), F.lit(0).alias("as_pred"), F.col("n")),
                F.struct(F.col(prediction).cast("double").alias("class"), F.lit(1).alias("as_pred"), F.col("n")),
            )
        ),
        (F.col(label).cast("double") == F.col(prediction).cast("double")).alias("hit"),
    )
    sums = sides.groupBy("class").agg(
        F.sum(F.when(F.col("as_pred") == 0, F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(F.col("as_pred") == 1, F.col("n")).otherwise(0)).alias("predicted"),
        F.sum(F.when(F.col("hit") & (F.col("as_pred") == 0), F.col("n")).otherwise(0)).alias("hits"),
    )
    precision = F.try_divide("hits", "predicted")
    recall = F.try_divide("hits", "support")
    return sums.select(
        "class",
        "support",
        F.round(precision, 6).alias("precision"),
        F.round(recall, 6).alias("recall"),
        F.round(F.try_divide(2 * precision * recall, precision + recall), 6).alias("f1"),
    )


def save_version(model: Model, root: str, name: str, metrics: dict[str, float]) -> int:
    """Write a model below the next version folder and add a row to the manifest.

    One writer per model name; a version is never overwritten.
    """
    spark = SparkSession.active()
    version = (versions(spark, root, name).agg(F.max("version")).first()[0] or 0) + 1
    path = f"{root}/{name}/v{version}"
    model.write().save(path)
    row = [(name, version, path, {k: float(v) for k, v in metrics.items()})]
    entry = spark.createDataFrame(row, MANIFEST).withColumn("saved_at", F.current_timestamp())
    entry.write.mode("append").parquet(f"{root}/{name}/manifest")
    return version


MANIFEST = "name string, version int, path string, metrics map<string,double>"


def versions(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The manifest of a model, empty before the first version."""
    schema = f"{MANIFEST}, saved_at timestamp"
    try:
        return spark.read.schema(schema).parquet(f"{root}/{name}/manifest")
    except Exception as error:  # the folder is missing until the first save
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def load_version(spark: SparkSession, root: str, name: str, version: int | None = None) -> PipelineModel:
    """A stored pipeline; the newest version when none is given."""
    known = versions(spark, root, name)
    chosen = known if version is None else known.where(F.col("version") == version)
    row = chosen.orderBy(F.desc("version")).select("path").first()
    if row is None:
        raise LookupError(f"no version {version} of {name}")
    return PipelineModel.load(row["path"])
