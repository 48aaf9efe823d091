"""Next-order purchase prediction."""

import re
from collections import Counter
from contextlib import contextmanager
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from basketlens.functions import newton
from basketlens.functions.columns import key_hash, pair_hash, spread
from basketlens.functions.parallel import run_all
from basketlens.functions.prefix import smallest_n
from basketlens.operators.metrics import ranking_metrics, threshold_metrics

# Names of features and models, and the models' decision thresholds.
PAIR_FEATURES = ["up_total_orders", "up_order_rate", "up_orders_since_last",
                 "up_avg_add_to_cart"]
USER_FEATURES = ["user_total_orders", "user_avg_order_interval", "user_avg_basket_size",
                 "user_reorder_rate", "user_unique_departments"]
PRODUCT_FEATURES = ["prod_total_orders", "prod_reorder_rate", "prod_avg_add_to_cart"]
FEATURES = PAIR_FEATURES + USER_FEATURES + PRODUCT_FEATURES

LOGISTIC, FOREST, BOOSTED = ("Logistic Regression (Baseline)", "Random Forest",
                             "Gradient Boosting")
DECISION = {LOGISTIC: 0.50, FOREST: 0.20, BOOSTED: 0.20}


#: Pairs that a model is fitted on at most; None takes every training pair.
FIT_ROWS = None
#: Tasks that hold a fit's rows at least. Learners draw per task: the number follows the rows, not the cores.
FIT_TASKS = 8


def sample_pairs(pairs, n=500000):
    """A repeatable sample of ``n`` pairs by a hash of both keys."""
    return smallest_n(pairs, pair_hash("user_id", "product_id"), n,
                      ["user_id", "product_id"])


def training_matrix(pairs, customer_features, product_features):
    """Pairs with their user's and product's features."""
    return (pairs.join(customer_features.select("user_id", *USER_FEATURES), "user_id", "left")
            .join(product_features.select("product_id", *PRODUCT_FEATURES), "product_id", "left"))


def split_by_user(matrix, train_ratio=0.8):
    """Training and validation rows; all rows of a user fall on one side."""
    chosen = key_hash("user_id") < train_ratio
    return matrix.filter(chosen), matrix.filter(~chosen)


def split_label(matrix, train_ratio=0.8):
    """The matrix with the side of each row as a column."""
    return matrix.withColumn(
        "side", F.when(key_hash("user_id") < train_ratio, "train").otherwise("validation"))


def _assembler():
    return VectorAssembler(inputCols=FEATURES, outputCol="raw_features", handleInvalid="keep")


def _ready(rows):
    return rows.na.fill(0, FEATURES)


def fit_logistic(train, max_iter=100, c=1.0):
    """Standardised logistic regression with balanced class weights, by Newton steps.

    Means and deviations come from the training rows only. ``c`` is the inverse L2 strength against
    the summed loss.
    """
    return newton.fit_logistic(_ready(train), FEATURES, max_iter, c)


def fit_forest(train, trees=80, depth=10, seed=42):
    """Random forest (P5)."""
    forest = RandomForestClassifier(labelCol="target", featuresCol="raw_features",
                                    numTrees=trees, maxDepth=depth, seed=seed)
    return Pipeline(stages=[_assembler(), forest]).fit(_ready(train))


def fit_boosted(train, rounds=150, rate=0.05, depth=5, seed=42):
    """Gradient boosted trees, grown level by level to at most 2**depth leaves."""
    boosted = GBTClassifier(labelCol="target", featuresCol="raw_features", maxIter=rounds,
                            stepSize=rate, maxDepth=depth, seed=seed, maxMemoryInMB=1024,
                            checkpointInterval=10)
    return Pipeline(stages=[_assembler(), boosted]).fit(_ready(train))


def score(model, rows, name="model"):
    """Purchase probability of every row."""
    keep = [c for c in ("user_id", "product_id", "target") if c in rows.columns]
    if isinstance(model, newton.LogisticModel):
        return _ready(rows).select(*keep, F.lit(name).alias("model"),
                                   model.probability().alias("score"))
    return model.transform(_ready(rows)).select(
        *keep, F.lit(name).alias("model"),
        vector_to_array("probability")[1].alias("score"))


@contextmanager
def held_rows(train, n=None, tasks=FIT_TASKS):
    """All training rows, spread over ``tasks`` tasks and kept while models are fitted.

    Only a caller that names ``n`` fits on a sample.
    """
    n = n or FIT_ROWS
    rows = spread((sample_pairs(train, n) if n else train).select("user_id", "product_id", "target", *FEATURES),
                  "user_id", "product_id", partitions=tasks).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows
    finally:
        rows.unpersist()


def train_models(train, trees=80, rounds=150, tasks=FIT_TASKS):
    """The three models by name, fitted side by side on the same held rows."""
    with held_rows(train, tasks=tasks) as rows:
        fits = {LOGISTIC: lambda: fit_logistic(rows), FOREST: lambda: fit_forest(rows, trees),
                BOOSTED: lambda: fit_boosted(rows, rounds)}
        return dict(zip(fits, run_all(train.sparkSession, list(fits.values()))))


def score_all(models, rows):
    """Scores of several models in one frame."""
    return reduce(lambda a, b: a.unionByName(b),
                  [score(model, rows, name) for name, model in models.items()])


def leaderboard(scored, decision=None):
    """Ranking and threshold metrics per model."""
    return ranking_metrics(scored).join(
        threshold_metrics(scored, decision or DECISION), "model")


def feature_importances(spark, model):
    """Importance per feature of a fitted tree pipeline, by gain and by number of splits.

    The trees' own description names the feature of every split; a model has a bounded number of them.
    """
    trees = model.stages[-1]
    gains = [float(v) for v in trees.featureImportances.toArray()]
    splits = Counter(int(i) for i in re.findall(r"If \(feature (\d+) ", trees.toDebugString))
    rows = sorted(((f, round(g, 4), splits[i]) for i, (f, g) in enumerate(zip(FEATURES, gains))),
                  key=lambda r: (-r[2], -r[1], r[0]))
    return spark.createDataFrame(rows, "feature string, importance double, splits long")


def save_model(model, path):
    if isinstance(model, newton.LogisticModel):
        model.save(path)
    else:
        model.write().overwrite().save(path)


def load_model(path):
    """A saved model of either kind; a table of weights has no metadata folder."""
    spark = SparkSession.active()
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "metadata")
    if place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return PipelineModel.load(path)
    return newton.LogisticModel.load(path)
