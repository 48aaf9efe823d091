"""K-means passes, silhouettes and logistic regression against brute force and Spark's own fits."""

from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import functions as F

from basketlens.functions import lloyd
from basketlens.functions.newton import fit_logistic
from basketlens.operators import prediction, segmentation
from basketlens.plans import queries

COLUMNS = ["x", "y"]


def points(spark, n=900, seed=3):
    rng = np.random.default_rng(seed)
    centres = np.array([[0, 0], [6, 1], [1, 7], [8, 8], [-5, 4]])
    rows = centres[rng.integers(0, 5, n)] + rng.normal(size=(n, 2))
    rows[:40] = rows[0]
    frame = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(rows)],
                                  "id long, x double, y double")
    return rows, frame.repartition(5).withColumn(lloyd.HASH, F.xxhash64("id"))


def nearest(rows, centres):
    return ((rows[:, None] - centres) ** 2).sum(-1).argmin(1)


def silhouette(rows, labels, distance):
    scores = []
    for i, label in enumerate(labels):
        d = distance(rows - rows[i])
        own = labels == label
        if own.sum() == 1:
            scores.append(0.0)
            continue
        a = d[own].sum() / (own.sum() - 1)
        b = min(d[labels == other].mean() for other in set(labels) - {label})
        scores.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return np.mean(scores)


def test_centre_sums_equal_a_plain_loop(spark):
    rows, data = points(spark)
    models = [np.array([[0.0, 0.0], [5.0, 5.0]]), np.array([[1.0, 1.0], [9.0, 9.0], [0.0, 8.0]])]
    for centres, sums in zip(models, lloyd.centre_sums(data, COLUMNS, models)):
        label = nearest(rows, centres)
        for i, found in enumerate(sums):
            held = rows[label == i]
            assert found[0] == len(held) and found[1:3] == pytest.approx(held.sum(0))
            assert found[3] == pytest.approx((held ** 2).sum())
            assert found[4] == pytest.approx(((held - centres[i]) ** 2).sum())


def test_best_models_are_as_cheap_as_sparks(spark):
    rows, data = points(spark)
    best = lloyd.best_by_k(data, COLUMNS, [2, 3, 5], 4)
    again = lloyd.best_by_k(data.repartition(2), COLUMNS, [2, 3, 5], 4)
    vectors = VectorAssembler(inputCols=COLUMNS, outputCol="features").transform(data).cache()
    for k, (centres, inertia) in best.items():
        assert inertia == pytest.approx(((rows - centres[nearest(rows, centres)]) ** 2).sum(), rel=1e-6)
        other = min(KMeans(k=k, seed=s, maxIter=100).fit(vectors).summary.trainingCost for s in range(4))
        assert inertia <= other * 1.001
        assert again[k][1] == pytest.approx(inertia)
    model = KMeans(k=3, seed=1).fit(vectors)
    found = lloyd.squared_silhouettes(data, COLUMNS, [np.array(model.clusterCenters())])[0]
    assert found == pytest.approx(ClusteringEvaluator().evaluate(model.transform(vectors)), abs=1e-6)


@pytest.mark.parametrize("block_rows", [100, 5000])
def test_silhouettes_equal_all_pairs(spark, block_rows):
    rows, data = points(spark, 300)
    models = [np.array([[0.0, 0.0], [7.0, 7.0]]), rows[[1, 60, 90, 200]], rows[[1, 1, 90]]]
    plain = lloyd.euclidean_silhouettes(data, COLUMNS, models, block_rows)
    squared = lloyd.squared_silhouettes(data, COLUMNS, models)
    for centres, a, b in zip(models, plain, squared):
        label = nearest(rows, centres)
        assert a == pytest.approx(silhouette(rows, label, lambda d: np.sqrt((d ** 2).sum(1))), abs=1e-6)
        assert b == pytest.approx(silhouette(rows, label, lambda d: (d ** 2).sum(1)), abs=1e-6)


def test_odd_inputs_of_the_sweep(spark):
    base = {c: 1.0 for c in segmentation.FEATURES}
    same = spark.createDataFrame([{"user_id": i, **base} for i in range(6)])
    found = segmentation.evaluate_k(segmentation.scale_features(same), range(2, 4), n_init=2).collect()
    assert [(r["k"], r["inertia"], r["silhouette"], r["silhouette_euclidean"]) for r in found] == [
        (2, 0.0, 0.0, 0.0), (3, 0.0, 0.0, 0.0)]
    none = segmentation.scale_features(same).limit(0)
    assert [r["silhouette"] for r in segmentation.evaluate_k(none, range(2, 4), n_init=1).collect()] == [
        None, None]
    assert segmentation.fit_clusters(none, k=2, n_init=1).count() == 0


def test_newton_equals_sparks_logistic_regression(spark, tmp_path):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(3, 2, 3000), rng.exponential(10, 3000), rng.normal(size=3000)])
    y = (rng.random(3000) < 1 / (1 + np.exp(3 - 0.5 * x[:, 0] - 0.1 * x[:, 1] + x[:, 2]))).astype(int)
    frame = spark.createDataFrame([(*map(float, r), int(t)) for r, t in zip(x, y)],
                                  "a double, b double, c double, target int").repartition(3)
    model = fit_logistic(frame, ["a", "b", "c"])
    n, ones = 3000, int(y.sum())
    weighted = frame.withColumn("weight", F.when(F.col("target") == 1, n / (2 * ones)).otherwise(
        n / (2 * (n - ones))))
    scaled = VectorAssembler(inputCols=["a", "b", "c"], outputCol="raw").transform(weighted)
    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True).fit(scaled)
    other = LogisticRegression(labelCol="target", weightCol="weight", maxIter=1000, tol=1e-12,
                               regParam=1.0 / n, standardization=False).fit(scaler.transform(scaled))
    wanted = other.coefficients.toArray() / scaler.std.toArray()
    assert model.weights == pytest.approx(wanted.tolist(), abs=1e-4)
    assert model.intercept == pytest.approx(other.intercept - wanted @ scaler.mean.toArray(), abs=1e-4)
    scored = frame.select("*", model.probability().alias("p")).collect()
    assert [r["p"] for r in scored] == pytest.approx(
        [1 / (1 + np.exp(-model.intercept - np.dot(model.weights, r[:3]))) for r in scored])
    prediction.save_model(model, str(tmp_path / "m"))
    again = prediction.load_model(str(tmp_path / "m"))
    assert (again.features, again.weights, again.intercept) == (
        model.features, model.weights, model.intercept)


def test_newton_on_odd_rows(spark):
    schema = "a double, b double, target int"
    for rows in ([], [(1.0, 2.0, 1)], [(1.0, 2.0, 0), (1.0, 2.0, 0)], [(1.0, 5.0, 1), (1.0, -5.0, 0)] * 3):
        model = fit_logistic(spark.createDataFrame(rows, schema), ["a", "b"])
        assert np.isfinite([*model.weights, model.intercept]).all()


@pytest.fixture
def many_pairs(spark):
    """A source of more training pairs than the 500,000 that fits were once cut to."""
    matrix = spark.range(700000).select(
        F.col("id").alias("user_id"), F.when(F.col("id") % 7 > 0, F.col("id") % 150).alias("product_id"),
        (F.col("id") % 10 == 0).cast("int").alias("target"),
        *[((F.col("id") * (i + 3)) % 101).cast("double").alias(c) for i, c in enumerate(prediction.FEATURES)])
    return SimpleNamespace(spark=spark, source="many pairs", grain="aisle", matrix=matrix, fit_tasks=11)


@pytest.mark.parametrize("query, fit", [("p11_forest_importances", "fit_forest"), ("p11_importances", "fit_boosted"),
                                        ("p4_logistic_scores", "fit_logistic"), ("p5_forest_scores", "fit_forest")])
def test_fits_take_all_training_pairs(many_pairs, monkeypatch, query, fit):
    seen = {}

    def counted(rows):
        seen.update(rows=rows.count(), parts=rows.rdd.getNumPartitions())

    counted.__name__ = f"counted_{query}"
    monkeypatch.setattr(prediction, fit, counted)
    monkeypatch.setattr(prediction, "feature_importances", lambda spark, model: spark.range(1))
    monkeypatch.setattr(prediction, "score", lambda model, rows, name: rows)
    queries.CATALOGUE[query][1](many_pairs)
    assert seen == {"rows": prediction.split_by_user(many_pairs.matrix)[0].count(), "parts": 11}
    assert seen["rows"] > 500000


def test_registered_scores_are_those_of_a_fit_to_all_pairs(many_pairs):
    """Weights as of one fit to the training rows themselves, which no sample has."""
    train, rest = prediction.split_by_user(many_pairs.matrix)
    weights = fit_logistic(train.na.fill(0, prediction.FEATURES), prediction.FEATURES)
    some = queries.p4_logistic(many_pairs).filter("user_id % 7000 = 0")
    wanted = {r["user_id"]: r["p"] for r in rest.filter("user_id % 7000 = 0").select(
        "user_id", weights.probability().alias("p")).collect()}
    found = {r["user_id"]: r["score"] for r in some.collect()}
    assert found == pytest.approx(wanted, abs=1e-6) and found
