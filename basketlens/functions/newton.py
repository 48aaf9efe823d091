"""Logistic regression by Newton steps, each of which is one aggregate over the rows.

A task turns its rows into the gradient and the Gram matrix of the weighted features; Spark adds these
few numbers up, and the step is solved from them.
"""

import sys
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# These functions travel by value, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

INTERCEPT = "(intercept)"


def _sums(batches, features, mean, scale, points, weights):
    """Loss, gradient and Gram matrix at every point, as numbered values."""
    width = len(features) + 1
    total = np.zeros((len(points), 1 + width + width * width))
    for batch in batches:
        rows = np.column_stack([batch[c].to_numpy(zero_copy_only=False) for c in features]).astype(float)
        x = np.column_stack([np.ones(len(rows)), (rows - mean) / scale])
        y = batch["target"].to_numpy().astype(float)
        weight = np.where(y > 0, weights[1], weights[0])
        for held, point in zip(total, points):
            z = x @ point
            p = 1 / (1 + np.exp(-z))
            held[0] += (weight * (np.logaddexp(0, z) - y * z)).sum()
            held[1:1 + width] += (weight * (p - y)) @ x
            held[1 + width:] += ((x * (weight * p * (1 - p))[:, None]).T @ x).ravel()
    yield pa.RecordBatch.from_pydict({"place": pa.array(np.arange(total.size), pa.int32()),
                                      "value": total.ravel()})


class LogisticModel:
    """Weights of the raw features and an intercept; scores are a plain column expression."""

    def __init__(self, features, weights, intercept):
        self.features, self.intercept = list(features), float(intercept)
        self.weights = [float(w) for w in weights]

    def probability(self):
        z = F.lit(self.intercept)
        for name, weight in zip(self.features, self.weights):
            z = z + F.lit(weight) * F.col(name).cast("double")
        return 1 / (1 + F.exp(-z))

    def save(self, path):
        rows = [(INTERCEPT, self.intercept), *zip(self.features, self.weights)]
        frame = SparkSession.active().createDataFrame(
            [(i, *r) for i, r in enumerate(rows)], "place int, feature string, weight double")
        frame.coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, path):
        rows = SparkSession.active().read.parquet(path).orderBy("place").collect()
        return cls([r["feature"] for r in rows[1:]], [r["weight"] for r in rows[1:]], rows[0]["weight"])


def fit_logistic(train, features, max_iter=100, c=1.0, tolerance=1e-9):
    """Balanced logistic regression on standardised ``features`` and the column ``target`` (0 or 1).

    Classes weigh n / (2 n_class). The squared weights of the standardised features, without the
    intercept, are added to the loss times 1 / (2 c). A step that does not lower the loss is halved:
    one aggregate tries several lengths at once.
    """
    facts = train.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("target"), F.lit(0)).alias("ones"),
        *[f(x).alias(f"{n}{i}") for i, x in enumerate(features)
          for n, f in (("m", F.avg), ("s", F.stddev_samp))]).first()
    n, ones = facts["n"], facts["ones"]
    # A class without rows has no weight; both are then told apart by the penalty alone.
    weights = [n / (2 * m) if m else 0.0 for m in (n - ones, ones)]
    mean = np.array([facts[f"m{i}"] or 0.0 for i in range(len(features))])
    scale = np.array([facts[f"s{i}"] or 1.0 for i in range(len(features))])
    penalty = np.r_[0.0, np.full(len(features), 1.0 / c)]
    width = len(features) + 1

    def evaluated(points):
        found = train.mapInArrow(
            partial(_sums, features=list(features), mean=mean, scale=scale, points=points,
                    weights=weights), "place int, value double").groupBy("place").agg(
            F.sum("value").alias("value")).collect()
        flat = np.zeros(len(points) * (1 + width + width * width))
        for row in found:
            flat[row["place"]] = row["value"]
        for point, values in zip(points, flat.reshape(len(points), -1)):
            yield (values[0] + (penalty * point * point).sum() / 2,
                   values[1:1 + width] + penalty * point,
                   values[1 + width:].reshape(width, width) + np.diag(penalty), point)

    best = next(evaluated([np.zeros(width)]))
    for _ in range(max_iter):
        loss, gradient, gram, point = best
        step = np.linalg.lstsq(gram, gradient, rcond=None)[0]
        if np.abs(step).max() < tolerance:
            break
        tried = min(evaluated([point - step / 2 ** i for i in range(3)]), key=lambda t: t[0])
        if tried[0] >= loss:
            break
        best = tried
    weight = best[3][1:] / scale
    return LogisticModel(features, weight, best[3][0] - weight @ mean)
