"""Customer segments: scaling, k-means, personas and profiles."""

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import functions as F

from basketlens.functions import lloyd
from basketlens.functions.columns import first_match, key_hash, share_pct
from basketlens.functions.prefix import exact_quantiles, smallest_n

FEATURES = ["user_total_orders", "user_avg_order_interval", "user_avg_basket_size",
            "user_reorder_rate", "user_unique_departments", "user_days_since_last_order"]

# Persona thresholds, for gaps capped at 30 days.
THRESHOLDS = {"loyal_orders": 35, "loyal_reorder": 0.65, "bulk_basket": 14,
              "bulk_departments": 9, "risk_interval": 15, "risk_recency": 18}


def scale_features(customer_features, columns=tuple(FEATURES)):
    """Add ``z_`` columns: distance to the mean in population deviations (G1).

    Missing values count as 0 and a constant column scales to 0. Means and deviations come
    from one aggregate as a scalar subquery.
    """
    filled = customer_features.na.fill(0, list(columns))
    stats = filled.agg(F.struct(*[
        x for c in columns for x in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))
    ]).alias("stats"))
    joined = filled.withColumn("_stats", stats.scalar())
    return joined.select(*filled.columns, *[
        F.when(F.col(f"_stats.s_{c}") > 0,
               (F.col(c) - F.col(f"_stats.m_{c}")) / F.col(f"_stats.s_{c}"))
        .otherwise(F.lit(0.0)).alias(f"z_{c}") for c in columns])


@contextmanager
def _held(scaled, columns):
    """The scaled columns kept while models pass over them; partitions follow the data."""
    data = scaled.select(*[F.col(f"z_{c}").cast("double").alias(f"z_{c}") for c in columns],
                         F.xxhash64("user_id").alias(lloyd.HASH)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield data
    finally:
        data.unpersist()


def evaluate_k(scaled, k_range=range(2, 8), n_init=10, max_iter=300, seed=42,
               columns=tuple(FEATURES), sample=lloyd.SAMPLE):
    """Inertia and two silhouettes per k.

    All starts of all k move in the same passes over the customers. ``silhouette`` has squared
    distances, which need only sums per cluster, and covers all customers; ``silhouette_euclidean``
    has plain distances between all pairs of a hashed sample of at most ``sample`` customers.
    """
    names, ks = [f"z_{c}" for c in columns], list(k_range)
    with _held(scaled, columns) as data:
        best = lloyd.best_by_k(data, names, ks, n_init, max_iter, seed)
        models = [best[k][0] for k in ks]
        squared = lloyd.squared_silhouettes(data, names, models)
    drawn = smallest_n(scaled.select("user_id", *[F.col(n).cast("double").alias(n) for n in names]),
                       key_hash("user_id"), sample, ["user_id"])
    plain = lloyd.euclidean_silhouettes(drawn, names, models)

    def rounded(value, digits):
        return None if value is None else round(value, digits)

    rows = [(k, rounded(best[k][1], 2), rounded(a, 4), rounded(b, 4))
            for k, a, b in zip(ks, squared, plain)]
    return scaled.sparkSession.createDataFrame(
        rows, "k bigint, inertia double, silhouette double, silhouette_euclidean double")


def fit_clusters(scaled, k=4, n_init=15, max_iter=300, seed=42, columns=tuple(FEATURES)):
    """Assign a cluster to every customer.

    Clusters are renumbered by their centres, largest first feature first, so numbers do
    not depend on the fit's own order.
    """
    names = [f"z_{c}" for c in columns]
    with _held(scaled, columns) as data:
        centres, _ = lloyd.best_by_k(data, names, [k], n_init, max_iter, seed)[k]
    return assign_clusters(scaled, sorted(map(tuple, centres.tolist()), reverse=True), columns)


def assign_clusters(scaled, centres, columns=tuple(FEATURES)):
    """Number of the nearest of the given ``centres``, the first of equally near ones."""
    def distance(centre):
        return sum((F.pow(F.col(f"z_{c}") - F.lit(v), 2) for c, v in zip(columns, centre)), F.lit(0.0))

    nearest = F.array_min(F.array(*[F.struct(distance(c).alias("distance"), F.lit(i).alias("cluster"))
                                    for i, c in enumerate(centres)]))
    keep = [c for c in scaled.columns if not c.startswith("z_")]
    return scaled.select(*keep, nearest["cluster"].alias("cluster"))


def cluster_profile(labelled, columns=tuple(FEATURES)):
    """Mean, exact median and count of every feature per cluster, in long form."""
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
        for c in columns])).alias("c")
    long = labelled.select("cluster", cells).select("cluster", "c.feature", "c.value")
    keys = ["cluster", "feature"]
    medians = exact_quantiles(long, keys, "value", [0.5]).select(
        *keys, F.round("quantile", 2).alias("median"))
    means = long.groupBy(*keys).agg(F.round(F.avg("value"), 2).alias("mean"),
                                    F.count("value").alias("customer_count"))
    return means.join(medians, keys, "left")


def name_segments(labelled, thresholds=None):
    """Add the persona of each customer's cluster, decided on cluster means."""
    t = {**THRESHOLDS, **(thresholds or {})}
    means = labelled.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in FEATURES])
    col = F.col
    rules = [
        ((col("user_total_orders") > t["loyal_orders"])
         & (col("user_reorder_rate") > t["loyal_reorder"]), "High-Value Frequent Loyalists"),
        ((col("user_avg_basket_size") > t["bulk_basket"])
         & (col("user_unique_departments") > t["bulk_departments"]), "Full-Pantry Bulk Shoppers"),
        ((col("user_avg_order_interval") > t["risk_interval"])
         | (col("user_days_since_last_order") > t["risk_recency"]),
         "Occasional / At-Risk Shoppers")]
    personas = means.select("cluster", first_match(rules, "Routine Convenience Buyers")
                            .alias("segment_name"))
    return labelled.join(personas, "cluster")


def segment_summary(segments):
    """Size, share and mean behaviour per cluster."""
    per_cluster = segments.groupBy("cluster", "segment_name").agg(
        F.count("user_id").alias("customer_count"),
        F.avg("user_total_orders").alias("avg_lifetime_orders"),
        F.avg("user_avg_order_interval").alias("avg_order_interval_days"),
        F.avg("user_avg_basket_size").alias("avg_basket_size"),
        F.round(F.avg("user_reorder_rate") * 100, 2).alias("avg_reorder_rate"),
        F.avg("user_unique_departments").alias("avg_departments_explored"),
        F.avg("user_days_since_last_order").alias("avg_recency_days"))
    whole = segments.agg(F.count(F.lit(1))).scalar()
    return per_cluster.withColumn("customer_pct", share_pct(F.col("customer_count"), whole))
