"""Features, graph, serving, segments and models on hand-made frames."""

import numpy as np
import pytest
from conftest import LINE, ORDER, rows
from pyspark.sql import functions as F

from basketlens.operators import (analytics, bi, eda, features, graph, prediction, segmentation,
                                  serving)
from basketlens.plans.context import Retail

FOLDER = "/root/testdata/sf0.001"


def test_top_products_breaks_ties_by_id(spark, lines, products, aisles, departments):
    top = analytics.top_products(lines, products, aisles, departments, n=2).collect()
    assert [(r["product_id"], r["total_purchases"], r["reorder_rate"]) for r in top] == [
        (2, 3, 0.3333), (1, 2, 0.5)]


def test_product_features_keep_unseen_products(lines, products):
    assert rows(features.product_features(lines, products), "product_id", "prod_total_orders",
                "prod_reorder_rate", "prod_avg_add_to_cart") == [
        (1, 2, 0.5, 1.0), (2, 3, 0.3333, 1.67), (3, 2, 0.0, 2.5), (4, 0, 0.0, 0.0)]


def test_mode_takes_the_smallest_on_ties_and_one_order_has_no_spread(spark):
    orders = spark.createDataFrame([
        (1, 1, "prior", 1, 2, 5, 0.0), (2, 1, "prior", 2, 2, 6, 4.0),
        (3, 1, "prior", 3, 0, 6, 6.0), (4, 1, "prior", 4, 0, 5, 9.0),
        (5, 2, "prior", 1, 3, 1, 0.0)], ORDER)
    found = {r["user_id"]: r for r in features.customer_order_stats(orders).collect()}
    assert (found[1]["user_preferred_dow"], found[1]["user_preferred_hour"]) == (0, 5)
    assert found[1]["user_days_since_last_order"] == 9.0
    assert found[2]["user_std_order_interval"] == 0.0


def test_features_do_not_see_held_out_orders(spark, lines, products):
    held = spark.createDataFrame([(13, 3, 1, 1, 100, 3, "train"), (13, 4, 2, 0, 100, 3, "train")],
                                 LINE)
    both = lines.unionByName(held)
    assert rows(features.product_features(both, products)) == rows(
        features.product_features(lines, products))
    assert rows(features.customer_item_stats(both, products)) == rows(
        features.customer_item_stats(lines, products))
    orders = spark.createDataFrame([
        (10, 100, "prior", 1, 0, 0, 0.0), (11, 100, "prior", 2, 0, 0, 1.0),
        (13, 100, "train", 3, 0, 0, 1.0), (12, 200, "prior", 1, 0, 0, 0.0)], ORDER)
    pairs = features.user_product_features(orders, both)
    assert rows(pairs, "user_id", "product_id", "up_order_rate", "up_orders_since_last",
                "target") == [(100, 1, 1.0, 0, 0), (100, 2, 1.0, 0, 0), (100, 3, 0.5, 1, 1)]


def test_order_context_adds_the_split(spark, lines):
    orders = spark.createDataFrame([(10, 100, "prior", 1, 0, 0, 0.0)], ORDER)
    bare = lines.select("order_id", "product_id", "add_to_cart_order", "reordered")
    assert rows(features.order_context(bare, orders), "user_id", "eval_set") == [
        (100, "prior")] * 3


def test_pair_counts(lines, products):
    pairs = graph.pair_counts(lines, products.select("product_id"))
    assert rows(pairs) == [(1, 2, 2), (1, 3, 1), (2, 3, 2)]
    doubled = lines.unionByName(lines)
    assert rows(graph.pair_counts(doubled, products.select("product_id"))) == rows(pairs)


def test_co_purchase_support_and_top_products(lines, products):
    feats = features.product_features(lines, products)
    assert rows(graph.co_purchase_edges(lines, feats, min_support=2), "source", "target",
                "co_occurrence") == [(1, 2, 2), (2, 3, 2)]
    assert rows(graph.co_purchase_edges(lines, feats, top_products=2, min_support=1), "source",
                "target") == [(1, 2)]


def brute_recommendations(bought, rates, target, near, n):
    mine = bought[target]
    others = sorted(((len(mine & b), -u) for u, b in bought.items() if u != target and mine & b),
                    reverse=True)[:near]
    score = {}
    for _, u in others:
        for p in bought[-u] - mine:
            score[p] = score.get(p, 0) + 1
    return sorted(score, key=lambda p: (-score[p], -rates[p], p))[:n]


def test_recommendations_match_brute_force(spark):
    rng = np.random.default_rng(4)
    bought = {u: set(rng.choice(12, size=5, replace=False).tolist()) for u in range(15)}
    rates = {p: round(float(rng.integers(0, 4)) / 4, 2) for p in range(12)}
    edges = spark.createDataFrame([(u, p) for u, b in bought.items() for p in b],
                                  "source long, target long")
    feats = spark.createDataFrame([(p, f"p{p}", r) for p, r in rates.items()],
                                  "product_id long, product_name string, "
                                  "prod_reorder_rate double")
    targets = spark.range(15).withColumnRenamed("id", "user_id")
    found = graph.collaborative_recommendations(edges, feats, targets, neighbours=4, n=3)
    got = {}
    for r in found.orderBy("user_id", "rank").collect():
        got.setdefault(r["user_id"], []).append(r["product_id"])
    for u in range(15):
        assert got.get(u, []) == brute_recommendations(bought, rates, u, 4, 3)


def test_bought_together_is_symmetric(spark, products):
    edges = spark.createDataFrame([(1, 2, 30), (2, 3, 40), (1, 3, 40)],
                                  "source long, target long, co_occurrence long")
    found = serving.bought_together(edges, products, limit=1)
    assert rows(found, "source_product_id", "product_id", "times_co_purchased") == [
        (1, 3, 40), (2, 3, 40), (3, 1, 40)]


def test_neighbourhood_keeps_products_without_affinities(spark, products, aisles, departments):
    edges = spark.createDataFrame([(1, 2, 30), (1, 3, 40)],
                                  "source long, target long, co_occurrence long")
    found = graph.product_neighbourhood(products, aisles, departments, edges)
    assert {r["product_id"]: r["top_affinity_items"] for r in found.collect()} == {
        1: ["C", "B"], 2: [], 3: [], 4: []}


def test_reorder_list_scores_and_tiers(spark):
    people = spark.createDataFrame([(1, "s", 0.5), (2, "s", 0.0)],
                                   "user_id long, segment_name string, user_reorder_rate double")
    feats = spark.createDataFrame([(1, "A", 10, 0.5), (2, "B", 9, 0.9), (3, "C", 8, 0.5),
                                   (4, "D", 1, 1.0)],
                                  "product_id long, product_name string, prod_total_orders long, "
                                  "prod_reorder_rate double")
    found = serving.reorder_list(people, feats, top_k=2, threshold=0.3, candidates=3)
    assert rows(found, "user_id", "rank", "product_id", "reorder_probability",
                "recommendation_tier") == [
        (1, 1, 2, 0.66, "High Priority"), (1, 2, 1, 0.5, "High Priority"),
        (2, 1, 2, 0.36, "Medium Priority")]


def test_named_products_follow_the_list(spark, products):
    wanted = spark.createDataFrame([(i + 1, p) for i, p in enumerate([3, 99, 1] + [2] * 9)],
                                   "position int, product_id long")
    found = rows(serving.named_products(products, wanted))
    assert found[:3] == [(1, 3, "C"), (10, 2, "B"), (11, 2, "B")] and len(found) == 11


def test_personas_and_descriptions(spark):
    names = spark.createDataFrame([("High-Value Frequent Loyalists",), ("else",)],
                                  "segment_name string")
    found = dict(rows(serving.persona_descriptions(names)))
    assert found["else"].startswith("Dormant") and "habitual" in found[
        "High-Value Frequent Loyalists"]


def test_persona_rules_first_match_wins(spark):
    base = dict.fromkeys(segmentation.FEATURES, 0.0)
    cases = [dict(user_total_orders=36.0, user_reorder_rate=0.7, user_avg_basket_size=20.0),
             dict(user_avg_basket_size=15.0, user_unique_departments=10.0),
             dict(user_days_since_last_order=19.0), dict()]
    data = [dict(user_id=i, cluster=i, **{**base, **c}) for i, c in enumerate(cases)]
    found = rows(segmentation.name_segments(spark.createDataFrame(data)), "cluster",
                 "segment_name")
    assert [x[1] for x in found] == [
        "High-Value Frequent Loyalists", "Full-Pantry Bulk Shoppers",
        "Occasional / At-Risk Shoppers", "Routine Convenience Buyers"]


def test_constant_feature_scales_to_zero(spark):
    data = [{"user_id": i, **{c: float(i) for c in segmentation.FEATURES},
             "user_reorder_rate": 3.0} for i in range(4)]
    found = segmentation.scale_features(spark.createDataFrame(data))
    assert {r[0] for r in found.select("z_user_reorder_rate").collect()} == {0.0}
    assert found.agg(F.stddev_pop("z_user_total_orders")).collect()[0][0] == pytest.approx(1.0)


def test_segments_and_inertia(spark):
    scaled = segmentation.scale_features(Retail(spark, FOLDER, "aisle").customer_features)
    sweep = segmentation.evaluate_k(scaled, range(2, 5), n_init=2).orderBy("k").collect()
    assert [r["k"] for r in sweep] == [2, 3, 4]
    assert sweep[0]["inertia"] > sweep[1]["inertia"] > sweep[2]["inertia"]
    found = segmentation.fit_clusters(scaled, k=3, n_init=2)
    assert found.count() == scaled.count()
    means = [r[1] for r in found.groupBy("cluster").agg(F.avg("user_total_orders"))
             .orderBy("cluster").collect()]
    assert len(means) == 3 and means == sorted(means, reverse=True)


def test_models_score_and_reload(spark, tmp_path):
    matrix = Retail(spark, FOLDER, "aisle").matrix
    train, rest = prediction.split_by_user(matrix)
    assert train.select("user_id").intersect(rest.select("user_id")).count() == 0
    models = prediction.train_models(train, trees=5, rounds=3)
    board = prediction.leaderboard(prediction.score_all(models, rest))
    assert board.count() == 3
    for r in board.collect():
        assert 0 <= r["roc_auc"] <= 1 and r["tp"] + r["fp"] + r["fn"] + r["tn"] == rest.count()
    forest = models[prediction.FOREST]
    top = prediction.feature_importances(spark, forest).collect()
    assert sum(r["importance"] for r in top) == pytest.approx(1.0, abs=1e-3)
    prediction.save_model(forest, str(tmp_path / "m"))
    again = prediction.load_model(str(tmp_path / "m"))
    assert rows(prediction.score(forest, rest)) == rows(prediction.score(again, rest))


def test_kpis_and_measures_on_small_tables(spark):
    people = spark.createDataFrame([(1, "High-Value Frequent Loyalists", 10.0, 0.5),
                                    (2, "x", 9.9, 0.3643)],
                                   "user_id long, segment_name string, user_avg_basket_size "
                                   "double, user_reorder_rate double")
    forecast = spark.createDataFrame([("2025-01-01", 5), ("2025-01-02", 5)],
                                     "forecast_date string, predicted_demand long")
    row = bi.measures(people, forecast).collect()[0]
    assert (row["high_value_loyalists_pct"], row["total_projected_orders"]) == (50.0, 10)
    assert bi.peak_day(forecast).collect()[0]["peak_day"] == "2025-01-01"
    one = spark.createDataFrame([(0.8252,)], "x double")
    kpis = {r["metric_name"]: r["formatted_value"]
            for r in bi.executive_kpis(people, people, spark.range(3421083), one, one).collect()}
    assert kpis["Platform Lifetime Orders"] == "3,421,083"
    assert kpis["Supervised Prediction ROC-AUC"] == "82.52%"


def test_pivot_has_all_hours(spark):
    orders = spark.createDataFrame([(1, 1, "prior", 1, 0, 23, 0.0)], ORDER)
    row = eda.day_hour_matrix(orders).collect()[0]
    assert row["dow_name"] == "Sunday" and row["h23"] == 1 and row["h00"] == 0


def test_products_without_rows(spark, products, aisles, departments):
    none = spark.createDataFrame([], LINE)
    orders = spark.createDataFrame([], ORDER).withColumn("is_first_order", F.lit(0))
    feats = features.product_features(none, products)
    empty = [
        analytics.top_products(none, products, aisles, departments),
        analytics.order_baskets(orders, none), analytics.volume_by_day_and_hour(orders),
        features.customer_features(orders, none, products),
        features.user_product_features(orders, none),
        graph.co_purchase_edges(none, feats), graph.bought_edges(none),
        eda.department_breakdown(none, products, departments)]
    assert [df.count() for df in empty] == [0] * len(empty)
    assert feats.count() == 4
    assert eda.basket_size_stats(none).collect()[0]["mean_basket_size"] is None
