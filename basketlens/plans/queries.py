"""Registered queries: a name, the grain of the line table, and the plan."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketlens.functions import prefix
from basketlens.functions.columns import dealt, plain_types
from basketlens.operators import (analytics, bi, cleaning, eda, features, forecasting, graph,
                                  metrics, prediction, quality, segmentation, serving)
from basketlens.plans.context import STAR_THRESHOLDS, Retail
from basketlens.sources import readers, sinks, star_schema
from basketlens.sources.stage import stage_path


def _rounded(df, digits, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _shared(r, name):
    """A path in the shared folder for a query that writes before it reads."""
    path = stage_path(r.spark, r.source, name)
    if path is None:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    return path


# --- sources and sinks -------------------------------------------------------------------

def src_csv_orders(r):
    path = _shared(r, "csv_orders")
    raw = r.raw_orders.select("order_id", "user_id", "eval_set", "order_number", "order_dow",
                              "order_hour_of_day", "days_since_prior_order")
    sinks.write_csv(raw, path)
    return readers.read_csv(r.spark, path, readers.SCHEMAS["orders"])


def src_discover(r):
    return readers.discover(r.spark, readers.tables_in(r.spark, r.folder)).select(
        "table_name", "file_count", "row_count", (F.col("total_bytes") > 0).alias("has_bytes"))


def src_report(r):
    path = _shared(r, "metrics_report")
    sinks.write_metrics(path, models_benchmark=metrics.ranking_metrics(r.scored),
                        threshold_analysis=metrics.threshold_sweep(r.scored))
    return readers.read_report(r.spark, path, "threshold_analysis").select(
        "model", "threshold", "precision", "recall", "f1_score")


def snk_upsert(r):
    """Merge prior purchase counts per product with those of the train orders."""
    def counts(split):
        return (r.lines.filter(F.col("eval_set") == split).groupBy("product_id")
                .agg(F.count(F.lit(1)).alias("lines"), F.max("order_number").alias("latest")))
    return graph.upsert(counts("prior"), counts("train"), ["product_id"])


def snk_table_load(r):
    folder = _shared(r, "processed")
    return sinks.load_tables({
        "departments": r.departments, "aisles": r.aisles, "products": r.products,
        "customers": r.customers, "orders": r.orders,
        "order_products": r.lines.select("order_id", "product_id", "add_to_cart_order",
                                         "reordered")}, folder)


# --- validation and cleaning -------------------------------------------------------------

def v1_profile(r):
    return quality.profile({
        "orders": r.raw_orders.drop("order_date"), "products": r.products, "aisles": r.aisles,
        "departments": r.departments, "raw_lines": r.raw_lines}).drop("data_type")


def v2_duplicates(r):
    return quality.duplicate_rows({"raw_lines": r.raw_lines,
                                   "orders": r.raw_orders, "products": r.products})


def v3_samples(r):
    return quality.sample_rows(r.raw_orders, ["order_id"]).select(
        "order_id", "user_id", "eval_set", "order_number", "days_since_prior_order")


def v4_foreign_keys(r):
    """Raw lines by the split of their order; a line without an order counts as prior."""
    tasks = r.line_tasks
    splits = dealt(r.raw_orders.select("order_id", "eval_set"), tasks, "order_id")
    lines = dealt(r.raw_lines.select("order_id", "product_id"), tasks, "order_id")
    placed = lines.join(splits, "order_id", "left")
    split = F.coalesce("eval_set", F.lit("prior"))
    return quality.foreign_keys(r.products, r.aisles, r.departments, r.raw_orders,
                                placed.filter(split == "prior"), placed.filter(split == "train"), tasks)


def v5_split_foreign_keys(r):
    """All raw lines against the orders of each split, so that orphans exist."""
    return quality.foreign_keys(r.products, r.aisles, r.departments, r.raw_orders,
                                r.raw_lines, r.raw_lines, r.line_tasks)


def v8_constraints(r):
    return quality.constraints({
        "departments": (r.departments, ["department_id"], ["department_id", "department"]),
        "aisles": (r.aisles, ["aisle_id"], ["aisle_id", "aisle"]),
        "products": (r.products, ["product_id"], ["product_id", "product_name"]),
        "orders": (r.raw_orders, ["order_id"], ["user_id", "days_since_prior_order"]),
        "raw_lines": (r.raw_lines, ["order_id", "product_id"], ["add_to_cart_order"])})


def v9_outputs(r):
    return quality.table_counts({
        "departments": r.departments, "aisles": r.aisles, "products": r.products,
        "customers": r.customers, "orders": r.orders.drop("order_date"),
        "order_products": r.lines.select("order_id", "product_id", "add_to_cart_order",
                                         "reordered")})


def c4_unify(r):
    whole = cleaning.unify_lines(r.lines_of("prior"), r.lines_of("train"))
    return whole.groupBy("reordered").agg(F.count(F.lit(1)).alias("line_count"),
                                          F.sum("product_id").alias("product_sum"),
                                          F.sum("add_to_cart_order").alias("cart_sum"))


# --- segmentation ------------------------------------------------------------------------

def g1_scaled(r):
    z = segmentation.scale_features(r.customer_features)
    return z.select("user_id", *[F.round(f"z_{c}", 4).alias(f"z_{c}")
                                 for c in segmentation.FEATURES])


def _scaled(r):
    return segmentation.scale_features(r.customer_features)


def g4_clusters(r):
    return segmentation.fit_clusters(_scaled(r)).select("user_id", "cluster")


def g7_summary(r):
    summary = segmentation.segment_summary(r.segments)
    return _rounded(summary, 2, "avg_lifetime_orders", "avg_order_interval_days",
                    "avg_basket_size", "avg_departments_explored", "avg_recency_days")


def fitted_segments(r):
    """Segments from the k-means fit instead of the fixed rule."""
    return segmentation.name_segments(segmentation.fit_clusters(_scaled(r)), STAR_THRESHOLDS)


# --- prediction --------------------------------------------------------------------------

_FITTED = {}


def _fit(r, fit):
    """The model of ``fit`` to all training rows, and the validation rows; fitted once per application and source."""
    train, rest = prediction.split_by_user(r.matrix)
    key = r.spark.sparkContext.applicationId, r.source, r.grain, fit.__name__
    if key not in _FITTED:
        with prediction.held_rows(train, tasks=r.fit_tasks) as rows:
            _FITTED[key] = fit(rows)
    return _FITTED[key], rest


def _models(r):
    fits = {prediction.LOGISTIC: prediction.fit_logistic, prediction.FOREST: prediction.fit_forest,
            prediction.BOOSTED: prediction.fit_boosted}
    return {name: _fit(r, fit)[0] for name, fit in fits.items()}, prediction.split_by_user(r.matrix)[1]


def p4_logistic(r):
    model, rest = _fit(r, prediction.fit_logistic)
    return prediction.score(model, rest, prediction.LOGISTIC)


def p5_forest(r):
    model, rest = _fit(r, prediction.fit_forest)
    return prediction.score(model, rest, prediction.FOREST)


def p6_boosted(r):
    model, rest = _fit(r, prediction.fit_boosted)
    return prediction.score(model, rest, prediction.BOOSTED)


def p11_importances(r):
    """Of the promoted model, the boosted trees."""
    return prediction.feature_importances(r.spark, _fit(r, prediction.fit_boosted)[0])


def p11_forest_importances(r):
    return prediction.feature_importances(r.spark, _fit(r, prediction.fit_forest)[0])


def p12_leaderboard(r):
    models, rest = _models(r)
    return prediction.leaderboard(prediction.score_all(models, rest))


def p12_leaderboard_fixed(r):
    return prediction.leaderboard(r.scored, {"blend": 0.05, "order_rate": 0.20})


def p13_batch_scores(r):
    """Every candidate pair scored by a logistic model that was fitted, saved and loaded."""
    path = _shared(r, "reorder_model")
    prediction.save_model(_fit(r, prediction.fit_logistic)[0], path)
    return prediction.score(prediction.load_model(path), r.matrix, prediction.LOGISTIC)


# --- forecasting -------------------------------------------------------------------------

def _departments_split(r):
    return forecasting.holdout_split(r.department_days)


def _platform_split(r):
    return forecasting.holdout_split(r.timeline_days)


def _models_of(split, models, **fixed):
    return _rounded(forecasting.model_backtest(split, models, **fixed), 4, "predicted").drop(
        "reason")


def t6_smoothing_fixed(r):
    return _models_of(_platform_split(r), (forecasting.SMOOTHING,), params=forecasting.FIXED)


def t6_smoothing_fitted(r):
    return _models_of(_platform_split(r), (forecasting.SMOOTHING,))


def _all_models(split):
    found = forecasting.average_backtest(split).unionByName(
        forecasting.model_backtest(split).drop("reason"))
    return forecasting.forecast_leaderboard(forecasting.forecast_errors(found))


def t10_leaderboard(r):
    return _all_models(_platform_split(r))


def _shelf_days(r):
    """Daily orders of every aisle."""
    return forecasting.fill_days(forecasting.daily_volume_by(
        r.orders, r.lines, r.products, level="aisle_id"))


def t12_smoothing_aisles(r):
    return _models_of(forecasting.holdout_split(_shelf_days(r)), (forecasting.SMOOTHING,),
                      params=forecasting.FIXED)


def t12_leaderboard(r):
    return _all_models(_departments_split(r))


# --- graph and serving -------------------------------------------------------------------

def _edges(r):
    return graph.taxonomy_edges(r.products)


def h1_nodes(r):
    made = graph.nodes(r.segments, r.product_features, r.aisles, r.departments)
    return quality.table_counts(made).drop("columns")


def _targets(r):
    """The customers that recommendations are made for: every id divisible by 100."""
    return r.customer_features.filter(F.pmod("user_id", F.lit(100)) == 0).select("user_id")


def h8_neighbourhood(r):
    found = graph.product_neighbourhood(r.products, r.aisles, r.departments, r.pairs)
    return found.withColumn("top_affinity_items", F.concat_ws(" | ", "top_affinity_items"))


def h9_upsert(r):
    """Node properties from the features, refreshed with totals that include train orders."""
    nodes = r.product_features.select("product_id", F.col("product_name").alias("name"),
                                      F.col("prod_reorder_rate").alias("reorder_rate"),
                                      F.col("prod_total_orders").alias("total_orders"))
    fresh = analytics.product_counts(r.lines).select(
        "product_id", F.col("total_purchases").alias("total_orders"))
    return graph.upsert(nodes, fresh, ["product_id"])


def h9_upsert_edges(r):
    """Bought edges of prior orders, merged with those of all orders by both ends and type."""
    keys = ["source", "target", "type"]
    old = graph.bought_edges(r.lines.filter(F.col("eval_set") == "prior")).drop("reorders_count")
    return graph.upsert(old, r.bought, keys)


def r4_daily(r):
    return serving.forecast_days(r.demand_forecast).select(
        "day", "forecast_date", "predicted_demand", "lower_ci_95", "upper_ci_95")


def r5_named(r):
    """Names of the bestsellers, given as a table of positions and ids."""
    best = eda.bestsellers(r.lines, r.products, r.departments, 8)
    place = W.partitionBy(F.lit(0)).orderBy(F.desc("total_orders"), "product_id")
    return serving.named_products(r.products, best.select(
        F.row_number().over(place).alias("position"), "product_id"))


def snk_union_csv(r):
    path = _shared(r, "union_csv")
    sinks.write_union([r.lines_of("prior"), r.lines_of("train")], path)
    return readers.read_csv(r.spark, path, readers.SCHEMAS["order_products"])


def snk_artifact_csv(r):
    folder = _shared(r, "artifacts")
    sinks.save_artifact(r.products, folder, "products", csv=True)
    return readers.read_csv(r.spark, f"{folder}/products.csv", readers.SCHEMAS["products"])


def _outputs(r):
    return {"departments": r.departments, "aisles": r.aisles, "products": r.products,
            "customers": r.customers, "orders": r.orders,
            "order_products": r.lines.select("order_id", "product_id", "add_to_cart_order",
                                             "reordered")}


def v9_written_values(r):
    """The tables as derived against what is read from their files."""
    folder = _shared(r, "verified")
    sinks.load_tables(_outputs(r), folder)
    return quality.verify_written(_outputs(r), folder)


def snk_bucket_upsert(r):
    """Purchase counts of prior orders as a bucketed table, merged with those of the train orders."""
    def counts(split):
        return (r.lines.filter(F.col("eval_set") == split).groupBy("product_id")
                .agg(F.count(F.lit(1)).alias("lines"), F.max("order_number").alias("latest")))
    path = _shared(r, "bucketed")
    sinks.write_buckets(counts("prior"), path, ["product_id"], 16)
    sinks.upsert_buckets(counts("train"), path, ["product_id"], graph.upsert, 16)
    return r.spark.read.parquet(path).drop(sinks.BUCKET)


def e7_basket_sketch(r):
    """Basket sizes by sketches per split of the orders, merged, with their rank errors."""
    sizes = r.lines.groupBy("order_id", "eval_set").agg(F.count(F.lit(1)).alias("basket_size"))
    sketches = prefix.quantile_sketches(sizes, ["eval_set"], "basket_size")
    found = prefix.rank_errors(sizes, "basket_size", prefix.sketched_quantiles(
        sketches, [0.25, 0.5, 0.75, 0.95]))
    return found.select("prob", F.col("n").alias("order_count"),
                        (F.col("rank_error") <= 0.015).alias("within_bound"))


# --- BI ----------------------------------------------------------------------------------

def b5_kpis(r):
    scores = metrics.ranking_metrics(r.scored).filter(F.col("model") == "blend")
    errors = forecasting.forecast_errors(r.backtest)
    return bi.executive_kpis(r.segments, r.product_features, r.orders,
                             scores.select("roc_auc"), errors.select("mape"))


def b12_line(r):
    return _rounded(bi.demand_line(r.timeline_days, r.demand_forecast), 4, "cumulative_volume")


def b13_scorecard(r):
    return bi.scorecard(p12_leaderboard_fixed(r), forecasting.forecast_errors(r.backtest))


PRODUCT, AISLE = "product", "aisle"

CATALOGUE = {
    # sources and sinks
    "src_csv_orders": (PRODUCT, src_csv_orders),
    "src_pruned_scan": (PRODUCT, lambda r: readers.read_parquet(
        r.spark, f"{r.folder}/orders.parquet",
        ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"])
        .filter((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000))
        .drop("o_orderstatus")),
    "src_discover": (PRODUCT, src_discover),
    "src_optional_missing": (PRODUCT, lambda r: readers.read_optional(
        r.spark, f"{r.folder}/no_such_table.parquet", "source bigint, target bigint")
        .unionByName(r.pairs.select("source", "target"))),
    "src_report": (AISLE, src_report),
    "src_key_sample": (PRODUCT, lambda r: readers.key_sample(r.orders, "user_id", 0.25).agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("order_id").alias("order_sum"))),
    "snk_upsert": (AISLE, snk_upsert),
    "snk_bucket_upsert": (AISLE, snk_bucket_upsert),
    "snk_table_load": (PRODUCT, snk_table_load),
    "snk_union_csv": (PRODUCT, snk_union_csv),
    "snk_artifact_csv": (PRODUCT, snk_artifact_csv),
    # validation
    "v1_profile": (PRODUCT, v1_profile),
    "v2_duplicate_rows": (PRODUCT, v2_duplicates),
    "v3_sample_rows": (PRODUCT, v3_samples),
    "v4_foreign_keys": (PRODUCT, v4_foreign_keys),
    "v5_split_foreign_keys": (PRODUCT, v5_split_foreign_keys),
    "v6_split_sizes": (PRODUCT, lambda r: quality.split_sizes(r.raw_orders)),
    "v7_domain_rules": (PRODUCT, lambda r: quality.domain_rules(
        r.raw_orders, star_schema.line_values(r.spark, r.folder))),
    "v8_constraints": (PRODUCT, v8_constraints),
    "v9_table_counts": (PRODUCT, v9_outputs),
    "v9_written_values": (PRODUCT, v9_written_values),
    # cleaning
    "c1_products": (PRODUCT, lambda r: cleaning.clean_reference(
        star_schema.products(r.spark, r.folder), ["product_id", "aisle_id", "department_id"],
        ["product_name"])),
    "c1_aisles": (PRODUCT, lambda r: cleaning.clean_reference(
        star_schema.aisles(r.spark, r.folder), ["aisle_id"], ["aisle"])),
    "c1_departments": (PRODUCT, lambda r: cleaning.clean_reference(
        star_schema.departments(r.spark, r.folder), ["department_id"], ["department"])),
    "c2_orders": (PRODUCT, lambda r: cleaning.clean_orders(
        star_schema.orders(r.spark, r.folder))),
    "c3_customers": (PRODUCT, lambda r: cleaning.customer_dimension(r.orders)),
    "c4_unified_lines": (PRODUCT, c4_unify),
    "c5_dedupe_report": (PRODUCT, lambda r: cleaning.dedupe_report(r.raw_lines)),
    "c5_deduped_lines": (PRODUCT, lambda r: cleaning.renumber_cart(
        cleaning.dedupe_lines(r.raw_lines))),
    "c5_order_lines": (PRODUCT, lambda r: star_schema.order_lines(
        r.spark, r.folder, r.raw_orders)),
    "c5_order_lines_aisle": (AISLE, lambda r: star_schema.order_lines(
        r.spark, r.folder, r.raw_orders, "aisle")),
    # analytics
    "a1_top_products": (PRODUCT, lambda r: analytics.top_products(
        r.lines, r.products, r.aisles, r.departments)),
    "a1_top_aisles": (AISLE, lambda r: analytics.top_products(
        r.lines, r.products, r.aisles, r.departments)),
    "a2_volume_by_day_hour": (PRODUCT, lambda r: analytics.volume_by_day_and_hour(r.orders)),
    "a3_retention": (PRODUCT, lambda r: analytics.retention_by_lifetime_orders(
        analytics.customer_summary(r.orders))),
    "a4_customer_summary": (PRODUCT, lambda r: _rounded(
        analytics.customer_summary(r.orders), 4, "avg_days_between_orders", "avg_order_hour")),
    "a5_order_baskets": (AISLE, lambda r: analytics.order_baskets(r.orders, r.lines)),
    # exploration
    "e1_peaks": (PRODUCT, lambda r: eda.peaks(r.orders)),
    "e2_orders_by_weekday": (PRODUCT, lambda r: eda.orders_by_weekday(r.orders)),
    "e3_orders_by_hour": (PRODUCT, lambda r: eda.orders_by_hour(r.orders)),
    "e4_day_hour_matrix": (PRODUCT, lambda r: eda.day_hour_matrix(r.orders)),
    "e5_repurchase_interval": (PRODUCT, lambda r: eda.repurchase_interval(r.orders)),
    "e6_interval_histogram": (PRODUCT, lambda r: eda.interval_histogram(r.orders)),
    "e7_basket_size_stats": (AISLE, lambda r: eda.basket_size_stats(r.lines)),
    "e7_basket_sketch": (AISLE, e7_basket_sketch),
    "e8_basket_size_histogram": (AISLE, lambda r: eda.basket_size_histogram(r.lines)),
    "e9_reorder_breakdown": (AISLE, lambda r: eda.reorder_breakdown(r.lines)),
    "e10_customer_stats": (PRODUCT, lambda r: eda.customer_order_stats(r.customers)),
    "e11_lifetime_histogram": (PRODUCT, lambda r: eda.lifetime_orders_histogram(r.customers)),
    "e12_bestsellers": (PRODUCT, lambda r: eda.bestsellers(
        r.lines, r.products, r.departments)),
    "e13_departments": (AISLE, lambda r: eda.department_breakdown(
        r.lines, r.products, r.departments)),
    "e14_reorder_by_order_number": (AISLE, lambda r: eda.reorder_rate_by_order_number(r.lines)),
    "e15_user_cadence": (PRODUCT, lambda r: _rounded(
        eda.user_cadence(r.orders), 4, "mean_interval", "std_interval")),
    "e16_department_diversity": (PRODUCT, lambda r: eda.department_diversity(
        r.lines, r.products)),
    "e17_reorder_by_cart_position": (AISLE, lambda r: eda.reorder_rate_by_cart_position(
        r.lines)),
    "e18_top_pairs": (AISLE, lambda r: eda.top_pairs(r.lines, r.products)),
    "e19_feature_correlation": (AISLE, lambda r: eda.feature_correlation(r.customer_features)),
    "e20_class_balance": (AISLE, lambda r: eda.class_balance(r.pair_features)),
    "e20_order_rate_boxplot": (AISLE, lambda r: eda.order_rate_boxplot(r.pair_features)),
    # features
    "f1_history": (PRODUCT, lambda r: features.history(r.lines).groupBy("reordered").agg(
        F.count(F.lit(1)).alias("line_count"), F.max("order_number").alias("max_order_number"))),
    "f2_product_features": (PRODUCT, lambda r: features.product_features(r.lines, r.products)),
    "f2_aisle_features": (AISLE, lambda r: features.product_features(r.lines, r.products)),
    "f3_customer_order_stats": (PRODUCT, lambda r: _rounded(
        features.customer_order_stats(r.orders), 4, "user_avg_order_interval",
        "user_std_order_interval")),
    "f3_order_stats_repeat_only": (PRODUCT, lambda r: _rounded(
        features.customer_order_stats(r.orders, exclude_first=True), 4,
        "user_avg_order_interval", "user_std_order_interval")),
    "f4_customer_item_stats": (PRODUCT, lambda r: features.customer_item_stats(
        r.lines, r.products)),
    "f5_customer_features": (PRODUCT, lambda r: _rounded(
        features.customer_features(r.orders, r.lines, r.products, tasks=r.line_tasks), 4,
        "user_avg_order_interval", "user_std_order_interval")),
    "f6_pair_stats": (AISLE, lambda r: features.user_product_stats(r.lines)),
    "f7_f8_pair_features": (AISLE, lambda r: features.user_product_features(
        r.orders, r.lines, tasks=r.line_tasks)),
    "f8_pair_features_product": (PRODUCT, lambda r: features.user_product_features(
        r.orders, r.lines, tasks=r.line_tasks)),
    "f9_cohort": (PRODUCT, lambda r: features.training_cohort(r.orders, 25000)),
    # segmentation
    "g1_scaled_features": (AISLE, g1_scaled),
    "g2_g3_k_sweep": (AISLE, lambda r: segmentation.evaluate_k(_scaled(r))),
    "g4_clusters": (AISLE, g4_clusters),
    "g5_cluster_profile": (AISLE, lambda r: segmentation.cluster_profile(r.labelled)),
    "g6_personas": (AISLE, lambda r: r.segments.select("user_id", "cluster", "segment_name")),
    "g7_segment_summary": (AISLE, g7_summary),
    "g7_fitted_summary": (AISLE, lambda r: segmentation.segment_summary(fitted_segments(r))),
    # prediction
    "p1_training_matrix": (AISLE, lambda r: _rounded(prediction.training_matrix(
        r.pair_features, r.customer_features, r.product_features), 4,
        "user_avg_order_interval")),
    "p2_sample": (AISLE, lambda r: prediction.sample_pairs(r.pair_features, 20000).select(
        "user_id", "product_id", "target")),
    "p3_split": (AISLE, lambda r: prediction.split_label(r.pair_features).groupBy("side").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("user_id").alias("user_count"),
        F.sum("target").alias("positives"))),
    "p4_logistic_scores": (AISLE, p4_logistic),
    "p5_forest_scores": (AISLE, p5_forest),
    "p6_boosted_scores": (AISLE, p6_boosted),
    "p7_p8_ranking_metrics": (AISLE, lambda r: metrics.ranking_metrics(r.scored)),
    "p9_threshold_metrics": (AISLE, lambda r: metrics.threshold_metrics(r.scored, 0.20)),
    "p10_threshold_sweep": (AISLE, lambda r: metrics.threshold_sweep(r.scored)),
    "p11_importances": (AISLE, p11_importances),
    "p11_forest_importances": (AISLE, p11_forest_importances),
    "p12_leaderboard": (AISLE, p12_leaderboard),
    "p12_leaderboard_fixed": (AISLE, p12_leaderboard_fixed),
    "p13_batch_scores": (AISLE, p13_batch_scores),
    # forecasting
    "t1_timeline": (PRODUCT, lambda r: forecasting.order_timeline(r.orders)),
    "t2_daily_volume": (PRODUCT, lambda r: forecasting.daily_volume(
        forecasting.order_timeline(r.orders))),
    "t2_real_dates": (PRODUCT, lambda r: forecasting.daily_volume(r.orders, None, None)),
    "t3_filled_days": (PRODUCT, lambda r: forecasting.fill_days(
        forecasting.daily_volume(r.orders, None, None))),
    "t4_holdout": (PRODUCT, lambda r: forecasting.holdout_split(r.timeline_days).groupBy(
        "series_key", F.col("is_holdout").cast("int").alias("is_holdout")).agg(
            F.min("ds").alias("first_day"), F.max("ds").alias("last_day"),
            F.count(F.lit(1)).alias("days"), F.sum("y").alias("volume"))),
    "t5_average_backtest": (PRODUCT, lambda r: _rounded(r.backtest, 4, "predicted")),
    "t5_average_multi_step": (PRODUCT, lambda r: _models_of(
        _platform_split(r), (forecasting.AVERAGE,))),
    "t6_smoothing_fixed": (PRODUCT, t6_smoothing_fixed),
    "t6_smoothing_fitted": (PRODUCT, t6_smoothing_fitted),
    "t6_smoothing_forecast": (PRODUCT, lambda r: forecasting.forecast_demand(
        r.timeline_days, params=forecasting.FIXED).drop("series_key", "reason")),
    "t7_arima": (PRODUCT, lambda r: _rounded(forecasting.model_backtest(
        _platform_split(r), (forecasting.ARIMA,)), 3, "predicted").drop("reason")),
    "t8_forecast": (PRODUCT, lambda r: r.demand_forecast),
    "t9_average_errors": (PRODUCT, lambda r: forecasting.forecast_errors(r.backtest)),
    "t10_leaderboard": (PRODUCT, t10_leaderboard),
    "t11_horizon": (PRODUCT, lambda r: serving.forecast_horizon(r.demand_forecast, 14)),
    "t12_department_days": (PRODUCT, lambda r: forecasting.fill_days(
        forecasting.daily_volume_by(r.orders, r.lines, r.products))),
    "t12_average_errors": (PRODUCT, lambda r: forecasting.forecast_errors(
        forecasting.average_backtest(_departments_split(r)))),
    "t12_leaderboard": (PRODUCT, t12_leaderboard),
    "t12_smoothing_aisles": (PRODUCT, t12_smoothing_aisles),
    "t12_forecast": (PRODUCT, lambda r: forecasting.forecast_arima(r.department_days)),
    "t12_product_series": (PRODUCT, lambda r: forecasting.series_report(r.product_days)),
    "t12_product_forecast": (PRODUCT, lambda r: forecasting.forecast_arima(r.product_series)),
    # graph
    "h1_nodes": (PRODUCT, h1_nodes),
    "h2_taxonomy_edges": (PRODUCT, _edges),
    "h3_bought_edges": (AISLE, lambda r: graph.bought_edges(r.lines)),
    "h4_co_purchase": (AISLE, lambda r: graph.co_purchase_edges(r.lines, r.product_features)),
    "h4_co_purchase_product": (PRODUCT, lambda r: graph.co_purchase_edges(
        r.lines, r.product_features, min_support=2)),
    "h5_bought_together": (AISLE, lambda r: graph.frequently_bought_together(
        r.pairs, r.products)),
    "h6_similar_customers": (PRODUCT, lambda r: graph.similar_customers(r.bought, _targets(r))),
    "h6_recommendations": (PRODUCT, lambda r: graph.collaborative_recommendations(
        r.bought, r.product_features, _targets(r))),
    "h7_segment_departments": (AISLE, lambda r: graph.segment_departments(
        r.bought, r.segments, r.products, r.departments)),
    "h8_neighbourhood": (AISLE, h8_neighbourhood),
    "h9_upsert_nodes": (AISLE, h9_upsert),
    "h9_upsert_edges": (AISLE, h9_upsert_edges),
    # serving
    "r1_profiles": (AISLE, lambda r: serving.customer_profiles(r.segments)),
    "r2_reorder_list": (AISLE, lambda r: serving.reorder_list(
        r.segments, r.product_features, threshold=0.1).filter(F.col("rank").isNotNull())),
    "r2_counts": (AISLE, lambda r: serving.reorder_list(
        r.segments, r.product_features, threshold=0.12).select(
        "user_id", "customer_segment", "recommendations_count").distinct()),
    "r3_bought_together": (AISLE, lambda r: serving.bought_together(r.pairs, r.products)),
    "r4_forecast_response": (PRODUCT, lambda r: serving.forecast_horizon(r.demand_forecast)),
    "r4_daily_forecast": (PRODUCT, r4_daily),
    "r5_named_products": (PRODUCT, r5_named),
    "r6_inventory": (PRODUCT, lambda r: serving.inventory(r.segments, r.product_features)),
    "r7_affinity_tiers": (AISLE, lambda r: serving.affinity_tiers(
        serving.bought_together(r.pairs, r.products, 6), high=30)),
    "r7_bundles": (AISLE, lambda r: serving.affinity_bundles(
        serving.bought_together(r.pairs, r.products, 6), high=30)),
    "r8_descriptions": (AISLE, lambda r: serving.persona_descriptions(r.segments)),
    # BI
    "b1_customer_feed": (AISLE, lambda r: _rounded(bi.customer_feed(r.segments), 4,
                                                   "user_avg_order_interval",
                                                   "user_std_order_interval")),
    "b2_product_intelligence": (PRODUCT, lambda r: bi.product_intelligence(
        r.product_features, r.aisles, r.departments)),
    "b3_forecast_feed": (PRODUCT, lambda r: bi.forecast_feed(r.demand_forecast)),
    "b4_cross_sell": (AISLE, lambda r: bi.cross_sell_matrix(r.pairs, r.products)),
    "b4_cross_sell_by_id": (PRODUCT, lambda r: bi.cross_sell_matrix(
        r.pairs, r.products, order="id")),
    "b5_kpis": (AISLE, b5_kpis),
    "b6_measures": (AISLE, lambda r: bi.measures(r.segments, r.demand_forecast)),
    "b6_line_reorder_rate": (AISLE, lambda r: bi.line_reorder_rate(r.lines)),
    "b7_segment_distribution": (AISLE, lambda r: bi.segment_distribution(r.segments)),
    "b8_top_departments": (PRODUCT, lambda r: bi.top_departments(
        r.lines, r.products, r.aisles, r.departments)),
    "b9_segment_diversity": (AISLE, lambda r: bi.segment_basket_diversity(r.segments)),
    "b10_high_value": (AISLE, lambda r: bi.high_value_customers(r.segments)),
    "b11_most_reordered": (AISLE, lambda r: analytics.top_products(
        r.lines, r.products, r.aisles, r.departments, by="total_reorders")),
    "b12_demand_line": (PRODUCT, b12_line),
    "b12_peak_day": (PRODUCT, lambda r: bi.peak_day(r.demand_forecast)),
    "b13_scorecard": (AISLE, b13_scorecard),
}


def build(name):
    """The query as a function of a session and a source folder."""
    grain, plan = CATALOGUE[name]

    def run(spark, folder):
        return plain_types(plan(Retail(spark, folder, grain)))
    run.__name__ = name
    return run
