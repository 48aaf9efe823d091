"""BI feeds and measures."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketlens.functions.columns import share_pct
from basketlens.functions.ranking import top_rows
from basketlens.operators.analytics import product_counts, with_taxonomy

LOYALISTS = "High-Value Frequent Loyalists"


def customer_feed(segments):
    """Customer segments with all features (B1)."""
    return segments


def product_intelligence(product_features, aisles, departments):
    """Product features with department and aisle names (B2)."""
    return (product_features.join(departments, "department_id").join(aisles, "aisle_id")
            .select("product_id", "product_name", "aisle_id", "department_id",
                    "prod_total_orders", "prod_reorder_rate", "prod_avg_add_to_cart",
                    "department", "aisle"))


def forecast_feed(forecast):
    """Forecast rows for charts."""
    return forecast.select("forecast_date", "predicted_demand", "lower_ci_95", "upper_ci_95")


def cross_sell_matrix(edges, products, n=250, order="support"):
    """Pairs with both names (B4): the strongest, or the first by id with ``order="id"``."""
    keys = {"support": [F.desc("co_occurrence"), "source", "target"], "id": ["source", "target"]}
    best = top_rows(edges, keys[order], n)
    names = products.select("product_id", "product_name")
    left = names.withColumnsRenamed({"product_id": "source", "product_name": "source_product"})
    right = names.withColumnsRenamed({"product_id": "target",
                                      "product_name": "recommended_product"})
    named = best.join(left, "source").join(right, "target").orderBy(*keys[order])
    return named.select(
        "source_product", "recommended_product",
        F.col("co_occurrence").alias("times_co_purchased"))


def executive_kpis(segments, product_features, orders, roc_auc, mape):
    """Name, value and formatted value of seven measures.

    ``roc_auc`` and ``mape`` are one-value frames of the chosen models.
    """
    people = segments.agg(F.count(F.lit(1)).alias("n"),
                          F.avg("user_avg_basket_size").alias("basket"),
                          F.avg("user_reorder_rate").alias("reorder"))
    one = (people.withColumn("products", product_features.agg(F.count(F.lit(1))).scalar())
           .withColumn("orders", orders.agg(F.count(F.lit(1))).scalar())
           .withColumn("auc", roc_auc.scalar()).withColumn("mape", mape.scalar()))

    def kpi(name, value, text):
        return F.struct(F.lit(name).alias("metric_name"), value.cast("double").alias("value"),
                        text.alias("formatted_value"))

    def whole(column):
        return F.format_number(F.col(column), 0)

    return one.select(F.explode(F.array(
        kpi("Total Registered Customers", F.col("n"), whole("n")),
        kpi("Total Catalog Products", F.col("products"), whole("products")),
        kpi("Platform Lifetime Orders", F.col("orders"), whole("orders")),
        kpi("Average Basket Size", F.round("basket", 2), F.format_string("%.1f items", "basket")),
        kpi("Platform Reorder Rate", F.round(F.col("reorder") * 100, 2),
            F.format_string("%.1f%%", F.col("reorder") * 100)),
        kpi("Supervised Prediction ROC-AUC", F.col("auc"),
            F.format_string("%.2f%%", F.col("auc") * 100)),
        kpi("Forecast Error (MAPE)", F.col("mape"), F.format_string("%.2f%%", "mape")))
    ).alias("k")).select("k.*")


def measures(segments, forecast):
    """The five dashboard measures in one row."""
    projected = forecast.agg(F.coalesce(F.sum("predicted_demand"), F.lit(0))).scalar()
    loyal = F.sum(F.when(F.col("segment_name") == LOYALISTS, 1).otherwise(0))
    return segments.agg(
        F.count_distinct("user_id").alias("total_customers"),
        F.round(F.avg("user_avg_basket_size"), 4).alias("avg_basket_size"),
        F.round(F.avg("user_reorder_rate") * 100, 4).alias("platform_reorder_rate_pct"),
        share_pct(loyal, F.count(F.lit(1)), 4).alias("high_value_loyalists_pct")
    ).withColumn("total_projected_orders", projected)


def line_reorder_rate(lines):
    """Share of reordered lines, the per-line counterpart of the mean user rate."""
    return lines.agg(share_pct(F.sum("reordered"), F.count(F.lit(1)), 4)
                     .alias("line_reorder_rate_pct"))


def segment_distribution(segments):
    """Customers and share per segment."""
    counts = segments.groupBy("segment_name").agg(F.count(F.lit(1)).alias("customer_count"))
    whole = counts.agg(F.sum("customer_count")).scalar()
    return counts.select("segment_name", "customer_count",
                         share_pct(F.col("customer_count"), whole).alias("customer_pct"))


def top_departments(lines, products, aisles, departments, n=10):
    """Departments by order lines, with their share of all lines."""
    volume = (with_taxonomy(product_counts(lines), products, aisles, departments)
              .groupBy("department").agg(F.sum("total_purchases").alias("order_lines")))
    whole = lines.agg(F.count(F.lit(1))).scalar()
    return top_rows(volume, [F.desc("order_lines"), "department"], n).select(
        "department", "order_lines", share_pct(F.col("order_lines"), whole).alias("share_pct"))


def segment_basket_diversity(segments):
    """Mean basket size and departments per segment."""
    return segments.groupBy("segment_name").agg(
        F.round(F.avg("user_avg_basket_size"), 4).alias("avg_basket_size"),
        F.round(F.avg("user_unique_departments"), 4).alias("avg_departments"))


def high_value_customers(segments, n=100, segment=LOYALISTS):
    """The customers of the loyal segment with most orders."""
    chosen = segments.filter(F.col("segment_name") == segment)
    return top_rows(chosen, [F.desc("user_total_orders"), "user_id"], n).select(
        "user_id", "segment_name", "user_total_orders", "user_avg_basket_size",
        "user_reorder_rate")


def demand_line(actual, forecast):
    """Actual and forecast days in one series with the running total.

    One row per day, so the window is bounded by the calendar.
    """
    rows = (actual.select(F.col("ds").cast("date").alias("day"), F.lit("actual").alias("kind"),
                          F.col("y").cast("double").alias("volume"))
            .unionByName(forecast.select(F.col("forecast_date").cast("date").alias("day"),
                                         F.lit("forecast").alias("kind"),
                                         F.col("predicted_demand").cast("double")
                                         .alias("volume"))))
    along = (W.partitionBy("kind").orderBy("day")
             .rowsBetween(W.unboundedPreceding, W.currentRow))
    return rows.withColumn("cumulative_volume", F.sum("volume").over(along))


def peak_day(forecast):
    """Day with the largest projected demand, the earliest on ties, and the total."""
    best = F.max(F.struct("predicted_demand", (-F.datediff(
        F.col("forecast_date").cast("date"), F.lit("1970-01-01").cast("date"))).alias("back"),
        F.col("forecast_date").cast("string").alias("day")))
    return forecast.agg(best.alias("b"), F.sum("predicted_demand").alias("total_volume")).select(
        F.col("b.day").alias("peak_day"), F.col("b.predicted_demand").alias("peak_demand"),
        "total_volume")


def scorecard(classifiers, forecasters):
    """Classifier and forecaster quality in one long table."""
    def long(df, kind, names):
        cells = F.explode(F.array(*[
            F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value"))
            for n in names])).alias("c")
        return df.select(F.lit(kind).alias("kind"), "model", cells).select(
            "kind", "model", "c.metric", "c.value")
    return long(classifiers, "classification",
                ["roc_auc", "pr_auc", "precision", "recall", "f1_score"]).unionByName(
        long(forecasters, "forecast", ["mae", "rmse", "mape"]))
