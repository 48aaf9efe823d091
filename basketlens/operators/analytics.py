"""Reports and views over orders, lines and catalogue (A1-A5)."""

from pyspark.sql import functions as F

from basketlens.functions.columns import rate
from basketlens.functions.ranking import top_rows


def product_counts(lines):
    """Purchases and reorders per product, before any join with the catalogue."""
    return lines.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("total_purchases"),
        F.sum("reordered").alias("total_reorders"))


def with_taxonomy(rows, products, aisles, departments):
    """Join product rows with product, aisle and department names."""
    return (rows.join(products, "product_id").join(departments, "department_id")
            .join(aisles, "aisle_id"))


def top_products(lines, products, aisles, departments, n=20, by="total_purchases"):
    """Most purchased products with reorder rate, in order (A1; by reorders: B11)."""
    named = with_taxonomy(product_counts(lines), products, aisles, departments).select(
        "product_id", "product_name", "department", "aisle", "total_purchases", "total_reorders",
        rate("total_reorders", "total_purchases").alias("reorder_rate"))
    return top_rows(named, [F.desc(by), "product_id"], n)


def volume_by_day_and_hour(orders):
    """Distinct orders per weekday and hour (A2)."""
    single = orders.groupBy("order_dow", "order_hour_of_day", "order_id").agg(F.lit(1))
    return single.groupBy("order_dow", "order_hour_of_day").agg(
        F.count(F.lit(1)).alias("order_volume"))


def customer_summary(orders):
    """One row per user with order count, range, mean gap and mean hour (A4).

    ``order_id`` is the key of orders, which ``constraints`` checks; repeated rows of an
    order are reduced to one before the count.
    """
    per_order = orders.groupBy("user_id", "order_id").agg(
        F.count(F.lit(1)).alias("copies"), F.min("order_number").alias("low"),
        F.max("order_number").alias("high"), F.sum("days_since_prior_order").alias("gaps"),
        F.count("days_since_prior_order").alias("gap_count"),
        F.sum("order_hour_of_day").alias("hours"))
    return per_order.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.min("low").alias("first_order_number"),
        F.max("high").alias("max_order_number"),
        F.try_divide(F.sum("gaps"), F.sum("gap_count")).alias("avg_days_between_orders"),
        F.try_divide(F.sum("hours").cast("double"), F.sum("copies")).alias("avg_order_hour"))


def retention_by_lifetime_orders(summary):
    """Customers and mean cadence per number of lifetime orders (A3)."""
    return summary.groupBy("total_orders").agg(
        F.count("user_id").alias("customer_count"),
        F.round(F.avg("avg_days_between_orders"), 2).alias("mean_days_between_orders"))


def order_baskets(orders, lines):
    """Basket size, reordered items and their ratio per order (A5).

    Lines are grouped by order before the join, so orders meet one row each.
    """
    sizes = lines.groupBy("order_id").agg(
        F.count("product_id").alias("basket_size"), F.sum("reordered").alias("reordered_count"))
    return orders.join(sizes, "order_id").select(
        "order_id", "user_id", "order_number", "order_dow", "order_hour_of_day",
        "days_since_prior_order", "basket_size", "reordered_count",
        rate("reordered_count", "basket_size").alias("reorder_ratio"))
