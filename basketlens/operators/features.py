"""Leak-free product, customer and customer-product features.

Line tables carry ``user_id``, ``order_number`` and ``eval_set`` of their order
(``order_context`` adds them); history is the prior split only.
"""

from pyspark.sql import functions as F

from basketlens.functions.columns import dealt, rate


def order_context(lines, orders):
    """Lines with the user, number and split of their order."""
    return lines.join(orders.select("order_id", "user_id", "order_number", "eval_set"),
                      "order_id")


def history(lines):
    """Lines of prior orders only; nothing of a held-out order passes (F1)."""
    return lines.filter(F.col("eval_set") == "prior")


def product_features(lines, products):
    """Orders, reorder rate and mean cart position; the whole catalogue is kept (F2)."""
    totals = history(lines).groupBy("product_id").agg(
        F.count("reordered").alias("n"), F.sum("reordered").alias("again"),
        F.sum("add_to_cart_order").alias("cart"))
    stats = totals.select("product_id", F.col("n").alias("prod_total_orders"),
                          rate("again", "n").alias("prod_reorder_rate"),
                          rate("cart", "n", 2).alias("prod_avg_add_to_cart"))
    return products.join(stats, "product_id", "left").na.fill(
        {"prod_total_orders": 0, "prod_reorder_rate": 0.0, "prod_avg_add_to_cart": 0.0})


def customer_order_stats(orders, exclude_first=False):
    """Order frequency and timing per user.

    The imputed 0 gap of the first order counts unless ``exclude_first`` is set.
    """
    gap = F.col("days_since_prior_order")
    if exclude_first:
        gap = F.when(F.col("order_number") > 1, gap)
    return orders.filter(F.col("eval_set") == "prior").groupBy("user_id").agg(
        F.max("order_number").alias("user_total_orders"),
        F.avg(gap).alias("user_avg_order_interval"),
        F.coalesce(F.stddev_samp(gap), F.lit(0.0)).alias("user_std_order_interval"),
        F.mode("order_dow", True).alias("user_preferred_dow"),
        F.mode("order_hour_of_day", True).alias("user_preferred_hour"),
        F.max_by("days_since_prior_order", "order_number").alias("user_days_since_last_order"))


def customer_item_stats(lines, products, tasks=None):
    """Items, reorders and distinct products, departments and aisles per user.

    Lines become one row per (user, product) before the catalogue join, so distinct
    products are a plain count; the two sets hold at most every department and aisle.
    A user has at most one row per product when its rows meet in one of ``tasks`` tasks.
    """
    past = history(lines).select("user_id", "product_id", "reordered")
    pairs = dealt(past, tasks, "user_id", "product_id").groupBy("user_id", "product_id").agg(
        F.count("reordered").alias("items"), F.sum("reordered").alias("again"))
    placed = pairs.join(products.select("product_id", "department_id", "aisle_id"),
                        "product_id", "left").drop("product_id")
    return dealt(placed, tasks, "user_id").groupBy("user_id").agg(
        F.sum("items").alias("user_total_items"),
        F.sum("again").alias("user_total_reorders"),
        F.count(F.lit(1)).alias("user_unique_products"),
        F.size(F.collect_set("department_id")).alias("user_unique_departments"),
        F.size(F.collect_set("aisle_id")).alias("user_unique_aisles")).select(
            "user_id", "user_total_items", "user_total_reorders",
            rate("user_total_reorders", "user_total_items").alias("user_reorder_rate"),
            "user_unique_products", "user_unique_departments", "user_unique_aisles")


def customer_features(orders, lines, products, exclude_first=False, tasks=None):
    """Order and item statistics per user with mean basket size.

    A user whose orders have no lines counts 0 in every item column.
    """
    items = customer_item_stats(lines, products, tasks)
    joined = customer_order_stats(orders, exclude_first).join(items, "user_id", "left").na.fill(
        0, [c for c in items.columns if c != "user_id"])
    return joined.withColumn("user_avg_basket_size",
                             rate("user_total_items", "user_total_orders", 2))


def training_cohort(orders, n=None):
    """Users that have a train order, all of them or the first ``n`` by id."""
    users = orders.filter(F.col("eval_set") == "train").select("user_id").distinct()
    return users if n is None else users.orderBy("user_id").limit(n)


def user_product_stats(lines, cohort=None, tasks=None):
    """Purchases, first and last order and summed cart position per (user, product)."""
    past = history(lines)
    if cohort is not None:
        past = past.join(cohort, "user_id", "left_semi")
    return dealt(past, tasks, "user_id", "product_id").groupBy("user_id", "product_id").agg(
        F.count("reordered").alias("up_total_orders"),
        F.min("order_number").alias("first_order_number"),
        F.max("order_number").alias("last_order_number"),
        F.sum("add_to_cart_order").alias("cart_sum"))


def user_product_features(orders, lines, cohort_size=None, tasks=None):
    """Pair features of the cohort and whether the train order bought the pair.

    Lines become one row per pair before they meet the users of the cohort.
    """
    cohort = training_cohort(orders, cohort_size)
    longest = (orders.filter(F.col("eval_set") == "prior").groupBy("user_id")
               .agg(F.max("order_number").alias("user_orders"))
               .join(cohort, "user_id", "left_semi"))
    bought = (dealt(lines.filter(F.col("eval_set") == "train").select("user_id", "product_id"),
                    tasks, "user_id", "product_id").distinct().withColumn("bought", F.lit(1)))
    pairs = user_product_stats(lines, tasks=tasks).join(bought, ["user_id", "product_id"], "left")
    return (dealt(pairs, tasks, "user_id").join(dealt(longest, tasks, "user_id"), "user_id")
            .select("user_id", "product_id", "up_total_orders",
                    rate("up_total_orders", "user_orders").alias("up_order_rate"),
                    (F.col("user_orders") - F.col("last_order_number"))
                    .alias("up_orders_since_last"),
                    rate("cart_sum", "up_total_orders", 2).alias("up_avg_add_to_cart"),
                    F.coalesce("bought", F.lit(0)).alias("target")))
