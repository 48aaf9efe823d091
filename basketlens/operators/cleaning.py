"""Cleaned relational tables from raw ones."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F


def clean_reference(df, id_columns, name_columns):
    """Cast the ids and trim the names of a reference table."""
    return df.withColumns({
        **{c: F.col(c).cast("bigint") for c in id_columns},
        **{c: F.trim(F.col(c).cast("string")) for c in name_columns}})


def clean_orders(orders):
    """Typed orders with a first-order flag and the first gap set to 0."""
    return orders.withColumns({
        "order_id": F.col("order_id").cast("bigint"),
        "user_id": F.col("user_id").cast("bigint"),
        "order_number": F.col("order_number").cast("bigint"),
        "order_dow": F.col("order_dow").cast("int"),
        "order_hour_of_day": F.col("order_hour_of_day").cast("int"),
        "is_first_order": (F.col("order_number") == 1).cast("int"),
        "days_since_prior_order": F.coalesce(
            F.col("days_since_prior_order").cast("double"), F.lit(0.0))})


def customer_dimension(orders):
    """One row per user: lifetime orders and whether a held-out order exists."""
    def has(split):
        return F.max(F.when(F.col("eval_set") == split, 1).otherwise(0))
    return orders.groupBy("user_id").agg(
        F.max("order_number").alias("total_orders"),
        has("train").alias("has_train_order"),
        has("test").alias("has_test_order"))


def unify_lines(prior_lines, train_lines):
    """Bag union of the prior and train line tables (C4)."""
    return prior_lines.unionByName(train_lines)


def dedupe_lines(lines):
    """One line per (order, product), the one with the lowest cart position."""
    rest = [c for c in lines.columns if c not in ("order_id", "product_id", "add_to_cart_order")]
    first = F.min(F.struct("add_to_cart_order", *rest)).alias("kept")
    return (lines.groupBy("order_id", "product_id").agg(first)
            .select("order_id", "product_id", "kept.*"))


def dedupe_report(lines):
    """Lines before and after dedupe, and how many were removed."""
    per_key = lines.groupBy("order_id", "product_id").agg(F.count(F.lit(1)).alias("copies"))
    return per_key.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_before"),
                       F.count(F.lit(1)).alias("rows_after"),
                       F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("rows_removed"))


def renumber_cart(lines):
    """Cart positions 1..n after a dedupe; an order's window is bounded by the catalogue."""
    place = W.partitionBy("order_id").orderBy("add_to_cart_order", "product_id")
    return lines.withColumn("add_to_cart_order", F.row_number().over(place))
