"""Lookup tables for all keys at once."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketlens.functions.columns import exact, first_match, labels
from basketlens.functions.ranking import top_per_key

# Retention strategy per persona.
STRATEGIES = {
    "High-Value Frequent Loyalists":
        "VIP Retention: Offer priority delivery slots and exclusive early access.",
    "Full-Pantry Bulk Shoppers":
        "Volume Incentive: Promote bulk pantry bundles and subscription discounts.",
    "Routine Convenience Buyers":
        "Basket Building: Recommend cross-sell essentials to increase item count.",
    "Occasional / At-Risk Shoppers":
        "Win-Back Campaign: Trigger 14-day re-engagement discounts to curb churn.",
}
DEFAULT_STRATEGY = "Standard Engagement"

# Persona description by a word of its name, in order of precedence.
DESCRIPTIONS = {
    "Loyalist": "Weekly habitual regular with the highest order frequency and loyalty "
                "stickiness. Reorders routine grocery staples consistently.",
    "Bulk": "Full-pantry restocker. Buys high volume across 10+ grocery departments with the "
            "highest basket item count.",
    "Convenience": "Quick grab-and-go customer. Orders smaller targeted carts on a predictable "
                   "weekly cadence.",
}
# Fixed value: the description of every other persona.
OTHER_DESCRIPTION = ("Dormant / churn-risk shopper. High elapsed days since last order. Needs "
                     "automated win-back re-engagement incentives.")


def _check(name, value, low, high):
    if not low <= value <= high:
        raise ValueError(f"{name} must be between {low} and {high}, got {value}")


def customer_profiles(segments):
    """Persona, rounded statistics and retention strategy per customer."""
    return segments.select(
        "user_id", F.col("cluster").alias("segment_id"),
        F.col("segment_name").alias("segment_persona"),
        F.col("user_total_orders").alias("total_orders"),
        F.round("user_avg_order_interval", 1).alias("avg_order_interval_days"),
        F.round("user_avg_basket_size", 1).alias("avg_basket_size"),
        F.round(exact("user_reorder_rate") * 100, 1).cast("double").alias("reorder_rate_pct"),
        F.col("user_unique_departments").alias("distinct_departments"),
        F.round("user_days_since_last_order", 1).alias("days_since_last_order"),
        labels("segment_name", STRATEGIES, DEFAULT_STRATEGY).alias("retention_action_strategy"))


def _tenths(rate, weight):
    """A rate of four decimals times a weight of one, exact as a decimal."""
    return exact(rate) * F.lit(weight).cast("decimal(2,1)")


def _clip(score):
    low, high = F.lit(0.05).cast("decimal(3,2)"), F.lit(0.95).cast("decimal(3,2)")
    return F.least(F.greatest(score, low), high)


def heuristic_score(product_rate, user_rate):
    """Fixed blend of product and user reorder rates, clipped to [.05, .95]."""
    return _clip(_tenths(product_rate, 0.4) + _tenths(user_rate, 0.6))


def reorder_list(segments, product_features, top_k=5, threshold=0.15, candidates=30):
    """The ``top_k`` reorder candidates of every customer (R2).

    The most ordered products form one array of at most ``candidates`` elements, fetched as
    a scalar subquery; scoring, filtering and ordering are array expressions on the
    customer's row, so customers are never shuffled. A customer without a candidate keeps one
    row with a count of 0 and nulls.
    """
    _check("top_k", top_k, 1, 20)
    _check("threshold", threshold, 0.05, 0.9)
    popular = (product_features.orderBy(F.desc("prod_total_orders"), "product_id")
               .limit(candidates)
               .agg(F.sort_array(F.collect_list(F.struct(
                   (-F.col("prod_total_orders")).alias("key"), "product_id", "product_name",
                   _tenths("prod_reorder_rate", 0.4).alias("part")))).alias("popular")))
    people = segments.select("user_id", "segment_name",
                             _tenths("user_reorder_rate", 0.6).alias("own")).withColumn(
        "popular", popular.scalar())
    scores = F.transform("popular", lambda item: _clip(item["part"] + F.col("own")))
    ordered = F.sort_array(F.filter(
        F.transform(scores, lambda score, at: F.struct(
            (-F.round(score, 4)).alias("order"), at.alias("at"), score.alias("score"))),
        lambda x: x["score"] >= threshold))
    rows = people.select("user_id", "segment_name", "popular",
                         F.least(F.size(ordered), F.lit(top_k)).alias("recommendations_count"),
                         F.posexplode_outer(F.slice(ordered, 1, top_k)).alias("place", "x"))
    item = F.get("popular", F.col("x.at"))
    return rows.select(
        "user_id", F.col("segment_name").alias("customer_segment"), "recommendations_count",
        (F.col("place") + 1).alias("rank"), item["product_id"].alias("product_id"),
        item["product_name"].alias("product_name"),
        F.round("x.score", 4).cast("double").alias("reorder_probability"),
        F.when(F.col("x.score") >= 0.40, "High Priority").when(
            F.col("x.score").isNotNull(), "Medium Priority").alias("recommendation_tier"))


def both_directions(edges):
    """Each undirected pair as two directed rows, so a product finds it by one key."""
    back = edges.select(F.col("target").alias("source"), F.col("source").alias("target"),
                        "co_occurrence")
    return edges.select("source", "target", "co_occurrence").unionByName(back)


def bought_together(edges, products, limit=5):
    """Top affinities of every product in either direction, with names."""
    _check("limit", limit, 1, 15)
    names = products.select("product_id", "product_name")
    best = top_per_key(both_directions(edges), ["source"], [F.desc("co_occurrence"), "target"],
                       limit)
    rec = names.withColumnsRenamed({"product_id": "target", "product_name": "product_name"})
    src = names.withColumnsRenamed({"product_id": "source",
                                    "product_name": "source_product_name"})
    return best.join(rec, "target").join(src, "source").select(
        F.col("source").alias("source_product_id"), "source_product_name", "rank",
        F.col("target").alias("product_id"), "product_name",
        F.col("co_occurrence").alias("times_co_purchased"))


def forecast_days(forecast, days=30):
    """The first days of a forecast, one row each, with their place."""
    _check("days", days, 7, 30)
    along = W.partitionBy(F.lit(0)).orderBy("forecast_date")
    # A forecast has at most some weeks of days.
    return forecast.orderBy("forecast_date").limit(days).withColumn(
        "day", F.row_number().over(along))


def forecast_horizon(forecast, days=30):
    """The first days of a forecast, their number and total."""
    _check("days", days, 7, 30)
    part = forecast.orderBy("forecast_date").limit(days)
    return part.agg(F.count(F.lit(1)).alias("forecast_horizon_days"),
                    F.coalesce(F.sum("predicted_demand"), F.lit(0))
                    .alias("total_projected_orders"))


def named_products(products, wanted):
    """Names of the products of ``wanted`` (position, product_id); unknown ids are left out."""
    return wanted.select("position", "product_id").join(
        products.select("product_id", "product_name"), "product_id").select(
        "position", "product_id", "product_name")


def inventory(segments, product_features):
    """How many customers and products the serving tables hold."""
    products = product_features.agg(F.count(F.lit(1))).scalar()
    return segments.agg(F.count(F.lit(1)).alias("customers_indexed")).select(
        "customers_indexed", products.alias("products_indexed"))


def affinity_bundles(recommendations, high=1000, size=2):
    """A bundle per product: itself and its two strongest partners, with the best tier.

    Input rows are those of ``bought_together``.
    """
    tier = F.when(F.col("times_co_purchased") > high, "High Affinity").otherwise("Medium Affinity")
    best = recommendations.filter(F.col("rank") <= size)
    return (best.withColumn("tier", tier)
            .groupBy("source_product_id", "source_product_name")
            .agg(F.sort_array(F.collect_list(F.struct("rank", "product_name"))).alias("found"),
                 F.min_by("tier", "rank").alias("top_tier"))
            .select("source_product_id",
                    F.concat_ws(" + ", F.array("source_product_name"), F.col("found.product_name"))
                    .alias("bundle"), "top_tier"))


def affinity_tiers(recommendations, high=1000):
    """Each recommendation with its affinity tier."""
    return recommendations.withColumn(
        "tier", F.when(F.col("times_co_purchased") > high, "High Affinity")
        .otherwise("Medium Affinity"))


def persona_descriptions(personas):
    """Description of each persona by the first word its name contains."""
    rules = [(F.contains(F.col("segment_name"), F.lit(word)), text)
             for word, text in DESCRIPTIONS.items()]
    return personas.select("segment_name").distinct().withColumn(
        "description", first_match(rules, OTHER_DESCRIPTION))
