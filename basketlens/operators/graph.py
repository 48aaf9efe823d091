"""Consumer-product graph: node and edge tables and their queries (H1-H9)."""

from pyspark.sql import functions as F

from basketlens.functions.ranking import top_per_key, top_rows


def nodes(segments, product_features, aisles, departments, customers=None):
    """The four node tables; all customers, or the first ``customers`` by id (H1)."""
    people = segments if customers is None else segments.orderBy("user_id").limit(customers)
    return {"customer": people,
            "product": product_features,
            "aisle": aisles.withColumnRenamed("aisle", "name"),
            "department": departments.withColumnRenamed("department", "name")}


def taxonomy_edges(products):
    """Product to aisle and aisle to department edges (H2)."""
    shelf = products.select(F.col("product_id").alias("source"),
                            F.col("aisle_id").cast("bigint").alias("target"),
                            F.lit("BELONGS_TO").alias("type"))
    area = products.select(F.col("aisle_id").cast("bigint").alias("source"),
                           F.col("department_id").cast("bigint").alias("target"),
                           F.lit("IN_DEPARTMENT").alias("type")).distinct()
    return shelf.unionByName(area)


def bought_edges(lines, users=None):
    """Orders and reorders per (user, product) over prior and train orders (H3)."""
    if users is not None:
        lines = lines.join(users.select("user_id"), "user_id", "left_semi")
    return lines.groupBy(F.col("user_id").alias("source"), F.col("product_id").alias("target")).agg(
        F.count("reordered").alias("order_count"),
        F.sum("reordered").alias("reorders_count"),
        F.lit("BOUGHT").alias("type"))


def pair_counts(lines, kept_products):
    """Orders per unordered pair of the kept products, source < target.

    Each order becomes one sorted set of kept products, so lines are shuffled once and an
    order holds at most as many ids as there are kept products. Pairs are unfolded in two
    steps, one element at a time, and are counted inside each task before the shuffle.
    """
    kept = lines.select("order_id", "product_id").join(kept_products, "product_id", "left_semi")
    baskets = (kept.groupBy("order_id")
               .agg(F.sort_array(F.collect_set("product_id")).alias("items"))
               .filter(F.size("items") > 1))
    rest = F.slice("items", F.col("at") + 2, F.size("items"))
    return (baskets.select("items", F.posexplode("items").alias("at", "source"))
            .select("source", F.explode(rest).alias("target"))
            .groupBy("source", "target").agg(F.count(F.lit(1)).alias("co_occurrence")))


def co_purchase_edges(lines, product_features, top_products=None, min_support=25):
    """Pairs of products with enough support, of all or of the most ordered (H4).

    No pair has more orders than its rarer product, so products below the support are
    left out before any pair is formed.
    """
    bought = lines.select("order_id", "product_id")
    if top_products is not None:
        best = top_rows(product_features.select("product_id", "prod_total_orders"),
                        [F.desc("prod_total_orders"), "product_id"], top_products)
        bought = bought.join(best, "product_id", "left_semi")
    frequent = (bought.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
                .filter(F.col("n") >= min_support))
    pairs = pair_counts(lines, frequent.select("product_id"))
    return (pairs.filter(F.col("co_occurrence") >= min_support)
            .withColumn("type", F.lit("OFTEN_BOUGHT_WITH")))


def _names(products, key, name):
    return products.select(F.col("product_id").alias(key), F.col("product_name").alias(name))


def frequently_bought_together(edges, products, product_name=None, n=10):
    """Targets most often bought with a source product, by name (H5).

    Without ``product_name`` every source gets its ``n`` rows.
    """
    sources = _names(products, "source", "source_product")
    if product_name is not None:
        sources = sources.filter(F.col("source_product") == product_name)
    best = top_per_key(edges.join(sources, "source"), ["source"],
                       [F.desc("co_occurrence"), "target"], n)
    return best.join(_names(products, "target", "recommended_product"), "target").select(
        "source_product", "recommended_product",
        F.col("co_occurrence").alias("times_co_purchased"), "rank")


def similar_customers(bought, targets, n=15):
    """The ``n`` users sharing most products with each target, excluding itself.

    Edges of targets meet all edges of the same product in an equi-join, which adaptive
    execution splits where a product is hot; counts combine before their shuffle.
    """
    wanted = targets.select(F.col("user_id").alias("source"))
    own = bought.join(wanted, "source", "left_semi").select(F.col("source").alias("user_id"),
                                                            "target")
    common = (bought.select(F.col("source").alias("other"), "target").join(own, "target")
              .filter(F.col("other") != F.col("user_id"))
              .groupBy("user_id", "other").agg(F.count(F.lit(1)).alias("common_products")))
    return top_per_key(common, ["user_id"], [F.desc("common_products"), "other"], n)


def collaborative_recommendations(bought, product_features, targets, neighbours=15, n=10):
    """Products of each target's nearest users that the target has not bought (H6)."""
    near = similar_customers(bought, targets, neighbours).select("user_id", "other")
    seen = (bought.join(targets.select(F.col("user_id").alias("source")), "source", "left_semi")
            .select(F.col("source").alias("user_id"), F.col("target").alias("product_id")))
    offers = (bought.select(F.col("source").alias("other"), F.col("target").alias("product_id"))
              .join(near, "other")
              .groupBy("user_id", "product_id").agg(F.count(F.lit(1)).alias("affinity_score")))
    fresh = offers.join(seen, ["user_id", "product_id"], "left_anti")
    ranked = fresh.join(product_features.select(
        "product_id", F.col("product_name").alias("recommended_product"),
        F.col("prod_reorder_rate").alias("product_reorder_rate")), "product_id")
    return top_per_key(ranked, ["user_id"], [F.desc("affinity_score"),
                                             F.desc("product_reorder_rate"), "product_id"], n)


def segment_departments(bought, segments, products, departments, segment=None, n=8):
    """Departments by number of bought products for one or every segment (H7).

    Edges are counted per (segment, product) before they meet the catalogue.
    """
    people = segments.select(F.col("user_id").alias("source"), "segment_name")
    if segment is not None:
        people = people.filter(F.col("segment_name") == segment)
    per_product = (bought.join(people, "source")
                   .groupBy("segment_name", F.col("target").alias("product_id"))
                   .agg(F.count(F.lit(1)).alias("n")))
    totals = (per_product.join(products.select("product_id", "department_id"), "product_id")
              .groupBy("segment_name", "department_id")
              .agg(F.sum("n").alias("total_purchases"))
              .join(departments, "department_id"))
    return top_per_key(totals, ["segment_name"], [F.desc("total_purchases"), "department"], n
                       ).select("segment_name", "department", "total_purchases", "rank")


def product_neighbourhood(products, aisles, departments, edges, product_name=None, n=5):
    """Aisle, department and up to ``n`` strongest affinities of products (H8)."""
    chosen = products
    if product_name is not None:
        chosen = products.filter(F.col("product_name") == product_name)
    best = top_per_key(edges, ["source"], [F.desc("co_occurrence"), "target"], n)
    items = (best.join(_names(products, "target", "related"), "target")
             .groupBy(F.col("source").alias("product_id"))
             .agg(F.sort_array(F.collect_list(F.struct("rank", "related"))).alias("found")))
    return (chosen.join(aisles, "aisle_id").join(departments, "department_id")
            .join(items, "product_id", "left")
            .select("product_id", "product_name", "aisle", "department",
                    F.coalesce(F.col("found.related"), F.array().cast("array<string>"))
                    .alias("top_affinity_items")))


def upsert(target, updates, key):
    """Merge ``updates`` into ``target`` by key, for nodes or edges (H9).

    Given values replace old ones, and columns that only ``updates`` has are added. Where a key
    occurs more than once in ``updates``, the largest given value of each column counts, so that
    no row of ``target`` is multiplied.
    """
    old = [c for c in target.columns if c not in key]
    given = [c for c in updates.columns if c not in key]
    new = updates.groupBy(*key).agg(*[F.max(c).alias(f"_{c}") for c in given])
    merged = [F.coalesce(f"_{c}", c).alias(c) if c in given else F.col(c) for c in old]
    added = [F.col(f"_{c}").alias(c) for c in given if c not in old]
    return target.join(new, list(key), "full_outer").select(*key, *merged, *added)
