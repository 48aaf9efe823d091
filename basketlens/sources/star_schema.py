"""Orders, order lines and catalogue derived from a TPC-H shaped star schema.

The result has the columns of a grocery order history: orders numbered per user with the
gap to the previous one, the last order of a user held out as ``train`` or ``test``, and
lines with cart position and a reorder flag. The line table carries its order's user,
number and split, so that later jobs need no second join of lines with orders.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketlens.sources.stage import tasks_for

#: Order ids that one chunk of a user's day spans.
IDS_PER_CHUNK = 100000
#: Bytes of the source's files per task of the order and line tables.
ORDER_BYTES_PER_TASK, LINE_BYTES_PER_TASK = 3 << 20, 8 << 20

# Department numbers by product type.
DEPARTMENT_IDS = {"ECONOMY": 1, "LARGE": 2, "MEDIUM": 3, "PROMO": 4, "SMALL": 5, "STANDARD": 6}


def _read(spark, folder, table):
    return spark.read.parquet(f"{folder}/{table}.parquet")


def catalogue(spark, folder):
    """One row per part: product, aisle and department with names."""
    part = _read(spark, folder, "part")
    department_id = F.element_at(
        F.create_map(*[F.lit(x) for kv in DEPARTMENT_IDS.items() for x in kv]), F.col("p_type"))
    brand_no = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int")
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.concat("p_name", F.lit(" #"), F.col("p_partkey").cast("string")).alias("product_name"),
        (department_id * 100 + brand_no).alias("aisle_id"),
        F.concat("p_type", F.lit("/"), F.col("p_brand")).alias("aisle"),
        department_id.alias("department_id"),
        F.col("p_type").alias("department"))


def departments(spark, folder):
    return catalogue(spark, folder).select("department_id", "department").distinct()


def aisles(spark, folder):
    return catalogue(spark, folder).select("aisle_id", "aisle").distinct()


def products(spark, folder, grain="product"):
    """The catalogue at product grain, or one row per aisle at aisle grain."""
    rows = catalogue(spark, folder)
    if grain == "aisle":
        return rows.select(F.col("aisle_id").cast("bigint").alias("product_id"),
                           F.col("aisle").alias("product_name"),
                           "aisle_id", "department_id").distinct()
    return rows.select("product_id", "product_name", "aisle_id", "department_id")


def orders(spark, folder):
    """Orders as a raw source would deliver them: the first gap of a user is null.

    Orders are numbered within chunks of order ids of a user's day. A user's chunks, one row each, give
    the number of earlier orders and the previous day, so that neither a user nor a user's day is
    windowed over as a whole.
    """
    raw = _read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").cast("date").alias("order_date"))
    tasks = tasks_for(spark, f"{folder}/orders.parquet", ORDER_BYTES_PER_TASK)
    chunk = ["user_id", "order_date", "chunk"]
    chunked = raw.withColumn("chunk", F.floor(F.col("order_id") / IDS_PER_CHUNK))
    along = W.partitionBy("user_id").orderBy("order_date", "chunk")
    placed = (chunked.groupBy(*chunk).agg(F.count(F.lit(1)).alias("chunk_orders"))
              .repartition(tasks, "user_id")
              .select(*chunk, "chunk_orders",
                      F.coalesce(F.sum("chunk_orders").over(
                          along.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("earlier"),
                      F.lag("order_date").over(along).alias("previous_day"),
                      F.lead(F.lit(1)).over(along).isNull().alias("last_chunk")))
    in_chunk = F.row_number().over(W.partitionBy(*chunk).orderBy("order_id"))
    numbered = (chunked.repartition(tasks, *chunk).withColumn("in_chunk", in_chunk)
                .join(placed.repartition(tasks, *chunk), chunk))
    number = F.col("earlier") + F.col("in_chunk")
    is_last = F.col("last_chunk") & (F.col("in_chunk") == F.col("chunk_orders"))
    split = (F.when(~is_last, "prior")
             .when(F.pmod(F.col("user_id"), F.lit(3)) != 0, "train").otherwise("test"))
    gap = (F.when((F.col("in_chunk") > 1) | (F.col("previous_day") == F.col("order_date")), F.lit(0))
           .otherwise(F.date_diff("order_date", "previous_day")))
    return numbered.select(
        "order_id", "user_id", split.alias("eval_set"), number.alias("order_number"),
        (F.dayofweek("order_date") - 1).alias("order_dow"),
        F.pmod(F.col("order_id"), F.lit(24)).cast("int").alias("order_hour_of_day"),
        gap.cast("double").alias("days_since_prior_order"), "order_date")


def raw_lines(spark, folder):
    """Line items before dedupe, with the line number as cart position."""
    return _read(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").alias("add_to_cart_order"))


def line_values(spark, folder):
    """Line items with their raw measures, for checks that must see what the source holds."""
    return _read(spark, folder, "lineitem").select(
        F.col("l_linenumber").alias("add_to_cart_order"), F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"))


def order_lines(spark, folder, order_table, grain="product"):
    """Deduplicated lines of all splits, with their order's user, number and split.

    Lines are shuffled twice: by order, where they lose their duplicates, get their position and meet
    their order, and by (user, product), where the reorder flag compares with the first purchase. Both
    are running windows over sorted rows, which hold no group in memory. The number of tasks follows
    the size of the source, so that a task's share does not grow with it.
    """
    lines = raw_lines(spark, folder)
    if grain == "aisle":
        shelf = catalogue(spark, folder).select("product_id", "aisle_id")
        lines = (lines.join(shelf, "product_id")
                 .select("order_id", F.col("aisle_id").cast("bigint").alias("product_id"),
                         "add_to_cart_order"))
    tasks = tasks_for(spark, f"{folder}/lineitem.parquet", LINE_BYTES_PER_TASK)
    copy = F.row_number().over(W.partitionBy("order_id", "product_id").orderBy(
        F.asc_nulls_last("add_to_cart_order")))
    single = (lines.repartition(tasks, "order_id").withColumn("copy", copy).filter(F.col("copy") == 1)
              .select("order_id", "product_id", F.col("add_to_cart_order").alias("position")))
    cart = F.row_number().over(W.partitionBy("order_id").orderBy("position", "product_id"))
    context = order_table.select("order_id", "user_id", "order_number", "eval_set")
    placed = (single.withColumn("add_to_cart_order", cart).drop("position")
              .join(context.repartition(tasks, "order_id"), "order_id"))
    so_far = (W.partitionBy("user_id", "product_id").orderBy("order_number")
              .rowsBetween(W.unboundedPreceding, W.currentRow))
    # Lines without a user or a product have no earlier purchase to compare with.
    known = F.col("user_id").isNotNull() & F.col("product_id").isNotNull()
    again = F.when(known, (F.col("order_number") > F.min("order_number").over(so_far)).cast("int"))
    return placed.repartition(tasks, "user_id", "product_id").select(
        "order_id", "product_id", "add_to_cart_order", again.alias("reordered"),
        "user_id", "order_number", "eval_set")
