"""Exploratory tables."""

from pyspark.sql import functions as F

from basketlens.functions.columns import labels, rate, share_pct
from basketlens.functions.ranking import top_rows
from basketlens.operators.analytics import product_counts
from basketlens.operators.graph import pair_counts

# Weekday names, 0 = Sunday.
WEEKDAYS = {0: "Sunday", 1: "Monday", 2: "Tuesday", 3: "Wednesday", 4: "Thursday",
            5: "Friday", 6: "Saturday"}

CORRELATED = ["user_total_orders", "user_avg_order_interval", "user_avg_basket_size",
              "user_reorder_rate", "user_unique_departments"]


def peaks(orders):
    """Busiest weekday and hour, the smallest on ties."""
    return orders.agg(F.mode("order_dow", True).alias("peak_dow"),
                      F.mode("order_hour_of_day", True).alias("peak_hour")).select(
        "peak_dow", labels("peak_dow", WEEKDAYS).alias("peak_day"), "peak_hour")


def orders_by_weekday(orders):
    """Orders per weekday name."""
    return orders.groupBy("order_dow").agg(F.count(F.lit(1)).alias("order_count")).select(
        "order_dow", labels("order_dow", WEEKDAYS).alias("dow_name"), "order_count")


def orders_by_hour(orders):
    """Orders per hour of day."""
    return orders.groupBy("order_hour_of_day").agg(F.count(F.lit(1)).alias("order_count"))


def day_hour_matrix(orders):
    """Weekday rows by hour columns; the hours are given, so no extra pass finds them."""
    hours = list(range(24))
    matrix = orders.groupBy("order_dow").pivot("order_hour_of_day", hours).count()
    return matrix.select(
        labels("order_dow", WEEKDAYS).alias("dow_name"),
        *[F.coalesce(F.col(str(h)), F.lit(0)).alias(f"h{h:02d}") for h in hours])


def _counted(df, value):
    return df.groupBy(F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("n"))


def repurchase_interval(orders):
    """Mean, median and weekly and monthly share of the gaps of repeat orders (E5).

    Gaps are whole days and are counted first, so the median works on days, not orders.
    """
    gaps = _counted(orders.filter(F.col("is_first_order") == 0), "days_since_prior_order")
    known = F.when(F.col("v").isNotNull(), F.col("n"))
    return gaps.agg(
        F.round(F.try_divide(F.sum(F.col("v") * F.col("n")), F.sum(known)), 2)
        .alias("mean_interval"),
        F.percentile("v", 0.5, F.col("n")).alias("median_interval"),
        share_pct(F.sum(F.when(F.col("v") == 7, F.col("n")).otherwise(0)), F.sum("n"))
        .alias("weekly_pct"),
        share_pct(F.sum(F.when(F.col("v") == 30, F.col("n")).otherwise(0)), F.sum("n"))
        .alias("monthly_pct"))


def interval_histogram(orders):
    """Repeat orders per whole-day gap."""
    return (orders.filter(F.col("is_first_order") == 0)
            .groupBy(F.floor("days_since_prior_order").alias("days"))
            .agg(F.count(F.lit(1)).alias("order_count")))


def _basket_sizes(lines):
    return lines.groupBy("order_id").agg(F.count(F.lit(1)).alias("basket_size"))


def basket_size_stats(lines):
    """Mean, median, 75th and 95th percentile of basket size."""
    sizes = _counted(_basket_sizes(lines), "basket_size")
    return sizes.agg(
        F.round(F.try_divide(F.sum(F.col("v") * F.col("n")).cast("double"), F.sum("n")), 2)
        .alias("mean_basket_size"),
        F.percentile("v", 0.5, F.col("n")).alias("median_basket_size"),
        F.percentile("v", 0.75, F.col("n")).alias("p75_basket_size"),
        F.percentile("v", 0.95, F.col("n")).alias("p95_basket_size"))


def equal_width_histogram(counted, value, weight, bins, low, high):
    """Counts per equal-width bin of [low, high]; the last bin is closed, others drop (AG14).

    ``low`` and ``high`` are columns, for instance literals or scalar subqueries.
    """
    width = (F.col("_hi") - F.col("_lo")) / bins
    placed = (counted.withColumn("_lo", low.cast("double")).withColumn("_hi", high.cast("double"))
              .filter(F.col(value).between(F.col("_lo"), F.col("_hi"))))
    number = F.when(width > 0, F.least(F.floor((F.col(value) - F.col("_lo")) / width),
                                       F.lit(bins - 1))).otherwise(F.lit(0))
    return (placed.select("_lo", width.alias("_w"), number.alias("bin"), weight)
            .groupBy("bin").agg(F.min("_lo").alias("_lo"), F.min("_w").alias("_w"),
                                F.sum(weight).alias("frequency"))
            .select("bin", F.round(F.col("_lo") + F.col("bin") * F.col("_w"), 4).alias("bin_start"),
                    "frequency"))


def basket_size_histogram(lines, bins=40, low=1, high=40):
    """Baskets per size bin."""
    return equal_width_histogram(_counted(_basket_sizes(lines), "basket_size"), "v", "n",
                                 bins, F.lit(low), F.lit(high))


def reorder_breakdown(lines):
    """First-time and reordered lines with their shares."""
    counts = lines.agg(F.count(F.lit(1)).alias("total"), F.sum("reordered").alias("again"))
    kinds = F.array(
        F.struct(F.lit("First-Time Purchase").alias("purchase_type"),
                 (F.col("total") - F.col("again")).alias("line_count")),
        F.struct(F.lit("Reordered Item").alias("purchase_type"),
                 F.col("again").alias("line_count")))
    return counts.select("total", F.explode(kinds).alias("k")).select(
        "k.purchase_type", "k.line_count",
        share_pct(F.col("k.line_count"), F.col("total")).alias("share_pct"))


def customer_order_stats(customers):
    """Customers and mean, median and largest number of lifetime orders."""
    counted = _counted(customers, "total_orders")
    return counted.agg(
        F.sum("n").alias("customer_count"),
        F.round(F.try_divide(F.sum(F.col("v") * F.col("n")).cast("double"), F.sum("n")), 2)
        .alias("mean_orders"),
        F.percentile("v", 0.5, F.col("n")).alias("median_orders"),
        F.max("v").alias("max_orders"))


def lifetime_orders_histogram(customers, bins=50):
    """Customers per bin of lifetime orders between the extremes."""
    counted = _counted(customers, "total_orders")
    ends = counted.agg(F.struct(F.min("v").alias("low"), F.max("v").alias("high"))).scalar()
    return equal_width_histogram(counted, "v", "n", bins, ends["low"], ends["high"])


def bestsellers(lines, products, departments, n=10):
    """Best-selling products with department and reorder rate in percent, in order."""
    named = (product_counts(lines).join(products, "product_id")
             .join(departments, "department_id").select(
                 "product_id", "product_name", "department",
                 F.col("total_purchases").alias("total_orders"),
                 share_pct(F.col("total_reorders"), F.col("total_purchases"))
                 .alias("reorder_rate_pct")))
    return top_rows(named, [F.desc("total_orders"), "product_id"], n)


def department_breakdown(lines, products, departments):
    """Department volume and the unweighted mean of its products' reorder rates."""
    per_product = product_counts(lines).withColumn(
        "p_rate", F.col("total_reorders").cast("double") / F.col("total_purchases"))
    return (per_product.join(products, "product_id").join(departments, "department_id")
            .groupBy("department").agg(
                F.sum("total_purchases").alias("total_volume"),
                F.round(F.avg("p_rate"), 4).alias("mean_reorder_rate")))


def _reorder_rate_by(lines, column, limit):
    return (lines.filter(F.col(column) <= limit).groupBy(column)
            .agg(F.count(F.lit(1)).alias("line_count"), F.sum("reordered").alias("again"))
            .select(column, "line_count", rate("again", "line_count").alias("reorder_rate")))


def reorder_rate_by_order_number(lines, limit=60):
    """Mean reorder flag along the customer lifetime."""
    return _reorder_rate_by(lines, "order_number", limit)


def user_cadence(orders):
    """Mean, sample deviation and count of gaps per user with two repeat orders."""
    return (orders.filter(F.col("is_first_order") == 0).groupBy("user_id").agg(
        F.avg("days_since_prior_order").alias("mean_interval"),
        F.stddev_samp("days_since_prior_order").alias("std_interval"),
        F.count("days_since_prior_order").alias("order_count"))
        .na.drop())


def department_diversity(lines, products):
    """How many customers bought from how many departments.

    Lines are reduced to (user, product) before the catalogue join.
    """
    pairs = lines.groupBy("user_id", "product_id").agg(F.lit(1))
    per_department = (pairs.join(products.select("product_id", "department_id"), "product_id")
                      .groupBy("user_id", "department_id").agg(F.lit(1)))
    return (per_department.groupBy("user_id").agg(F.count(F.lit(1)).alias("departments"))
            .groupBy("departments").agg(F.count(F.lit(1)).alias("customer_count")))


def reorder_rate_by_cart_position(lines, limit=25):
    """Mean reorder flag by cart position."""
    return _reorder_rate_by(lines, "add_to_cart_order", limit)


def top_pairs(lines, products, top_products=50, n=10):
    """Most frequent pairs among the most bought products, with a label."""
    best = top_rows(product_counts(lines), [F.desc("total_purchases"), "product_id"], top_products)
    pairs = pair_counts(lines, best.select("product_id"))
    names = products.select("product_id", "product_name")
    first = names.withColumnsRenamed({"product_id": "source", "product_name": "product_name_a"})
    second = names.withColumnsRenamed({"product_id": "target", "product_name": "product_name_b"})
    named = pairs.join(first, "source").join(second, "target").select(
        F.concat("product_name_a", F.lit(" + "), "product_name_b").alias("pair_label"),
        "source", "target", "co_occurrence")
    return top_rows(named, [F.desc("co_occurrence"), "source", "target"], n)


def feature_correlation(customer_features, columns=tuple(CORRELATED)):
    """Pearson correlation of the feature columns in long form, one pass."""
    names = list(columns)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    one = customer_features.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = [F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"),
                      F.round(F.col(f"`{x}|{y}`"), 4).alias("correlation"))
             for x, y in pairs for a, b in {(x, y), (y, x)}]
    return one.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def class_balance(pairs):
    """Rows and share per target class."""
    counts = pairs.groupBy("target").agg(F.count(F.lit(1)).alias("row_count"))
    whole = counts.agg(F.sum("row_count")).scalar()
    return counts.select("target", "row_count",
                         F.round(F.col("row_count").cast("double") / whole, 4).alias("share"))


def order_rate_boxplot(pairs):
    """Five-number summary and 1.5 IQR whiskers of the order rate per target.

    Order rates have four decimals, so counting them first leaves at most 10,001 values.
    """
    counted = pairs.groupBy("target", F.col("up_order_rate").alias("v")).agg(
        F.count(F.lit(1)).alias("n"))
    five = counted.groupBy("target").agg(
        F.percentile("v", [0.0, 0.25, 0.5, 0.75, 1.0], F.col("n")).alias("q"))
    reach = (F.col("q")[3] - F.col("q")[1]) * 1.5
    fenced = five.select("target", "q", (F.col("q")[1] - reach).alias("low"),
                         (F.col("q")[3] + reach).alias("high"))
    inside = counted.join(fenced, "target").filter(F.col("v").between(F.col("low"), F.col("high")))
    return inside.groupBy("target").agg(
        F.first("q").alias("q"), F.min("v").alias("whisker_low"),
        F.max("v").alias("whisker_high")).select(
            "target", *[F.round(F.col("q")[i], 4).alias(name) for i, name in enumerate(
                ["minimum", "q1", "median", "q3", "maximum"])], "whisker_low", "whisker_high")
