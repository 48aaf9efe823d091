"""Profiles, constraint checks and referential integrity (V1-V9)."""

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.functions.columns import dealt


def _union(frames):
    return reduce(lambda a, b: a.unionByName(b), frames)


def profile(tables):
    """Rows, type, nulls, null share, min and max of every column (V1).

    One aggregate per table; the one-row result is unfolded to a row per column.
    """
    def one(name, df):
        measures = [F.count(F.lit(1)).alias("total_rows")]
        for i, field in enumerate(df.schema.fields):
            numeric = isinstance(field.dataType, T.NumericType)
            value = F.col(field.name).cast("double")
            measures += [
                F.count(field.name).alias(f"c{i}_filled"),
                (F.min(value) if numeric else F.lit(None).cast("double")).alias(f"c{i}_min"),
                (F.max(value) if numeric else F.lit(None).cast("double")).alias(f"c{i}_max")]
        cells = F.explode(F.array(*[
            F.struct(F.lit(f.name).alias("column_name"),
                     F.lit(f.dataType.simpleString()).alias("data_type"),
                     F.col(f"c{i}_filled").alias("filled"),
                     F.col(f"c{i}_min").alias("min_value"),
                     F.col(f"c{i}_max").alias("max_value"))
            for i, f in enumerate(df.schema.fields)])).alias("cell")
        nulls = F.col("total_rows") - F.col("filled")
        return (df.agg(*measures).select("total_rows", cells).select("total_rows", "cell.*")
                .select(F.lit(name).alias("table_name"), "column_name", "data_type",
                        "total_rows", nulls.alias("null_count"),
                        F.coalesce(F.round(F.try_divide(nulls.cast("double"),
                                                        F.col("total_rows")) * 100, 2),
                                   F.lit(0.0)).alias("null_pct"),
                        "min_value", "max_value"))
    return _union([one(name, df) for name, df in tables.items()])


def duplicate_rows(tables):
    """Rows that repeat an earlier, fully equal row (V2)."""
    def one(name, df):
        copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))
        return copies.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("total_rows"),
                          F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows")
                          ).select(F.lit(name).alias("table_name"), "*")
    return _union([one(name, df) for name, df in tables.items()])


def sample_rows(df, key, n=5):
    """The first ``n`` rows by key (V3)."""
    return df.orderBy(*key).limit(n)


# The six relations between the tables.
RELATIONS = {
    "aisle": "products.aisle_id -> aisles.aisle_id",
    "department": "products.department_id -> departments.department_id",
    "prior_order": "prior_lines.order_id -> orders.order_id (prior)",
    "prior_product": "prior_lines.product_id -> products.product_id",
    "train_order": "train_lines.order_id -> orders.order_id (train)",
    "train_product": "train_lines.product_id -> products.product_id"}


def _number(name):
    """The number of a relation, which stands for its name in the rows that are shuffled."""
    return F.lit(list(RELATIONS).index(name)).cast("tinyint")


def _keys(df, **columns):
    """Rows (relation, key), one per named relation and row; every table is read once."""
    cells = [F.struct(_number(name).alias("relation"),
                      F.col(column).cast("bigint").alias("key"))
             for name, column in columns.items()]
    return df.select(F.explode(F.array(*cells)).alias("c")).select("c.*").filter("key is not null")


def foreign_keys(products, aisles, departments, orders, prior_lines, train_lines, tasks=None):
    """The six relations, lines against the orders of their own split (V4, V5).

    Child keys of all relations are counted together before they meet the parents in ``tasks`` tasks.
    """
    children = (_keys(products, aisle="aisle_id", department="department_id")
                .unionByName(_keys(prior_lines, prior_order="order_id",
                                   prior_product="product_id"))
                .unionByName(_keys(train_lines, train_order="order_id",
                                   train_product="product_id")))
    of_split = F.when(F.col("eval_set") == "prior", _number("prior_order")).when(
        F.col("eval_set") == "train", _number("train_order"))
    listed = (_keys(aisles, aisle="aisle_id")
              .unionByName(_keys(departments, department="department_id"))
              .unionByName(_keys(products, prior_product="product_id",
                                 train_product="product_id"))
              .unionByName(orders.select(of_split.alias("relation"),
                                         F.col("order_id").cast("bigint").alias("key"))
                           .filter("relation is not null")))
    parents = dealt(listed, tasks, "relation", "key").distinct().withColumn("known", F.lit(True))
    uses = children.groupBy("relation", "key").agg(F.count(F.lit(1)).alias("uses"))
    found = dealt(uses, tasks, "relation", "key").join(parents, ["relation", "key"], "left").groupBy("relation").agg(
        F.sum("uses").alias("rows"), F.count_if(F.col("known").isNull()).alias("orphans"))
    every = products.sparkSession.range(1).select(
        F.posexplode(F.array(*map(F.lit, RELATIONS.values()))).alias("relation", "foreign_key"))
    orphans = F.coalesce("orphans", F.lit(0))
    return every.join(found, "relation", "left").select(
        "foreign_key",
        F.when(orphans == 0, "PASS").otherwise("FAIL").alias("status"),
        orphans.alias("orphan_count"), F.coalesce("rows", F.lit(0)).alias("rows_checked"))


def split_sizes(orders):
    """Orders and users per split (V6).

    Orders are counted per (split, user) first, so one split never holds all users' rows.
    """
    per_user = orders.groupBy("eval_set", "user_id").agg(F.count(F.lit(1)).alias("n"))
    return per_user.groupBy("eval_set").agg(
        F.sum("n").alias("order_count"), F.count(F.lit(1)).alias("user_count"))


def domain_rules(orders, lines):
    """Violations of the value rules, one aggregate per table (V7)."""
    def broken(condition):
        return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0))

    first = F.col("order_number") == 1
    gap = F.col("days_since_prior_order")
    order_rules = {
        "order_dow in 0..6": ~F.col("order_dow").between(0, 6),
        "order_hour_of_day in 0..23": ~F.col("order_hour_of_day").between(0, 23),
        "gap is null only for the first order": first != gap.isNull()}
    # Rules of the columns that the given lines have.
    line_rules = {name: rule for column, name, rule in [
        ("reordered", "reordered is 0 or 1", ~F.col("reordered").isin(0, 1)),
        ("add_to_cart_order", "add_to_cart_order starts at 1", F.col("add_to_cart_order") < 1),
        ("quantity", "quantity is positive", F.col("quantity") <= 0),
        ("discount", "discount in 0..1", ~F.col("discount").between(0, 1))]
        if column in lines.columns}

    def check(table, df, rules):
        names = list(rules)
        counts = df.agg(*[broken(rules[n]).alias(f"r{i}") for i, n in enumerate(names)],
                        F.count(F.lit(1)).alias("rows_checked"))
        cells = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"),
                                             F.col(f"r{i}").alias("violations"))
                                    for i, n in enumerate(names)])).alias("cell")
        return counts.select(F.lit(table).alias("table_name"), "rows_checked", cells).select(
            "table_name", "cell.rule", "rows_checked", "cell.violations")

    return check("orders", orders, order_rules).unionByName(
        check("order_products", lines, line_rules))


def constraints(tables):
    """Key uniqueness and NOT NULL checks; ``tables`` maps a name to (frame, key, required)
    (V8)."""
    def one(name, df, key, required):
        per_key = df.groupBy(*key).agg(
            F.count(F.lit(1)).alias("copies"),
            *[F.sum(F.col(c).isNull().cast("bigint")).alias(f"null_{c}")
              for c in required if c not in key])
        nulls = [F.coalesce(F.sum(F.when(F.col(c).isNull(), F.col("copies")).otherwise(0)
                                  if c in key else F.col(f"null_{c}")), F.lit(0))
                 .alias(f"n{i}") for i, c in enumerate(required)]
        counts = per_key.agg(
            F.coalesce(F.sum((F.col("copies") > 1).cast("bigint")), F.lit(0)).alias("dup"),
            *nulls)
        cells = [F.struct(F.lit(f"UNIQUE ({', '.join(key)})").alias("rule"),
                          F.col("dup").alias("violations"))]
        cells += [F.struct(F.lit(f"NOT NULL ({c})").alias("rule"),
                           F.col(f"n{i}").alias("violations")) for i, c in enumerate(required)]
        return (counts.select(F.explode(F.array(*cells)).alias("cell"))
                .select(F.lit(name).alias("table_name"), "cell.rule", "cell.violations"))
    return _union([one(name, *spec) for name, spec in tables.items()])


def table_counts(tables):
    """Rows and columns per output table (V9, SNK7)."""
    return _union([
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count",
            F.lit(", ".join(df.columns)).alias("columns"))
        for name, df in tables.items()])


def verify_written(tables, folder):
    """Rows of each table as derived and as read from its file, and whether all values agree (V9).

    Values are compared by the sum of the rows' hashes, one aggregate per side; equal sums of 64-bit
    hashes leave no room for a row that differs, is missing or is there twice.
    """
    def facts(name, df, written, alike):
        return df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(
            F.xxhash64(*df.columns).cast("decimal(38,0)")), F.lit(0)).alias("hash")).select(
            F.lit(name).alias("table_name"), F.lit(written).alias("written"), "n", "hash",
            F.lit(alike).alias("alike"))

    parts = []
    for name, df in tables.items():
        saved = df.sparkSession.read.parquet(f"{folder}/{name}.parquet")
        alike = saved.dtypes == df.dtypes
        parts += [facts(name, df, False, alike), facts(name, saved, True, alike)]

    def of(column, written):
        return F.max(F.when(F.col("written") == written, F.col(column)))

    return _union(parts).groupBy("table_name").agg(
        of("n", False).alias("rows_derived"), of("n", True).alias("rows_written"),
        (F.min("alike") & (of("hash", False) == of("hash", True))).alias("values_agree"))


def schema_differences(df, expected):
    """Columns that are missing, added or of another type; no rows where all agree (V9).

    Works on the two schemas alone, so no data is read.
    """
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    rows = [(c, wanted.get(c), found.get(c)) for c in sorted({*found, *wanted})
            if wanted.get(c) != found.get(c)]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, expected_type string, found_type string")
