"""Table readers (SRC1-SRC8)."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.functions.columns import key_hash

# Columns and types of the raw tables.
SCHEMAS = {
    "departments": "department_id int, department string",
    "aisles": "aisle_id int, aisle string",
    "products": "product_id bigint, product_name string, aisle_id int, department_id int",
    "orders": "order_id bigint, user_id bigint, eval_set string, order_number bigint, "
              "order_dow int, order_hour_of_day int, days_since_prior_order double",
    "order_products": "order_id bigint, product_id bigint, add_to_cart_order int, reordered int",
    "customers": "user_id bigint, total_orders bigint, has_train_order int, has_test_order int",
}


def expected(table):
    """The declared schema of a raw table as a struct type."""
    return T.StructType.fromDDL(SCHEMAS[table])


def read_csv(spark, path, schema):
    """CSV with a header and a declared schema, so that no pass infers types (SRC1)."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_parquet(spark, path, columns=None):
    """Parquet, all or some columns (SRC2, SRC5)."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_optional(spark, path, schema, fmt="parquet"):
    """The table, or an empty one with its schema where the path does not exist (SRC7)."""
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    try:
        return reader.load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def tables_in(spark, folder):
    """Name and path of every Parquet table in a folder, on any file system (SRC6)."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in system.listStatus(place)]
    return {n.removesuffix(".parquet"): f"{folder}/{n}" for n in sorted(names)
            if n.endswith(".parquet")}


def discover(spark, paths):
    """Files, bytes and rows per table from the file metadata column (SRC6).

    ``paths`` maps table names to Parquet paths.
    """
    parts = []
    for name, path in paths.items():
        files = spark.read.parquet(path).select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
        per_file = files.groupBy("file", "bytes").agg(F.count(F.lit(1)).alias("n"))
        parts.append(per_file.agg(
            F.count(F.lit(1)).alias("file_count"), F.sum("bytes").alias("total_bytes"),
            F.sum("n").alias("row_count")).select(F.lit(name).alias("table_name"), "*"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def read_report(spark, path, field):
    """Records under ``field`` of nested JSON reports, one row each (SRC8)."""
    reports = spark.read.option("multiLine", True).json(path)
    return reports.select(F.explode(field).alias("record")).select("record.*")


def key_sample(df, key, share):
    """A repeatable part of a table by key hash, in place of a file prefix (SRC4)."""
    return df.filter(key_hash(key) < share)
