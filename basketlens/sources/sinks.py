"""Table writers (SNK1-SNK5, SNK7)."""

import uuid

from pyspark.sql import functions as F

BUCKET = "_bucket"


def write_csv(df, path, mode="overwrite"):
    """CSV with a header, one part per task (SNK1)."""
    df.write.mode(mode).option("header", True).csv(path)


def write_union(frames, path, mode="overwrite"):
    """Several frames of one shape as a single CSV table (SNK2)."""
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    write_csv(whole, path, mode)


def save_artifact(df, folder, name, csv=True, partition_by=()):
    """A table as Parquet and, from that copy, as CSV (SNK3). Errors are not hidden."""
    path = f"{folder}/{name}.parquet"
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    saved = df.sparkSession.read.parquet(path)
    if csv:
        write_csv(saved, f"{folder}/{name}.csv")
    return saved


def write_metrics(path, **sections):
    """One JSON document with an array of records per section (SNK4).

    Sections are metric tables of a few rows per model.
    """
    parts = [df.agg(F.collect_list(F.struct(*df.columns)).alias(name))
             for name, df in sections.items()]
    report = parts[0]
    for name, part in zip(list(sections)[1:], parts[1:]):
        report = report.withColumn(name, part.scalar())
    report.write.mode("overwrite").json(path)


def load_tables(tables, folder):
    """Write tables in the given order and return their row counts as one frame (SNK7)."""
    counts = []
    for name, df in tables.items():
        saved = save_artifact(df, folder, name, csv=False)
        counts.append(saved.agg(F.count(F.lit(1)).alias("row_count"))
                      .select(F.lit(name).alias("table_name"), "row_count"))
    whole = counts[0]
    for part in counts[1:]:
        whole = whole.unionByName(part)
    return whole


def _in_buckets(df, key, buckets):
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))


def write_buckets(df, path, key, buckets=64):
    """A table with one folder per bucket of its key's hash, so that an upsert can leave most alone."""
    _in_buckets(df, key, buckets).repartition(buckets, BUCKET).write.mode("overwrite").partitionBy(
        BUCKET).parquet(path)


def upsert_buckets(updates, path, key, merge, buckets=64):
    """Merge ``updates`` into the table at ``path`` and rewrite only the buckets that they touch (SNK5).

    ``merge(old, updates, key)`` makes the new rows of those buckets; it must keep the table's columns.
    ``buckets`` is the number the table was written with. The new rows are written beside the table
    first, as they are read from the folders that they replace.
    """
    spark = updates.sparkSession
    table = spark.read.parquet(path)
    marked = _in_buckets(updates, key, buckets)
    # One number per bucket at most.
    touched = [r[0] for r in marked.select(BUCKET).distinct().collect()]
    if not touched:
        return
    old = table.where(F.col(BUCKET).isin(touched)).drop(BUCKET)
    fresh = merge(old, updates, key).select(old.columns)
    beside = f"{path}-merged-{uuid.uuid4().hex}"
    write_buckets(fresh, beside, key, buckets)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(beside)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    spark.read.schema(table.schema).parquet(beside).repartition(
        min(buckets, len(touched)), BUCKET).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
