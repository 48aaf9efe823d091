"""Helpers shared by the operators: words, staging, Arrow batches and connected components."""

import re
import tempfile
import uuid

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

_LOCAL = {}

#: Maps A-Z to a-z and leaves every other byte as it is.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words(text):
    """Lower-cased words of a text as bytes; bytes.split() splits at 0x09-0x0D and 0x20 only."""
    return text.translate(LOWER).split() if text else []


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark):
    """Folder of ``spark.checkpoint.dir``; where it is unset, a temporary one for local tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the whole cluster shares")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.TemporaryDirectory(prefix="basketlens-llm-")
    return f"file://{_LOCAL[app].name}"


def written(df, name):
    """``df`` written as Parquet to the shared folder and read back; deleted as Spark ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def ranged(df, order, name, most=1_000_000):
    """``df`` written in ranges along the columns ``order``, numbered by the column ``part``.

    Ranges hold about equally many rows, ``most`` at the utmost, and rise with the order; rows of
    one range are in no order. Written, so that a range's number is the same for all that read it.
    """
    parts = -(-df.count() // most)
    if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        df = df.repartitionByRange(parts, *order)
    else:
        df = df.repartitionByRange(*order)
    return written(df.withColumn("part", F.spark_partition_id()), name)


def share(spark, value):
    """Broadcast of ``value`` with its class, so that executors need no import."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def opened(shared):
    return cloudpickle.loads(shared.value)


def sliced(batch, column, most=8 << 20):
    """Slices of an Arrow batch whose ``column`` holds about ``most`` bytes, one row at least."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch[column]), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if sizes:
        yield batch.slice(start)


def raw_bytes(column):
    """The UTF-8 bytes of an Arrow string column as a list; None for null."""
    return column.cast(pa.binary()).to_pylist()


def components(edges, rounds=64):
    """Connected components of undirected ``edges`` (a, b): rows (node, label), label the smallest.

    Large-star and small-star rounds: each is a partial aggregate of the smallest neighbour and an
    equi-join that adaptive execution may split, so a hub's neighbours never meet in one task.
    Every round's edges are written to the shared folder. Rounds grow with the logarithm of the
    largest component. Loops and repeated edges are allowed; null ends are ignored.
    """
    links = written(edges.select("a", "b").where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    for _ in range(rounds):
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Written, so that a hub's many links meet its row in a join that can be split.
        lowest = written(both.groupBy("a").agg(
            F.least(F.min("b"), F.col("a")).alias("low")), "lowest")
        large = written(both.where("b > a").join(lowest, "a").select(
            F.col("b").alias("a"), F.col("low").alias("b")).distinct(), "large")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").where("b <> low").select(
            F.greatest("b", "low").alias("a"), F.least("b", "low").alias("b"))
        links = written(small.union(low.select("a", F.col("low").alias("b"))).distinct(), "small")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
