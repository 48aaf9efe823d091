"""Very many small pieces of work dealt into tasks of equal work."""

from pyspark.sql import functions as F

from basketlens.functions.prefix import running_totals

#: Parts into which pieces of one size are cut for the running sum.
PARTS = 1024


def packs(sizes, key, work):
    """(frame of key and pack, number of packs): pieces of ``sizes`` (key, size) in packs of ``work``.

    Pieces are taken in order of size, so that a pack's pieces are of like size and its sizes add up
    to about ``work``. The running sum meets in one task only as totals per size and part.
    """
    part = F.col("size") * PARTS + F.pmod(F.xxhash64(key), F.lit(PARTS))
    placed = running_totals(sizes.select(key, "size", part.alias("_part")), [], "_part", [key],
                            {"_upto": F.col("size")})
    total = sizes.agg(F.sum("size")).first()[0] or 0
    return placed.select(key, F.floor((F.col("_upto") - 1) / work).cast("int").alias("pack")), max(
        1, -(-total // work))


def in_packs(rows, sizes, key, work):
    """``rows`` (one per key) with ``pack``, each pack whole in one task and packs spread evenly."""
    dealt, count = packs(sizes, key, work)
    # A number given to repartition is kept, where small shuffles would be merged into one task.
    return rows.join(dealt, key).repartition(count, "pack").sortWithinPartitions("pack")
