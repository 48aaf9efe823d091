"""Shards by a minimax contiguous partition of ordered atomic groups."""

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import functions as F
from pyspark.sql import Window

from basketlens.llm.common import written

SHARDS = 40
#: Bytes counted for a row besides its text.
ROW_BYTES = 16
#: Bits of the ordering key: all, those of the first cells, those that a refinement adds.
KEY_BITS, FIRST_BITS, STEP_BITS = 60, 16, 6
#: Rows of one numbering cell, on average.
CELL_ROWS = 2000


def sized(docs):
    """(doc_id, size, text_crc32, key) of every row; equal texts have equal keys.

    A key has 60 bits of the text's hash. Texts that share a key by chance stay together too.
    """
    body = F.coalesce("text", F.lit(""))
    raw = F.encode(body, "UTF-8")
    return docs.select(
        "doc_id", (F.octet_length(raw) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(body), 64 - KEY_BITS).alias("key"))


def greedy_ends(cells, capacity, shards, divisible):
    """Bytes before the end of each greedy shard, and whether all fits.

    cells: (low key, high key, size) in order. A cell with two keys can be cut at any byte if
    ``divisible``, and else is atomic like a single group.
    """
    total = list(accumulate((c[2] for c in cells), initial=0))
    at, ends = 0, []
    for _ in range(shards):
        i = bisect_right(total, at + capacity) - 1
        end = total[i]
        if divisible and i < len(cells) and cells[i][0] != cells[i][1]:
            end = at + capacity
        at = max(end, at)
        ends.append(at)
    return ends, at >= total[-1]


def smallest_capacity(cells, shards, divisible=False):
    """Smallest capacity at which the greedy check succeeds, by binary search."""
    total = sum(c[2] for c in cells)
    low, high = -(-total // shards), total
    while low < high:
        middle = (low + high) // 2
        if greedy_ends(cells, middle, shards, divisible)[1]:
            high = middle
        else:
            low = middle + 1
    return low


def _summed(groups, bits):
    """Cells of the first ``bits`` bits of the key, in order."""
    found = groups.groupBy(F.shiftright("key", KEY_BITS - bits).alias("cell")).agg(
        F.min("key").alias("low"), F.max("key").alias("high"), F.sum("size").alias("size"))
    return sorted((r["low"], r["high"], r["size"]) for r in found.collect())


def minimax_cuts(groups, shards, first_bits=FIRST_BITS):
    """(capacity, first keys of the shards after the first) of ``groups`` (key, size) in key order.

    Cells of equal leading key bits stand for their groups: cut at will they give a lower bound of
    the capacity, uncut an upper one. Only cells in which a greedy cut of a capacity between the
    two can fall are replaced by finer ones, until the cuts meet single groups. The driver holds
    2^16 cells and those replaced, however many groups there are.
    """
    bits = first_bits
    cells = _summed(groups, bits)
    if not cells:
        return 0, []
    while True:
        low, high = (smallest_capacity(cells, shards, d) for d in (True, False))
        left, right = greedy_ends(cells, low, shards, False)[0], greedy_ends(
            cells, high, shards, True)[0]
        total = list(accumulate((c[2] for c in cells), initial=0))
        unclear = set()
        for start, end in zip(left, right):
            first = max(bisect_right(total, start) - 1, 0)
            unclear.update(range(first, min(bisect_left(total, end) + 1, len(cells))))
        unclear = {i for i in unclear if cells[i][0] != cells[i][1]}
        if low == high and greedy_ends(cells, high, shards, False)[0] == right or not unclear:
            break
        parents = [cells[i][0] >> (KEY_BITS - bits) for i in unclear]
        inside = groups.where(F.shiftright("key", KEY_BITS - bits).isin(parents))
        bits = min(bits + STEP_BITS, KEY_BITS)
        cells = sorted([c for i, c in enumerate(cells) if i not in unclear]
                       + _summed(inside, bits))
    ends = greedy_ends(cells, high, shards, False)[0]
    starts = [bisect_left(total, end) for end in ends[:-1]]
    return high, [cells[i][0] for i in starts if i < len(cells)]


def assign(docs, shards=SHARDS):
    """One row per row of docs: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Law ``bytes``: the largest shard is as small as whole groups of equal texts allow, each group
    being atomic. Groups over the mean of what is left get a shard of their own, largest first; all
    others follow in the order of their text's hash and are cut at the smallest feasible capacity.
    Null texts count as empty ones. Extra columns are ignored, null doc_ids are rows like others,
    repeated rows each get a slot, and an empty table gives an empty result. Rows are numbered in
    hashed cells of each shard, so that no task holds a whole shard or group.
    """
    rows = written(sized(docs), "sizes")
    groups = rows.groupBy("key").agg(F.sum("size").alias("size"))
    rest, giants = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0], []
    for group in groups.orderBy(F.desc("size"), "key").limit(shards).collect():
        if group["size"] * (shards - len(giants)) <= rest:
            break
        giants.append(group["key"])
        rest -= group["size"]
    others = rows.where(~F.col("key").isin(giants)) if giants else rows
    cuts = minimax_cuts(others, shards - len(giants))[1] if len(giants) < shards else []
    place = F.lit(len(giants))
    for cut in cuts:
        place = place + (F.col("key") >= cut).cast("int")
    for i, key in enumerate(giants):
        place = F.when(F.col("key") == key, i).otherwise(place)
    total = rows.count()
    salts = max(1, -(-total // (shards * CELL_ROWS)))
    placed = rows.select("doc_id", "size", "text_crc32", "key", place.alias("shard"),
                         F.pmod(F.xxhash64("doc_id", "key"), F.lit(salts)).alias("salt"))
    counts = placed.groupBy("shard", "salt").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("shard").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("shard", "salt",
                           F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    inside = Window.partitionBy("shard", "salt").orderBy("doc_id", "key", "text_crc32")
    numbered = placed.withColumn("within", F.row_number().over(inside) - 1)
    return numbered.join(before, ["shard", "salt"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("before") + F.col("within")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
