"""SimHash near-duplicates, linked through the anchor points of a covering code."""

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from basketlens.llm.common import components, raw_bytes, words, written

#: Contract of the query and of the pipeline's stage: words in a shingle, differing bits.
SHINGLE, BITS, SEED = 3, 3, 42
#: Rows of one block of a large anchor.
BLOCK = 2048


def text_fingerprint(text, width=SHINGLE):
    """Unsigned 64-bit fingerprint of UTF-8 bytes: a bit is set where over half the hashes set it.

    A text of fewer than ``width`` words is one shingle; one without words has fingerprint 0.
    """
    found = words(text)
    if not found:
        return 0
    if len(found) <= width:
        return xxhash.xxh64_intdigest(b" ".join(found), SEED)
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:len(found) - width + 1]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[i:j], SEED) for i, j in
                          zip(starts.tolist(), ends[width - 1:].tolist())),
                         np.uint64, len(starts))
    counts = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 4096):
        block = hashes[part:part + 4096].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view(np.uint64)[0])


def _fingerprints(batches, width):
    for batch in batches:
        values = [text_fingerprint(x, width) for x in raw_bytes(batch["text"])]
        signed = np.array(values, np.uint64).view(np.int64)
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([batch[n] for n in names] + [pa.array(signed)], names + ["fp"])


def fingerprints(docs, width=SHINGLE, hashed=False):
    """(doc_id, fp) of all rows; fp is the fingerprint as a signed long. ``hashed`` adds the text's hash."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    mark = [F.xxhash64("text").alias("mark")] if hashed else []
    return docs.select("doc_id", *mark, "text").mapInArrow(
        partial(_fingerprints, width=width),
        f"doc_id {kind}, " + "mark long, " * hashed + "fp long")


# --- anchors -----------------------------------------------------------------------------------
# A fingerprint is cut into two halves; two fingerprints within 3 bits are within 1 bit in one
# half. The anchors are the words of the Hamming code of length 31 over the low 31 bits of a half:
# a perfect code, so every half has one anchor within its covering radius 1 (its home). Another
# half within 1 bit of it is then within 2 bits of that anchor, so it is sent to all 16 (or 1)
# anchors within 2 bits.

def _syndromes(half):
    masks = np.array([sum(1 << (p - 1) for p in range(1, 32) if p >> bit & 1)
                      for bit in range(5)], np.uint32)
    parity = np.bitwise_count(half[:, None] & masks) & 1
    return (parity << np.arange(5, dtype=np.uint8)).sum(axis=1).astype(np.int64)


def anchors(half):
    """(row, anchor, home) of uint32 halves: every anchor within 2 bits; home: within 1."""
    half = half & np.uint32(0x7FFFFFFF)
    syndrome = _syndromes(half)
    flip = np.concatenate((np.zeros(1, np.uint32), np.uint32(1) << np.arange(31, dtype=np.uint32)))
    home = half ^ flip[syndrome]
    rows, found, near = [np.arange(len(half))], [home], [np.ones(len(half), bool)]
    for first in range(1, 32):
        second = syndrome ^ first
        pick = np.flatnonzero((syndrome > 0) & (first < second))
        rows.append(pick)
        found.append(half[pick] ^ flip[first] ^ flip[second[pick]])
        near.append(np.zeros(len(pick), bool))
    return np.concatenate(rows), np.concatenate(found), np.concatenate(near)


def _replicas(batches):
    for batch in batches:
        values = batch["fp"].to_numpy(zero_copy_only=False).view(np.uint64)
        for side in range(2):
            half = (values >> np.uint64(32 * side)).astype(np.uint32)
            row, anchor, home = anchors(half)
            key = anchor.astype(np.int64) * 2 + side
            for part in range(0, len(row), 100_000):
                cut = slice(part, part + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[cut]), pa.array(values[row[cut]].view(np.int64)),
                     pa.array(home[cut])], ["anchor", "fp", "home"])


def _forest(homes, others, bits):
    """Edges of a spanning forest of the links between two blocks of fingerprints."""
    values, index = np.unique(np.concatenate((homes, others)), return_inverse=True)
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges, other_index = [], index[len(homes):]
    for value, i in zip(homes, index[:len(homes)].tolist()):
        near = other_index[np.bitwise_count(others ^ value) <= bits]
        a = root(i)
        for j in near.tolist():
            b = root(j)
            if a != b:
                parent[b] = a
                edges.append((i, j))
    return [(values[i], values[j]) for i, j in edges]


def _compare(batches, bits):
    """Forests of runs of equal (anchor, cell, other); rows come sorted, a run has two blocks."""
    names = ["anchor", "cell", "other", "home", "fp"]
    held = None

    def links(run):
        fp = run[4].view(np.uint64)
        homes, others = fp[run[3] > 0], fp[run[3] == 0]
        return _forest(homes, others, bits) if len(homes) and len(others) else []

    def packed(found):
        pairs = np.array(found, np.uint64).view(np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])],
                                          ["a", "b"])

    for batch in batches:
        rows = np.stack([batch[n].to_numpy(zero_copy_only=False).astype(np.int64) for n in names])
        held = rows if held is None else np.concatenate((held, rows), axis=1)
        if held.shape[1] == 0:
            continue
        cuts = np.flatnonzero((held[:3, 1:] != held[:3, :-1]).any(axis=0)) + 1
        bounds = [0, *cuts.tolist()]
        found = [e for i, j in zip(bounds, bounds[1:]) if j - i > 1 for e in links(held[:, i:j])]
        held = held[:, bounds[-1]:]
        if found:
            yield packed(found)
    if held is not None and held.shape[1]:
        if found := links(held):
            yield packed(found)


def link_fingerprints(distinct, bits=BITS, block=BLOCK):
    """Spanning links (a, b) of distinct fingerprints (fp long) at ``bits`` <= 3 differing bits.

    Every pair within the distance meets at an anchor. An anchor with more than ``block`` rows is
    cut into hashed blocks; each block of its homes meets each block of all its rows in a group of
    its own. A group emits a spanning forest of its links, not the pairs.
    """
    if not 0 <= bits <= 3:
        raise ValueError("two halves and a covering radius of 1 are complete up to 3 bits")
    spread = distinct.mapInArrow(_replicas, "anchor long, fp long, home boolean")
    spread = written(spread, "anchors")
    # Whoever is alone at an anchor, or has no home there, has no link there.
    busy = spread.groupBy("anchor").agg(F.count("*").alias("n"), F.max("home").alias("any_home"))
    busy = busy.where("n > 1 and any_home").select(
        "anchor", F.ceil(F.col("n") / block).cast("long").alias("cells"))
    rows = spread.join(busy, "anchor").withColumn("own", F.pmod(F.xxhash64("fp"), "cells"))
    every = F.sequence(F.lit(0).cast("long"), F.col("cells") - 1)
    home = rows.where("home").select("anchor", F.col("own").alias("cell"),
                                     F.explode(every).alias("other"),
                                     F.lit(1).alias("home"), "fp")
    rest = rows.select("anchor", F.explode(every).alias("cell"),
                       F.col("own").alias("other"), F.lit(0).alias("home"), "fp")
    keys = ["anchor", "cell", "other"]
    met = home.union(rest)
    shuffles = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = met.repartition(max(shuffles, 1), *keys).sortWithinPartitions(*keys)
    return met.mapInArrow(partial(_compare, bits=bits), "a long, b long")


def near_duplicates(docs, width=SHINGLE, bits=BITS):
    """One row per input row: doc_id, fp, component_id (smallest doc_id reachable).

    docs needs doc_id and text; other columns are ignored. Null and empty texts have fingerprint 0
    and link like any other. A null doc_id takes part with its text and is never a component_id
    unless no other id is reachable. Repeated rows give repeated results. An empty table gives
    an empty result. Equal fingerprints become one before the anchors, so copies cost one row.
    """
    marked = written(fingerprints(docs, width), "fingerprints")
    joined = _labelled(marked, bits)
    smallest = joined.groupBy("label").agg(F.min("least").alias("component_id"))
    classes = joined.join(smallest, "label").select("fp", "component_id")
    return marked.join(classes, "fp").select("doc_id", "fp", "component_id")


def _labelled(marked, bits):
    """(fp, least, label): each fingerprint with its smallest doc_id and its component's label."""
    distinct = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    labels = components(link_fingerprints(distinct.select("fp"), bits))
    return distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label"))


def keep_representatives(docs, width=SHINGLE, bits=BITS):
    """The rows of docs that stay: one of each group of linked texts.

    It is the row with the smallest doc_id, and of several texts under that id the one whose hash is
    smallest; rows without a doc_id come last. Of rows equal in id and text one stays. So a row goes
    only where an equal or linked text stays, also if ids repeat or are missing.
    """
    marked = written(fingerprints(docs, width, hashed=True), "fingerprints")
    labels = _labelled(marked, bits).select("fp", "label")
    # Copies are one row before they meet their label; a group's rows are reduced in the tasks.
    rows = marked.groupBy("fp").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("nameless"), "doc_id", "mark")).alias("first"))
    chosen = written(rows.join(labels, "fp").groupBy("label").agg(F.min("first").alias("first")).select(
        F.col("first.doc_id").alias("_chosen_id"), F.col("first.mark").alias("_chosen_mark")), "chosen")
    same = (docs["doc_id"].eqNullSafe(chosen["_chosen_id"])
            & (F.xxhash64(docs["text"]) == chosen["_chosen_mark"]))
    kept = docs.join(chosen, same, "left_semi").withColumn("_chosen_text", F.xxhash64("text"))
    return kept.dropDuplicates(["doc_id", "_chosen_text"]).drop("_chosen_text")
