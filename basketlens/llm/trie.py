"""Prefix trie of conversations: a node per distinct sequence of first turns, with subtree sums.

A turn is known by a digest of role and text and by its number of code points. Null roles and texts
count as empty, turns without a conv_id belong to no conversation, and turns of one number are ordered
by role and then by the MD5 of the text; repeated rows are turns of their own. Other columns are not
read. An empty table has no node, not even a root.

A prefix is known by a 128-bit digest that builds on the digest before it. Tasks put the distinct
digests of a shard of rows into slots of a minimal perfect hash whose stored keys verify every lookup,
scatter counts into flat arrays by slot, and emit one row per slot; equal digests of all shards are
added up, and one that stands for different prefixes ends the job with an error. Each node is owned by its smallest
member. In a second pass a shard holds whole paths, so a node's parent is in its own shard; the owner's
path carries the node's value, and values are added to parents level by level, deepest first. The
shards' sums of a node add up to its subtree's. Paths longer than ``SEGMENT`` turns are cut; what the
later segments own is added at the end of the earlier ones.
"""

import hashlib
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketlens.functions.prefix import running_totals
from basketlens.llm.common import ranged, written

#: Turns of a path that stay together, and rows of a shard about.
SEGMENT, SHARD = 4096, 200_000
ROOT = hashlib.md5(b"").digest()
_LAST = np.iinfo(np.int64).max


class Slots:
    """A minimal perfect hash of distinct 128-bit keys, given as rows of two uint64.

    On each level a key takes the place that its hash names unless another key names it too; those
    that collide go to the next level. A slot is the number of taken places before its own. ``find``
    compares the key stored in the slot, so that a strange key is never taken for a known one.
    """

    def __init__(self, keys):
        order = np.lexsort((keys[:, 1], keys[:, 0]))
        keys = keys[order]
        fresh = np.ones(len(keys), bool)
        fresh[1:] = (keys[1:] != keys[:-1]).any(axis=1)
        left = keys[fresh]
        self.levels, self.keys, base = [], np.zeros_like(left), 0
        while len(left):
            size = 2 * len(left)
            place = self._place(left, len(self.levels), size)
            alone = np.bincount(place, minlength=size) == 1
            slot = base + np.cumsum(alone) - 1
            placed = alone[place]
            self.keys[slot[place[placed]]] = left[placed]
            self.levels.append((size, alone, slot))
            base += int(alone.sum())
            left = left[~placed]

    @staticmethod
    def _place(keys, level, size):
        mixed = keys[:, 0] ^ (keys[:, 1] + np.uint64(level)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ mixed >> np.uint64(31)) * np.uint64(0xD6E8FEB86659FD93)
        mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
        return ((mixed ^ mixed >> np.uint64(29)) % np.uint64(size)).astype(np.int64)

    def find(self, keys):
        """Slots of ``keys``; -1 where a key is not in the table."""
        found = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (size, alone, slot) in enumerate(self.levels):
            place = self._place(keys[open_], level, size)
            hit = alone[place]
            found[open_[hit]] = slot[place[hit]]
            open_ = open_[~hit]
        known = found >= 0
        known[known] = (self.keys[found[known]] == keys[known]).all(axis=1)
        return np.where(known, found, -1)


def _keys(column):
    """Digests of an Arrow column as rows of two uint64; null as zeros."""
    filled = column.fill_null(bytes(16)).cast(pa.binary(16))
    if isinstance(filled, pa.ChunkedArray):
        filled = filled.combine_chunks()
    raw = np.frombuffer(filled.buffers()[1], np.uint64) if len(filled) else np.zeros(0, np.uint64)
    return raw.reshape(-1, 2)[filled.offset:filled.offset + len(filled)].copy()


def _digests(keys):
    """Rows of two uint64 as an Arrow column of digests."""
    raw = np.ascontiguousarray(keys).tobytes()
    return pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(16), len(keys), [None, pa.py_buffer(raw)]).cast(pa.binary())


def numbered(turns):
    """(conv_id, place, key, chars): the turns of each conversation in order, from place 1.

    Places are counted by ranges of the order, so that a very long conversation is spread over tasks.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), "turn", role.alias("role"), F.md5(text).alias("digest"),
        F.char_length(text).cast("long").alias("chars"),
        F.monotonically_increasing_id().alias("row"))
    order = ["turn", "role", "digest", "row"]
    placed = running_totals(ranged(rows, ["conv_id", *order], "trie_turns"), ["conv_id"], "part", order,
                            {"place": F.lit(1)})
    return written(placed.select("conv_id", "place", F.unhex(F.md5(F.concat("digest", "role"))).alias(
        "key"), "chars"), "trie_places")


def _hashed(batches):
    """Rows sorted by path with the digest of their prefix and of the one before it."""
    path, state = None, None
    for batch in batches:
        columns = batch.to_pydict()
        nodes, parents = [], []
        for conv, seg, depth, key, start in zip(*(columns[c] for c in (
                "conv_id", "seg", "depth", "key", "start"))):
            fresh = path != (conv, seg)
            if fresh:
                path, state = (conv, seg), start or ROOT
            if depth == 0:
                nodes.append(ROOT)
                parents.append(None)
                continue
            # A later segment builds on all before it, but its first parent is looked up.
            parents.append(None if fresh and seg else state)
            state = hashlib.md5(state + key).digest()
            nodes.append(state)
        yield pa.RecordBatch.from_pydict({
            "conv_id": batch["conv_id"], "seg": batch["seg"], "depth": batch["depth"],
            "ends": batch["ends"], "chars": batch["chars"], "node": pa.array(nodes, pa.binary()),
            "parent": pa.array(parents, pa.binary())})


def _segment_digest(batches):
    """One digest of each whole segment."""
    rows = (row for batch in batches for row in zip(*(
        batch[c].to_pylist() for c in ("conv_id", "seg", "key"))))
    for (conv, seg), group in groupby(rows, key=lambda r: r[:2]):
        whole = hashlib.md5(b"".join(key for _, _, key in group)).digest()
        yield pa.RecordBatch.from_pydict({"conv_id": pa.array([conv], pa.int64()),
                                          "seg": pa.array([seg], pa.int64()),
                                          "whole": pa.array([whole], pa.binary())})


def _in_order(rows, *order):
    return rows.repartition("conv_id", "seg").sortWithinPartitions("conv_id", "seg", *order)


def _paths(turns, members, segment):
    """(conv_id, seg, depth, ends, chars, node, parent) per member and depth, the root included."""
    rows = turns.join(members.select("conv_id", "length"), "conv_id").select(
        "conv_id", F.floor((F.col("place") - 1) / segment).alias("seg"), F.col("place").alias("depth"),
        (F.col("place") == F.col("length")).alias("ends"), "chars", "key", "length").unionByName(
        members.select("conv_id", F.lit(0).cast("long").alias("seg"),
                       F.lit(0).cast("long").alias("depth"), (F.col("length") == 0).alias("ends"),
                       F.lit(0).cast("long").alias("chars"), F.lit(None).cast("binary").alias("key"),
                       "length"))
    rows = written(rows, "trie_rows")
    wholes = _in_order(rows.where(f"length > {segment} and depth > 0"), "depth").select(
        "conv_id", "seg", "key").mapInArrow(_segment_digest, "conv_id long, seg long, whole binary")
    # A segment starts from a digest of all segments before it: one row per segment.
    chain = wholes.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("seg", "whole"))).alias(
        "all")).select("conv_id", F.explode(F.expr(
            "transform(slice(all, 1, size(all) - 1), (x, i) -> named_struct('seg', x.seg + 1, 'start', "
            "unhex(md5(aggregate(slice(all, 1, i + 1), cast('' as binary), "
            "(a, y) -> unhex(md5(concat(a, y.whole))))))))")).alias("s")).select(
        "conv_id", "s.seg", "s.start")
    hashed = _in_order(rows.join(chain, ["conv_id", "seg"], "left"), "depth").select(
        "conv_id", "seg", "depth", "ends", "chars", "key", "start").mapInArrow(
        _hashed, "conv_id long, seg long, depth long, ends boolean, chars long, node binary, "
                 "parent binary")
    hashed = written(hashed, "trie_hashed")
    before = hashed.where(f"depth > 0 and depth % {segment} = 0").select(
        "conv_id", (F.col("seg") + 1).alias("seg"), F.col("node").alias("before"))
    return hashed.join(before, ["conv_id", "seg"], "left").withColumn(
        "parent", F.coalesce("parent", F.when(F.col("depth") > 0, F.col("before")))).drop("before")


def _shards(batches, columns):
    """Arrow batches joined to tables of about SHARD rows."""
    held, count = [], 0
    for batch in batches:
        held.append(batch.select(columns))
        count += len(batch)
        if count >= SHARD:
            yield pa.Table.from_batches(held)
            held, count = [], 0
    if count:
        yield pa.Table.from_batches(held)


def _counted(batches):
    """One row per distinct prefix of a shard: members, the smallest of them, and its own facts."""
    for shard in _shards(batches, ["conv_id", "depth", "chars", "node", "parent"]):
        keys = _keys(shard["node"])
        slots = Slots(keys)
        at, size = slots.find(keys), len(slots.keys)
        conv = shard["conv_id"].to_numpy()
        members, low = np.zeros(size, np.int64), np.full(size, _LAST)
        np.add.at(members, at, 1)
        np.minimum.at(low, at, conv)
        one = np.zeros(size, np.int64)
        one[at] = np.arange(len(at))
        facts = shard.take(one)
        yield from pa.table({
            "node": _digests(slots.keys), "parent": facts["parent"], "depth": facts["depth"],
            "chars": facts["chars"], "members": members, "low": low}).combine_chunks().to_batches()


def _whole_paths(batches):
    """Shards that hold whole (conv_id, seg) paths of rows sorted by them."""
    held = None
    for shard in _shards(batches, ["conv_id", "seg", "node", "parent", "depth", "kind", "value",
                                   "leaf"]):
        held = shard if held is None else pa.concat_tables([held, shard])
        conv, seg = held["conv_id"].to_numpy(), held["seg"].to_numpy()
        other = np.flatnonzero((conv != conv[-1]) | (seg != seg[-1]))
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield held.slice(0, cut)
            held = held.slice(cut)
    if held is not None:
        yield held


def _accumulated(batches, segment):
    """Values of a shard's paths added up to every prefix on the way to the root."""
    for shard in _whole_paths(batches):
        kind = shard["kind"].to_numpy()
        path = np.flatnonzero(kind == 0)
        own = np.flatnonzero(kind > 0)
        # A value follows the path's row to which it belongs.
        owner = np.searchsorted(path, own) - 1
        rows = shard.take(path)
        keys = _keys(rows["node"])
        slots = Slots(keys)
        at, size = slots.find(keys), len(slots.keys)
        parent, depth = np.full(size, -1, np.int64), np.zeros(size, np.int64)
        parent[at] = slots.find(_keys(rows["parent"]))
        depth[at] = rows["depth"].to_numpy()
        # What a later segment owns is carried apart, even if the one before it is in this shard.
        parent[(depth > 1) & (depth % segment == 1 % segment)] = -1
        sums = {}
        for name in ("value", "leaf"):
            sums[name] = np.zeros(size, np.int64)
            np.add.at(sums[name], at[owner], shard[name].take(own).to_numpy())
        order = np.argsort(-depth, kind="stable")
        for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
            up = level[parent[level] >= 0]
            for held in sums.values():
                np.add.at(held, parent[up], held[up])
        yield from pa.table({"node": _digests(slots.keys), **sums}).combine_chunks().to_batches()


def _end_digests(batches):
    """SHA-256 of the ids that end at each prefix, from rows sorted by prefix and id."""
    rows = (row for batch in batches for row in zip(batch["node"].to_pylist(),
                                                    batch["conv_id"].to_pylist()))
    nodes, texts = [], []
    for node, group in groupby(rows, key=lambda r: r[0]):
        digest, comma = hashlib.sha256(), b""
        for _, conv in group:
            digest.update(comma + str(conv).encode())
            comma = b","
        nodes.append(node)
        texts.append(digest.hexdigest())
        if len(nodes) == 10_000:
            yield pa.RecordBatch.from_pydict({"node": pa.array(nodes, pa.binary()), "ends_sha256": texts})
            nodes, texts = [], []
    if nodes:
        yield pa.RecordBatch.from_pydict({"node": pa.array(nodes, pa.binary()), "ends_sha256": texts})


def build(turns, members, segment=SEGMENT):
    """The trie of ``members`` (conv_id, length) with ``turns`` (conv_id, place, key, chars).

    Places run from 1 to the member's length. One row per node: conv_id (the smallest member), depth,
    parent_conv_id (the parent's smallest; null for the root), n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. Saved tokens are the code points of the node's last text times its
    members but one, added up over its subtree.
    """
    paths = written(_paths(turns, members, segment), "trie_paths")

    def unanimous(name):
        return F.when(F.min(name).eqNullSafe(F.max(name)), F.min(name)).otherwise(F.raise_error(
            F.lit("two prefixes share a digest"))).alias(name)

    nodes = written(paths.mapInArrow(
        _counted, "node binary, parent binary, depth long, chars long, members long, low long").groupBy(
        "node").agg(unanimous("parent"), unanimous("depth"), unanimous("chars"),
                    F.sum("members").alias("n_convs"), F.min("low").alias("low")), "trie_nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(
        F.count(F.lit(1)).alias("n_children"))
    facts = written(nodes.join(children, "node", "left").na.fill(0, ["n_children"]), "trie_facts")
    owned = facts.select(
        F.col("low").alias("conv_id"), F.when(F.col("depth") > 0, F.floor(
            (F.col("depth") - 1) / segment)).otherwise(0).alias("seg"), "depth", F.lit(1).alias("kind"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("value"),
        (F.col("n_children") == 0).cast("long").alias("leaf"))
    later = owned.where("seg > 0").groupBy("conv_id", "seg").agg(
        F.sum("value").alias("value"), F.sum("leaf").alias("leaf"))
    cut = paths.groupBy("conv_id").agg(F.max("seg").alias("top")).where("top > 0").select(
        "conv_id", F.explode(F.sequence(F.lit(0).cast("long"), "top")).alias("seg"))
    after = W.partitionBy("conv_id").orderBy(F.desc("seg")).rowsBetween(W.unboundedPreceding, -1)
    carried = cut.join(later, ["conv_id", "seg"], "left").select(
        "conv_id", "seg", F.lit(_LAST).alias("depth"), F.lit(2).alias("kind"),
        *[F.coalesce(F.sum(n).over(after), F.lit(0)).alias(n) for n in ("value", "leaf")])
    none = [F.lit(None).cast("binary").alias(n) for n in ("node", "parent")]
    zero = [F.lit(0).cast("long").alias(n) for n in ("value", "leaf")]
    names = ["conv_id", "seg", "depth", "kind", "value", "leaf", "node", "parent"]
    rows = paths.select("*", F.lit(0).alias("kind"), *zero).select(names).unionByName(
        owned.select("*", *none).select(names)).unionByName(carried.select("*", *none).select(names))
    sums = _in_order(rows, "depth", "kind").mapInArrow(
        lambda batches: _accumulated(batches, segment), "node binary, value long, leaf long").groupBy("node").agg(
        F.sum("value").alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))
    ends = paths.where("ends").select("node", "conv_id").repartition("node").sortWithinPartitions(
        "node", "conv_id").mapInArrow(_end_digests, "node binary, ends_sha256 string")
    above = nodes.select(F.col("node").alias("parent"), F.col("low").alias("parent_conv_id"))
    return facts.join(sums, "node").join(ends, "node", "left").join(above, "parent", "left").select(
        F.col("low").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias(
            "ends_sha256"))
