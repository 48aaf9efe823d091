"""Benchmark passages in documents: q-gram lemma filter and banded alignment."""

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from basketlens.llm.common import opened, share, sliced

#: Characters of a q-gram, and edits allowed as a share of an item's length.
Q, EDITS = 8, 0.1
#: Characters of benchmark items that are broadcast at once; more items take more passes.
BLOCK_CHARS = 4 << 20
#: Bytes of text searched at once, and shared q-grams that are counted at once.
TEXT_BYTES, POSTINGS = 2 << 20, 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BITS = 20
_BLANKS = str.maketrans("\n\r\t\f\v ", "      ")


def codes(text):
    """Code points, lower case, white space as blanks; one number per character of lower()."""
    found = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where((found >= 9) & (found <= 13), np.uint32(32), found)


def grams(values):
    """Hash of the Q characters from each position, by doubling."""
    with np.errstate(over="ignore"):
        found, width, power = values.astype(np.uint64) + np.uint64(1), 1, _BASE
        while width < Q:
            found = found[:-width] * power + found[width:] if len(found) > width else found[:0]
            power, width = power * power, width * 2
    return found


class Index:
    """q-grams of a block of items. An item of m characters may have up to ``edits`` * m edits, or
    fewer if it is so short that its q-grams could not tell; shorter than Q, it matches nothing."""

    def __init__(self, items, edits=EDITS):
        items = [(i, codes(t)) for i, t in items if t is not None and len(codes(t)) >= Q]
        self.ids = [i for i, _ in items]
        self.codes = [c for _, c in items]
        lengths = np.array([len(c) for c in self.codes], np.int64)
        self.lengths = lengths
        self.edits = np.minimum((lengths * edits).astype(np.int64), lengths // Q - 1)
        # The lemma: an occurrence with k edits shares at least m + 1 - (k + 1) q of its q-grams.
        self.bound = lengths + 1 - (self.edits + 1) * Q
        self.step = self.edits + 1
        hashes = [grams(c) for c in self.codes]
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(items)), [len(h) for h in hashes])
        place = np.concatenate([np.arange(len(h)) for h in hashes]) if hashes else item
        order = np.argsort(flat, kind="stable")
        self.keys, first, self.counts = np.unique(
            flat[order], return_index=True, return_counts=True)
        self.first, self.item, self.place = first, item[order], place[order]
        self.maybe = np.zeros(1 << _BITS, bool)
        self.maybe[(self.keys >> np.uint64(64 - _BITS)).astype(np.int64)] = True
        self.gap = int(self.edits.max(initial=0)) + 1

    def candidates(self, flat):
        """(item, band) whose count of shared q-grams reaches the bound.

        Band b of an item holds the diagonals from b to b + 2 steps, a step being one more than its
        edits: bands overlap by half, so that all diagonals of an occurrence lie in one band.
        """
        at, spot = self._shared(flat)
        if not len(at):
            return at, at
        shift = int(self.lengths.max())
        width = len(flat) + shift + 3
        # All q-grams of a band lie within ``reach``: windows that overlap by it hold each band whole.
        reach = shift + 2 * self.gap
        ends = np.cumsum(self.counts[spot])
        bands, first = [], 0
        while True:
            last = int(np.searchsorted(ends, (ends[first - 1] if first else 0) + POSTINGS, side="right"))
            last = max(last, int(np.searchsorted(at, at[first] + 2 * reach, side="right")))
            bands.append(self._bands(at[first:last], spot[first:last], width, shift))
            if last >= len(at):
                break
            first = int(np.searchsorted(at, at[last] - reach))
        bands = np.unique(np.concatenate(bands))
        item = bands // width
        return item, (bands % width - 1) * self.step[item] - shift

    def _shared(self, flat):
        """Positions of flat whose q-gram an item has, and its place among the keys."""
        parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for start in range(0, len(flat) if len(self.keys) else 0, POSTINGS):
            hashes = grams(flat[start:start + POSTINGS + Q - 1])
            at = np.flatnonzero(self.maybe[(hashes >> np.uint64(64 - _BITS)).astype(np.int64)])
            spot = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
            real = self.keys[spot] == hashes[at]
            parts.append((at[real] + start, spot[real]))
        return [np.concatenate(p) for p in zip(*parts)]

    def _bands(self, at, spot, width, shift):
        """item * width + band + 1 of the bands that the q-grams at some positions show to be full."""
        many = self.counts[spot]
        ends = np.cumsum(many)
        posting = np.repeat(self.first[spot] - ends + many, many) + np.arange(ends[-1])
        item = self.item[posting]
        half = (np.repeat(at, many) - self.place[posting] + shift) // self.step[item]
        # The lemma counts an item's q-grams, so that a text that repeats one counts it once.
        span = int(self.lengths.max())
        key = np.sort((item * width + half + 1) * span + self.place[posting])
        key = key[np.concatenate(([True], key[1:] != key[:-1]))] // span
        # A band is a half band and the one after it.
        both = np.sort(np.concatenate((key, key - 1)))
        first = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1])))
        total = np.diff(np.append(first, len(both)))
        bands = both[first]
        return bands[total >= self.bound[bands // width]]

    def verified(self, flat, item, start):
        """(edits, end) of the best alignment of each item within its band; edits too many: -1."""
        order = np.argsort(self.lengths[item], kind="stable")
        edits, end = np.full(len(item), -1), np.zeros(len(item), np.int64)
        for part in range(0, len(order), 512):
            some = order[part:part + 512]
            edits[some], end[some] = self._aligned(flat, item[some], start[some])
        return edits, end

    def _aligned(self, flat, item, start):
        lengths, allowed = self.lengths[item], self.edits[item]
        longest = int(lengths.max())
        # Diagonals: those of the band and, on both sides, as many as there may be edits.
        own_width = 2 * self.step[item] + 2 * allowed + 1
        width = int(own_width.max())
        origin = start - allowed
        pattern = np.zeros((len(item), longest), np.uint32)
        for row, i in enumerate(item.tolist()):
            pattern[row, :lengths[row]] = self.codes[i]
        place = origin[:, None] + np.arange(longest + width)
        inside = (place >= 0) & (place < len(flat))
        text = np.where(inside, flat[np.clip(place, 0, len(flat) - 1)], 0)
        ramp = np.arange(width)
        # cost[d]: edits of the first i characters ending at text position i + d; any start is free.
        cost = np.zeros((len(item), width), np.int32)
        best, where = np.full(len(item), 1 << 20), np.zeros(len(item), np.int64)
        for i in range(longest):
            same = text[:, i:i + width] == pattern[:, i:i + 1]
            following = cost + ~same
            following[:, :-1] = np.minimum(following[:, :-1], cost[:, 1:] + 1)
            following = np.minimum.accumulate(following - ramp, axis=1) + ramp
            cost = following
            done = np.flatnonzero(lengths == i + 1)
            if len(done):
                # Ends beyond an item's own band belong to other bands, perhaps of other texts.
                ends = np.where(ramp < own_width[done, None], cost[done], 1 << 20)
                best[done] = ends.min(axis=1)
                where[done] = origin[done] + i + 1 + ends.argmin(axis=1)
        return np.where(best <= allowed, best, -1), where

    def matches(self, texts):
        """For each text its matches {item: (edits, end)}, the fewest edits and then first end."""
        found = [{} for _ in texts]
        if not self.ids:
            return found
        parts, starts, at = [], [], 0
        blank = np.zeros(self.gap, np.uint32)
        for text in texts:
            own = codes(text or "")
            parts += [own, blank]
            starts.append(at)
            at += len(own) + self.gap
        flat = np.concatenate(parts)
        item, start = self.candidates(flat)
        if not len(item):
            return found
        edits, end = self.verified(flat, item, start)
        good = np.flatnonzero(edits >= 0)
        rows = np.searchsorted(starts, end[good] - 1, side="right") - 1
        for i, row in zip(good.tolist(), rows.tolist()):
            value = (int(edits[i]), int(end[i] - starts[row]))
            name = self.ids[item[i]]
            if name not in found[row] or value < found[row][name]:
                found[row][name] = value
        return found


def _search(batches, shared, keep, name):
    index = opened(shared)
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int32()),
                               ("end", pa.int32())]))
    for whole in batches:
        for batch in sliced(whole, "text", TEXT_BYTES):
            found = index.matches(batch["text"].to_pylist())
            lists = [old + [{"item_id": i, "edits": e, "end": p} for i, (e, p) in own.items()]
                     for old, own in zip(batch[name].to_pylist(), found)]
            names = [n for n in batch.schema.names if n != name and (keep or n != "text")]
            yield pa.RecordBatch.from_arrays([batch[n] for n in names] + [pa.array(lists, kind)],
                                             [*names, name])


def find(docs, benchmark, edits=EDITS, keep_text=True, block_chars=BLOCK_CHARS,
         name="matches"):
    """docs with ``name``: (item_id, edits, end) of every benchmark item within the edit budget.

    The whole text is searched; end is the character behind the match in lower-cased text. Items
    are broadcast in blocks of a bounded size, and each block takes one pass over docs. Null
    items, items shorter than ``Q`` characters, null and empty texts match nothing; equal items
    match each under its id. Repeated rows match alike. Other columns pass through, except that
    ``name`` is replaced; without ``keep_text`` the text is left out. Empty tables give no matches.
    """
    items = benchmark.where("item_id is not null and text is not null").select("item_id", "text")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    rows = docs.drop(name).withColumn(name, F.array().cast(
        "array<struct<item_id:bigint,edits:int,end:int>>"))
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        index = Index(sorted((r["item_id"], r["text"]) for r in own.collect()), edits)
        last = block == blocks - 1 and not keep_text
        shared = share(docs.sparkSession, index)
        schema = rows.drop("text").schema if last else rows.schema
        rows = rows.mapInArrow(partial(_search, shared=shared, keep=not last, name=name), schema)
    return rows


def report(docs, benchmark, edits=EDITS):
    """doc_id, contaminated and matches, ordered by item_id, of every row of docs."""
    found = find(docs.select("doc_id", "text"), benchmark, edits, keep_text=False)
    return found.select("doc_id", (F.size("matches") > 0).alias("contaminated"),
                        F.array_sort("matches").alias("matches"))


def keep_clean(docs, benchmark, edits=EDITS):
    """The rows of docs that hold no benchmark item, with all their columns."""
    found = find(docs, benchmark, edits, name="_found")
    return found.where(F.size("_found") == 0).select(*docs.columns)
