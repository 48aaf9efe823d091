"""Repeated passages by hashed units: each unit stays where it is ranked first."""

import re

import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from basketlens.llm.common import written

#: Cuts of a text, from whole to part: paragraphs, lines, sentences, and before capitalised words, so
#: that a passage set into the middle of a sentence still falls into the units it has elsewhere.
CUTS = [re.compile(r"\n[ \t\r]*\n\s*"), re.compile(r"\n+"), re.compile(r"(?<=[.!?])[ \t\r]+"),
        re.compile(r"[ \t\r]+(?=[A-ZÀ-ÖØ-Þ])")]
#: Words or characters from which on a unit is compared; shorter ones recur by chance.
MIN_WORDS, MIN_CHARS = 5, 30


def _enough(part, min_words):
    found = part.split(None, min_words - 1)
    return len(found) >= min_words or sum(map(len, found)) + len(found) > MIN_CHARS


def _digest(part, place=None):
    name = " ".join(part.lower().split())
    return xxhash.xxh3_128_digest(name if place is None else f"{name}\n{place}")


def units(text, min_words=MIN_WORDS):
    """(start, end, digest) of the units of a text, in characters; they are disjoint and in order.

    A unit is normalised by lower-casing and by making each run of white space one blank. Parts too
    short to be compared are joined with short neighbours. Where the run is still too short, it takes
    its digest from the whole it is part of and its place there, so that it goes with a repeated
    sentence, line, paragraph or text, and with nothing less.
    """
    found = []

    def deal(start, end, depth):
        while depth < len(CUTS):
            cuts = [(m.start(), m.end()) for m in CUTS[depth].finditer(text, start, end)]
            if cuts:
                break
            depth += 1
        else:
            found.append((start, end, _digest(text[start:end])))
            return
        run, place, at = None, 0, start

        def close():
            part = text[run[0]:run[1]]
            found.append((*run, _digest(part) if _enough(part, min_words)
                          else _digest(text[start:end], place)))

        for stop, following in [*cuts, (end, end)]:
            part = text[at:stop]
            if _enough(part, min_words):
                if run:
                    close()
                    run, place = None, place + 1
                deal(at, stop, depth + 1)
            elif part.strip():
                run = (run[0] if run else at, stop)
            at = following
        if run:
            close()

    if _enough(text, min_words):
        deal(0, len(text), 0)
    return found


def _listed(batches):
    for batch in batches:
        ids, hashes = batch["doc_id"], batch["hash"]
        rows, starts, ends, digests = [], [], [], []
        for i, text in enumerate(batch["text"].to_pylist()):
            for start, end, digest in units(text or ""):
                rows.append(i)
                starts.append(start)
                ends.append(end)
                digests.append(digest)
            if len(rows) > 200_000 or i == batch.num_rows - 1 and rows:
                at = pa.array(rows, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(at), hashes.take(at), pa.array(starts, pa.int32()),
                     pa.array(ends, pa.int32()), pa.array(digests, pa.binary())],
                    ["doc_id", "hash", "start", "end", "digest"])
                rows, starts, ends, digests = [], [], [], []


def repeated_spans(docs):
    """(doc_id, hash of the text, spans): units that occur earlier, in order of (doc_id, start).

    A null doc_id ranks last. Where one doc_id has several texts, their hash ranks them; rows
    repeated with id and text count as one row and are treated alike.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = written(docs.select("doc_id", F.xxhash64("text").alias("hash"), "text").mapInArrow(
        _listed, f"doc_id {kind}, hash long, start int, end int, digest binary"), "units")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "hash", "start")
    # Written, so that a very common unit meets its first place in a join that can be split.
    first = written(found.groupBy("digest").agg(
        F.min(rank).alias("first"), F.count("*").alias("n")).where("n > 1").select(
        "digest", "first"), "first")
    again = found.join(first, "digest").where(rank > F.col("first"))
    return again.groupBy("doc_id", "hash").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("removed"))


def without_spans(text, spans):
    """``text`` without the spans; white space between two removed spans goes too."""
    parts, at = [], 0
    for start, end in spans:
        between = text[at:start]
        if at == 0 or between.strip():
            parts.append(between)
        at = end
    parts.append(text[at:])
    return "".join(parts)


def _cut(batches):
    for batch in batches:
        texts = [text if text is None or not spans
                 else without_spans(text, [(s["start"], s["end"]) for s in spans])
                 for text, spans in zip(batch["text"].to_pylist(), batch["removed"].to_pylist())]
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, batch.schema.field(at), pa.array(texts, pa.string()))


def drop_repeats(docs):
    """docs with every later occurrence of a unit cut out of ``text``, and the column removed.

    removed: spans (start, end) of the original text, in characters, in order; empty if none. Null
    texts stay null, empty ones empty. Units of fewer than ``MIN_WORDS`` words and ``MIN_CHARS``
    characters go only with a repeated whole around them. Other columns pass through, except that
    removed is replaced. An empty table stays empty.
    """
    spans = repeated_spans(docs).select(
        F.col("doc_id").alias("_id"), F.col("hash").alias("_hash"), "removed")
    none = F.array().cast("array<struct<start:int,end:int>>")
    joined = docs.drop("removed").join(
        spans, F.col("doc_id").eqNullSafe(F.col("_id"))
        & (F.xxhash64("text") == F.col("_hash")), "left").drop("_id", "_hash").withColumn(
        "removed", F.coalesce("removed", none))
    return joined.mapInArrow(_cut, joined.schema)
