"""Quality of whole texts by a byte-level convolutional network in numpy."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from basketlens.llm.common import raw_bytes, sliced

#: Network: bytes that a filter sees, numbers for a byte, filters, positions of a chunk.
WIDTH, EMBED, FILTERS, CHUNK = 6, 8, 16, 256
FOLDS, HELD = 4, 2
#: Bounds of the fit: rows of each label and bytes of all of them.
SAMPLE_ROWS, SAMPLE_BYTES = 1000, 16 << 20
EPOCHS, BATCH_CHUNKS = 9, 384
THRESHOLD = 0.7


def chunked(texts):
    """(windows, first chunk of each text) of byte strings; None counts as empty.

    A chunk has ``CHUNK`` positions; its window also holds the first bytes of the next chunk, so
    that windows overlap and every filter position of a text lies in one chunk. Texts end in zeros,
    and the last window of a text sees zeros instead of the text that follows.
    """
    sizes = [len(t or b"") for t in texts]
    chunks = np.array([max(1, -(-(n + WIDTH - 1) // CHUNK)) for n in sizes])
    starts = np.cumsum(chunks) - chunks
    flat = bytearray(int(chunks.sum()) * CHUNK + WIDTH)
    for text, start in zip(texts, starts.tolist()):
        if text:
            flat[start * CHUNK:start * CHUNK + len(text)] = text
    flat = np.frombuffer(bytes(flat), np.uint8)
    windows = np.lib.stride_tricks.sliding_window_view(flat, CHUNK + WIDTH - 1)[::CHUNK]
    windows = windows[:int(chunks.sum())].copy()
    windows[starts + chunks - 1, CHUNK:] = 0
    return windows, starts


def _unfolded(weights, window):
    """(positions, WIDTH * EMBED) inputs of the filters of some chunks."""
    embedded = weights["embed"][window]
    views = np.lib.stride_tricks.sliding_window_view(embedded, WIDTH, axis=1)
    return np.ascontiguousarray(views.transpose(0, 1, 3, 2)).reshape(
        -1, WIDTH * EMBED)


def activations(weights, windows, places=False):
    """Largest response of each filter in each chunk, and where it was."""
    out = np.empty((len(windows), FILTERS), np.float32)
    where = np.empty((len(windows), FILTERS), np.int64) if places else None
    for part in range(0, len(windows), 32):
        window = windows[part:part + 32]
        found = (_unfolded(weights, window) @ weights["filters"]).reshape(
            len(window), CHUNK, FILTERS)
        if places:
            where[part:part + 32] = found.argmax(axis=1)
        out[part:part + 32] = found.max(axis=1)
    return out + weights["shift"], where


def pooled(chunk_max, starts):
    """Features of each text: largest and mean filter response over its chunks."""
    positive = np.maximum(chunk_max, 0)
    counts = np.diff(np.append(starts, len(chunk_max)))[:, None]
    return np.concatenate((np.maximum.reduceat(positive, starts),
                           np.add.reduceat(positive, starts) / counts), axis=1)


def probability(weights, features):
    logit = features @ weights["mix"] + weights["base"]
    return 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -500, 500)))


def train(texts, labels, epochs=EPOCHS, seed=1):
    """Weights fitted by Adam on whole texts; the classes count alike and the base is then moved
    to their share in ``labels``, so that ``share`` can be corrected by the caller."""
    rng = np.random.default_rng(seed)
    weights = {"embed": rng.normal(0, 0.5, (256, EMBED)),
               "filters": rng.normal(0, 1 / math.sqrt(WIDTH * EMBED), (WIDTH * EMBED, FILTERS)),
               "shift": np.zeros(FILTERS), "mix": rng.normal(0, 0.1, 2 * FILTERS),
               "base": np.zeros(1)}
    weights = {k: v.astype(np.float32) for k, v in weights.items()}
    labels = np.asarray(labels, np.float32)
    if not len(texts):
        return weights
    balance = np.where(labels > 0, 0.5 / max(labels.sum(), 1), 0.5 / max((1 - labels).sum(), 1))
    balance = (balance * len(labels)).astype(np.float32)
    sizes = np.array([len(t or b"") // CHUNK + 1 for t in texts])
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    step, steps = 0, max(1, epochs * int(sizes.sum()) // BATCH_CHUNKS)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        group = np.cumsum(sizes[order]) // BATCH_CHUNKS
        for part in np.split(order, np.flatnonzero(np.diff(group)) + 1):
            step += 1
            windows, starts = chunked([texts[i] for i in part])
            best, where = activations(weights, windows, places=True)
            features = pooled(best, starts)
            error = (probability(weights, features) - labels[part]).astype(np.float32)
            error *= balance[part] / len(part)
            d_features = error[:, None] * weights["mix"]
            counts = np.diff(np.append(starts, len(best)))
            text_of = np.repeat(np.arange(len(part)), counts)
            positive = np.maximum(best, 0)
            # The largest response of a text passes its gradient to one chunk, the mean to all.
            top = positive == features[text_of, :FILTERS]
            ties = np.add.reduceat(top.astype(np.float32), starts)[text_of]
            d_best = (d_features[text_of, :FILTERS] * top / ties
                      + d_features[text_of, FILTERS:] / counts[text_of, None]) * (best > 0)
            picked = windows[np.arange(len(best))[:, None, None],
                             where[:, :, None] + np.arange(WIDTH)]
            inputs = weights["embed"][picked].reshape(len(best), FILTERS, WIDTH * EMBED)
            gradient = {
                "filters": np.einsum("cf,cfi->if", d_best, inputs),
                "shift": d_best.sum(0), "mix": features.T @ error,
                "base": error.sum(keepdims=True), "embed": np.zeros_like(weights["embed"])}
            d_inputs = d_best[:, :, None] * weights["filters"].T[None]
            np.add.at(gradient["embed"], picked.reshape(-1), d_inputs.reshape(-1, EMBED))
            rate = 0.01 * (1 - step / (steps + step))
            for k, g in gradient.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                weights[k] -= (rate * (first[k] / (1 - 0.9 ** step))
                               / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
                               ).astype(np.float32)
    return weights


def _remainder(column):
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(FOLDS))


def fit(docs, labels, rows=SAMPLE_ROWS, size=SAMPLE_BYTES, epochs=EPOCHS):
    """Weights learned from a bounded sample of labelled rows outside the held-out fold.

    At most about ``rows`` rows of each label are drawn by a hash of their id, fewer if their texts
    exceed ``size`` bytes. Nothing but text and label reaches the network; the share of label 1
    among all labelled training rows sets its base.
    """
    known = labels.where(F.col("quality").isin(0, 1) & (_remainder("doc_id") != HELD)).select(
        "doc_id", "quality").distinct()
    found = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    place = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 20))

    def drawn(part):
        share = F.create_map(*[F.lit(x) for q, n in found.items()
                               for x in (q, int(min(1, part * rows / n) * (1 << 20)))])
        # The bound of the sample is the bound of the broadcast.
        return docs.select("doc_id", "text").join(
            F.broadcast(known.where(place < share[F.col("quality")])), "doc_id")

    if not found:
        return train([], []) | {"mix": np.zeros(2 * FILTERS, np.float32)}
    total = drawn(1).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    sample = drawn(min(1, size / max(total, 1))).toArrow()
    order = np.argsort(sample["doc_id"].to_numpy(), kind="stable")
    texts = raw_bytes(sample["text"])
    weights = train([texts[i] for i in order],
                    sample["quality"].to_numpy()[order] > 0, epochs)
    weights["base"] += np.float32(math.log((found.get(1, 0) + 1) / (found.get(0, 0) + 1)))
    return weights


def _scored(batches, shared):
    weights = shared.value
    for whole in batches:
        for batch in sliced(whole, "text", 4 << 20):
            windows, starts = chunked(raw_bytes(batch["text"]))
            found = probability(weights, pooled(activations(weights, windows)[0], starts))
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [batch[n] for n in names] + [pa.array(found)], names + ["score"])


def score(docs, weights):
    """docs' doc_id, held_out and score of every row, whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    kind = docs.schema["doc_id"].dataType.simpleString()
    held = F.coalesce(_remainder("doc_id") == HELD, F.lit(False))
    return docs.select("doc_id", held.alias("held_out"), "text").mapInArrow(
        lambda batches: _scored(batches, shared), f"doc_id {kind}, held_out boolean, score double")


def classify(docs, labels, threshold=THRESHOLD, **bounds):
    """One row per row of docs: doc_id, held_out, score, predicted (1 if score >= threshold).

    Null texts score as empty ones. A null doc_id is never a training row. Labels other than 0 and
    1, null labels and labels of unknown documents are ignored; without labels every score is
    one half. Repeated rows score alike; other columns are ignored; an empty table gives no rows.
    """
    found = score(docs, fit(docs, labels, **bounds))
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs, labels, threshold=THRESHOLD, **bounds):
    """The rows of docs that the classifier does not reject, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, **bounds))

    def kept(batches):
        for whole in batches:
            for batch in sliced(whole, "text", 4 << 20):
                windows, starts = chunked(raw_bytes(batch["text"]))
                found = probability(shared.value, pooled(
                    activations(shared.value, windows)[0], starts))
                if (good := found >= threshold).any():
                    yield batch.filter(pa.array(good))

    return docs.mapInArrow(kept, docs.schema)
