"""Log-bilinear language model over word classes, trained by noise-contrastive estimation.

A token's probability is that of its class after the two classes before it, times that of the word
within its class. Frequent words and the end are classes of their own; all other words fall into
classes by their first two bytes and last byte, so that unseen words have one too.
"""

import math
import zlib
from collections import Counter
from functools import partial
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from basketlens.llm.common import raw_bytes, sliced, words, written

#: Words with a class of their own, and those whose counts every task holds (a bound, not a cut:
#: all other counts are joined).
HEAD, HOT = 160, 200_000
PREFIXES, ENDINGS = 16, 5
SHAPES = PREFIXES * ENDINGS
CLASSES = HEAD + SHAPES + 1
END, START = CLASSES - 1, CLASSES
CONTEXTS = CLASSES + 1
#: Training: vector length, steps, pairs in a step, noise samples.
VECTOR, STEPS, PAIRS, NOISE = 32, 2500, 2048, 96
FOLDS, HELD = 5, 1
#: Distinct words a task counts or remembers at once.
MEMORY = 200_000


def shape(word):
    """Class number of a word by its form: kind of its last byte, and a hash of its first two."""
    last = word[-1:]
    kind = (0 if last == b"!" else 1 if last in (b"$", b"%", b"#", b"&", b"*")
            else 2 if last == b"." else 3 if not last.isalnum() and last < b"\x80" else 4)
    return kind * PREFIXES + zlib.crc32(word[:2]) % PREFIXES


class _Numbers(dict):
    """Number of each word; words not listed get ``base`` plus their shape."""

    def __init__(self, listed, base):
        super().__init__(listed)
        self.listed, self.base = listed, base

    def __missing__(self, word):
        if len(self) > len(self.listed) + MEMORY:
            self.clear()
            self.update(self.listed)
        self[word] = number = self.base + shape(word)
        return number


# --- corpus counts --------------------------------------------------------------------------------

def _counted(batches):
    """(token, shape, n) of a partition; the end is the empty token."""
    def packed(found):
        keys = list(found)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array([shape(w) for w in keys], pa.int32()),
             pa.array(found.values(), pa.int64())], ["token", "shape", "n"])

    found = Counter()
    for batch in batches:
        for text in raw_bytes(batch["text"]):
            found.update(words(text))
            found[b""] += 1
            if len(found) > MEMORY:
                yield packed(found)
                found = Counter()
    if found:
        yield packed(found)


def _sequence(texts, numbers, end):
    """Numbers of all tokens of the texts, one after the other, and their counts."""
    flat, sizes, lists = [], [], []
    for text in texts:
        found = words(text)
        flat.extend(map(numbers.__getitem__, found))
        flat.append(end)
        sizes.append(len(found) + 1)
        lists.append(found)
    return np.array(flat, np.int64), np.array(sizes, np.int64), lists


def _contexts(classes, sizes):
    """The classes one and two tokens before, START before a text."""
    starts = np.cumsum(sizes) - sizes
    one = np.concatenate(([START], classes[:-1]))
    one[starts] = START
    two = np.concatenate(([START], one[:-1]))
    two[starts] = START
    return one, two


def _trigrams(batches, head):
    """Counts of (class two before, class before, class) of a partition, as one number."""
    numbers = _Numbers({w: i for i, w in enumerate(head)}, HEAD)
    held = None
    for whole in batches:
        for batch in sliced(whole, "text", 4 << 20):
            classes, sizes, _ = _sequence(raw_bytes(batch["text"]), numbers, END)
            one, two = _contexts(classes, sizes)
            key = (two * CONTEXTS + one) * CONTEXTS + classes
            if held is None:
                held = np.zeros(CONTEXTS ** 3, np.int32)
            np.add.at(held, key, np.int32(1))
    if held is not None:
        key = np.flatnonzero(held)
        for part in range(0, len(key), 500_000):
            some = key[part:part + 500_000]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some].astype(np.int64))], ["key", "n"])


# --- model ----------------------------------------------------------------------------------------

def train(keys, counts, steps=STEPS, seed=1):
    """Vectors fitted by noise-contrastive estimation on counted class trigrams.

    Pairs are drawn in proportion to their counts; noise follows the class frequencies and is
    shared by the pairs of a step, so that scores are matrix products.
    """
    rng = np.random.default_rng(seed)
    weights = {
        "context": rng.normal(0, 0.1, (CONTEXTS, VECTOR)), "one": np.eye(VECTOR) * 0.7,
        "two": np.eye(VECTOR) * 0.3, "target": rng.normal(0, 0.1, (CLASSES, VECTOR)),
        "bias": np.zeros(CLASSES)}
    weights = {k: v.astype(np.float32) for k, v in weights.items()}
    if not len(keys):
        return weights
    order = np.argsort(keys)
    keys, total = keys[order], np.cumsum(counts[order])
    noise = np.bincount(keys % CONTEXTS, counts[order], CLASSES)[:CLASSES] + 0.5
    noise /= noise.sum()
    log_noise, noise_edges = np.log(NOISE * noise).astype(np.float32), np.cumsum(noise)
    weights["bias"] = np.log(noise).astype(np.float32)
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    for step in range(1, steps + 1):
        pick = keys[np.searchsorted(total, rng.random(PAIRS) * total[-1], side="right")]
        target, one, two = pick % CONTEXTS, pick // CONTEXTS % CONTEXTS, pick // CONTEXTS ** 2
        other = np.minimum(np.searchsorted(noise_edges, rng.random(NOISE)), CLASSES - 1)
        v1, v2 = weights["context"][one], weights["context"][two]
        query = v1 @ weights["one"] + v2 @ weights["two"]
        real = (query * weights["target"][target]).sum(1) + weights["bias"][target]
        false = query @ weights["target"][other].T + weights["bias"][other]
        # Gradients of the logistic loss that tells data from noise.
        d_real = (1 / (1 + np.exp(log_noise[target] - real)) - 1) / PAIRS
        d_false = 1 / (1 + np.exp(np.clip(log_noise[other] - false, -60, 60))) / PAIRS
        d_query = d_real[:, None] * weights["target"][target] + d_false @ weights["target"][other]
        gradient = {k: np.zeros_like(v) for k, v in weights.items()}
        np.add.at(gradient["target"], target, d_real[:, None] * query)
        np.add.at(gradient["target"], other, d_false.T @ query)
        np.add.at(gradient["bias"], target, d_real)
        np.add.at(gradient["bias"], other, d_false.sum(0))
        gradient["one"], gradient["two"] = v1.T @ d_query, v2.T @ d_query
        np.add.at(gradient["context"], one, d_query @ weights["one"].T)
        np.add.at(gradient["context"], two, d_query @ weights["two"].T)
        rate = 0.01 * (1 - step / (steps + 1))
        for k, g in gradient.items():
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.001 * (g * g - second[k])
            weights[k] -= (rate * (first[k] / (1 - 0.9 ** step))
                           / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-9)).astype(np.float32)
    return weights


def log_probabilities(weights):
    """log10 P(class | two before, before), normalised, for all contexts at once."""
    one = weights["context"] @ weights["one"]
    two = weights["context"] @ weights["two"]
    out = np.empty((CONTEXTS, CONTEXTS, CLASSES), np.float32)
    for i in range(CONTEXTS):
        score = (one + two[i]) @ weights["target"].T + weights["bias"]
        score -= score.max(axis=1, keepdims=True)
        out[i] = score - np.log(np.exp(score).sum(axis=1, keepdims=True))
    out /= np.float32(math.log(10))
    return out


def _scored(batches, shared):
    """Sums of a partition's texts over tokens that every task knows, and the other tokens."""
    model = shared.value
    listed, counts, below = model["listed"], model["counts"], model["below"]
    classes = np.concatenate((model["classes"], HEAD + np.arange(SHAPES), [END]))
    logs = np.concatenate((np.log10(counts + 0.5), np.zeros(SHAPES),
                           [math.log10(model["ends"] + 0.5)]))
    known = np.concatenate((counts > 0, np.zeros(SHAPES, bool), [model["ends"] > 0]))
    end = len(counts) + SHAPES
    numbers = _Numbers({w: i for i, w in enumerate(listed)}, len(counts))
    table = log_probabilities(model["weights"])
    context = TaskContext.get()
    row = (context.partitionId() if context else 0) << 40
    for whole in batches:
        for batch in sliced(whole, "text", 4 << 20):
            number, sizes, lists = _sequence(raw_bytes(batch["text"]), numbers, end)
            kind = classes[number]
            one, two = _contexts(kind, sizes)
            starts = np.cumsum(sizes) - sizes
            model_part = table[two, one, kind].astype(np.float64) - below[kind]
            cold = (number >= len(counts)) & (number < end)
            offsets, tokens, times = [0], [], []
            for start, found in zip(starts.tolist(), lists):
                own = Counter([found[i] for i in
                               np.flatnonzero(cold[start:start + len(found)]).tolist()])
                tokens.extend(own)
                times.extend(own.values())
                offsets.append(len(tokens))
            rare = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(tokens, pa.binary()), pa.array(times, pa.int32())], ["token", "times"]))
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + n)), batch["doc_id"], batch["held_out"],
                 pa.array(sizes), pa.array(np.add.reduceat(known[number].astype(np.int64), starts)),
                 pa.array(np.add.reduceat(logs[number], starts)),
                 pa.array(np.add.reduceat(model_part, starts)), rare],
                ["row", "doc_id", "held_out", "n_tokens", "n_known", "logs", "model", "rare"])
            row += n


def _split(docs):
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS))
    return docs.select("doc_id", "text",
                       F.coalesce(remainder == HELD, F.lit(False)).alias("held_out"))


def fit(docs, hot=HOT, steps=STEPS):
    """(token counts, model) learned from all rows of the training folds.

    Counts are summed in tasks and then by key; the driver receives at most ``hot`` words, the class
    totals and the class trigrams (bounded by the number of classes, not by the corpus).
    """
    training = _split(docs).where("not held_out").select("text")
    counts = written(training.mapInArrow(_counted, "token binary, shape int, n long").groupBy(
        "token", "shape").agg(F.sum("n").alias("n")), "tokens")
    size, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    words_only = counts.where(F.octet_length("token") > 0)
    # The lowest count whose words, with all more frequent ones, stay within the bound.
    band = F.floor(F.log2("n") * 16)
    bands = sorted(words_only.groupBy(band.alias("band")).count().collect(), reverse=True)
    least = next((b for (b, _), total in zip(bands, accumulate(b[1] for b in bands))
                  if total > hot), -1)
    top = words_only.where(band > least).select("token", "shape", "n").toArrow().to_pydict()
    order = sorted(range(len(top["n"])), key=lambda i: (-top["n"][i], top["token"][i]))
    listed = [top["token"][i] for i in order]
    numbers = np.array([top["n"][i] for i in order], np.int64)
    shapes = np.array([top["shape"][i] for i in order], np.int64)
    head = listed[:HEAD]
    classes = HEAD + shapes
    classes[:HEAD] = np.arange(len(head))
    ends = next((r["n"] for r in counts.where(F.octet_length("token") == 0).collect()), 0)
    # Denominators of words within their class; a class of one word has probability 1 within.
    mass, many = np.zeros(SHAPES), np.zeros(SHAPES)
    for s, n, k in words_only.groupBy("shape").agg(F.sum("n"), F.count("*")).collect():
        mass[s], many[s] = n, k
    np.subtract.at(mass, shapes[:HEAD], numbers[:HEAD])
    np.subtract.at(many, shapes[:HEAD], 1)
    below = np.ones(CLASSES)
    below[:len(head)] = numbers[:HEAD] + 0.5
    below[HEAD:END] = mass + 0.5 * (many + 1)
    below[END] = ends + 0.5
    grams = training.mapInArrow(partial(_trigrams, head=head), "key long, n long").groupBy(
        "key").agg(F.sum("n").alias("n")).toArrow()
    weights = train(grams["key"].to_numpy(), grams["n"].to_numpy(), steps)
    return counts, {"listed": listed, "counts": numbers, "classes": classes, "ends": ends,
                    "below": np.log10(below), "weights": weights, "size": size, "kinds": kinds}


def score(docs, hot=HOT, steps=STEPS):
    """One row per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A null text counts as empty and consists of the end alone. A null doc_id is in the training
    folds. Repeated rows count and score each on their own; other columns are ignored. Without
    training rows every class is equally likely; an empty table gives an empty result. An unseen
    word is one event of its class, as it is one event of the base.
    """
    counts, model = fit(docs, hot, steps)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = written(_split(docs).mapInArrow(
        partial(_scored, shared=shared),
        f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, logs double, "
        "model double, rare array<struct<token: binary, times: int>>"), "scored")
    rare = parts.select("row", F.inline("rare")).join(counts.select("token", "n"), "token", "left")
    sums = rare.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("rare_logs"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"))
    logs = F.col("logs") + F.coalesce("rare_logs", F.lit(0.0))
    size, kinds = model["size"], model["kinds"]
    return parts.drop("rare").join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(size).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * math.log10(size + 0.5 * (kinds + 1))).alias("base_score"),
        (logs + F.col("model")).alias("score"))
