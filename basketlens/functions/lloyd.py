"""K-means of many models at once: one pass over the rows serves every k and every start.

Tasks hold a batch of rows and the centres of all models in numpy arrays and emit one row per centre
and task; Spark adds them up, and only one row per centre reaches the driver.
"""

import sys
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# These functions travel by value, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rounds of oversampling, and rows drawn per round as a multiple of k.
SEED_ROUNDS, OVERSAMPLE = 3, 2
#: A model is settled when no centre moves farther than this.
TOLERANCE = 3e-5
#: A start is given up when so many passes of its last gain would not reach the best of its k.
PATIENCE = 30
SAMPLE, BLOCK_ROWS = 25000, 2500
HASH = "_row_hash"


def _rows(batch, columns):
    return np.column_stack([batch[c].to_numpy(zero_copy_only=False) for c in columns]).astype(float)


def _distances(rows, centres):
    """Squared distances, rows by centres."""
    found = (rows ** 2).sum(1)[:, None] - 2 * rows @ centres.T + (centres ** 2).sum(1)
    return np.maximum(found, 0.0, out=found)


def _uniform(hashes, salt):
    """Numbers in (0, 1) from 64-bit hashes, the same for one row and salt on every run."""
    x = hashes.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) % (1 << 64))
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return ((x ^ x >> np.uint64(31)) >> np.uint64(11)).astype(float) / (1 << 53) + 2.0 ** -54


def _draw(batches, columns, models, sizes, salt):
    """The rows of a task that have the smallest of exponential keys whose rate is the squared distance
    to the nearest candidate; the smallest of all tasks are a sample weighted by that distance."""
    kept = [(np.empty(0), np.empty((0, len(columns)))) for _ in models]
    for batch in batches:
        rows, hashes = _rows(batch, columns), batch[HASH].to_numpy()
        for i, (candidates, size) in enumerate(zip(models, sizes)):
            near = _distances(rows, candidates).min(1) if len(candidates) else np.ones(len(rows))
            with np.errstate(divide="ignore"):
                keys = -np.log(_uniform(hashes, salt * 1009 + i)) / near
            keys = np.concatenate([kept[i][0], keys])
            order = np.argsort(keys, kind="stable")[:size]
            order = order[np.isfinite(keys[order])]
            kept[i] = keys[order], np.concatenate([kept[i][1], rows])[order]
    for i, (keys, rows) in enumerate(kept):
        yield pa.RecordBatch.from_pydict({
            "model": pa.array([i] * len(keys), pa.int32()), "key": keys,
            "row": pa.array(rows.tolist(), pa.list_(pa.float64()))})


def _sums(batches, columns, centres, starts):
    """Per centre: rows nearest to it in its model, their sums, squared norms and squared distances."""
    ends = [*starts[1:], len(centres)]
    total = np.zeros((len(centres), len(columns) + 3))
    for batch in batches:
        rows = _rows(batch, columns)
        squares = (rows ** 2).sum(1)
        distances = np.ascontiguousarray(_distances(rows, centres).T)
        nearest, least = [], []
        for a, b in zip(starts, ends):
            near, low = np.full(len(rows), a), distances[a].copy()
            for c in range(a + 1, b):
                closer = distances[c] < low
                near[closer] = c
                np.minimum(low, distances[c], out=low)
            nearest.append(near)
            least.append(low)
        nearest = np.concatenate(nearest)
        parts = [*([part] * len(starts) for part in (np.ones(len(rows)), *rows.T, squares)), least]
        total += np.column_stack([np.bincount(nearest, np.concatenate(part), len(centres))
                                  for part in parts])
    yield pa.RecordBatch.from_pydict({
        "centre": pa.array(np.arange(len(centres)), pa.int32()),
        **{f"v{i}": total[:, i] for i in range(total.shape[1])}})


def centre_sums(data, columns, models):
    """Sums of every centre of ``models`` (arrays of centres), as one array per model: count, sums of
    the columns, of squared norms and of squared distances."""
    starts = np.cumsum([0] + [len(m) for m in models])[:-1].tolist()
    values = [f"v{i}" for i in range(len(columns) + 3)]
    found = data.mapInArrow(
        partial(_sums, columns=columns, centres=np.concatenate(models), starts=starts),
        "centre int, " + ", ".join(f"{v} double" for v in values)).groupBy("centre").agg(
        *[F.sum(v).alias(v) for v in values]).collect()
    total = np.zeros((sum(map(len, models)), len(values)))
    for row in found:
        total[row["centre"]] = row[1:]
    return [total[a:a + len(m)] for a, m in zip(starts, models)]


def _reduced(candidates, weights, k, rng):
    """k centres of weighted candidates: spread by squared distance, then moved to their means."""
    if not len(candidates):
        return np.zeros((k, candidates.shape[1]))
    chosen = [rng.choice(len(candidates), p=weights / weights.sum())]
    while len(chosen) < k:
        near = _distances(candidates, candidates[chosen]).min(1) * weights
        chosen.append(rng.choice(len(candidates), p=near / near.sum()) if near.sum() > 0 else chosen[0])
    centres = candidates[chosen].copy()
    for _ in range(20):
        nearest = _distances(candidates, centres).argmin(1)
        for i in range(k):
            held = weights * (nearest == i)
            if held.sum() > 0:
                centres[i] = held @ candidates / held.sum()
    return centres


def seeds(data, columns, ks, seed):
    """First centres of one model per entry of ``ks``, from rows oversampled in passes over the data."""
    models = [np.empty((0, len(columns))) for _ in ks]
    for step in range(SEED_ROUNDS + 1):
        sizes = [OVERSAMPLE * k if step else 1 for k in ks]
        drawn = data.mapInArrow(
            partial(_draw, columns=columns, models=models, sizes=sizes, salt=seed + step),
            "model int, key double, row array<double>")
        place = F.row_number().over(W.partitionBy("model").orderBy("key"))
        found = drawn.withColumn("place", place).where(
            F.col("place") <= F.array(*map(F.lit, sizes))[F.col("model")]).collect()
        for row in sorted(found, key=lambda r: (r["model"], r["place"])):
            models[row["model"]] = np.vstack([models[row["model"]], row["row"]])
    weights = [s[:, 0] for s in centre_sums(data, columns, [m if len(m) else np.zeros((1, len(columns)))
                                                            for m in models])]
    return [_reduced(m, w[:len(m)], k, np.random.default_rng(seed + i))
            for i, (m, w, k) in enumerate(zip(models, weights, ks))]


def fit(data, columns, ks, max_iter=300, seed=42):
    """(centres, inertia) of one model per entry of ``ks``; equal entries are different starts.

    Every pass moves all models that are neither settled nor hopeless beside another start of their k.
    """
    models = seeds(data, columns, ks, seed)
    inertia, open_ = [float("inf")] * len(ks), list(range(len(ks)))
    for _ in range(max_iter):
        sums, moving = centre_sums(data, columns, [models[i] for i in open_]), []
        gains = {}
        for i, s in zip(open_, sums):
            before, inertia[i] = inertia[i], float(s[:, -1].sum())
            gains[i] = before - inertia[i]
            filled = s[:, 0] > 0
            fresh = models[i].copy()
            fresh[filled] = s[filled, 1:-2] / s[filled, :1]
            if ((fresh - models[i]) ** 2).sum(1).max() > TOLERANCE ** 2:
                models[i] = fresh
                moving.append(i)
        best = {k: min(x for j, x in zip(ks, inertia) if j == k) for k in set(ks)}
        open_ = [i for i in moving if inertia[i] - PATIENCE * gains[i] <= best[ks[i]]]
        if not open_:
            break
    return list(zip(models, inertia))


def best_by_k(data, columns, ks, n_init, max_iter=300, seed=42):
    """(centres, inertia) of the cheapest of ``n_init`` starts for every k."""
    runs = [k for k in ks for _ in range(n_init)]
    best = {}
    for k, model in zip(runs, fit(data, columns, runs, max_iter, seed)):
        if k not in best or model[1] < best[k][1]:
            best[k] = model
    return best


def _mean_silhouette(own, other):
    """Sum of (b - a) / max(a, b) over rows; 0 where both are 0 or the row is alone."""
    top = np.maximum(own, other)
    alone = ~np.isfinite(own) | ~np.isfinite(other) | (top <= 0)
    return float(np.where(alone, 0.0, (other - own) / np.where(alone, 1.0, top)).sum())


def _scores(found, models):
    """Scores in the order of the models; None where there are no rows."""
    scores = {row["model"]: row["score"] for row in found}
    return [scores.get(i) for i in range(len(models))]


def _squared_silhouettes(batches, columns, models, sums):
    scores, count = np.zeros(len(models)), 0
    for batch in batches:
        rows = _rows(batch, columns)
        norms, at = (rows ** 2).sum(1), np.arange(len(rows))
        count += len(rows)
        for i, (centres, s) in enumerate(zip(models, sums)):
            n = s[:, 0]
            with np.errstate(divide="ignore", invalid="ignore"):
                mean = norms[:, None] - 2 * rows @ (s[:, 1:-2] / n[:, None]).T + s[:, -2] / n
                near = _distances(rows, centres).argmin(1)
                own = mean[at, near] * n[near] / (n[near] - 1)
            mean[at, near] = np.inf
            scores[i] += _mean_silhouette(own, np.where(n > 0, mean, np.inf).min(1))
    yield pa.RecordBatch.from_pydict({"model": pa.array(np.arange(len(models)), pa.int32()),
                                      "score": scores, "n": [count] * len(models)})


def squared_silhouettes(data, columns, models):
    """Mean silhouette with squared distances over all rows, per model: sums per centre suffice."""
    sums = centre_sums(data, columns, models)
    found = data.mapInArrow(partial(_squared_silhouettes, columns=columns, models=models, sums=sums),
                            "model int, score double, n long").groupBy("model").agg(
        F.try_divide(F.sum("score"), F.sum("n").cast("double")).alias("score")).collect()
    return _scores(found, models)


def _block_pairs(batches, columns, models):
    """Distance sums of the rows of one block to the clusters of another, for each pair of blocks."""
    held = None
    for batch in batches:
        fresh = pa.Table.from_batches([batch])
        held = fresh if held is None else pa.concat_tables([held, fresh])
        pair = held["pair"].to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(pair)) + 1)]
        for a, b in zip(cuts, cuts[1:]):
            yield from _one_pair(held.slice(a, b - a), columns, models)
        held = held.slice(cuts[-1])
    if held is not None and len(held):
        yield from _one_pair(held, columns, models)


def _one_pair(table, columns, models):
    left = table["side"].to_numpy() == 0
    rows, numbers = _rows(table, columns), table["number"].to_numpy()
    distance = np.sqrt(_distances(rows[left], rows[~left]))
    # The difference of large squares must not give a row a distance to itself.
    distance[numbers[left][:, None] == numbers[~left]] = 0.0
    sums, counts = [], []
    for centres in models:
        member = np.eye(len(centres))[_distances(rows[~left], centres).argmin(1)]
        sums.append(distance @ member)
        counts.append(np.broadcast_to(member.sum(0), sums[-1].shape))
    yield pa.RecordBatch.from_pydict({
        "number": numbers[left], "sums": pa.array(np.hstack(sums).tolist(), pa.list_(pa.float64())),
        "counts": pa.array(np.hstack(counts).tolist(), pa.list_(pa.float64()))})


def euclidean_silhouettes(sample, columns, models, block_rows=BLOCK_ROWS):
    """Mean silhouette with plain distances, per model, exact over all pairs of ``sample``.

    The rows are hashed into blocks; a task takes a pair of blocks, so that no task holds more than two,
    and Spark adds up each row's sums over the blocks.
    """
    numbered = sample.withColumns({"number": F.monotonically_increasing_id()})
    numbered = numbered.select("number", *columns).persist()
    try:
        blocks = max(1, -(-numbered.count() // block_rows))
        block = F.pmod(F.xxhash64("number"), F.lit(blocks)).cast("int")
        others = F.sequence(F.lit(0), F.lit(blocks - 1))
        sides = numbered.withColumn("block", block)
        left = sides.select("number", *columns, F.lit(0).alias("side"), F.explode(F.transform(
            others, lambda o: F.col("block") * blocks + o)).alias("pair"))
        right = sides.select("number", *columns, F.lit(1).alias("side"), F.explode(F.transform(
            others, lambda o: o * blocks + F.col("block"))).alias("pair"))
        pairs = left.unionByName(right).repartition(
            min(blocks * blocks, 200), "pair").sortWithinPartitions("pair")
        width = sum(map(len, models))
        own = [F.sum(F.col(n)[i]).alias(f"{n[0]}{i}") for i in range(width) for n in ("sums", "counts")]
        summed = pairs.mapInArrow(partial(_block_pairs, columns=columns, models=models),
                                  "number long, sums array<double>, counts array<double>").groupBy(
            "number").agg(*own).join(numbered, "number")
        found = summed.mapInArrow(
            partial(_silhouettes, columns=columns, models=models), "model int, score double, n long"
        ).groupBy("model").agg(F.try_divide(F.sum("score"), F.sum("n").cast("double")).alias("score")
                               ).collect()
    finally:
        numbered.unpersist()
    return _scores(found, models)


def _silhouettes(batches, columns, models):
    scores, count = np.zeros(len(models)), 0
    for batch in batches:
        rows, start = _rows(batch, columns), 0
        count += len(rows)
        for i, centres in enumerate(models):
            span, at = range(start, start + len(centres)), np.arange(len(rows))
            start += len(centres)
            sums, n = (_rows(batch, [f"{c}{j}" for j in span]) for c in "sc")
            near = _distances(rows, centres).argmin(1)
            with np.errstate(divide="ignore", invalid="ignore"):
                own = sums[at, near] / (n[at, near] - 1)
                mean = np.where(n > 0, sums / n, np.inf)
            mean[at, near] = np.inf
            scores[i] += _mean_silhouette(own, mean.min(1))
    yield pa.RecordBatch.from_pydict({"model": pa.array(np.arange(len(models)), pa.int32()),
                                      "score": scores, "n": [count] * len(models)})
