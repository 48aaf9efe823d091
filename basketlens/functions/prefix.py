"""Running totals, exact quantiles and samples whose groups may be of any size.

A window over one key puts that key's rows into one task. The functions here cut a key
into chunks along the ordering, window inside each chunk, and carry the chunks' totals
forward. Only the totals (one row per key and chunk) ever meet in one task.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Cells of a key by quantiles, and cells of hashed scores by width.
CELLS, HASH_CELLS = 128, 65536


def running_totals(df, keys, chunk, order, totals):
    """Add running sums per ``keys`` along (``chunk``, ``order``), current row included.

    ``chunk`` is a column that never decreases along the ordering and ``totals`` maps an
    output name to the value column to add up. Chunks should be small enough for one task.
    """
    inside = (W.partitionBy(*keys, chunk).orderBy(*order)
              .rowsBetween(W.unboundedPreceding, W.currentRow))
    before = W.partitionBy(*keys).orderBy(chunk).rowsBetween(W.unboundedPreceding, -1)
    sums = df.groupBy(*keys, chunk).agg(
        *[F.sum(value).alias(f"_{name}_sum") for name, value in totals.items()])
    offsets = sums.select(*keys, chunk, *[
        F.coalesce(F.sum(f"_{name}_sum").over(before), F.lit(0)).alias(f"_{name}_before")
        for name in totals])
    local = df.select("*", *[F.sum(value).over(inside).alias(f"_{name}_local")
                             for name, value in totals.items()])
    joined = local.join(offsets, [*keys, chunk])
    return joined.select(*df.columns, *[
        (F.col(f"_{name}_local") + F.col(f"_{name}_before")).alias(name) for name in totals])


def with_cells(df, keys, value, cells=CELLS):
    """Add ``_cell``: between which of a key's cut points the value lies.

    The cut points are approximate quantiles of the given rows, so that cells hold about equally
    many of them however the values are spread. Equal values share a cell, cells rise with values.
    """
    if cells < 2:
        return df.withColumn("_cell", F.lit(0))
    shares = F.array(*[F.lit(i / cells) for i in range(1, cells)])
    cuts = F.array_distinct(F.percentile_approx(F.col(value).cast("double"), shares, 10 * cells))
    if keys:
        placed = df.join(df.groupBy(*keys).agg(cuts.alias("_cuts")), keys)
    else:
        placed = df.withColumn("_cuts", df.agg(cuts.alias("_cuts")).scalar())
    below = F.filter("_cuts", lambda c: c < F.col(value))
    return placed.withColumn("_cell", F.size(below)).drop("_cuts")


def exact_quantiles(df, keys, value, probs, cells=CELLS):
    """Exact, linearly interpolated quantiles: one row per key and probability.

    Values are counted first, so copies of one value cost one row. The cell counts locate
    the wanted ranks, and only the cells that hold them are ordered.
    """
    counts = (df.filter(F.col(value).isNotNull())
              .select(*keys, F.col(value).cast("double").alias("_v"))
              .groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n")))
    placed = with_cells(counts, keys, "_v", cells).select(*keys, "_v", "_n", "_cell")
    per_cell = placed.groupBy(*keys, "_cell").agg(F.sum("_n").alias("_cell_n"))
    along = W.partitionBy(*(keys or [F.lit(0)])).orderBy("_cell")
    ranked = per_cell.select(
        *keys, "_cell",
        (F.sum("_cell_n").over(along) - F.col("_cell_n")).alias("_start"),
        F.sum("_cell_n").over(along).alias("_end"),
        F.sum("_cell_n").over(W.partitionBy(*(keys or [F.lit(0)]))).alias("_total"))
    wanted = (ranked
              .withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
              .withColumn("_pos", F.col("prob") * (F.col("_total") - 1))
              .withColumn("_rank", F.explode(F.array_distinct(
                  F.array(F.floor("_pos"), F.ceil("_pos")))))
              .filter((F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_end")))
              .select(*keys, "_cell", "prob", "_pos", "_rank", "_start"))
    near = placed.join(wanted.select(*keys, "_cell").distinct(), [*keys, "_cell"], "left_semi")
    inside = W.partitionBy(*keys, "_cell").orderBy("_v")
    spans = near.select(*keys, "_cell", "_v",
                        (F.sum("_n").over(inside) - F.col("_n")).alias("_from"),
                        F.sum("_n").over(inside).alias("_to"))
    local = F.col("_rank") - F.col("_start")
    hits = (wanted.join(spans, [*keys, "_cell"])
            .filter((local >= F.col("_from")) & (local < F.col("_to"))))
    weight = F.when(F.col("_rank") == F.floor("_pos"),
                    1 - (F.col("_pos") - F.floor("_pos"))).otherwise(
                        F.col("_pos") - F.floor("_pos"))
    return hits.groupBy(*keys, "prob").agg(F.sum(F.col("_v") * weight).alias("quantile"))


def smallest_n(df, score, n, tiebreak, cells=HASH_CELLS):
    """The ``n`` rows with the smallest score in [0, 1), without gathering them in one task.

    Cell counts find the cell where row ``n`` falls; cells below it are kept whole and only
    that cell is ordered. That cell is a scalar subquery, so that the rows are filtered where they
    are read, and none that is not drawn is shuffled or joined.
    """
    placed = df.withColumn("_score", score).withColumn("_cell", F.floor(F.col("_score") * cells))
    per_cell = placed.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n"))
    along = W.partitionBy(F.lit(0)).orderBy("_cell")
    last = (per_cell
            .select("_cell", "_n", (F.sum("_n").over(along) - F.col("_n")).alias("_start"))
            .filter(F.col("_start") < n)
            .agg(F.max(F.struct("_cell", (F.col("_start") + F.col("_n") <= n).alias("_whole"),
                                (F.lit(n) - F.col("_start")).alias("_take")))).scalar())
    on_edge = (F.col("_cell") == last["_cell"]) & ~last["_whole"]
    whole = placed.filter((F.col("_cell") <= last["_cell"]) & ~on_edge).select(*df.columns)
    edge = (placed.filter(on_edge)
            .withColumn("_rn", F.row_number().over(
                W.partitionBy("_cell").orderBy("_score", *tiebreak)))
            .filter(F.col("_rn") <= last["_take"]).select(*df.columns))
    return whole.unionByName(edge)


def quantile_sketches(df, keys, value, k=400):
    """One mergeable sketch of ``value`` per key, to be stored beside a table and merged later (AG8).

    The rank error grows as 1 / k and does not depend on the number of rows.
    """
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"))


def sketched_quantiles(sketches, probs):
    """Approximate quantiles of all rows behind ``sketches``: one row per probability."""
    whole = sketches.agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    cells = F.array(*[F.struct(F.lit(float(p)).alias("prob"), F.kll_sketch_get_quantile_double(
        F.col("sketch"), F.lit(float(p))).alias("quantile")) for p in probs])
    return whole.where(F.kll_sketch_get_n_double("sketch") > 0).select(F.explode(cells).alias("c")).select(
        "c.prob", "c.quantile")


def rank_errors(df, value, quantiles):
    """How far each quantile's rank among all values is from its probability; 0 where it is among ties."""
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("_v")).agg(
        F.count(F.lit(1)).alias("_n"))
    marks = quantiles.agg(F.array_sort(F.collect_list(F.struct("prob", "quantile"))).alias("m")).scalar()
    # Few probabilities, so each value is counted once per probability in the tasks.
    each = counts.withColumn("_m", F.explode(marks))
    sums = each.groupBy("_m.prob", "_m.quantile").agg(
        F.sum("_n").alias("n"), F.sum(F.when(F.col("_v") < F.col("_m.quantile"), F.col("_n")).otherwise(0)
                                      ).alias("below"),
        F.sum(F.when(F.col("_v") <= F.col("_m.quantile"), F.col("_n")).otherwise(0)).alias("upto"))
    return sums.select("prob", "quantile", "n", F.greatest(
        F.lit(0.0), F.col("below") / F.col("n") - F.col("prob"),
        F.col("prob") - F.col("upto") / F.col("n")).alias("rank_error"))
