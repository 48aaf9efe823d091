"""Exact ranking and threshold metrics over scored rows.

Scored frames have ``model``, ``target`` (0 or 1) and ``score`` in [0, 1].
"""

from pyspark.sql import functions as F

from basketlens.functions.prefix import running_totals, with_cells

# The thresholds of the sweep.
THRESHOLDS = (0.10, 0.15, 0.20, 0.25, 0.30, 0.40, 0.50)


def _per_score(scored):
    """Positives and rows per model and distinct score."""
    return scored.groupBy("model", "score").agg(
        F.sum("target").alias("pos"), F.count(F.lit(1)).alias("rows"))


def _from_below(counts):
    """Running totals of the counts by rising score."""
    return running_totals(with_cells(counts, ["model"], "score"), ["model"], "_cell", ["score"],
                          {"pos_upto": F.col("pos"), "rows_upto": F.col("rows")})


def ranking_metrics(scored):
    """ROC-AUC by mid-ranks and average precision by steps, per model.

    Rows are counted per score first. Running totals are carried across quantile cells, so no
    window spans all scores. Both are null where one class is missing.
    """
    counts = _per_score(scored)
    ranked = _from_below(counts)
    totals = counts.groupBy("model").agg(F.sum("pos").alias("all_pos"),
                                         F.sum("rows").alias("all_rows"))
    neg = F.col("rows") - F.col("pos")
    neg_below = (F.col("rows_upto") - F.col("pos_upto")) - neg
    tp = F.col("all_pos") - F.col("pos_upto") + F.col("pos")
    flagged = F.col("all_rows") - F.col("rows_upto") + F.col("rows")
    sums = ranked.join(totals, "model").groupBy("model").agg(
        F.first("all_pos").alias("p"), F.first("all_rows").alias("n"),
        F.sum(F.col("pos") * (neg_below + neg * 0.5)).alias("wins"),
        F.sum(F.col("pos").cast("double") * tp / flagged).alias("steps"))
    both = (F.col("p") > 0) & (F.col("p") < F.col("n"))
    return sums.select(
        "model",
        F.when(both, F.round(F.col("wins") / (F.col("p").cast("double")
                                              * (F.col("n") - F.col("p"))), 4)).alias("roc_auc"),
        F.when(F.col("p") > 0, F.round(F.col("steps") / F.col("p"), 4)).alias("pr_auc"))


def _confusion(flagged, keys):
    hit = F.col("score") >= F.col("threshold")
    yes = F.col("target") == 1

    def tally(condition):
        return F.sum(F.when(condition, 1).otherwise(0))

    counts = flagged.groupBy(*keys, "threshold").agg(
        tally(hit & yes).alias("tp"), tally(hit & ~yes).alias("fp"),
        tally(~hit & yes).alias("fn"), tally(~hit & ~yes).alias("tn"))

    def ratio(above, below):
        return F.round(F.coalesce(F.try_divide(above.cast("double"), below), F.lit(0.0)), 4)

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(*keys, "threshold", ratio(tp, tp + fp).alias("precision"),
                         ratio(tp, tp + fn).alias("recall"),
                         ratio(tp * 2, tp * 2 + fp + fn).alias("f1_score"),
                         "tn", "fp", "fn", "tp")


def threshold_metrics(scored, thresholds):
    """Precision, recall, F1 and the confusion counts per model at its threshold.

    ``thresholds`` maps model names to thresholds, or is one number for all.
    """
    if isinstance(thresholds, dict):
        pairs = [F.lit(x) for kv in thresholds.items() for x in kv]
        at = F.element_at(F.create_map(*pairs), F.col("model"))
    else:
        at = F.lit(float(thresholds))
    return _confusion(scored.withColumn("threshold", at), ["model"])


def threshold_sweep(scored, thresholds=THRESHOLDS):
    """The same metrics at several thresholds (P10).

    Scores are cut into the bands between thresholds and counted, so a row is read once and
    the thresholds multiply a handful of band counts.
    """
    cuts = sorted(float(t) for t in thresholds)
    band = sum([(F.col("score") >= t).cast("int") for t in cuts], F.lit(0))
    bands = scored.groupBy("model", band.alias("band")).agg(
        F.sum("target").alias("pos"), F.count(F.lit(1)).alias("rows"))
    marks = F.explode(F.array(*[F.struct(F.lit(i + 1).alias("at"), F.lit(t).alias("threshold"))
                                for i, t in enumerate(cuts)])).alias("m")
    wide = bands.select("model", "band", "pos", "rows", marks).select(
        "model", "pos", "rows", (F.col("band") >= F.col("m.at")).alias("hit"), "m.threshold")
    counts = wide.groupBy("model", "threshold").agg(
        F.sum(F.when(F.col("hit"), F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("hit"), F.col("rows")).otherwise(0)).alias("flagged"),
        F.sum("pos").alias("p"))

    def ratio(above, below):
        return F.round(F.coalesce(F.try_divide(above.cast("double"), below), F.lit(0.0)), 4)

    return counts.select("model", "threshold",
                         ratio(F.col("tp"), F.col("flagged")).alias("precision"),
                         ratio(F.col("tp"), F.col("p")).alias("recall"),
                         ratio(F.col("tp") * 2, F.col("flagged") + F.col("p")).alias("f1_score"))
