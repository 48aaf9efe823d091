"""Mixing sources to target weights: hash-random order, prefix sums, a cut at each source's budget.

Rows with a null text or without words have size 0 and take nothing. Sources are ordered by code
point with null last, and a null source is a source of its own. Repeated rows count one by one; rows
that are alike in id and text may swap places, which changes no row of the result. An empty table
gives an empty result. Only the columns named in ``keep`` are carried along, so other columns may
have any name.
"""

from pyspark.sql import functions as F

from basketlens.functions.prefix import running_totals
from basketlens.llm.common import ranged, written

#: Weights of the sources in their order, repeating; words taken in all as a share of all words; and
#: how often at most a document may be taken.
WEIGHTS, SHARE, EPOCHS = (5, 2, 1), 1.5, 2
BLANK = r"\x20\x09-\x0D"
RESULT = ["size", "source_size", "target", "taken"]


def word_count(text):
    """Number of words in a text; 0 for null. No array of them is built."""
    words = F.length(F.regexp_replace(text, f"[{BLANK}]*[^{BLANK}]+[{BLANK}]*", "x"))
    return F.when(text.rlike(f"[^{BLANK}]"), words).otherwise(0).cast("long")


def random_key(docs):
    """128 random bits from id and text, the same in any SQL engine."""
    return F.md5(F.concat(F.coalesce(docs["doc_id"].cast("string"), F.lit("")), F.lit(":"),
                          F.coalesce(docs["text"], F.lit(""))))


def targets(sizes, weights=WEIGHTS, share=SHARE, epochs=EPOCHS):
    """(named, source_size, target) of ``sizes`` (named, source_size).

    All targets are one level times the weight, but not above ``epochs`` times the source. With the
    sources ordered by the level at which they are full, the level that uses up the words is the
    greatest of (words left over by the full ones) / (weights of the others). The sources may be
    many: their order, and the sums along it, are spread over tasks.
    """
    total = sizes.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * share
    order = running_totals(ranged(sizes, ["named"], "sources"), [], "part", ["named"],
                           {"rank": F.lit(1)})
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    placed = order.select("named", "source_size", "rank", weight.alias("weight")).withColumn(
        "full_at", epochs * F.col("source_size") / F.col("weight"))
    along = written(running_totals(
        ranged(placed, ["full_at", "rank"], "filling"), [], "part", ["full_at", "rank"],
        {"size_upto": F.col("source_size"), "weight_upto": F.col("weight")}), "levels")
    weights_sum = along.agg(F.sum("weight")).first()[0] or 1.0
    rest = weights_sum - (F.col("weight_upto") - F.col("weight"))
    left = F.lit(float(total)) - epochs * (F.col("size_upto") - F.col("source_size"))
    level = along.agg(F.max(left / rest)).first()[0] or 0.0
    return along.select("named", "source_size", F.least(
        (epochs * F.col("source_size")).cast("double"), level * F.col("weight")).alias("target"))


def mix(docs, keep=("doc_id",), weights=WEIGHTS, share=SHARE, epochs=EPOCHS):
    """Rows of ``docs`` (doc_id, text, source) with the words that the mix takes of each.

    A source's budget is its target as a whole number. It is taken by whole epochs over the source and
    then along the random order; the document at the cut gives its first words only, so that the
    budget is met exactly.

    The keys are written with the row's number, which splits many equal rows over the ranges. A
    source's rows lie in consecutive ranges, and only the ranges' sums meet in one task.
    """
    if set(keep) & set(RESULT):
        raise ValueError(f"columns named {RESULT} cannot be kept")
    # '=' comes before '~': a null source is the last one.
    named = F.coalesce(F.concat(F.lit("="), docs["source"]), F.lit("~"))
    rows = written(docs.select(
        *[docs[c] for c in keep], named.alias("_named"), random_key(docs).alias("_key"),
        word_count(docs["text"]).alias("size"), F.monotonically_increasing_id().alias("_row")),
        "mix_keys")
    spread = ranged(rows, ["_named", "_key", "_row"], "mix")
    sizes = spread.groupBy("_named").agg(F.sum("size").alias("source_size"))
    wanted = targets(sizes.withColumnRenamed("_named", "named"), weights, share, epochs)
    budget = F.round("target").cast("long")
    whole = F.coalesce(F.floor(budget / F.expr("nullif(source_size, 0)")), F.lit(0))
    wanted = wanted.select(F.col("named").alias("_named"), "source_size", "target",
                           whole.alias("_whole"),
                           (budget - whole * F.col("source_size")).alias("_rest"))
    placed = running_totals(spread, ["_named"], "part", ["_key", "_row"],
                            {"_upto": F.col("size")}).join(wanted, "_named")
    cut = F.greatest(F.lit(0), F.least(
        F.col("size"), F.col("_rest") - (F.col("_upto") - F.col("size"))))
    return placed.select(*keep, "size", "source_size", "target",
                         (F.col("_whole") * F.col("size") + cut).cast("long").alias("taken"))


def corpus(docs, **options):
    """The mixed corpus: (doc_id, source, epoch, text), a document once per epoch that takes it.

    The document at its source's cut has its first words, with the blanks before them.
    """
    taken = mix(docs, keep=("doc_id", "source", "text"), **options).where("taken > 0")
    last = F.ceil(F.col("taken") / F.col("size"))
    some = F.col("taken") - F.col("size") * (F.col("epoch") - 1)
    head = F.array_join(F.slice(F.regexp_extract_all(
        "text", F.lit(f"[{BLANK}]*[^{BLANK}]+"), F.lit(0)), F.lit(1), some.cast("int")), "")
    return taken.withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), last))).select(
        "doc_id", "source", "epoch",
        F.when(some >= F.col("size"), F.col("text")).otherwise(head).alias("text"))
