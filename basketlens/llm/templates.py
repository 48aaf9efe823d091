"""Lines whose log template recurs across documents, found by a fixed-depth parse tree.

Only DataFrame functions are used. The tree's levels are a line's token count and its leading
tokens; a leaf's lines are generalised position by position.
"""

from pyspark.sql import functions as F

from basketlens.llm.common import written

#: Documents in which a template recurs, leading tokens of a leaf, and the share of a template's
#: positions that must be constant.
MIN_DOCS, LEADING, MIN_CONSTANT = 10, 3, 0.6
#: From this share of recurring text on, a document is a copy or a form and has no vote.
COPY_SHARE = 0.5
VARIABLE = "<*>"


def parsed(docs):
    """One row per non-blank line: key of its text, number, length, masked line and leaf."""
    key = F.struct("doc_id", F.xxhash64("text").alias("hash"))
    lines = docs.where("text is not null").select(
        key.alias("key"), F.length("text").alias("doc_chars"),
        F.posexplode(F.split("text", "\n")).alias("n", "line"))
    plain = F.trim(F.regexp_replace("line", r"\s+", " "))
    masked = F.when(F.col("plain").rlike(r"\d"),
                    F.regexp_replace("plain", r"\S*\d\S*", VARIABLE)).otherwise(F.col("plain"))
    return lines.withColumn("plain", plain).where("plain <> ''").select(
        "key", "doc_chars", "n", F.length("line").alias("chars"), masked.alias("masked")).withColumns({
            "tokens": F.length("masked") - F.length(F.replace("masked", F.lit(" "))) + 1,
            "lead": F.substring_index("masked", " ", LEADING),
            "line": F.unhex(F.md5("masked"))})


def line_templates(pairs, min_docs):
    """(line, template, constant share) of the distinct masked lines of ``pairs``.

    A position of a leaf is constant for a line if its token stands there in ``min_docs`` documents
    or more; all others are variable fields.
    """
    lines = written(pairs.groupBy("tokens", "lead", "line").agg(
        F.count("*").alias("docs"), F.first("masked").alias("masked")), "lines")
    spots = lines.select("tokens", "lead", "line", "docs",
                         F.posexplode(F.split("masked", " ")).alias("place", "token"))
    leaf = ["tokens", "lead", "place", "token"]
    constant = spots.where(F.col("token") != VARIABLE).groupBy(*leaf).agg(
        F.sum("docs").alias("in_docs")).where(F.col("in_docs") >= min_docs)
    named = spots.select(*leaf, "line").join(constant, leaf, "left").select(
        "line", "place", F.when(F.col("in_docs").isNotNull(), F.col("token")).alias("token"))
    whole = F.array_sort(F.collect_list(F.struct(
        "place", F.coalesce("token", F.lit(VARIABLE)).alias("token"))))
    return named.groupBy("line").agg(
        F.concat_ws(" ", whole["token"]).alias("template"),
        (F.count("token") / F.count("*")).alias("constant"))


def recurring_lines(docs, min_docs=MIN_DOCS, min_constant=MIN_CONSTANT, copy_share=COPY_SHARE):
    """(key, drop): the line numbers of each text whose template recurs across documents."""
    lines = parsed(docs)
    # Written, so that the join deals out both sides anew and a leaf of very many lines is split.
    leaves = written(lines.groupBy("tokens", "lead").agg(F.count("*").alias("n")).where(
        F.col("n") >= min_docs).select("tokens", "lead"), "leaves")
    # Lines of smaller leaves cannot recur often enough; the rest is the tree that is worked on.
    kept = written(lines.join(leaves, ["tokens", "lead"]), "kept")
    pairs = written(kept.groupBy("key", "doc_chars", "tokens", "lead", "line").agg(
        F.sum(F.col("chars") + 1).alias("chars"), F.first("masked").alias("masked")), "pairs")
    named = written(line_templates(pairs, min_docs).where(F.col("constant") >= min_constant).select(
        "line", "template"), "templates")
    # Both written, so that a template of very many lines meets the short list in a join of its own.
    votes = written(pairs.select("key", "doc_chars", "line", "chars").join(named, "line"), "votes")
    often = written(votes.groupBy("template").agg(F.count("*").alias("n")).where(
        F.col("n") >= min_docs).select("template"), "often")
    votes = votes.join(often, "template")
    voters = votes.groupBy("key").agg(
        (F.sum("chars") / (F.max("doc_chars") + 1)).alias("share")).where(
        F.col("share") < copy_share).select("key")
    recurring = votes.join(voters, "key").select("key", "template").distinct().groupBy(
        "template").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs)
    dropped = named.join(recurring, "template").select("line")
    return kept.select("key", "n", "line").join(dropped, "line").groupBy("key").agg(
        F.collect_set("n").alias("drop"))


def drop_recurring(docs, min_docs=MIN_DOCS, min_constant=MIN_CONSTANT, copy_share=COPY_SHARE):
    """docs with recurring lines cut out of ``text``, and the columns n_lines and dropped.

    dropped: sorted numbers, from 0, of the lines of the original text that went. A template recurs
    if at least ``min_docs`` documents hold it that are not themselves mostly recurring lines:
    copies of a document, whose lines all recur with it, are left to document deduplication. A text
    of recurring lines only stays as it is. Blank lines are kept. Null texts stay null with 0 lines;
    the empty text has one. Repeated rows are cut alike; rows without doc_id take part; other columns
    pass through, except that n_lines and dropped are replaced. An empty table stays empty.
    """
    found = recurring_lines(docs, min_docs, min_constant, copy_share).select(
        F.col("key.doc_id").alias("_id"), F.col("key.hash").alias("_hash"),
        F.array_sort("drop").alias("_drop"))
    lines = F.split("text", "\n")
    kept = F.filter("_lines", lambda _, i: ~F.array_contains("_drop", i))
    rest = F.array_join("_kept", "\n")
    cut = F.col("_drop").isNotNull() & F.exists("_kept", lambda x: F.trim(x) != "")
    joined = docs.drop("n_lines", "dropped").join(
        found, F.col("doc_id").eqNullSafe(F.col("_id"))
        & (F.xxhash64("text") == F.col("_hash")), "left")
    return joined.withColumn("_lines", lines).withColumn("_kept", kept).withColumns({
        "n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size("_lines")),
        "dropped": F.when(cut, F.col("_drop")).otherwise(F.array().cast("array<int>")),
        "text": F.when(cut, rest).otherwise(F.col("text"))}).drop(
            "_id", "_hash", "_drop", "_lines", "_kept")
