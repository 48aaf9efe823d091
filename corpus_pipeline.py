"""Corpus pipeline: stages over documents, each written as Parquet and read by the next."""

from basketlens.llm import decontaminate, pieces, quality, simhash, templates
from basketlens.llm.common import table, written


def quality_classifier(spark, docs, sf_dir):
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark, docs, sf_dir):
    """Lines whose template recurs across documents are cut out of the texts; n_chars follows."""
    return templates.drop_recurring(docs).selectExpr(
        *[f"cast(length(text) as {kind}) as n_chars" if name == "n_chars" else f"`{name}`"
          for name, kind in docs.dtypes])


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of SimHash links stays."""
    return simhash.keep_representatives(docs)


def decontamination(spark, docs, sf_dir):
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def piece_ids(spark, docs, sf_dir):
    """The ids of each text, checked by decoding them."""
    return pieces.encode(docs).select("doc_id", "n_ids", "ids", "exact")


STAGES = [("quality_classifier", quality_classifier), ("line_dedup", line_dedup),
          ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("piece_ids", piece_ids)]

#: SQL has no counterpart of the network's training, of XXH64 and of the piece model.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The last stage's rows over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
