"""Registered queries: each operator with production parameters on its whole table."""

import json

from pyspark.sql import functions as F

from basketlens.llm import (decontaminate, lm, mixing, neighbours, pieces, quality, repair,
                            sharding, simhash, substrings, templates, toolcalls, trie)
from basketlens.llm.oracle import CONVERSATION_TRIE, REPAIRED_CONVERSATIONS, SOURCE_MIX
from basketlens.llm.common import table, written


def op1_lm_score(spark, folder):
    return lm.score(table(spark, folder, "documents"))


#: The tools that turns of ``conversations`` call in op2.
TOOLS = {
    "search": {"properties": {"query": {"type": "string"}, "text": {"type": "string"},
                              "limit": {"type": "integer", "minimum": 1, "maximum": 1500}},
               "required": ["limit", "query"], "additionalProperties": False},
    "calculate": {"properties": {"value": {"type": "number"}, "text": {"type": "string"}},
                  "required": ["value"]},
    "remember": {"properties": {"key": {"type": "string"}, "keep": {"type": "boolean"},
                                "text": {"type": "string"}},
                 "required": ["key"], "additionalProperties": False}}


def conversation_calls(turns):
    """(calls, results) that ``conversations`` imply: an assistant's turn calls a tool with arguments
    taken from its text, the whole text among them, and builds on the assistant's two turns before; the
    turn after answers it.
    """
    name = F.concat(F.lit("call-"), F.col("conv_id"), F.lit("-"))
    size, number = F.length("text"), F.crc32(F.coalesce("text", F.lit("")))
    word = F.regexp_replace(F.substring_index("text", " ", 1), r'["\\\p{Cntrl}]', "")
    field = F.to_json(F.struct("text"), {"ignoreNullFields": "false"})
    whole = F.substring(field, F.lit(2), F.length(field) - 2)
    arguments = F.when(number % 3 == 0, F.format_string(
        '{ %s, "query": "%s", "limit": %s }', whole, word,
        F.when(number % 11 == 0, F.format_string('"%d"', size)).otherwise(size.cast("string")))
    ).when(number % 3 == 1, F.format_string(
        '{"value": %d.%d, %s}', size, number % 10, whole)).otherwise(
        F.format_string('{"keep":true, "key":"%s"%s, %s}', word,
                        F.when(number % 7 == 0, F.lit(', "more": null')).otherwise(F.lit("")),
                        whole))
    tool = F.element_at(F.array(*map(F.lit, TOOLS)), (number % 3 + 1).cast("int"))
    earlier = F.filter(F.array(F.col("turn") - 2, F.col("turn") - 4), lambda x: x >= 0)
    calls = turns.where("role = 'assistant'").select(
        "conv_id", "turn", F.concat(name, F.col("turn")).alias("call_id"), tool.alias("tool"),
        arguments.alias("arguments"),
        F.transform(earlier, lambda x: F.concat(name, x)).alias("depends_on"))
    results = turns.where("role <> 'assistant'").select(
        F.concat(name, F.col("turn") - 1).alias("call_id"), F.col("text").alias("result"))
    return calls, results


def op2_tool_calls(spark, folder):
    calls, results = conversation_calls(table(spark, folder, "conversations"))
    schemas = spark.createDataFrame([(k, json.dumps(v)) for k, v in TOOLS.items()],
                                    "tool string, schema string")
    return toolcalls.link(calls, results, schemas)


def op3_quality(spark, folder):
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_shards(spark, folder):
    return sharding.assign(table(spark, folder, "documents"))


def op5_simhash(spark, folder):
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


def op6_substring_dedup(spark, folder):
    return substrings.drop_repeats(table(spark, folder, "documents").select("doc_id", "text"))


def op7_line_templates(spark, folder):
    return templates.drop_recurring(table(spark, folder, "documents").select("doc_id", "text"))


def op8_nearest(spark, folder):
    return neighbours.search(table(spark, folder, "embeddings"))


def op9_sentencepiece(spark, folder):
    found = pieces.encode(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_ids", "ids", "exact")


def op10_decontaminate(spark, folder):
    return decontaminate.report(table(spark, folder, "documents"),
                                table(spark, folder, "benchmark"))


def op11_source_mix(spark, folder):
    return mixing.mix(table(spark, folder, "documents"))


def damaged(turns):
    """``turns`` with faults by a hash of conversation and turn; dropped rows are marked ``gone``."""
    def text_of(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    text = F.when(fault.isin(0, 1), "").when(
        fault == 2, F.regexp_replace(text_of("text"), "[.!?]", "")).otherwise(text_of("text"))
    role = F.when(fault == 4, "user").otherwise(text_of("role"))
    again = F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                        (fault == 0).alias("gone"), again.alias("again")).drop("again")


def op12_conversation_repair(spark, folder):
    return repair.report(damaged(table(spark, folder, "conversations")))


def rebuilt(turns):
    """(turns, members): conversations whose first turns are those of their block of 100's head."""
    own = trie.numbered(turns)
    sizes = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    taken = F.crc32(F.col("conv_id").cast("string")) % 6
    head = F.col("conv_id") - F.col("conv_id") % 100
    plan = sizes.select("conv_id", "n", taken.alias("h"), head.alias("head")).join(
        sizes.select(F.col("conv_id").alias("head"), F.col("n").alias("head_n")), "head", "left")
    plan = written(plan.withColumn("k", F.least("h", F.coalesce("head_n", F.lit(0)))), "rebuild_plan")
    rest = own.join(plan.select("conv_id", "h", "k"), "conv_id").where("place > h").select(
        "conv_id", (F.col("place") - F.col("h") + F.col("k")).alias("place"), "key", "chars")
    # A head has at most five such turns, and a block at most 199 conversations.
    shared = plan.select("conv_id", "head", "k").where("k > 0").join(
        own.where("place < 6").select(F.col("conv_id").alias("head"), "place", "key", "chars"),
        "head").where("place <= k").select("conv_id", "place", "key", "chars")
    members = plan.select("conv_id", (F.col("k") + F.greatest(
        F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    return rest.unionByName(shared), members


def op13_conversation_trie(spark, folder):
    return trie.build(*rebuilt(table(spark, folder, "conversations")))


QUERIES = {f.__name__: f for f in (
    op1_lm_score, op2_tool_calls, op3_quality, op4_shards, op5_simhash, op6_substring_dedup,
    op7_line_templates, op8_nearest, op9_sentencepiece, op10_decontaminate, op11_source_mix,
    op12_conversation_repair, op13_conversation_trie)}

ORACLE_SQL = {"op11_source_mix": SOURCE_MIX,
              "op12_conversation_repair": REPAIRED_CONVERSATIONS,
              "op13_conversation_trie": CONVERSATION_TRIE}
