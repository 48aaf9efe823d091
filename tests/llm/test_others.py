"""Tool calls, nearest vectors, pieces and the pipeline against brute force, and on odd tables."""

import json
import random

import numpy as np
import pytest
import sentencepiece
from llm_rows import BODY, LONG, by_id, none, odd  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from basketlens.llm import decontaminate, neighbours, pieces, quality, queries, simhash, templates
from basketlens.llm import toolcalls
from basketlens.llm.common import table

FOLDER = "/root/testdata/sf0.001"
CALLS = ("conv_id long, turn long, call_id string, tool string, arguments string, "
         "depends_on array<string>, status string")


# --- tool calls -----------------------------------------------------------------------------

def linked(spark, calls, results=(), schemas=()):
    found = toolcalls.link(
        spark.createDataFrame(list(calls), CALLS),
        spark.createDataFrame(list(results), "call_id string, result string"),
        spark.createDataFrame(list(schemas), "tool string, schema string"))
    return {r["call_id"]: r for r in found.collect()}


def test_links_levels_and_errors(spark):
    rule = json.dumps({"properties": {"n": {"type": "integer", "minimum": 2}, "s": {
        "type": "string", "enum": ["é", "b"]}}, "required": ["n"], "additionalProperties": False})
    found = linked(spark, [
        (1, 1, "a", "t", '{"s": "é",  "n": 3}', None, "x"),
        (1, 5, "d", "t", '{"n": 3.0}', ["b", "c"], "x"),
        (1, 2, "b", "t", '{"n": true}', ["a"], "x"), (1, 3, "c", "t", '{"n": 1}', ["b", "zz"], "x"),
        (1, 3, "c", "t", '{"n": 1}', ["b", "zz"], "x"),
        (2, 1, "e", "u", "{}", [], "x"), (2, 2, "f", "t", "{bad", ["g"], "x"),
        (2, 3, "g", "t", None, ["f", None], "x"), (2, 4, "h", "t", '{"x": NaN}', ["g"], "x"),
        (2, 5, None, "t", "{}", None, "x")],
        [("a", "r2"), ("a", "r1"), ("q", "lost"), (None, "no")], [("t", rule), (None, "{}")])
    assert len(found) == 9
    assert found["a"]["json"] == '{"arguments":{"n":3,"s":"é"},"id":"a","name":"t","result":"r1"}'
    assert (found["a"]["status"], found["b"]["status"], found["q"]["status"]) == (
        "linked", "no_result", "orphan_result")
    assert [found[c]["level"] for c in "abcdefgh"] == [0, 1, 2, 3, 0, None, None, None]
    assert [found[c]["rank"] for c in "abcde"] == [0, 1, 2, 3, 0]
    assert {c: r["errors"] for c, r in found.items()} == {
        "a": [], "b": ["n is no integer"], "c": ["n is too small", "unknown dependency zz"],
        "d": ["n is no integer"], "e": ["unknown tool"],
        "f": ["arguments are no JSON", "cyclic dependency"],
        "g": ["arguments are no object", "cyclic dependency"],
        "h": ["arguments are no JSON", "cyclic dependency"], "q": ["unknown call"]}
    assert [c for c, r in found.items() if r["valid"]] == ["a"]
    assert linked(spark, []) == {}


@pytest.mark.parametrize("near", [3, 20_000])
def test_topological_order_of_random_graphs(spark, monkeypatch, near):
    monkeypatch.setattr(toolcalls, "BUCKET", 3)
    monkeypatch.setattr(toolcalls, "NEAR", near)
    rng = random.Random(4)
    calls = [(c, t, f"{c}-{t}", "t", "{}", [f"{c}-{rng.randrange(t)}" for _ in range(
        rng.randint(0, 3))] if t else [], "x") for c in range(4) for t in range(25)]
    found = linked(spark, calls)
    level = {}
    for c, t, name, _, _, parents, _ in calls:
        level[name] = max((level[p] + 1 for p in parents), default=0)
    assert {n: r["level"] for n, r in found.items()} == level
    for c in range(4):
        own = sorted((level[f"{c}-{t}"], t) for t in range(25))
        assert [found[f"{c}-{t}"]["rank"] for _, t in own] == list(range(25))


def test_conversations_give_every_call_and_result(spark):
    turns = table(spark, FOLDER, "conversations")
    found = queries.op2_tool_calls(spark, FOLDER).collect()
    spoken = turns.where("role = 'assistant'").count()
    assert sum(r["status"] != "orphan_result" for r in found) == spoken
    assert all(json.loads(r["json"])["id"] == r["call_id"] for r in found)


def test_one_long_chain_goes_range_by_range(spark, monkeypatch):
    monkeypatch.setattr(toolcalls, "RANGE", 20_000)
    rounds = []
    write = toolcalls.written
    monkeypatch.setattr(toolcalls, "written", lambda df, name: (
        rounds.append(name), len(rounds) < 60 or pytest.fail("a round per link"))[0] or write(
            df, name))
    calls = spark.range(50_000).selectExpr(
        "1L conv_id", "id turn", "string(id) call_id", "'t' tool", "'{}' arguments",
        "if(id > 0, array(string(id - 1)), null) depends_on", "'x' status")
    found = toolcalls.link(calls, spark.createDataFrame([], "call_id string, result string"),
                           spark.createDataFrame([], "tool string, schema string"))
    assert found.where("level = turn and rank = turn").count() == 50_000
    assert rounds.count("settled") == 3


def test_ranges_with_edges_against_the_order_and_cycles(spark, monkeypatch):
    monkeypatch.setattr(toolcalls, "NEAR", 3)
    monkeypatch.setattr(toolcalls, "RANGE", 8)
    back = {"0-2": ["0-17"], "1-4": ["0-20"], "2-3": ["2-12"], "2-12": ["2-3"], "2-15": ["2-12"]}
    calls = [(c, t, f"{c}-{t}", "t", "{}", back.get(f"{c}-{t}", [f"{c}-{t - 9}"] if t > 8 else []),
              "x") for c in range(3) for t in range(24)]
    parents, level = {name: found for _, _, name, _, _, found, _ in calls}, {}
    for _ in parents:  # a level once all parents have theirs
        for name, found in parents.items():
            if all(p in level for p in found):
                level[name] = max((level[p] + 1 for p in found), default=0)
    found = linked(spark, calls)
    assert {n: r["level"] for n, r in found.items()} == {n: level.get(n) for n in parents}
    assert found["2-15"]["level"] is None and found["1-4"]["level"] == 5


def test_derived_calls_hold_whole_texts(spark):
    texts = [f'say {i} "quoted" \\ back\\slash\n\ttab \u0001 é 日本 😀 100 % {"long " * i}' for i in range(60)]
    turns = spark.createDataFrame([(1, i, "assistant", t) for i, t in enumerate(texts)],
                                  "conv_id long, turn long, role string, text string")
    schemas = spark.createDataFrame([(k, json.dumps(v)) for k, v in queries.TOOLS.items()],
                                    "tool string, schema string")
    found = toolcalls.link(*queries.conversation_calls(turns), schemas).collect()
    assert {r["turn"]: json.loads(r["json"])["arguments"]["text"] for r in found} == dict(
        enumerate(texts))
    assert {r["tool"] for r in found if r["valid"]} == set(queries.TOOLS)


# --- nearest vectors ------------------------------------------------------------------------

def test_recall_and_scores_against_brute_force(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    pdf = frame.toPandas().sort_values("vec_id")
    ids, rows = pdf["vec_id"].to_numpy(), np.stack(pdf["embedding"]).astype(float)
    norms = np.linalg.norm(rows, axis=1)
    hits = total = 0
    for query, own in neighbours.search(frame, every=10, leaf=16).toPandas().groupby("query_id"):
        at = np.flatnonzero(ids == query)[0]
        score = rows @ rows[at] / norms / norms[at]
        score[at] = -2
        own = own.sort_values("rank")
        assert own["rank"].tolist() == [1, 2, 3, 4, 5]
        assert own["score"].tolist() == pytest.approx(
            [score[np.flatnonzero(ids == v)[0]] for v in own["vec_id"]])
        assert (np.diff(own["score"]) <= 0).all()
        hits += len(set(ids[np.lexsort((ids, -score))[:5]]) & set(own["vec_id"]))
        total += 5
    assert hits / total >= 0.9


def test_copies_ties_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0, 0.0], 1) for i in range(0, 40)] + [
        (50, [0.0, 1.0, 0.0], 1), (51, [1.0, 1.0, 0.0], 1), (51, [1.0, 1.0, 0.0], 1),
        (52, None, 1), (53, [0.0, 0.0, 0.0], 1), (54, [nan, 0.0, 0.0], 1), (55, [inf, 1.0, 0.0], 1),
        (56, [None, 1.0, 0.0], 1), (57, [1.0, 0.0], 1), (None, [1.0, 0.0, 0.0], 1), (100, [], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    found = {}
    for r in neighbours.search(frame).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], round(r["score"], 6)))
    assert set(found) == {0, 50}
    assert found[0] == [(i, 1.0) for i in range(1, 6)]
    assert found[50] == [(51, 0.707107)] + [(i, 0.0) for i in range(4)]
    assert neighbours.search(frame.limit(0)).count() == 0
    assert neighbours.search(frame.where("vec_id = 50")).count() == 0


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    frame = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    def found():
        return sorted((q, r, v, round(s, 12)) for q, r, v, s in neighbours.search(
            frame, every=5).collect())

    whole = found()
    monkeypatch.setattr(neighbours, "ROWS", 7)
    monkeypatch.setattr(neighbours, "QUERIES", 3)
    assert found() == whole


def test_vectors_are_not_copied_per_tree_or_leaf(spark, monkeypatch):
    """What a search writes does not grow with the trees: two copies of the vectors and the queries."""
    frame = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    held, kept = [], neighbours.written

    def counted(df, name):
        found = kept(df, name)
        if "embedding" in df.columns:
            held.append(found.count())
        return found

    monkeypatch.setattr(neighbours, "written", counted)
    neighbours.search(frame).collect()
    assert sum(held) <= 2.1 * frame.count()


def test_nearest_of_the_visited_leaves(spark, monkeypatch):
    """All rows that share a leaf with the query take part, copies and asked copies included."""
    rng = np.random.default_rng(11)
    vectors = rng.normal(size=(600, 8)).round(2)
    vectors[400:420] = vectors[3]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(neighbours, "ROWS", 50)
    monkeypatch.setattr(neighbours, "PAIRS", 40)
    found = {}
    for r in neighbours.search(frame, every=2, leaf=8).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    first = np.array([np.flatnonzero((vectors == v).all(axis=1))[0] for v in vectors])
    classes = np.unique(first)
    forest = neighbours.Forest(unit[classes], leaf=8)
    leaves = [neighbours.leaf_of(nodes, unit) for nodes in forest.trees]
    assert set(found) == set(range(0, 600, 2))
    for query, own in found.items():
        seen = np.zeros(600, bool)
        for tree, node in forest.probes(unit[query]):
            seen |= leaves[tree] == node
        seen[query] = False
        score = np.where(seen, unit @ unit[query], -2).round(12)
        # Of a vector's copies the six smallest ids can be among the nearest.
        wanted = [i for i in np.lexsort((np.arange(600), -score)) if (first[:i + 1] == first[i]).sum() <= 6][:5]
        assert [own[k] for k in range(1, 6)] == wanted


# --- pieces ---------------------------------------------------------------------------------

def test_ids_are_those_of_the_models_own_encoder(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    odd_texts = ["", " ", "  a ", "\n", "a\n\n b\t\tc\r\n", "日本語 テキスト", "😀😀 x😀y", "ſ ½",
                 "a" * 300, "    indented", "\x00 <s> </s> <unk> <0x0A>", "§§ §", BODY]
    texts = odd_texts + [r["text"] for r in table(spark, FOLDER, "documents").collect()]
    encoder = pieces.Encoder(pieces.Pieces())
    for _ in range(2):  # the second time from memory
        ids, offsets = encoder.encode(texts)
        for i, text in enumerate(texts):
            assert ids[offsets[i]:offsets[i + 1]].tolist() == model.encode(text), text[:50]
            assert pieces.decode(encoder.pieces, model.encode(text)) == text


def test_unigram_scores_take_the_largest_sum():
    encoder = pieces.Encoder(pieces.Pieces())
    encoder.pieces.merges = False
    p, unit = encoder.pieces, "▁theinat"
    best = {0: (0.0, [])}
    for end in range(1, len(unit) + 1):
        best[end] = max((best[i][0] + p.score[p.id[unit[i:end]]], best[i][1] + [p.id[unit[i:end]]])
                        for i in range(end) if unit[i:end] in p.id and i in best)
    ids, _ = encoder.encode([unit[1:]])
    assert p.score[ids].sum() == pytest.approx(best[len(unit)][0])


def test_pieces_on_odd_tables(odd, none):
    found = by_id(pieces.encode(odd))
    for i in (1, 2, 9):
        assert (found[i][0]["n_ids"], found[i][0]["decoded"], found[i][0]["ids"]) == (0, "", [])
    assert all(r["exact"] and r["key"] == "k" for rows in found.values() for r in rows)
    assert found[3][0]["decoded"] == LONG and len(found[5]) == 2
    assert pieces.encode(none).count() == 0


# --- pipeline -------------------------------------------------------------------------------

def test_pipeline_equals_its_operators_one_by_one(spark):
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    found = {r["doc_id"]: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    good = {r["doc_id"] for r in quality.classify(docs, labels).where("predicted = 1").collect()}
    left = docs.where(F.col("doc_id").isin(list(good)))
    cut = {r["doc_id"]: r["text"] for r in templates.drop_recurring(left).collect()}
    groups = {}
    fps = {i: simhash.text_fingerprint((t or "").encode()) for i, t in cut.items()}
    for i in sorted(fps):
        near = [g for g in groups if any((fps[i] ^ fps[j]).bit_count() <= 3 for j in groups[g])]
        joined = [i] + [j for g in near for j in groups.pop(g)]
        groups[min(joined)] = joined
    index = decontaminate.Index([tuple(r) for r in table(spark, FOLDER, "benchmark").collect()])
    kept = [i for i in groups if not index.matches([cut[i]])[0]]
    assert sorted(found) == sorted(kept)
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    assert all(found[i]["ids"] == model.encode(cut[i]) and found[i]["exact"] for i in kept)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_odd_documents(spark, odd, none, name, stage):
    for frame in (odd, none):
        docs = frame.select("doc_id", "text", "lang", "source", "n_chars")
        found = stage(spark, docs, FOLDER)
        assert found.count() <= docs.count()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert found.columns == docs.columns


# --- hostile calls and schemas --------------------------------------------------------------

HOSTILE = [
    ('{"a": "\\ud800x"}', '{"properties": {"a": {"type": "string"}}}', []),
    ('{"a": null, "b": 1}', '{"properties": {"a": {"type": ["string", "null"]}, '
     '"b": {"type": ["string", "null"]}}}', ["b is no string or null"]),
    ('{"a": 1}', '{"properties": {"a": {"type": "date"}}}', ["bad schema: unknown type"]),
    ('{"a": 1}', "no json", ["bad schema: no JSON"]),
    ('{"a": 1}', "[1]", ["bad schema: no object"]),
    ('{"a": "x", "b": true, "c": 3}', '{"properties": {"a": {"minimum": 5}, "b": {"minimum": 5}, '
     '"c": {"minimum": 5}}}', ["c is too small"]),
    ('{"o": {"x": [1, "2"], "y": 1}}', '{"properties": {"o": {"type": "object", "required": ["z"], '
     '"additionalProperties": false, "properties": {"x": {"items": {"type": "integer"}}}}}}',
     ["missing o.z", "o.x[1] is no integer", "unknown o.y"]),
    ('{"v": [true, 1, "s"]}', '{"properties": {"v": {"items": {"anyOf": [{"enum": [1]}, '
     '{"type": "string"}]}}}}', ["v[0] fits no alternative"]),
    ('{"\\udc00": 1}', '{"additionalProperties": false}', ["unknown \\udc00"]),
    ('{"a": 1, "b": 2}', '{"properties": {"b": false}}', ["b is not allowed"]),
    ('{"a": 1}', '{"required": "a"}', ["bad schema: required is no array of names"]),
    ("[" * 100000, "{}", ["arguments are no JSON"])]


def test_hostile_arguments_and_schemas(spark):
    calls = spark.createDataFrame(
        [(1, i, f"c{i:02d}", f"t{i:02d}", a, []) for i, (a, _, _) in enumerate(HOSTILE)],
        "conv_id long, turn long, call_id string, tool string, arguments string, depends_on array<string>")
    schemas = spark.createDataFrame([(f"t{i:02d}", s) for i, (_, s, _) in enumerate(HOSTILE)],
                                    "tool string, schema string")
    results = spark.createDataFrame([], "call_id string, result string")
    found = sorted(toolcalls.link(calls, results, schemas).collect(), key=lambda r: r["call_id"])
    assert [r["errors"] for r in found] == [e for _, _, e in HOSTILE]
    assert json.loads(found[0]["json"])["arguments"] == {"a": "\ud800x"}
    assert all(r["valid"] == (not r["errors"]) for r in found)
