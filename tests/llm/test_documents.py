"""Operators over documents against brute force, and on odd tables."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from llm_rows import BODY, LONG, by_id, none, odd  # noqa: F401
from pyspark.sql import functions as F

from basketlens.llm import decontaminate, lm, quality, sharding, simhash, substrings, templates
from basketlens.llm.common import components

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def tokens(text):
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    return re.findall(rb"[^\x20\x09-\x0D]+", low)


# --- language model ------------------------------------------------------------------------

def test_base_scores_equal_plain_counting(docs):
    texts = dict(docs.select("doc_id", "text").collect())
    count = Counter()
    for i, text in texts.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            count.update(tokens(text) + [b""])
    size, kinds = sum(count.values()), len(count)
    found = lm.score(docs, hot=300, steps=200).collect()
    assert len(found) == len(texts)
    for row in found:
        own = tokens(texts[row["doc_id"]]) + [b""]
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 1)
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (
            len(own), sum(count[w] > 0 for w in own), size)
        base = sum(math.log10((count[w] + 0.5) / (size + 0.5 * (kinds + 1))) for w in own)
        assert row["base_score"] == pytest.approx(base)
    held = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_model_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, lm.CONTEXTS ** 2, 5000) * lm.CONTEXTS + rng.integers(
        0, lm.CLASSES, 5000)
    table = lm.log_probabilities(lm.train(keys, np.ones(5000), steps=20))
    assert np.allclose((10.0 ** table[:5]).sum(axis=2), 1, atol=1e-3)


def test_language_model_on_odd_tables(odd, none):
    found = by_id(lm.score(odd, steps=5))
    assert {i: len(r) for i, r in found.items()}[5] == 2 and None in found
    assert {found[i][0]["n_tokens"] for i in (1, 2, 6, 9)} == {1}
    assert found[3][0]["n_tokens"] == 20001
    assert all(math.isfinite(r["score"]) for rows in found.values() for r in rows)
    assert lm.score(none, steps=5).count() == 0


# --- quality --------------------------------------------------------------------------------

def test_network_tells_held_out_labels_apart(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = quality.classify(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert ((found["predicted"] == found["quality"]).mean()) > 0.9
    assert found["score"].between(0, 1).all()


def test_pooling_equals_a_plain_loop_over_positions():
    rng = np.random.default_rng(2)
    weights = quality.train([], [])
    for size in (0, 1, 5, 250, 251, 252, 256, 257, 507, 1000):
        text = bytes(rng.integers(1, 256, size).tolist())
        windows, starts = quality.chunked([b"before", text, b"after" * 100])
        found = quality.pooled(quality.activations(weights, windows)[0], starts)[1]
        chunks = max(1, math.ceil((size + quality.WIDTH - 1) / quality.CHUNK))
        padded = np.frombuffer(text + b"\0" * 600, np.uint8)
        at = np.arange(chunks * quality.CHUNK)[:, None] + np.arange(quality.WIDTH)
        plain = weights["embed"][padded[at]].reshape(len(at), -1) @ weights["filters"]
        best = np.maximum(plain.reshape(chunks, quality.CHUNK, -1).max(axis=1), 0)
        assert found == pytest.approx(np.concatenate((best.max(axis=0), best.mean(axis=0))), abs=1e-5)


def test_a_score_does_not_depend_on_the_texts_beside_it(spark):
    rng = np.random.default_rng(6)
    texts = [bytes(rng.integers(32, 127, int(n)).tolist()) for n in rng.integers(0, 900, 120)]
    weights = quality.train(texts[:60], rng.integers(0, 2, 60), epochs=2)

    def scores(some):
        windows, starts = quality.chunked(some)
        return quality.probability(weights, quality.pooled(
            quality.activations(weights, windows)[0], starts))

    alone = [scores([t])[0] for t in texts]
    for _ in range(5):
        order = rng.permutation(len(texts))
        assert scores([texts[i] for i in order]) == pytest.approx([alone[i] for i in order], abs=1e-6)
    docs = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(texts)], "doc_id long, text string")
    spread = [{r["doc_id"]: r["score"] for r in quality.score(docs.repartition(n), weights).collect()}
              for n in (1, 64)]
    assert spread[0] == pytest.approx(spread[1], abs=1e-6)


def test_quality_on_odd_tables(spark, odd, none):
    labels = spark.createDataFrame(
        [(4, 1, 0), (4, 1, 0), (8, 0, 0), (3, 1, 0), (None, 1, 0), (2, None, 0), (7, 5, 0),
         (99, 0, 0)], "doc_id long, quality int, toxic int")
    found = by_id(quality.classify(odd, labels, epochs=1))
    assert len(found[5]) == 2 and found[1][0]["score"] == found[2][0]["score"]
    assert all(0 <= r["score"] <= 1 for rows in found.values() for r in rows)
    assert quality.classify(none, labels, epochs=1).count() == 0
    unlabelled = quality.classify(odd, labels.limit(0))
    assert {r["score"] for r in unlabelled.collect()} == {0.5}
    kept = quality.keep_good(odd, labels, 0.0, epochs=1)
    assert kept.columns == odd.columns and kept.count() == odd.count()


# --- shards ---------------------------------------------------------------------------------

def smallest_by_trial(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle, used, held = (low + high) // 2, 1, 0
        for size in sizes:
            if held + size > middle:
                used, held = used + 1, 0
            held += size
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low


def test_capacity_is_the_smallest(spark):
    rng = random.Random(3)
    sizes = [rng.randint(1, 500) for _ in range(800)]
    keys = sorted(rng.sample(range(1 << 60), 800))
    groups = spark.createDataFrame(list(zip(keys, sizes)), "key long, size long")
    for bits in (2, 6, 16):
        capacity, cuts = sharding.minimax_cuts(groups, 13, bits)
        assert capacity == smallest_by_trial(sizes, 13)
        bounds = [0, *[keys.index(c) for c in cuts], 800]
        assert max(sum(sizes[i:j]) for i, j in zip(bounds, bounds[1:])) == capacity


def test_shards_are_gapless_and_groups_whole(spark, docs, odd, none):
    for table in (docs, odd, docs.withColumn("text", F.when(F.col("doc_id") % 3 == 0, "x" * 900)
                                             .otherwise(F.col("text")))):
        found = sharding.assign(table).toPandas()
        assert len(found) == table.count() and found["shard"].between(0, 39).all()
        for _, own in found.groupby("shard"):
            assert sorted(own["slot"]) == list(range(len(own)))
        assert (found.groupby(["text_crc32", "size"])["shard"].nunique() == 1).all()
    assert sharding.assign(none).count() == 0
    sizes = by_id(sharding.assign(odd))
    assert sizes[1][0]["size"] == 16 and sizes[7][0]["text_crc32"] == zlib.crc32(
        "É ñ ß 日本 😀\r\nx".encode())


# --- near duplicates ------------------------------------------------------------------------

def plain_fingerprint(text):
    words = tokens(text)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42)
              for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reachable(items):
    """Smallest name in the component of each (name, fingerprint) at 3 bits, pair by pair."""
    label = {name: name for name, _ in items}
    changed = True
    while changed:
        changed = False
        for a, x in items:
            for b, y in items:
                if (x ^ y).bit_count() <= 3 and label[a] < label[b]:
                    label[b], changed = label[a], True
    return label


def test_fingerprints_and_groups_equal_brute_force(docs):
    texts = dict(docs.select("doc_id", "text").collect())
    wanted = {i: plain_fingerprint(t) for i, t in texts.items()}
    groups = reachable(sorted(wanted.items()))
    for row in simhash.near_duplicates(docs).collect():
        assert row["fp"] % (1 << 64) == wanted[row["doc_id"]]
        assert row["component_id"] == groups[row["doc_id"]]


@pytest.mark.parametrize("block", [4, 4096])
def test_links_are_complete_in_a_dense_group(spark, block):
    rng = random.Random(5)
    centre, fps = rng.getrandbits(64), set()
    for _ in range(120):
        x = centre
        for bit in rng.sample(range(64), rng.randint(0, 5)):
            x ^= 1 << bit
        fps.add(x)
    fps |= {rng.getrandbits(64) for _ in range(50)}
    signed = {int(np.uint64(x).astype(np.int64)): x for x in fps}
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    links = simhash.link_fingerprints(frame, block=block).collect()
    wanted = reachable(sorted(signed.items()))
    assert all((signed[a] ^ signed[b]).bit_count() <= 3 for a, b in links)
    label = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert {x: label.get(x, x) for x in signed} == wanted


def test_near_duplicates_on_odd_tables(odd, none):
    found = by_id(simhash.near_duplicates(odd))
    assert {found[i][0]["component_id"] for i in (1, 2, 6, 9)} == {1}
    assert {found[i][0]["component_id"] for i in (4, 5, None)} == {4} and len(found[5]) == 2
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.keep_representatives(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "4", "7", "8"]


def test_a_row_goes_only_where_a_linked_text_stays(spark):
    other = "Wholly different words stand in this text, which shares an id with some other text."
    third = "A third text without any id at all, which nobody else has written down so far."
    rows = [(1, BODY), (1, other), (1, other), (2, other), (None, third), (None, third), (None, BODY),
            (3, third.upper())]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    kept = sorted((str(r["doc_id"]), r["text"]) for r in simhash.keep_representatives(docs).collect())
    assert kept == sorted([("1", BODY), ("1", other), ("3", third.upper())])
    nameless = docs.where("doc_id is null")
    kept = simhash.keep_representatives(nameless).collect()
    assert sorted(r["text"] for r in kept) == sorted([BODY, third])


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(200)] + [(900, 901), (901, 900), (5, 5)]
    label = dict(components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert {label[i] for i in range(201)} == {0} and label[901] == 900


# --- repeated passages ----------------------------------------------------------------------

def test_first_occurrence_stays_with_offsets(spark):
    passage = "The quick brown fox jumps over it all. And then it slept a long while there."
    frame = spark.createDataFrame([
        (3, f"Something else entirely was said before this. {passage}\nshort line"),
        (1, f"Opening words of the first document stand here. {passage}"),
        (2, f"and Then comes {passage.upper()[:3]}{passage[3:]}\nshort line")],
        "doc_id long, text string")
    found = by_id(substrings.drop_repeats(frame))
    assert found[1][0]["removed"] == []
    three, text = found[3][0], frame.where("doc_id = 3").first()["text"]
    assert [text[s["start"]:s["end"]] for s in three["removed"]] == [
        "The quick brown fox jumps over it all.", "And then it slept a long while there."]
    assert three["text"] == "Something else entirely was said before this. \nshort line"
    assert len(found[2][0]["removed"]) == 2


def test_repeats_equal_brute_force(docs):
    ranked, wanted = set(), {}
    for i, text in sorted(docs.select("doc_id", "text").collect()):
        wanted[i] = []
        for start, end, digest in substrings.units(text):
            if digest in ranked:
                wanted[i].append((start, end))
            ranked.add(digest)
    found = by_id(substrings.drop_repeats(docs))
    assert {i: [tuple(s) for s in r[0]["removed"]] for i, r in found.items()} == wanted


@pytest.mark.parametrize("line", [
    "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.",
    "Nt onor. The of it.", "ALL RIGHTS RESERVED BY THE HOLDER", "Dr. Smith saw it all on that day.",
    "Der Hund des Nachbarn liegt im Garten unter dem Apfelbaum.", "One Two\nThree Four\nFive Six",
    "Donaudampfschifffahrtsgesellschaft Kapitän"])
def test_whole_repeated_lines_leave_no_scrap(spark, line):
    texts = [f"{word} stands here alone as prose\n\n{line}\n\nand {word} again ends this text"
             for word in ("alpha", "beta", "gamma")]
    found = by_id(substrings.drop_repeats(spark.createDataFrame(
        list(enumerate(texts)), "doc_id long, text string")))
    assert found[0][0]["text"] == texts[0]
    for i in (1, 2):
        assert found[i][0]["text"] == texts[i].replace(line, "")


def test_repeats_on_odd_tables(odd, none):
    found = by_id(substrings.drop_repeats(odd))
    assert found[1][0]["text"] is None and found[2][0]["text"] == ""
    assert found[4][0]["text"] == BODY and [r["text"] for r in found[5]] == ["", ""]
    assert found[3][0]["text"] == LONG and found[3][0]["key"] == "k"
    assert substrings.drop_repeats(none).count() == 0


# --- line templates -------------------------------------------------------------------------

def test_recurring_templates_go_and_others_stay(spark):
    rng = random.Random(7)

    def prose():
        return " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(20))

    rows = [(i, f"{prose()}\nPage {i} of 900 printed by {prose()[:5]}x for all readers\n{prose()}")
            for i in range(12)]
    copy = "\n".join(prose() for _ in range(4))
    rows += [(100 + i, copy) for i in range(15)]
    rows += [(200, "Page 3 of 900 printed by nobody for all readers")]
    found = by_id(templates.drop_recurring(spark.createDataFrame(rows, "doc_id long, text string")))
    for i, text in rows:
        row, lines = found[i][0], text.split("\n")
        if i < 12:
            assert row["dropped"] == [1] and row["text"] == f"{lines[0]}\n{lines[2]}"
        else:
            assert row["dropped"] == [] and row["text"] == text and row["n_lines"] == len(lines)


def test_templates_on_odd_tables(odd, none):
    found = by_id(templates.drop_recurring(odd, min_docs=2))
    assert found[1][0]["text"] is None and found[1][0]["n_lines"] == 0
    assert found[2][0]["n_lines"] == 1 and found[4][0]["text"] == BODY
    assert found[3][0]["text"] == LONG and len(found[5]) == 2 and found[7][0]["key"] == "k"
    assert templates.drop_recurring(none).count() == 0


# --- decontamination ------------------------------------------------------------------------

def edits_within(item, text):
    """Fewest edits of item against any part of text, by the plain recursion."""
    row = np.zeros(len(text) + 1, int)
    for c in item:
        following = np.concatenate(([row[0] + 1], np.minimum(
            row[1:] + 1, row[:-1] + np.array([t != c for t in text], int))))
        row = np.minimum.accumulate(following - np.arange(len(text) + 1)) + np.arange(
            len(text) + 1)
    return row.min()


def test_matches_equal_the_plain_recursion(spark):
    rng = random.Random(11)

    def text(n):
        return "".join(rng.choices("abcde ", k=n))

    items = [(i, text(rng.choice([8, 20, 60, 150]))) for i in range(12)]
    index = decontaminate.Index(items)
    texts = []
    for _ in range(120):
        _, item = rng.choice(items)
        part = list(item)
        for _ in range(rng.randint(0, len(item) // 7 + 1)):
            place = rng.randrange(len(part))
            part[place:place + rng.randint(0, 1)] = rng.choices("abcde", k=rng.randint(0, 1))
        texts.append(text(rng.choice([0, 3, 90])) + "".join(part) + text(rng.choice([0, 3, 90])))
    for found, own in zip(index.matches(texts), texts):
        for k, (i, item) in enumerate(items):
            edits = edits_within(item, own)
            if edits <= index.edits[k]:
                assert found[i][0] == edits
            else:
                assert i not in found


def test_shared_grams_are_counted_in_windows(monkeypatch):
    rng = random.Random(5)
    items = [(i, "".join(rng.choices("ab", k=rng.choice([9, 40, 120])))) for i in range(30)]
    texts = ["".join(rng.choices("ab", k=60)) + items[i % 30][1] + "ab" * 40 for i in range(60)] + [
        "", None, "ab" * 9000, "".join(rng.choices("ab", k=5000)) + items[3][1]]
    index, counted, whole = decontaminate.Index(items), [], decontaminate.Index._bands
    monkeypatch.setattr(decontaminate, "POSTINGS", 1 << 30)
    wanted = index.matches(texts)
    monkeypatch.setattr(decontaminate, "POSTINGS", 50)

    def bands(self, at, spot, width, shift):
        counted.append(at[-1] - at[0])
        return whole(self, at, spot, width, shift)

    monkeypatch.setattr(decontaminate.Index, "_bands", bands)
    assert index.matches(texts) == wanted and sum(map(bool, wanted)) >= 61
    # A window spans little more than an item, however long the texts are.
    assert max(counted) <= 2 * (120 + 2 * index.gap) and len(counted) > 50


def test_decontamination_on_odd_tables(spark, odd, none):
    bench = spark.createDataFrame(
        [(1, BODY.upper()), (2, None), (3, ""), (None, BODY), (4, "abc"), (5, BODY[:-9] + "\n")],
        "item_id long, text string")
    for blocks in (1 << 20, 40):
        found = by_id(decontaminate.find(odd, bench, block_chars=blocks))
        hits = {i for i, rows in found.items() if rows[0]["matches"]}
        assert hits == {4, 5, None} and len(found[5]) == 2
        assert sorted(m["item_id"] for m in found[4][0]["matches"]) == [1, 5]
    assert decontaminate.find(none, bench).count() == 0
    assert decontaminate.report(odd, bench.limit(0)).where("contaminated").count() == 0
    kept = decontaminate.keep_clean(odd, bench)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 4
