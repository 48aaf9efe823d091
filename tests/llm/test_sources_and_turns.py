"""Source mixing, conversation repair and the prefix trie against plain loops."""

import hashlib
import random
import re
import zlib
from itertools import product

import numpy as np
import pytest

from basketlens.llm import mixing, queries, repair, trie
from llm_rows import none, odd  # noqa: F401

DOC = "doc_id long, text string, source string, size int, part int"
TURN = "conv_id long, turn long, role string, text string, part int, gone string"


# --- mixing ------------------------------------------------------------------------------

def plain_targets(sizes, share=1.5, epochs=2, weights=(5, 2, 1)):
    """Share out, cap, share the excess again until none is above."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, left = {}, share * sum(sizes.values())
    while True:
        rest = [s for s in order if s not in full]
        level = left / sum(weight[s] for s in rest) if rest else 0
        above = [s for s in rest if level * weight[s] > epochs * sizes[s]]
        if not above:
            return full | {s: level * weight[s] for s in rest}
        for s in above:
            full[s] = epochs * sizes[s]
            left -= full[s]


def mixed(docs):
    return [r.asDict() for r in mixing.mix(docs).collect()]


def test_mix_meets_targets(spark):
    rng = random.Random(3)
    names = ["a", "b", "é", "", None, "Z", "zz"]
    rows = [(i, " ".join(["w"] * int(rng.paretovariate(0.9)) + ["x" * (i % 5)]),
             rng.choice(names + ["a"] * 6)) for i in range(800)]
    rows += [(7, None, "a"), (None, "one two", None), (8, " \n\t\v\f\r", "b")] + [(9, "p q r", "b")] * 400
    found = mixed(spark.createDataFrame([r + (1, 2) for r in rows], DOC))
    assert len(found) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + size(text)
    wanted, by_target = plain_targets(sizes), {}
    for row in found:
        assert 0 <= row["taken"] <= 2 * row["size"]
        by_target.setdefault((row["source_size"], round(row["target"], 6)), []).append(row["taken"])
    assert {k: sum(v) for k, v in by_target.items()} == {
        (sizes[s], round(t, 6)): round(t) for s, t in wanted.items()}
    assert sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in mixed(
        spark.createDataFrame([r + (1, 2) for r in rows], DOC).repartition(13))) == sorted(
            (str(r["doc_id"]), r["size"], r["taken"]) for r in found)


def test_mix_of_odd_tables(spark, odd, none):
    assert mixed(none) == []
    found = mixed(odd)
    assert len(found) == odd.count() and all(r["taken"] <= 2 * r["size"] for r in found)
    blank = spark.createDataFrame([(1, None, "s", 0, 0), (2, "", None, 0, 0)], DOC)
    assert [(r["size"], r["target"], r["taken"]) for r in mixed(blank)] == [(0, 0.0, 0)] * 2
    with pytest.raises(ValueError):
        mixing.mix(odd, keep=("doc_id", "taken"))


def test_mixed_corpus_holds_the_words(spark):
    rows = [(i, f"  a{i} b\n c d ", "s" if i % 3 else "t", 0, 0) for i in range(50)]
    docs = spark.createDataFrame(rows, DOC)
    taken = {r["doc_id"]: r["taken"] for r in mixed(docs)}
    held = {}
    for row in mixing.corpus(docs).collect():
        assert rows[row["doc_id"]][1].startswith(row["text"])
        held[row["doc_id"]] = held.get(row["doc_id"], 0) + len(row["text"].split())
    assert held == {k: v for k, v in taken.items() if v}


# --- repair ------------------------------------------------------------------------------

def damaged_rows(rows):
    kept = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        kept += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return sorted(kept, key=lambda r: (r[1] is not None, r[1] or 0, r[2],
                                       hashlib.md5(r[3].encode()).hexdigest()))


def plain_search(rows):
    """(cost, audit) of rows (initial, forced, cut) over every choice of edits and insertions."""
    grammar, best = re.compile("(s?(ua)+)?$"), None
    slots = list(product(["", "I", "II"], repeat=len(rows) + 1))
    for edits in product("DKR", repeat=len(rows)):
        if any(e != "D" and r[1] for e, r in zip(edits, rows)):
            continue
        for inserts in slots:
            audit = "".join(i + e for i, e in zip(inserts, edits)) + inserts[-1]
            left = iter(zip(edits, rows))
            options = []
            for letter in audit:
                if letter == "I":
                    options.append("ua")
                else:
                    _, row = next(left)
                    if letter == "K":
                        options.append(row[0] or "-")
                    elif letter == "R":
                        options.append("ua")
            cost = (3 * edits.count("D") + 2 * edits.count("R") + 2 * audit.count("I")
                    + sum(r[2] for e, r in zip(edits, rows) if e != "D"))
            if best and (cost, audit) >= best:
                continue
            if any(grammar.match("".join(roles)) for roles in product(*options)):
                best = (cost, audit)
    return best


def test_search_is_the_cheapest_and_least():
    rng = random.Random(5)
    for _ in range(150):
        rows = [(rng.choice(["s", "u", "a", "x", ""]), rng.random() < 0.2, 0)
                for _ in range(rng.randrange(0, 5))]
        rows = [(i, f, 0 if f else int(rng.random() < 0.3)) for i, f, _ in rows]
        cost, edits, _ = repair.search(rows)
        assert (cost, "".join(e[0] for e in edits)) == plain_search(rows)


def plain_report(rows):
    """The report of one conversation's damaged rows in order."""
    seen, search_rows, counts, before = set(), [], [0, 0, 0, 0], None
    for _, _, role, text in rows:
        core = text.strip(" \t\n\v\f\r")
        fault = 0 if not core else 1 if (role, text) in seen else 2 if core[-1] not in ".!?" else 3
        seen.add((role, text))
        if fault < 3:
            counts[fault] += 1
        counts[3] += before is not None and before + role[:1] not in ("su", "ua", "au")
        before = role[:1]
        search_rows.append((role[:1], fault < 2, int(fault == 2)))
    turns = [t for _, t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, edits, _ = repair.search(search_rows)
    kept = []
    for letter, at, state in edits:
        if letter != "D":
            role = repair.ROLE[state] if letter in "IR" else rows[at][2]
            kept.append(f"{role}:{'' if letter == 'I' else rows[at][3]}")
    digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
    return (gaps, *counts, cost, "".join(e[0] for e in edits), digest)


def conversations(rng, count, longest):
    rows = []
    for conv in [None, *range(count)]:
        for turn in range(rng.randrange(1, longest)):
            rows.append((conv, None if rng.random() < 0.1 else turn + rng.randrange(2),
                         rng.choice(["user", "assistant", "user", "assistant", "system", "", None, "tool"]),
                         rng.choice(["Hi.", "What?", "open end", "", None, " \n", f"Say {turn}! ",
                                     "É 😀." * 3])))
    rows += rows[:20]
    return rows


@pytest.mark.parametrize("ranges", [1, 9])
def test_repair_agrees_with_plain_loops(spark, monkeypatch, ranges):
    rng = random.Random(ranges)
    rows = conversations(rng, 60, 12) + [
        (1000, t, rng.choice(["user", "assistant"]), rng.choice(["Yes.", f"No {t}.", "cut"]))
        for t in range(1500)]
    if ranges > 1:
        # Ranges of 200 rows cut the long conversation into several segments.
        monkeypatch.setattr(repair, "ranged", lambda df, order, name: common_ranged(
            df.repartition(2), order, name, 200))
    found = {r[0]: tuple(r)[1:] for r in repair.report(queries.damaged(spark.createDataFrame(
        [r + (3, "g") for r in rows], TURN))).collect()}
    wanted = {c: [] for c, *_ in rows}
    for row in rows:
        wanted[row[0]].append(row)
    assert found == {c: plain_report(damaged_rows(some)) for c, some in wanted.items()}


def common_ranged(df, order, name, most):
    from basketlens.llm.common import ranged
    return ranged(df, order, name, most)


def test_repaired_turns_are_legal(spark):
    rows = [(c, t, r, x, 0, "g") for c, t, r, x in conversations(random.Random(8), 40, 9)]
    turns = queries.damaged(spark.createDataFrame(rows, TURN))
    kept = {}
    for row in repair.repaired_turns(repair.repair(turns)).orderBy("place").collect():
        kept.setdefault(row["conv_id"], []).append(row["role"][:1])
    assert kept and all(re.fullmatch("(s?(ua)+)?", "".join(r)) for r in kept.values())
    assert repair.report(turns.limit(0)).collect() == []


# --- trie --------------------------------------------------------------------------------

def plain_trie(rows):
    """Nodes of the rebuilt conversations by dictionaries of prefixes."""
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn, role or "", text or ""))
    for turns in own.values():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1],
                                  hashlib.md5(r[2].encode()).hexdigest()))
    built = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        head = own.get(conv - (abs(conv) % 100 if conv >= 0 else -(abs(conv) % 100)), [])
        built[conv] = tuple((r, t) for _, r, t in head[:h] + turns[h:])
    members, ends = {}, {}
    for conv, turns in built.items():
        for depth in range(len(turns) + 1):
            members.setdefault(turns[:depth], []).append(conv)
        ends.setdefault(turns, []).append(conv)
    children, sums = {}, {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node in members:
        saved = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        for depth in range(len(node) + 1):
            total = sums.setdefault(node[:depth], [0, 0])
            total[0] += node not in children
            total[1] += saved
    return sorted((min(m), len(node), min(members[node[:-1]]) if node else -1, len(m),
                   children.get(node, 0), *sums[node], hashlib.sha256(",".join(
                       map(str, sorted(ends.get(node, [])))).encode()).hexdigest())
                  for node, m in members.items())


def trie_rows(df):
    return sorted((r["conv_id"], r["depth"], -1 if r["parent_conv_id"] is None else r["parent_conv_id"],
                   r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"])
                  for r in df.collect())


@pytest.mark.parametrize("segment", [4096, 3, 1])
def test_trie_agrees_with_prefix_tables(spark, segment):
    rng = random.Random(segment)
    rows = [(c, None if t == 0 and c % 5 == 0 else t, rng.choice(["user", None]),
             rng.choice(["a", "b", "", "é😀", None]), 0, "g")
            for c in [*range(0, 330), 1205, -3, -105, 700] for t in range(rng.randrange(1, 9))]
    rows += [(c, t, "user", f"long {t}", 0, "g") for c in (600, 500, 423) for t in range(40)]
    rows += [(None, 1, "user", "x", 0, "g"), (5, 2, "user", "a", 0, "g"), (5, 2, "user", "a", 0, "g")]
    rng.shuffle(rows)
    turns = spark.createDataFrame(rows, TURN)
    assert trie_rows(trie.build(*queries.rebuilt(turns), segment=segment)) == plain_trie(rows)


def test_trie_of_an_empty_table(spark):
    turns = spark.createDataFrame([(None, 1, "user", "x", 0, "g")], TURN)
    assert trie.build(*queries.rebuilt(turns)).collect() == []
    assert trie.build(*queries.rebuilt(turns.limit(0))).collect() == []


def test_slots_are_minimal_and_perfect():
    keys = np.random.default_rng(1).integers(0, 2**63, (5000, 2), np.uint64)
    keys[4000:] = keys[:1000]
    slots = trie.Slots(keys)
    found = slots.find(keys)
    assert set(found[:4000]) == set(range(4000)) and (found[4000:] == found[:1000]).all()
    assert (slots.find(keys ^ np.uint64(1 << 62)) == -1).all()
    assert len(trie.Slots(keys[:0]).keys) == 0
