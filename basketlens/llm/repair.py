"""Conversation structure repair: the cheapest edits that make turns alternate.

Turns of a conversation are read by turn (null first), then role, then MD5 of the text. A row's first
fault counts: blank (no characters but blanks), duplicate (role and text seen earlier), truncated (the
last such character ends no sentence). Edits and costs: Keep 0, Rerole to user or assistant 2, Delete
3, Insert an empty user or assistant turn 2; blank and duplicate rows must go, and a truncated row that
stays adds 1. The initials of the roles must become ``(s?(ua)+)?``.

A null role or text reads as one space, a null turn comes first, and a null conv_id is a conversation
of its own. Rows marked ``gone`` only keep their conversation in the result. An empty table gives an
empty result. Other columns are not read. Repeated rows are duplicates.

Each conversation is searched depth first with an explicit stack. A node is (row, state, cost). The
cheapest completion from every row and state, from one backward sweep, is the lower bound; children
are tried by bound and then by initial, so the first solution at the bound has the ASCII-least audit;
a table of the least cost per (row, state) removes worse prefixes. Turns lie in ranges of bounded size,
so a conversation may be cut into segments. The segments' costs between states (4 x 4) meet on the
driver, where at most one conversation per border of two ranges occurs, and give each segment its
first state and the bounds at its end.
"""

import hashlib
from array import array
from itertools import groupby

import pyarrow as pa
from pyspark.sql import functions as F

from basketlens.llm.common import ranged, written

DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: The state after the only turn that an insertion or a new role may give in each state.
NEXT = (USER, USER, ASSISTANT, USER)
#: The state after keeping a turn of this initial.
KEEP = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER,
        ("a", USER): ASSISTANT}
LEGAL = {"su", "ua", "au"}
NEVER = 1 << 50
#: What is left to pay at the end of a conversation in each state before insertions.
END = (0, NEVER, NEVER, 0)
BLANKS = " \t\n\v\f\r"
#: Edits, and characters of text, that one piece of a result holds about.
PIECE, PIECE_TEXT = 1000, 1 << 20
ORDER = ["turn", "role", "digest", "row"]
EDIT = "struct<edit:string,turn:long,role:string,text:string>"
PIECES = ("conv_id long, part long, piece long, split boolean, blank long, duplicate long, "
          "truncated long, illegal long, turns long, low long, high long, cost long, audit string, "
          f"repaired_sha256 string, edits array<{EDIT}>")
_EDITS = pa.list_(pa.struct([("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()),
                             ("text", pa.string())]))
_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")


def bounds(rows, ends, last):
    """The least cost from each row and state on, four states a row, as a flat array."""
    found = array("q", bytes(32 * (len(rows) + 1)))

    def put(at, low):
        for state in range(4):
            one = NEXT[state]
            found[at + state] = min(low[state], INSERT + low[one], 2 * INSERT + low[NEXT[one]])

    at = 4 * len(rows)
    if last:
        put(at, ends)
    else:
        found[at:] = array("q", ends)
    for initial, forced, cut in reversed(rows):
        after, at = at, at - 4
        low = []
        for state in range(4):
            cost = DELETE + found[after + state]
            if not forced:
                cost = min(cost, REROLE + cut + found[after + NEXT[state]])
                kept = KEEP.get((initial, state))
                if kept is not None:
                    cost = min(cost, cut + found[after + kept])
            low.append(cost)
        put(at, low)
    return found


def search(rows, entry=START, ends=END, last=True):
    """(cost, edits, final state) of the cheapest and then ASCII-least edits of ``rows``.

    A row is (initial of its role, must go, cost of staying). An edit is (initial, row, state after);
    an insertion stands before its row. Where more segments follow, ``ends`` holds what they cost from
    each state, and turns missing at the border are theirs to insert.
    """
    lower = bounds(rows, ends, last)
    least = array("q", [NEVER]) * len(lower)
    stack, best = [(0, entry, 0, None)], None
    while stack:
        row, state, cost, trail = stack.pop()
        node = 4 * row + state
        if cost >= least[node] or best and cost + lower[node] >= best[0]:
            continue
        least[node] = cost
        if row == len(rows) and ends[state] < NEVER:
            best = (cost + ends[state], trail, state)
            continue
        next_state, children = NEXT[state], []
        if row < len(rows):
            initial, forced, cut = rows[row]
            children.append((row + 1, state, cost + DELETE, "D"))
            if not forced:
                kept = KEEP.get((initial, state))
                if kept is not None:
                    children.append((row + 1, kept, cost + cut, "K"))
                children.append((row + 1, next_state, cost + REROLE + cut, "R"))
        if row < len(rows) or last:
            children.append((row, next_state, cost + INSERT, "I"))
        children.sort(key=lambda c: (c[2] + lower[4 * c[0] + c[1]], c[3]), reverse=True)
        for to, to_state, paid, letter in children:
            if paid + lower[4 * to + to_state] < NEVER:
                stack.append((to, to_state, paid, (trail, letter, row, to_state)))
    cost, trail, state = best
    edits = []
    while trail:
        trail, letter, row, after = trail
        edits.append((letter, row, after))
    return cost, edits[::-1], state


def _faults(row):
    """(row of the search, blank, duplicate, truncated)."""
    core = row["text"].strip(BLANKS)
    blank = not core
    again = not blank and row["again"]
    cut = not blank and not again and core[-1] not in ".!?"
    return (row["role"][:1], blank or again, TRUNCATED * cut), blank, again, cut


def _segments(batches):
    """Sorted Arrow batches as lists of rows of one (conv_id, part), without the rows that are gone."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for key, group in groupby(rows, key=lambda r: (r["conv_id"], r["part"])):
        yield key, [r for r in group if not r["gone"]]


def _segment_costs(batches):
    """Least costs from each to each state, and what borders on the neighbours."""
    for (conv, part), rows in _segments(batches):
        search_rows = [_faults(r)[0] for r in rows]
        costs = [[] for _ in range(4)]
        for leave in range(4):
            ends = [NEVER] * 4
            ends[leave] = 0
            found = bounds(search_rows, ends, False)
            for enter in range(4):
                costs[enter].append(found[enter])
        yield pa.RecordBatch.from_pydict({
            "conv_id": pa.array([conv], pa.int64()), "part": pa.array([part], pa.int64()),
            "costs": pa.array([sum(costs, [])], pa.list_(pa.int64())),
            "role": pa.array([rows[-1]["role"][:1] if rows else None], pa.string()),
            "turn": pa.array([rows[-1]["turn"] if rows else None], pa.int64()),
            "empty": pa.array([not rows], pa.bool_())})


def _segment_exits(places):
    """For the segments of ``places``, the last state from each first state."""
    def run(batches):
        for (conv, part), rows in _segments(batches):
            place = places[conv, part]
            search_rows = [_faults(r)[0] for r in rows]
            exits = [search(search_rows, enter, place["ends"], place["last"])[2]
                     for enter in range(4)]
            yield pa.RecordBatch.from_pydict({
                "conv_id": pa.array([conv], pa.int64()), "part": pa.array([part], pa.int64()),
                "exits": pa.array([exits], pa.list_(pa.int64()))})
    return run


def _repaired(places, texts):
    """Pieces of the repaired segments."""
    alone = {"entry": START, "ends": END, "last": True, "role": None, "turn": None}

    def pieces(conv, part, rows):
        split = (conv, part) in places
        place = places.get((conv, part), alone)
        faults = [_faults(r) for r in rows]
        _, edits, _ = search([f[0] for f in faults], place["entry"], place["ends"], place["last"])
        carry, digest = split or texts, hashlib.sha256()
        number, stood, role, turn = 0, False, place["role"], place["turn"]

        def fresh():
            return dict.fromkeys((*_COUNTS, "cost"), 0) | {
                "low": None, "high": None, "audit": [], "edits": []}

        made, held = fresh(), 0
        for letter, at, state in edits:
            row = rows[at] if letter != "I" else {"turn": None, "role": None, "text": ""}
            if letter != "I":
                _, blank, again, cut = faults[at]
                made["blank"] += blank
                made["duplicate"] += again
                made["truncated"] += cut
                made["illegal"] += role is not None and role + row["role"][:1] not in LEGAL
                role = row["role"][:1]
                if row["turn"] is not None:
                    made["turns"] += row["turn"] != turn
                    turn = row["turn"]
                    made["low"] = turn if made["low"] is None else made["low"]
                    made["high"] = turn
                made["cost"] += (TRUNCATED * cut if letter != "D" else DELETE)
            made["cost"] += {"I": INSERT, "R": REROLE}.get(letter, 0)
            made["audit"].append(letter)
            new_role = ROLE[state] if letter in "IR" else row["role"]
            if letter != "D":
                digest.update(("\n" * stood + f"{new_role}:{row['text']}").encode())
                stood = True
            if carry:
                made["edits"].append({"edit": letter, "turn": row["turn"], "role": new_role,
                                      "text": row["text"]})
                held += len(row["text"])
            if len(made["audit"]) >= PIECE or held >= PIECE_TEXT:
                yield made | {"conv_id": conv, "part": part, "piece": number, "split": split}
                number, made, held = number + 1, fresh(), 0
        yield made | {"conv_id": conv, "part": part, "piece": number, "split": split,
                      "repaired_sha256": None if split else digest.hexdigest()}

    schema = pa.schema([(n, pa.int64()) for n in ("conv_id", "part", "piece")]
                       + [("split", pa.bool_())]
                       + [(n, pa.int64()) for n in (*_COUNTS, "low", "high", "cost")]
                       + [("audit", pa.string()), ("repaired_sha256", pa.string()),
                          ("edits", _EDITS)])

    def run(batches):
        made, held = [], 0
        for (conv, part), rows in _segments(batches):
            for piece in pieces(conv, part, rows):
                held += 1 + len(piece["audit"])
                made.append(piece | {"audit": "".join(piece["audit"])})
                if held >= 4 * PIECE:
                    yield pa.RecordBatch.from_pylist(made, schema)
                    made, held = [], 0
        if made:
            yield pa.RecordBatch.from_pylist(made, schema)
    return run


def _chain(found, exits=None):
    """Places of the segments of cut conversations: bounds at the end, and the state at the start."""
    places = {}
    for conv, rows in groupby(sorted(found, key=lambda r: (r["conv_id"] is not None, r["conv_id"] or 0,
                                                           r["part"])), key=lambda r: r["conv_id"]):
        rows = list(rows)
        ends, last = list(END), True
        for row in reversed(rows):
            places[conv, row["part"]] = {"ends": tuple(ends), "last": last}
            closed = list(bounds([], ends, True)) if last else ends
            through = [min(row["costs"][4 * enter + leave] + closed[leave] for leave in range(4))
                       for enter in range(4)]
            ends, last = through, False
        state, role, turn = START, None, None
        for row in rows:
            place = places[conv, row["part"]]
            place |= {"entry": state, "role": role, "turn": turn}
            if exits:
                state = exits[conv, row["part"]][state]
            if not row["empty"]:
                role, turn = row["role"], row["turn"] if row["turn"] is not None else turn
    return places


def _ordered(turns):
    """Turns written in ranges of their order, each with whether its role and text came before."""
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), F.coalesce("gone", F.lit(False)).alias("gone"))
    rows = rows.withColumns({"digest": F.md5("text"), "row": F.monotonically_increasing_id()})
    return ranged(rows, ["conv_id", *ORDER], "turns")


def _marked(rows):
    """Rows with ``again``: the same role and text stands earlier in the conversation."""
    # Only texts that recur are kept, so that this side stays small. Nulls come first in a struct.
    first = rows.where("not gone").groupBy("conv_id", "role", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("turn", "row"))["row"].alias("first")).where(
        "n > 1").select(F.col("conv_id").alias("c"), F.col("role").alias("r"),
                        F.col("digest").alias("d"), "first")
    same = (F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r"))
            & (F.col("digest") == F.col("d")))
    return rows.join(first, same, "left").withColumn(
        "again", F.coalesce(F.col("first") != F.col("row"), F.lit(False))).drop("c", "r", "d", "first")


def _in_order(rows):
    """Rows of each segment together and in order."""
    return rows.repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", *ORDER).select(
        "conv_id", "part", "turn", "role", "text", "gone", "again")


def repair(turns, texts=True):
    """Edited conversations in pieces: of each segment (conv_id, part) its edits in order, with counts.

    ``turns`` has conv_id, turn, role, text and gone. Without ``texts`` the edits are left out, but for
    conversations that lie in several ranges.
    """
    rows = _ordered(turns)
    cut = rows.groupBy("conv_id").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a < b")
    # A border between two ranges cuts one conversation at most, so these are fewer than the ranges.
    cut = [r["conv_id"] for r in cut.select("conv_id").collect()]
    marked, places = _marked(rows), {}
    if cut:
        named = rows.sparkSession.createDataFrame([(c,) for c in cut], "c long")
        some = marked.join(named, F.col("conv_id").eqNullSafe(F.col("c")), "left_semi")
        some = written(some, "cut_turns")
        found = _in_order(some).mapInArrow(
            _segment_costs, "conv_id long, part long, costs array<long>, role string, turn long, "
                            "empty boolean").collect()
        exits = _in_order(some).mapInArrow(
            _segment_exits(_chain(found)), "conv_id long, part long, exits array<long>").collect()
        places = _chain(found, {(r["conv_id"], r["part"]): r["exits"] for r in exits})
    return _in_order(marked).mapInArrow(_repaired(places, texts), PIECES)


def repaired_turns(pieces):
    """The repaired conversations, a row per turn: conv_id, place (rising), edit, turn, role, text."""
    edits = pieces.select("conv_id", "part", "piece", F.posexplode("edits").alias("at", "e"))
    place = (F.col("part") * F.lit(1 << 42) + F.col("piece") * F.lit(1 << 12) + F.col("at"))
    return edits.where("e.edit <> 'D'").select("conv_id", place.alias("place"), "e.edit", "e.turn",
                                               "e.role", "e.text")


def _digests(batches):
    """SHA-256 of each conversation's repaired turns, one piece after the other."""
    pieces = (p for batch in batches for p in batch.to_pylist())
    for conv, group in groupby(pieces, key=lambda p: p["conv_id"]):
        digest, stood = hashlib.sha256(), False
        for piece in group:
            for e in piece["edits"]:
                if e["edit"] != "D":
                    digest.update(("\n" * stood + f"{e['role']}:{e['text']}").encode())
                    stood = True
        yield pa.RecordBatch.from_pydict({"c": pa.array([conv], pa.int64()),
                                          "whole": pa.array([digest.hexdigest()], pa.string())})


def report(turns):
    """One row per conversation: gaps, faults, cost, audit and the digest of its repaired turns.

    The digest of a conversation that lies in several ranges reads its turns one after the other in one
    task, as the digest demands, but holds one piece at a time.
    """
    pieces = written(repair(turns, texts=False), "repaired")
    names = [*_COUNTS[:4], "cost"]
    parts = F.sort_array(F.collect_list(F.struct("part", "piece", "audit")))
    gaps = F.max("high") - F.min("low") + 1 - F.sum("turns")
    found = pieces.groupBy("conv_id").agg(
        F.coalesce(gaps, F.lit(0)).alias("gaps"), *[F.sum(n).alias(n) for n in names],
        F.array_join(parts["audit"], "").alias("audit"), F.max("repaired_sha256").alias("one"))
    whole = pieces.where("split").select("conv_id", "part", "piece", "edits").repartition(
        "conv_id").sortWithinPartitions("conv_id", "part", "piece").mapInArrow(
        _digests, "c long, whole string")
    return found.join(whole, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
        "conv_id", "gaps", *names[:4], "cost", "audit",
        F.coalesce("one", "whole").alias("repaired_sha256"))
