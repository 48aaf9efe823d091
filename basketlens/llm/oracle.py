"""DuckDB SQL of the queries that SQL can express, by plain means."""


def crc32(text):
    """CRC-32 of ASCII text: every byte is followed by eight shifts."""
    steps = ", ".join(["-1"] * 8)
    return f"""xor(list_reduce(flatten(list_transform(string_split({text}, ''),
  lambda ch: [CAST(ascii(ch) AS BIGINT), {steps}])), lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x)
  WHEN acc % 2 = 1 THEN xor(acc >> 1, 3988292384) ELSE acc >> 1 END, CAST(4294967295 AS BIGINT)),
  4294967295)"""


SOURCE_MIX = r"""
WITH d AS (
  SELECT doc_id, coalesce('=' || source, '~') AS named,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS k FROM documents),
s AS (SELECT named, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
w AS (
  SELECT named, source_size, CASE (row_number() OVER (ORDER BY named) - 1) % 3
    WHEN 0 THEN CAST(5 AS DOUBLE) WHEN 1 THEN CAST(2 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS weight
  FROM s),
l AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * CAST(1.5 AS DOUBLE)
      - CAST(2 * (sum(source_size) OVER o - source_size) AS DOUBLE))
    / (sum(weight) OVER () - (sum(weight) OVER o - weight)) AS level
  FROM w WINDOW o AS (ORDER BY 2 * source_size / weight, named ROWS UNBOUNDED PRECEDING)),
t AS (
  SELECT named, source_size,
    least(CAST(2 * source_size AS DOUBLE), max(level) OVER () * weight) AS target FROM l),
p AS (
  SELECT doc_id, size, source_size, target, CAST(round(target) AS BIGINT) AS budget,
    CAST(sum(size) OVER (PARTITION BY named ORDER BY k ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
  FROM d JOIN t USING (named))
SELECT doc_id, size, source_size, target, CAST(coalesce(budget // nullif(source_size, 0) * size
  + greatest(0, least(size, budget % nullif(source_size, 0) - (upto - size))), 0) AS BIGINT) AS taken
FROM p"""


def _step(state, letter, cost, kept=None):
    out = f"list_append({state}.o, {kept})" if kept else f"{state}.o"
    return (f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, "
            f"'a': {state}.a || '{letter}', 'o': {out}}} END")


def _stay(state, initial):
    return f"CASE WHEN NOT forced AND initial = '{initial}' THEN " + _step(
        state, "K", "cut", "role || ':' || text") + " END"


def _rerole(state, role):
    return "CASE WHEN NOT forced THEN " + _step(
        state, "R", "2 + cut", f"'{role}:' || text") + " END"


_USER_IN = "least(u, " + ", ".join(_step(x, "I", 2, "'user:'") for x in ("st", "s", "a")) + ")"
_ASSISTANT_IN = f"least(a, {_step('u1', 'I', 2, chr(39) + 'assistant:' + chr(39))})"

#: The cheapest edits of each prefix per state (nothing, s, u, a), row after row.
REPAIRED_CONVERSATIONS = rf"""
WITH RECURSIVE faulty AS (
  SELECT conv_id, turn, {crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS f,
    coalesce(role, ' ') AS role, coalesce(text, ' ') AS text FROM conversations),
live AS (
  SELECT conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role, CASE f WHEN 1 THEN ''
    WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM faulty, generate_series(1, CASE f WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i
  FROM live),
marked AS (
  SELECT conv_id, turn, role, text, i, substr(role, 1, 1) AS initial,
    NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS open_end,
    lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
turns AS (
  SELECT *, blank OR again AS forced, CAST(NOT blank AND NOT again AND open_end AS BIGINT) AS cut
  FROM marked),
steps AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, {{'c': CAST(0 AS BIGINT), 'a': '', 'o': CAST([] AS VARCHAR[])}} AS st,
    CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, o VARCHAR[])) AS s,
    CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, o VARCHAR[])) AS u,
    CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, o VARCHAR[])) AS a
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, {_step("st", "D", 3)} AS st,
    least({_step("s", "D", 3)}, {_stay("st", "s")}) AS s,
    least({_step("u1", "D", 3)}, {_stay("st", "u")}, {_stay("s", "u")}, {_stay("a1", "u")},
      {_rerole("st", "user")}, {_rerole("s", "user")}, {_rerole("a1", "user")}) AS u,
    least({_step("a1", "D", 3)}, {_stay("u1", "a")}, {_rerole("u1", "assistant")}) AS a
  FROM (SELECT *, {_ASSISTANT_IN} AS a1 FROM (SELECT t.conv_id, t.i, st, s, u, a, {_USER_IN} AS u1,
      t.forced, t.cut, t.initial, t.role, t.text
    FROM steps JOIN turns t ON t.conv_id IS NOT DISTINCT FROM steps.conv_id AND t.i = steps.i + 1))),
best AS (
  SELECT conv_id, least(st, {_ASSISTANT_IN}) AS b FROM (SELECT *, {_USER_IN} AS u1 FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS back FROM steps)
    WHERE back = 1)),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
    sum(cut) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM turns GROUP BY conv_id)
SELECT b.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(b.b.c AS BIGINT) AS cost, b.b.a AS audit,
  sha256(coalesce(array_to_string(b.b.o, chr(10)), '')) AS repaired_sha256
FROM best b LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM b.conv_id"""

CONVERSATION_TRIE = f"""
WITH r AS (
  SELECT conv_id AS c, role, text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS p
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL)),
sizes AS (SELECT c, count(*) AS n, {crc32("CAST(c AS VARCHAR)")} % 6 AS h FROM r GROUP BY c),
plan AS (
  SELECT a.c, a.n, a.h, a.c - a.c % 100 AS head, least(a.h, coalesce(b.n, 0)) AS k
  FROM sizes a LEFT JOIN sizes b ON b.c = a.c - a.c % 100),
turns AS (
  SELECT plan.c, p - h + k AS d, role, text FROM plan JOIN r ON r.c = plan.c WHERE p > h
  UNION ALL SELECT plan.c, p, role, text FROM plan JOIN r ON r.c = head WHERE p <= k),
pre AS (
  SELECT c, d, length(text) AS chars, md5(string_agg(md5(role) || md5(text), '') OVER (
    PARTITION BY c ORDER BY d)) AS node FROM turns
  UNION ALL SELECT c, 0, 0, '' FROM plan),
nodes AS (
  SELECT node, any_value(d) AS depth, any_value(chars) AS chars, count(*) AS n, min(c) AS low
  FROM pre GROUP BY node),
up AS (
  SELECT DISTINCT a.node, b.node AS parent FROM pre a JOIN pre b ON b.c = a.c AND b.d = a.d - 1),
kids AS (SELECT parent AS node, count(*) AS n_children FROM up GROUP BY 1),
subtree AS (
  SELECT p.node, sum((m.n - 1) * m.chars) AS saved, count(*) FILTER (n_children IS NULL) AS leaves
  FROM nodes m LEFT JOIN kids USING (node) JOIN pre p ON p.c = m.low AND p.d <= m.depth GROUP BY 1),
ends AS (
  SELECT node, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids
  FROM (SELECT *, d = max(d) OVER (PARTITION BY c) AS last FROM pre) WHERE last GROUP BY 1)
SELECT nodes.low AS conv_id, nodes.depth, above.low AS parent_conv_id, CAST(nodes.n AS BIGINT) AS n_convs,
  CAST(coalesce(n_children, 0) AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes JOIN subtree USING (node) LEFT JOIN kids USING (node) LEFT JOIN ends USING (node)
LEFT JOIN up USING (node) LEFT JOIN nodes above ON above.node = up.parent"""
