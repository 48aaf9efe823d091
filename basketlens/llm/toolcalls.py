"""Tool calls of conversations: linked to their results, ordered, validated and serialised."""

import json
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql import types as T

from basketlens.functions.prefix import running_totals
from basketlens.llm.common import components, written

#: Turns of a conversation that are numbered in one task.
BUCKET = 512
#: Calls of a conversation that is ordered in one task, and of each range of a larger one.
NEAR, RANGE = 20_000, 200_000
_SURROGATES = re.compile("[\ud800-\udfff]")
_KINDS = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list,
          "object": dict, "null": type(None)}


def _no_constant(name):
    raise ValueError(f"{name} is not JSON")


class BadSchema(ValueError):
    """A schema that says nothing that could be checked."""


def _is(value, kind):
    return isinstance(value, _KINDS[kind]) and (kind == "boolean" or not isinstance(value, bool))


def _same(a, b):
    """Equality of JSON values: true is not 1."""
    return a == b and isinstance(a, bool) == isinstance(b, bool)


def _kinds(schema):
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if not isinstance(kinds, list) or any(not isinstance(k, str) or k not in _KINDS for k in kinds):
        raise BadSchema("unknown type")
    return kinds


def _bounds(schema, name):
    bound = schema.get(name)
    if bound is not None and not _is(bound, "number"):
        raise BadSchema(f"{name} is no number")
    return bound


def compiled(schema):
    """A schema as a function (value, its name, errors) that adds what is wrong with the value.

    Understood are type (one or several), enum, minimum, maximum, properties, required,
    additionalProperties, items, anyOf and the schemas true and false, nested to any depth. Others are
    ignored. A schema of another form raises BadSchema.
    """
    if isinstance(schema, bool):
        return lambda value, name, found: None if schema else found.append(f"{name} is not allowed")
    if not isinstance(schema, dict):
        raise BadSchema("no object")
    kinds, allowed = _kinds(schema), schema.get("enum")
    low, high = (_bounds(schema, n) for n in ("minimum", "maximum"))
    properties, required = schema.get("properties", {}), schema.get("required", [])
    if allowed is not None and not isinstance(allowed, list):
        raise BadSchema("enum is no array")
    if not isinstance(properties, dict):
        raise BadSchema("properties are no object")
    if not isinstance(required, list) or any(not isinstance(r, str) for r in required):
        raise BadSchema("required is no array of names")
    rules = {name: compiled(rule) for name, rule in properties.items()}
    other = compiled(schema.get("additionalProperties", True))
    strict = schema.get("additionalProperties", True) is False
    items = compiled(schema["items"]) if "items" in schema else None
    choices = schema.get("anyOf")
    if choices is not None and not isinstance(choices, list):
        raise BadSchema("anyOf is no array")
    choices = [compiled(c) for c in choices or []]

    def fits(rule, value):
        wrong = []
        rule(value, "", wrong)
        return not wrong

    def check(value, name, found):
        if kinds and not any(_is(value, k) for k in kinds):
            found.append(f"{name or 'arguments'} is no {' or '.join(kinds)}")
            return
        if allowed is not None and not any(_same(value, a) for a in allowed):
            found.append(f"{name} is not allowed")
        if _is(value, "number"):
            if low is not None and value < low:
                found.append(f"{name} is too small")
            if high is not None and value > high:
                found.append(f"{name} is too large")
        if choices and not any(fits(c, value) for c in choices):
            found.append(f"{name} fits no alternative")
        if isinstance(value, dict):
            path = f"{name}." if name else ""
            found += [f"missing {path}{r}" for r in sorted(set(required) - set(value))]
            for key in sorted(value):
                if key not in rules and strict:
                    found.append(f"unknown {path}{key}")
                else:
                    rules.get(key, other)(value[key], path + key, found)
        if items and isinstance(value, list):
            for i, part in enumerate(value):
                items(part, f"{name}[{i}]", found)

    return check


def problems(arguments, schema):
    """What is wrong with parsed ``arguments``, in order; ``schema`` is a compiled or a parsed one."""
    if not isinstance(arguments, dict):
        return ["arguments are no object"]
    found = []
    (schema if callable(schema) else compiled(schema))(arguments, "", found)
    return found


def _rule(text):
    """(compiled schema, None) of a schema's text, or (None, what is wrong with it)."""
    try:
        return compiled(json.loads(text, parse_constant=_no_constant)), None
    except BadSchema as wrong:
        return None, f"bad schema: {wrong}"
    except (ValueError, RecursionError):
        return None, "bad schema: no JSON"


def escaped(text):
    """Lone surrogates, which JSON may spell but UTF-8 cannot hold, as JSON escapes."""
    return _SURROGATES.sub(lambda m: f"\\u{ord(m.group()):04x}", text)


def canonical(value):
    """JSON with sorted keys and no white space, non-ASCII characters as they are but for surrogates."""
    return escaped(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False,
                              allow_nan=False))


def examined(tool, text, schema, call_id, result, rules=None):
    """(errors, canonical JSON) of one call; arguments that are no JSON are kept as a string.

    ``rules`` remembers the compiled schemas of a task by their text. A schema that cannot be read is an
    error of the call.
    """
    errors, rules = [], {} if rules is None else rules
    try:
        arguments = json.loads(text, parse_constant=_no_constant) if text is not None else None
    except (ValueError, RecursionError):
        arguments, errors = text, ["arguments are no JSON"]
    if schema is None:
        errors.append("unknown tool")
    else:
        if schema not in rules:
            rules[schema] = _rule(schema)
        rule, wrong = rules[schema]
        if wrong:
            errors.append(wrong)
        elif not errors:
            errors = problems(arguments, rule)
    try:
        line = canonical({"arguments": arguments, "id": call_id, "name": tool, "result": result})
    except (ValueError, RecursionError):
        line = canonical({"arguments": text, "id": call_id, "name": tool, "result": result})
    return [escaped(e) for e in errors], line


def _examined(batches):
    rules = {}
    for batch in batches:
        columns = [batch[n].to_pylist() for n in
                   ("tool", "arguments", "schema", "call_id", "result")]
        found = [examined(*row, rules) for row in zip(*columns)]
        names = [n for n in batch.schema.names if n not in ("arguments", "schema", "result")]
        yield pa.RecordBatch.from_arrays(
            [batch[n] for n in names]
            + [pa.array([e for e, _ in found], pa.list_(pa.string())),
               pa.array([j for _, j in found], pa.string())], [*names, "errors", "json"])


def _longest(pdf):
    """Levels of the calls of some whole conversations from their (parent, child) edges."""
    children, waiting, level = {}, {}, {}
    for parent, child in zip(pdf["parent"], pdf["child"]):
        children.setdefault(parent, []).append(child)
        waiting[child] = waiting.get(child, 0) + 1
        level[parent] = level[child] = 0
    ready = [x for x in level if not waiting.get(x)]
    for call in ready:  # grows as calls become ready
        for child in children.get(call, ()):
            level[child] = max(level[child], level[call] + 1)
            waiting[child] -= 1
            if not waiting[child]:
                ready.append(child)
    return pd.DataFrame({"call_id": list(level), "level": list(level.values()),
                         "cyclic": [bool(waiting.get(x)) for x in level]})


def _ranged(key, pdf):
    """Levels of the calls of one range all of whose parents are known or settle with it.

    An edge has the level of its parent, or -1 where that is not known.
    """
    children, waiting, level = {}, {}, {}
    for parent, child, known in zip(pdf["parent"].tolist(), pdf["child"].tolist(),
                                    pdf["level"].tolist()):
        waiting[child] = waiting.get(child, 0) + (known < 0)
        level[child] = max(level.get(child, 0), known + 1)
        if known < 0:
            children.setdefault(parent, []).append(child)
    ready = [x for x in waiting if not waiting[x]]
    for call in ready:  # grows as calls become ready
        for child in children.get(call, ()):
            level[child] = max(level[child], level[call] + 1)
            waiting[child] -= 1
            if not waiting[child]:
                ready.append(child)
    return pd.DataFrame({"line": key[0], "place": ready, "level": [level[x] for x in ready]},
                        columns=["line", "place", "level"])


def _by_range(home, pairs):
    """(call_id, level, cyclic) of calls in lines too long for a task, range after range.

    A call settles once all its parents have. A range of places settles in one task per line and hands
    the levels on to the edges of other ranges. Edges against the order of places wait for the next
    sweep over the ranges. A sweep that settles nothing leaves cycles and what is behind them.
    """
    spark = home.sparkSession
    placed = written(running_totals(
        home.withColumn("chunk", F.coalesce(F.floor(F.col("turn") / BUCKET), F.lit(-1))),
        ["line"], "chunk", ["turn", "call_id"], {"place": F.lit(1)}).select(
        "call_id", "line", F.col("place").cast("long")), "placed")
    place = placed.drop("line")
    links = pairs.join(place.toDF("child", "c"), "child").join(
        place.toDF("parent", "p"), "parent").select(
        "line", F.col("p").alias("parent"), F.col("c").alias("child"),
        F.floor((F.col("p") - 1) / RANGE).alias("from"), F.floor((F.col("c") - 1) / RANGE).alias("to"))
    links = written(links, "links")
    inner = links.select("line", F.col("child").alias("parent"), F.lit(-1).alias("level")).distinct()
    keys, solved = ["line", "parent"], []
    left = links.join(inner, keys, "left").withColumn("level", F.coalesce("level", F.lit(0)))

    def read(parts):
        """One scan of several written tables."""
        return spark.read.schema(parts[0].schema).parquet(
            *[name for part in parts for name in part.inputFiles()]) if any(
                part.inputFiles() for part in parts) else parts[0]

    while True:
        # In order of ranges, so that a round reads little besides its own.
        left = written(left.repartitionByRange("to"), "left")
        settled, handed = [], []
        for at in [row["to"] for row in left.select("to").distinct().orderBy("to").collect()]:
            own = left.where(F.col("to") == at)
            if handed:
                own = own.join(read(handed).where(F.col("to") == at).select(
                    *keys, "child", F.col("level").alias("met")), [*keys, "child"], "left"
                    ).withColumn("level", F.coalesce("met", "level"))
            settled.append(written(own.select("line", "parent", "child", "level").groupBy(
                "line").applyInPandas(_ranged, "line long, place long, level int"), "settled"))
            onward = left.where((F.col("from") == at) & (F.col("to") > at) & (F.col("level") < 0))
            handed.append(written(onward.drop("level").join(
                settled[-1].withColumnRenamed("place", "parent"), keys), "handed"))
        found = read(settled) if settled else None
        if found is None or found.isEmpty():
            break
        solved.append(found)
        parents = found.select("line", F.col("place").alias("parent"), F.col("level").alias("met"))
        left = left.join(found.select("line", F.col("place").alias("child")), ["line", "child"],
                         "left_anti").join(parents, keys, "left").withColumn(
            "level", F.coalesce("met", "level")).select("line", "parent", "child", "from", "to",
                                                         "level")
    rows = left.select("line", F.col("child").alias("place"), F.lit(0).alias("level"),
                       F.lit(True).alias("cyclic")).distinct()
    for found in solved:
        rows = rows.union(found.withColumn("cyclic", F.lit(False)))
    return rows.join(placed, ["line", "place"]).select("call_id", "level", "cyclic")


def levels(nodes, edges):
    """(call_id, level): the length of the longest chain of calls before each; null in a cycle.

    A line is a conversation, or several that calls of each other link. Lines of at most ``NEAR``
    calls are ordered in tasks, many to a task; larger ones range after range of ``RANGE`` calls.
    """
    home = nodes.select("call_id", "turn", F.xxhash64("conv_id").alias("conv"))
    convs = home.select("call_id", "conv")
    pairs = written(edges.select("parent", "child").distinct().join(
        convs.toDF("child", "conv"), "child").join(convs.toDF("parent", "other"), "parent"), "pairs")
    crossing = pairs.where("conv <> other")
    line = F.col("conv")
    if not crossing.isEmpty():
        labels = written(components(crossing.select(
            F.col("conv").alias("a"), F.col("other").alias("b"))).toDF("conv", "label"), "lines")
        home, pairs = home.join(labels, "conv", "left"), pairs.join(labels, "conv", "left")
        line = F.coalesce("label", "conv")
    home = home.select("call_id", "turn", line.alias("line"))
    pairs = pairs.select("parent", "child", line.alias("line"))
    far = written(home.groupBy("line").count().where(F.col("count") > NEAR).select("line"), "far")
    buckets = max(1, -(-nodes.count() // NEAR))
    reached = pairs.join(far, "line", "left_anti").select(
        "parent", "child", F.pmod("line", F.lit(buckets)).alias("bucket")).groupBy(
        "bucket").applyInPandas(_longest, "call_id string, level int, cyclic boolean")
    if not far.isEmpty():
        reached = reached.union(_by_range(home.join(far, "line", "left_semi"),
                                          pairs.join(far, "line", "left_semi")))
    top = reached.groupBy("call_id").agg(F.max("level").alias("level"),
                                         F.max("cyclic").alias("cyclic"))
    return nodes.select("call_id").join(top, "call_id", "left").select(
        "call_id", F.when(~F.coalesce("cyclic", F.lit(False)),
                          F.coalesce("level", F.lit(0))).alias("level"))


def link(calls, results, schemas):
    """One row per call, and per result whose call is unknown.

    calls: conv_id, turn, call_id, tool, arguments (JSON text), depends_on (array of call_ids);
    results: call_id, result; schemas: tool, schema (JSON text). Returned: conv_id, turn, call_id,
    tool, status (linked, no_result, orphan_result), level (longest chain of calls before it), rank
    (topological place in its conversation from 0, by level and then turn), valid, errors, json.

    Of calls with one call_id the earliest by (conv_id, turn) counts, of results the smallest text;
    rows without call_id take no part. Dependencies on unknown calls are errors and order nothing; a
    call on a cycle or behind one has no level and rank and is an error. A null tool, one without a
    schema and one whose schema cannot be read are errors; of several schemas of a tool the smallest text counts. Other columns are
    ignored; repeated rows count once; empty tables give no rows.
    """
    first = F.min_by(F.struct("conv_id", "turn", "tool", "arguments", "depends_on"),
                     F.struct("conv_id", "turn", "tool", "arguments"))
    nodes = written(calls.where("call_id is not null").groupBy("call_id").agg(
        first.alias("call")).select("call_id", "call.*"), "calls")
    asked = nodes.select(F.col("call_id").alias("child"), F.explode("depends_on").alias("parent")
                         ).where("parent is not null").distinct()
    known = nodes.select(F.col("call_id").alias("parent"), F.lit(True).alias("known"))
    asked = written(asked.join(known, "parent", "left"), "asked")
    depth = levels(nodes, asked.where("known"))
    strange = asked.where("known is null").groupBy("child").agg(
        F.array_sort(F.collect_set("parent")).alias("strange")).withColumnRenamed(
        "child", "call_id")
    answers = results.where("call_id is not null").groupBy("call_id").agg(
        F.min("result").alias("result"), F.lit(True).alias("answered"))
    rules = schemas.where("tool is not null").groupBy("tool").agg(F.min("schema").alias("schema"))
    joined = nodes.drop("depends_on").withColumn("called", F.lit(True)).join(
        answers, "call_id", "full").join(depth, "call_id", "left").join(
        strange, "call_id", "left").join(rules, "tool", "left")
    status = F.when(F.col("called").isNull(), "orphan_result").when(
        F.col("answered"), "linked").otherwise("no_result")
    rows = joined.select("conv_id", "turn", "call_id", "tool", status.alias("status"), "level",
                         "strange", "arguments", "schema", "result")
    schema = rows.drop("arguments", "schema", "result").schema.add(
        "errors", T.ArrayType(T.StringType())).add("json", "string")
    done = written(rows.mapInArrow(_examined, schema), "examined")
    # Places: totals of buckets of turns are added up, then rows are numbered within a bucket.
    bucket = ["conv_id", "level", F.floor(F.col("turn") / BUCKET).alias("bucket")]
    placed = done.where("level is not null").select("call_id", "turn", *bucket)
    # Levels too go by cells, since a chain has as many as it has calls.
    counts = placed.groupBy("conv_id", "level", "bucket").agg(F.count("*").alias("n"))
    totals = running_totals(
        counts.select(F.struct("conv_id").alias("conv"), "level", "bucket", "n",
                      F.floor(F.col("level") / BUCKET).alias("cell")), ["conv"], "cell",
        ["level", "bucket"], {"upto": F.col("n")}).select(
        F.col("conv.conv_id").alias("c"), F.col("level").alias("l"), F.col("bucket").alias("b"),
        (F.col("upto") - F.col("n")).alias("before"))
    inside = Window.partitionBy("conv_id", "level", "bucket").orderBy("turn", "call_id")
    ranks = placed.withColumn("within", F.row_number().over(inside) - 1).join(
        totals, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("level") == F.col("l"))
        & F.col("bucket").eqNullSafe(F.col("b"))).select(
        "call_id", (F.col("before") + F.col("within")).alias("rank"))
    orphan = F.col("status") == "orphan_result"
    errors = F.when(orphan, F.array(F.lit("unknown call"))).otherwise(F.concat(
        "errors", F.transform(F.coalesce("strange", F.array().cast("array<string>")),
                              lambda x: F.concat(F.lit("unknown dependency "), x)),
        F.when(F.col("level").isNull(), F.array(F.lit("cyclic dependency"))).otherwise(
            F.array().cast("array<string>"))))
    return done.join(ranks, "call_id", "left").select(
        "conv_id", "turn", "call_id", "tool", "status", "level", "rank",
        (F.size(errors) == 0).alias("valid"), errors.alias("errors"), "json")
