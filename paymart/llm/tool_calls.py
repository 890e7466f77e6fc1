"""Operator 1, tool-call linking: calls and results meet in a hash join, are put in topological order, have their
arguments checked against schemas, and become canonical JSON.

Calls and results are joined by (conversation, call id), so the rows of a very long conversation spread over all tasks.
A call's references to other calls are edges. A call whose references all come from earlier turns is in place already:
turn order is a topological order of such edges. Only calls that refer to the same or a later turn, directly or through
others, are affected; these are peeled off in rounds once all they refer to is placed, and come after it. What can't be
peeled is in a cycle, or behind one, and gets no position. Rounds are as many as the longest affected chain; without
references to later turns there are none. Positions are counted in blocks of turns, so that no task ranks a whole
conversation.

A call repeated under its id counts once, as its first by (turn, name, arguments); of several results the first by (turn,
content) is used and all are counted. Results without a call are returned as orphans. References to unknown calls, and
repeated ones, are counted and left out of the order; a reference to itself is a cycle. Rows without a conversation, id or
turn can't be linked and are returned as such. Arguments that are null or not JSON are errors and stand in the record as
null or as a string. A schema with a rule that isn't checked here ends the job. Empty tables give an empty one. Texts of any length are whole, and memory is one row's. Other columns,
whatever their names, aren't read."""

from __future__ import annotations

import json
import math
import operator
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paymart.llm.common import cut, workers_can_import

BLOCK_TURNS = 1024
LINKED = (
    "conv_id long, call_id string, turn long, name string, status string, n_copies long, n_results long, result_turn long, "
    "n_refs long, n_missing_refs long, position long, valid boolean, errors array<string>, record string"
)


# ---- JSON


def _refuse(name: str):
    raise ValueError(name)


def _plain(value):
    """Whole floats as integers, so that 1.0 and 1 are one number."""
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    if isinstance(value, list):
        return [_plain(v) for v in value]
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError("number out of range")
        return int(value) if value.is_integer() and abs(value) < 1 << 53 else value
    return value


def canonical(value) -> str:
    """Keys sorted, no blanks, text as it is."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


KINDS = {
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str),
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
}


#: Rules that `violations` checks, and words of a schema that set no rule.
RULES = {
    "type", "enum", "const", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "minLength", "maxLength", "pattern",
    "minItems", "maxItems", "items", "required", "properties", "additionalProperties",
}
NOTES = {"$schema", "$id", "$comment", "title", "description", "default", "examples", "deprecated", "readOnly", "writeOnly", "format"}


def check_schema(schema: dict, at: str = "$") -> None:
    """Raise on a rule that `violations` doesn't know, wherever it stands: arguments that break it must not pass as valid."""
    if not isinstance(schema, dict):
        raise ValueError(f"{at}: a schema is an object, not {schema!r}")
    unknown = sorted(schema.keys() - RULES - NOTES)
    if unknown:
        raise ValueError(f"{at}: unknown schema rules {', '.join(unknown)}")
    kinds = schema.get("type", [])
    if odd := [k for k in ([kinds] if isinstance(kinds, str) else kinds) if k not in KINDS]:
        raise ValueError(f"{at}: unknown types {', '.join(map(str, odd))}")
    for name, rule in schema.get("properties", {}).items():
        check_schema(rule, f"{at}.{name}")
    if "items" in schema:
        check_schema(schema["items"], f"{at}[]")
    if not isinstance(schema.get("additionalProperties", True), bool):
        check_schema(schema["additionalProperties"], f"{at}.*")


def violations(value, schema: dict, at: str = "$") -> list[str]:
    """`place rule` of every rule of a JSON schema that the value breaks, in the order of the schema."""
    out = []
    kinds = schema.get("type")
    if kinds is not None and not any(KINDS[k](value) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return [f"{at} type"]
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]):
        out.append(f"{at} enum")
    if "const" in schema and canonical(value) != canonical(schema["const"]):
        out.append(f"{at} const")
    if KINDS["number"](value):
        for rule, breaks in (("minimum", operator.lt), ("maximum", operator.gt), ("exclusiveMinimum", operator.le), ("exclusiveMaximum", operator.ge)):
            if rule in schema and breaks(value, schema[rule]):
                out.append(f"{at} {rule}")
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            out.append(f"{at} minLength")
        if len(value) > schema.get("maxLength", len(value)):
            out.append(f"{at} maxLength")
        if "pattern" in schema and not re.search(schema["pattern"], value):
            out.append(f"{at} pattern")
    if isinstance(value, list):
        if not schema.get("minItems", 0) <= len(value) <= schema.get("maxItems", len(value)):
            out.append(f"{at} items")
        for i, item in enumerate(value if "items" in schema else ()):
            out += violations(item, schema["items"], f"{at}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k} required" for k in schema.get("required", ()) if k not in value]
        for k, rule in known.items():
            if k in value:
                out += violations(value[k], rule, f"{at}.{k}")
        others = schema.get("additionalProperties", True)
        for k in sorted(value.keys() - known.keys()):
            if others is False:
                out.append(f"{at}.{k} additional")
            elif isinstance(others, dict):
                out += violations(value[k], others, f"{at}.{k}")
    return out


def check_call(call_id: str | None, name: str | None, arguments: str | None, result: str | None, schemas: dict[str, dict]) -> tuple[list[str], str]:
    """(errors, canonical record) of a call."""
    try:
        value = None if arguments is None else _plain(json.loads(arguments, parse_constant=_refuse))
        errors = ["$ missing"] if arguments is None else violations(value, schemas[name]) if name in schemas else ["unknown tool"]
    except (ValueError, RecursionError):
        value, errors = arguments, ["$ not JSON"]
    return errors, canonical({"arguments": value, "id": call_id, "name": name, "result": result})


# ---- order


def topological_keys(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """(conv_id, call_id, late, hop) of the calls that aren't simply placed by their turn: they follow turn `late`, as
    the hop-th after it; late is null in cycles and behind them. edges: (conv_id, call_id, ref, turn, ref_turn)."""
    key = ["conv_id", "call_id"]
    found = cut(edges.where("ref_turn >= turn").select(*key).distinct())
    if found.isEmpty():
        return found.select(*key, F.lit(None).cast("long").alias("late"), F.lit(None).cast("long").alias("hop"))
    edges = cut(edges)
    front = found
    while not front.isEmpty():  # all that refer to an affected call are affected
        reached = edges.join(front.select("conv_id", F.col("call_id").alias("ref")), ["conv_id", "ref"]).select(*key).distinct()
        front = cut(reached.join(found, key, "left_anti"))
        found = cut(found.unionByName(front))
    inside = cut(edges.join(found, key))
    placed = None
    left = found
    while True:
        refs = inside.join(left, key).select(*key, "turn", "ref", "ref_turn")
        waiting = refs.join(left.select("conv_id", F.col("call_id").alias("ref")), ["conv_id", "ref"]).select(*key).distinct()
        ready = refs.join(waiting, key, "left_anti")
        if placed is None:
            ready = ready.select(*key, "turn", F.struct(F.col("ref_turn").alias("late"), F.lit(0).cast("long").alias("hop")).alias("after"))
        else:
            named = placed.select("conv_id", F.col("call_id").alias("ref"), F.struct("late", "hop").alias("p"))
            ready = ready.join(named, ["conv_id", "ref"], "left").select(
                *key, "turn", F.coalesce("p", F.struct(F.col("ref_turn").alias("late"), F.lit(0).cast("long").alias("hop"))).alias("after")
            )
        step = ready.groupBy(*key, "turn").agg(F.max("after").alias("after"))
        early = F.col("after.late") < F.col("turn")
        step = cut(step.select(*key, F.when(early, F.col("turn")).otherwise(F.col("after.late")).alias("late"), F.when(early, 0).otherwise(F.col("after.hop") + 1).cast("long").alias("hop")))
        if step.isEmpty():
            break
        placed = step if placed is None else cut(placed.unionByName(step))
        left = cut(left.join(step.select(*key), key, "left_anti"))
    cyclic = left.select(*key, F.lit(None).cast("long").alias("late"), F.lit(None).cast("long").alias("hop"))
    return cyclic if placed is None else placed.unionByName(cyclic)


def positions(calls: DataFrame, keys: DataFrame) -> DataFrame:
    """(conv_id, call_id, position) by (late or turn, hop, turn, call_id); none in a cycle."""
    key = ["conv_id", "call_id"]
    placed = calls.select(*key, "turn").join(keys.withColumn("moved", F.lit(True)), key, "left")
    placed = placed.where("moved is null or late is not null").select(
        *key, "turn", F.coalesce("late", "turn").alias("at"), F.coalesce("hop", F.lit(0).cast("long")).alias("hop")
    )
    placed = placed.withColumn("block", F.floor(F.col("at") / BLOCK_TURNS))
    sizes = placed.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("conv_id", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("conv_id", "block").orderBy("at", "hop", "turn", "call_id")
    ranked = placed.withColumn("row", F.row_number().over(inside)).join(bases, ["conv_id", "block"])
    return ranked.select(*key, (F.col("base") + F.col("row") - 1).alias("position"))


# ---- linking


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """LINKED: one row a call, then the orphans and the rows that can't be linked.

    calls: conv_id, call_id, turn, name, arguments (JSON text), refs (array of call ids); results: conv_id, call_id,
    turn, content."""
    spark = calls.sparkSession
    workers_can_import(spark)
    for schema in schemas.values():
        check_schema(schema)
    key = ["conv_id", "call_id"]
    calls = calls.select(F.col("conv_id").cast("long"), "call_id", F.col("turn").cast("long"), "name", "arguments", F.array_distinct("refs").alias("refs"))
    results = results.select(F.col("conv_id").cast("long"), "call_id", F.col("turn").cast("long"), "content")
    whole = "conv_id is not null and call_id is not null and turn is not null"
    first = calls.where(whole).groupBy(*key).agg(F.min(F.struct("turn", "name", "arguments", "refs")).alias("c"), F.count(F.lit(1)).alias("n_copies"))
    first = first.select(*key, "c.*", "n_copies")
    answers = results.where(whole).groupBy(*key).agg(F.min(F.struct("turn", "content")).alias("r"), F.count(F.lit(1)).alias("n_results"))
    answers = answers.select(*key, F.col("r.turn").alias("result_turn"), F.col("r.content").alias("content"), "n_results")
    turns = first.select("conv_id", F.col("call_id").alias("ref"), F.col("turn").alias("ref_turn"))
    refs = first.select(*key, "turn", F.explode("refs").alias("ref")).join(turns, ["conv_id", "ref"], "left")
    order = positions(first, topological_keys(first, refs.where("ref_turn is not null")))
    counts = refs.groupBy(*key).agg(F.count(F.lit(1)).alias("n_refs"), F.count(F.when(F.col("ref_turn").isNull(), 1)).alias("n_missing_refs"))
    linked = first.drop("refs").join(answers, key, "full_outer").join(counts, key, "left").join(order, key, "left")
    status = F.when(F.col("n_copies").isNull(), "orphan").when(F.col("n_results").isNull(), "unanswered").otherwise("answered")
    linked = linked.withColumn("status", status)
    loose = calls.where(f"not ({whole})").select(*key, "turn", "name", "arguments", F.lit(1).cast("long").alias("n_copies"), F.lit(None).cast("string").alias("content"), F.lit("unlinkable").alias("status"))
    stray = results.where(f"not ({whole})").select(*key, F.col("turn").alias("result_turn"), "content", F.lit(1).cast("long").alias("n_results"), F.lit("unlinkable").alias("status"))
    rows = linked.unionByName(loose, allowMissingColumns=True).unionByName(stray, allowMissingColumns=True)
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_copies", "n_results", "n_refs", "n_missing_refs")]
    rows = rows.select(*key, "turn", "name", "status", *zero[:2], "result_turn", *zero[2:], "position", "arguments", "content")
    names = [f.split()[0] for f in LINKED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            valid, errors, records = [], [], []
            for call_id, name, copies, arguments, content in zip(*(batch.column(c).to_pylist() for c in ("call_id", "name", "n_copies", "arguments", "content"))):
                found, record = check_call(call_id, name, arguments, content, schemas) if copies else (None, canonical({"id": call_id, "result": content}))
                valid.append(None if found is None else not found)
                errors.append(found)
                records.append(record)
            cols = {n: batch.column(n) for n in names[:-3]}
            yield pa.RecordBatch.from_arrays([*cols.values(), pa.array(valid, pa.bool_()), pa.array(errors, pa.list_(pa.string())), pa.array(records, pa.string())], names)

    return rows.mapInArrow(run, LINKED)


#: Tools of the query's calls; `lookup` is called too, but isn't a known tool.
SCHEMAS = {
    "search": {
        "type": "object", "required": ["text", "turn"], "additionalProperties": False,
        "properties": {"text": {"type": "string", "minLength": 1, "maxLength": 1000}, "turn": {"type": "integer", "minimum": 0}},
    },
    "translate": {
        "type": "object", "required": ["text", "turn", "lang"],
        "properties": {"text": {"type": "string"}, "turn": {"type": "integer", "maximum": 5}},
    },
}


def op1_tool_calls(conversations: DataFrame) -> DataFrame:
    """Assistant turns taken as calls (their text is the argument, they refer to the assistant turn before), user turns as
    results of the turn before."""
    turn = F.col("turn").cast("long")
    name = lambda back: F.concat(F.lit("call-"), (turn - back).cast("string"))
    calls = conversations.where("role = 'assistant'").select(
        "conv_id", name(0).alias("call_id"), turn.alias("turn"),
        F.when(turn % 5 == 1, "search").when(turn % 5 == 3, "translate").otherwise("lookup").alias("name"),
        F.to_json(F.struct("turn", "text"), {"ignoreNullFields": "false"}).alias("arguments"),
        F.when(turn >= 2, F.array(name(2))).otherwise(F.array().cast("array<string>")).alias("refs"),
    )
    results = conversations.where("role = 'user' and (turn >= 1 or turn is null)").select("conv_id", name(1).alias("call_id"), turn.alias("turn"), F.col("text").alias("content"))
    linked = link_tool_calls(calls, results, SCHEMAS)
    return linked.withColumn("errors", F.array_join("errors", "; ")).withColumn("record_sha256", F.sha2(F.col("record").cast("binary"), 256)).drop("record")


OP1_SQL = """
with calls as (
  select conv_id, 'call-' || turn as call_id, turn,
         case turn % 5 when 1 then 'search' when 3 then 'translate' else 'lookup' end as name, min(text) as text, count(*) as n_copies
  from conversations where role = 'assistant' group by conv_id, turn
), results as (
  select conv_id, 'call-' || (turn - 1) as call_id, turn as result_turn, min(text) as content, count(*) as n_results
  from conversations where role = 'user' and turn >= 1 group by conv_id, turn
), joined as (
  select coalesce(c.conv_id, r.conv_id) as conv_id, coalesce(c.call_id, r.call_id) as call_id, c.turn, c.name, c.text,
         case when c.call_id is null then 'orphan' when r.call_id is null then 'unanswered' else 'answered' end as status,
         coalesce(c.n_copies, 0) as n_copies, coalesce(r.n_results, 0) as n_results, r.result_turn, r.content,
         case when c.turn >= 2 then 1 else 0 end as n_refs,
         case when c.turn >= 2 and p.call_id is null then 1 else 0 end as n_missing_refs,
         case when c.call_id is not null then row_number() over (partition by c.conv_id order by c.turn) - 1 end as position
  from calls c full join results r on c.conv_id = r.conv_id and c.call_id = r.call_id
  left join calls p on p.conv_id = c.conv_id and p.turn = c.turn - 2
), checked as (
  select *, case name when 'lookup' then 'unknown tool'
    when 'search' then case when text is null then '$.text type' when length(text) < 1 then '$.text minLength'
                            when length(text) > 1000 then '$.text maxLength' else '' end
    when 'translate' then '$.lang required' || case when text is null then '; $.text type' else '' end || case when turn > 5 then '; $.turn maximum' else '' end
    end as errors from joined
)
select conv_id, call_id, turn, name, status, n_copies, n_results, result_turn, n_refs, n_missing_refs, position,
       case when n_copies > 0 then errors = '' end as valid, errors,
       sha256(case when n_copies > 0
         then '{"arguments":{"text":' || coalesce(to_json(text)::varchar, 'null') || ',"turn":' || turn || '},"id":"' || call_id || '","name":"' || name || '","result":' || coalesce(to_json(content)::varchar, 'null') || '}'
         else '{"id":"' || call_id || '","result":' || coalesce(to_json(content)::varchar, 'null') || '}' end) as record_sha256
from checked
"""
