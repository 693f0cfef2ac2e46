"""Chat formatting: tool calls linked with their results.

Calls and results meet in a hash join by identifier. Calls are ordered by the calls they depend on. A call that
needs one other follows that one's own need by pointer doubling: each join doubles the stretch behind it, so a chain
of a million calls takes twenty joins. What is left are calls with several needs, ordered among themselves level by
level. No conversation is gathered in one row or task, and no plan grows with the longest one.
Arguments are validated against the tool's schema and each linked call is one line of canonical JSON: keys
in code point order, no white space, only what must be escaped is.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quiltmap.llm.common import Scratch, apart, load

KINDS = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict, "null": type(None)}


def problems(value, schema: dict, at: str = "$") -> list[str]:
    """What of a JSON value breaks a schema of ``type, enum, required, properties, additionalProperties, items`` and bounds."""
    out = []
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(isinstance(value, KINDS[k]) and (not isinstance(value, bool) or k == "boolean") for k in kinds):
        return [f"{at}: not {' or '.join(kinds)}"]
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: not in the list")
    if isinstance(value, str) and not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
        out.append(f"{at}: length {len(value)}")
    if isinstance(value, int | float) and not isinstance(value, bool) and not schema.get("minimum", value) <= value <= schema.get("maximum", value):
        out.append(f"{at}: out of bounds")
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            out += problems(item, schema["items"], f"{at}[{i}]")
    if isinstance(value, dict):
        out += [f"{at}.{k}: missing" for k in schema.get("required", ()) if k not in value]
        known = schema.get("properties", {})
        for key in sorted(value):
            if key in known:
                out += problems(value[key], known[key], f"{at}.{key}")
            elif schema.get("additionalProperties", True) is False:
                out.append(f"{at}.{key}: unknown")
    return out


def canonical(value) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def chains(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """``call_id, root, dist``: the first call with no need or several on the way back along single needs, and how far it is.

    ``nodes`` has ``call_id, n`` (distinct needs) and ``need`` (one of them). Calls whose way ends in a cycle or at
    an unknown call get no row. The number of joins is the logarithm of the longest chain, or of the number of
    calls where there is a cycle.
    """
    one = F.col("n") == 1
    start = nodes.select("call_id", F.when(one, F.col("need")).otherwise(F.col("call_id")).alias("root"), one.cast("int").alias("dist"), (~one).alias("ended"))
    now, turn = scratch.write(start, "chains-0"), 0
    left = single = now.where("not ended").count()
    while left and 1 << turn <= 2 * single:  # then no way is longer, and what is left turns in a circle
        turn += 1
        far = now.select(F.col("call_id").alias("root"), F.col("root").alias("next"), F.col("dist").alias("more"), F.col("ended").alias("there"))
        moved = now.where("not ended").join(apart(far), "root").select("call_id", F.col("next").alias("root"), (F.col("dist") + F.col("more")).alias("dist"), F.col("there").alias("ended"))
        now = scratch.write(now.where("ended").unionByName(moved), f"chains-{turn}")
        scratch.drop(f"chains-{turn - 1}")
        left = now.where("not ended").count()
    return now.where("ended").drop("ended")


def levels(calls: DataFrame, scratch: Scratch) -> DataFrame:
    """``call_id, level``: 0 for calls that depend on none, else one more than the last they depend on.

    Calls on a cycle, that depend on an unknown call, or on one of these, get no row. Calls with several needs
    take one round per level among themselves; all levels go to one table.
    """
    edges = scratch.write(calls.select("call_id", F.explode("after").alias("need")).distinct(), "edges")
    needs = edges.groupBy("call_id").agg(F.count(F.lit(1)).alias("n"), F.min("need").alias("need"))
    nodes = scratch.write(calls.select("call_id").distinct().join(apart(needs), "call_id", "left").withColumn("n", F.coalesce("n", F.lit(0))), "nodes")
    placed = scratch.write(chains(nodes, scratch), "placed")
    several = nodes.where("n > 1").select("call_id", "n")
    roots = nodes.select(F.col("call_id").alias("root"), (F.col("n") > 1).alias("open"))
    # each need of a call with several, by the root of the need's own chain
    met = edges.join(several.select("call_id"), "call_id", "left_semi").join(apart(placed.select(F.col("call_id").alias("need"), "root", (F.col("dist") + 1).alias("dist"))), "need")
    links = scratch.write(met.join(apart(roots), "root").select("call_id", "root", "dist", "open"), "links")
    found = links.groupBy("call_id").agg(F.count(F.lit(1)).alias("found"), F.count_if("open").alias("waits"), F.max(F.when(~F.col("open"), F.col("dist"))).alias("level"))
    # a need that has no place leaves its call without one
    waiting = scratch.write(several.join(apart(found), "call_id").where("found = n").select("call_id", "waits", F.coalesce("level", F.lit(0)).alias("level")), "waiting-0")
    sources = nodes.where("n = 0").select("call_id", F.lit(0).alias("level"))
    scratch.append(sources, "roots")
    turn = 0
    while True:
        ready = waiting.where("waits = 0").select("call_id", "level")
        if ready.isEmpty():
            break
        scratch.append(ready, "roots")
        turn += 1
        reached = links.join(apart(ready.withColumnsRenamed({"call_id": "root", "level": "at"})), "root").groupBy("call_id").agg(F.count(F.lit(1)).alias("met"), F.max(F.col("at") + F.col("dist")).alias("top"))
        rest = waiting.where("waits > 0").join(apart(reached), "call_id", "left")
        waiting = scratch.write(rest.select("call_id", (F.col("waits") - F.coalesce("met", F.lit(0))).alias("waits"), F.greatest("level", F.coalesce("top", F.lit(0))).alias("level")), f"waiting-{turn}")
        scratch.drop(f"waiting-{turn - 1}")
    known = scratch.read("roots", sources.schema).withColumnsRenamed({"call_id": "root", "level": "base"})
    return placed.join(apart(known), "root").select("call_id", (F.col("base") + F.col("dist")).alias("level"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """``conv_id, call_id, name, level, status, line``: one row per call.

    ``calls`` has ``conv_id, call_id, name, arguments`` (JSON text) and ``after`` (array of call ids, null as
    empty); ``results`` has ``call_id, result``. Status is ``ok``, or the first that holds of ``unknown_tool``,
    ``bad_json``, ``bad_arguments``, ``cycle`` (or a dependency on an unknown call) and ``no_result``. Of
    repeated results of an id the smallest counts; a call id that repeats gives a row for each repeat, and a
    null call id links with nothing. Nulls in other columns become JSON nulls. Extra columns are ignored. Arguments
    and results of any length are one row each, and empty tables give an empty one.
    """
    scratch = Scratch(calls.sparkSession, "calls")
    own = calls.select("conv_id", "call_id", "name", "arguments", F.coalesce("after", F.array().cast("array<string>")).alias("after"))
    one = results.where("call_id is not null").groupBy("call_id").agg(F.min("result").alias("result"), F.lit(True).alias("has_result"))
    named = own.where("call_id is not null")
    linked = own.join(apart(one), "call_id", "left").join(apart(levels(named, scratch)), "call_id", "left")
    names = ["conv_id", "call_id", "name", "arguments", "after", "result", "has_result", "level"]

    def write(batches):
        for batch in batches:
            status, lines = [], []
            for conv, call, name, arguments, after, result, has_result, level in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                value, found = None, None
                try:
                    value = json.loads(arguments or "null")
                except ValueError:
                    found = "bad_json"
                schema = schemas.get(name)
                if schema is None:
                    found = "unknown_tool"
                elif found is None:
                    found = "bad_arguments" if problems(value, schema) else "cycle" if level is None else "ok" if has_result else "no_result"
                status.append(found)
                lines.append(canonical({"after": sorted(after), "arguments": value, "conv_id": conv, "id": call, "name": name, "result": result, "status": found}))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in (0, 1, 2, 7)), pa.array(status, pa.string()), pa.array(lines, pa.string())], ["conv_id", "call_id", "name", "level", "status", "line"])

    kind = calls.schema["conv_id"].dataType.simpleString()
    return linked.select(*names).mapInArrow(write, f"conv_id {kind}, call_id string, name string, level int, status string, line string")


SCHEMAS = {
    "reply": {
        "type": "object",
        "required": ["prompt", "turn"],
        "properties": {"prompt": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}},
        "additionalProperties": False,
    }
}


#: Turns of a conversation that one window covers.
TURNS = 256


def turn_before(turns: DataFrame) -> DataFrame:
    """Rows with ``before``: the turn of the row before in the conversation. A window covers ``TURNS`` turns, the last of which the next one is told."""
    ranged = turns.withColumn("range", F.floor(F.col("turn") / TURNS))
    last = ranged.groupBy("conv_id", "range").agg(F.max("turn").alias("last"))
    told = last.select("conv_id", "range", F.lag("last").over(Window.partitionBy("conv_id").orderBy("range")).alias("told"))
    inside = Window.partitionBy("conv_id", "range").orderBy("turn")
    near = ranged.withColumns({"before": F.lag("turn").over(inside), "first": F.row_number().over(inside) == 1})
    same = near.conv_id.eqNullSafe(told.conv_id) & near.range.eqNullSafe(told.range)
    return near.join(apart(told), same, "left").select(*[near[c] for c in turns.columns], F.when(F.col("first"), F.col("told")).otherwise(F.col("before")).alias("before"))


def as_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of a table of turns: a user's turn calls ``reply`` after the call before it, the assistant's next turn is its result."""
    name = lambda turn: F.concat_ws("-", F.col("conv_id"), turn)
    users, before = turn_before(turns.where("role = 'user'")), F.col("before")
    arguments = F.to_json(F.struct(F.col("text").alias("prompt"), "turn"))
    calls = users.select("conv_id", name(F.col("turn")).alias("call_id"), F.lit("reply").alias("name"), arguments.alias("arguments"), F.when(before.isNull(), F.array().cast("array<string>")).otherwise(F.array(name(before))).alias("after"))
    results = turns.where("role = 'assistant'").select(name(F.col("turn") - 1).alias("call_id"), F.col("text").alias("result"))
    return calls, results


def op5_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = as_calls(load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return link_calls(calls, results, SCHEMAS)


SQL = r"""
WITH u AS (
  SELECT conv_id, turn, text, conv_id || '-' || turn AS call_id,
         lag(turn) OVER w AS before, CAST(row_number() OVER w - 1 AS INTEGER) AS level
  FROM conversations WHERE role = 'user' WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
), a AS (
  SELECT conv_id || '-' || (turn - 1) AS call_id, min(text) AS result FROM conversations WHERE role = 'assistant' GROUP BY 1
), l AS (
  SELECT u.*, a.result,
         CASE WHEN coalesce(length(text), 0) < 1 OR turn < 0 THEN 'bad_arguments' WHEN a.call_id IS NULL THEN 'no_result' ELSE 'ok' END AS status
  FROM u LEFT JOIN a USING (call_id)
)
SELECT conv_id, call_id, 'reply' AS name, level, status,
       '{"after":[' || coalesce('"' || conv_id || '-' || before || '"', '') || '],"arguments":{"prompt":' || CAST(to_json(text) AS VARCHAR)
       || ',"turn":' || turn || '},"conv_id":' || conv_id || ',"id":"' || call_id || '","name":"reply","result":'
       || coalesce(CAST(to_json(result) AS VARCHAR), 'null') || ',"status":"' || status || '"}' AS line
FROM l
"""
