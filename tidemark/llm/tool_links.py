"""Tool-call linking for chat data.

Calls and results are joined by conversation and call identifier. Calls are
ordered topologically: each may name the call it comes after, and its depth
is the number of calls before it along that chain, found by pointer doubling
(joins in the logarithm of the longest chain, no conversation gathered in one
task). Arguments are checked against the tool's schema and every linked call
is serialised as canonical JSON: keys sorted at each level, no spaces.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.staging import stage

# JSON Schema types and the Python types of parsed values.
_TYPES = {
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool),
    "number": lambda v: isinstance(v, int | float) and not isinstance(v, bool),
}


def schema_error(value: object, schema: dict, at: str = "$") -> str | None:
    """The first way in which ``value`` breaks ``schema``, or None.

    Understands type, enum, minimum, maximum, minLength, maxLength, items,
    properties, required and additionalProperties.
    """
    kind = schema.get("type")
    if kind and not _TYPES[kind](value):
        return f"{at}: not {kind}"
    if "enum" in schema and value not in schema["enum"]:
        return f"{at}: not in enum"
    if _TYPES["number"](value):
        if value < schema.get("minimum", value):
            return f"{at}: below minimum"
        if value > schema.get("maximum", value):
            return f"{at}: above maximum"
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            return f"{at}: too short"
        if len(value) > schema.get("maxLength", len(value)):
            return f"{at}: too long"
    if isinstance(value, list) and "items" in schema:
        for i, v in enumerate(value):
            if error := schema_error(v, schema["items"], f"{at}[{i}]"):
                return error
    if isinstance(value, dict):
        known = schema.get("properties", {})
        for name in sorted(schema.get("required", [])):
            if name not in value:
                return f"{at}.{name}: missing"
        for name in sorted(value):
            if name in known:
                if error := schema_error(value[name], known[name], f"{at}.{name}"):
                    return error
            elif schema.get("additionalProperties", True) is False:
                return f"{at}.{name}: not allowed"
    return None


def canonical(value: object) -> str:
    """JSON with sorted keys, no spaces, non-ASCII kept; NaN and infinities are errors."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _refuse_constant(name: str) -> None:
    raise ValueError(name)


def check_call(name: str | None, arguments: str | None, schemas: dict[str, dict]) -> tuple[object, str | None]:
    """Parsed arguments (the raw string where it is no JSON) and the error, if any."""
    try:
        parsed = json.loads(arguments or "", parse_constant=_refuse_constant)
    except ValueError:
        return arguments, "arguments are not JSON"
    if name not in schemas:
        return parsed, "unknown tool"
    return parsed, schema_error(parsed, schemas[name])


def _first_of(rows: DataFrame) -> DataFrame:
    """``rows`` with ``nth``: 0 for the earliest turn of each identifier and for null identifiers, 1 for later ones."""
    low = stage(rows.groupBy("conv_id", "call_id").agg(F.min("turn").alias("low")), "first-turns")
    same = rows["conv_id"].eqNullSafe(low["conv_id"]) & (rows["call_id"] == low["call_id"])
    later = F.when(rows["call_id"].isNotNull(), (~F.col("turn").eqNullSafe(F.col("low"))).cast("int")).otherwise(0)
    return rows.join(low, same, "left").select(*[rows[c] for c in rows.columns], later.alias("nth"))


def depths(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth) of distinct calls (conv_id, call_id, after); depth -1 on a cycle.

    ``after`` names an earlier call of the conversation; a name that no call
    bears starts a chain as null does.
    """
    ids = calls.select(F.col("conv_id").alias("c"), F.col("call_id").alias("k"))
    known = (calls["conv_id"] == F.col("c")) & (calls["after"] == F.col("k"))
    state = stage(
        calls.join(ids, known, "left").select(
            "conv_id", "call_id", F.col("k").alias("up"), F.when(F.col("k").isNotNull(), 1).otherwise(0).cast("long").alias("depth")
        ),
        "depths",
    )
    total, reach = state.count(), 1
    while reach <= total and not state.filter("up is not null").isEmpty():
        above = state.select(
            F.col("conv_id").alias("c"), F.col("call_id").alias("k"), F.col("up").alias("next"), F.col("depth").alias("more")
        )
        step = (state["conv_id"] == above["c"]) & (state["up"] == above["k"])
        state = stage(
            state.join(above, step, "left").select(
                "conv_id", "call_id", F.col("next").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")
            ),
            "depths",
        )
        reach *= 2
    return state.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("depth")).otherwise(-1).alias("depth"))


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call, and per result without a call of its own.

    ``calls``: conv_id, call_id, turn, name, arguments (JSON text), after.
    ``results``: conv_id, call_id, turn, content. Returns conv_id, call_id,
    turn, depth, status, valid, error, json; a conversation's calls in order
    of (depth, turn, call_id) keep every call behind the one it comes after.

    status: ``linked``, ``unanswered`` (a call without result), ``orphan`` (a
    result without call), ``repeated`` (a call or result whose identifier an
    earlier turn has used already; it links with nothing). Equal rows of one
    turn each link. A null identifier links with nothing; a null conv_id
    neither. ``valid`` tells whether the arguments are JSON that meets the
    tool's schema. Empty tables give no rows.
    """
    calls = _first_of(calls.select("conv_id", "call_id", "turn", "name", "arguments", "after"))
    results = _first_of(results.select("conv_id", "call_id", "turn", "content"))
    first = stage(calls.filter("nth = 0 and conv_id is not null and call_id is not null").drop("nth"), "first-calls")
    order = depths(first.groupBy("conv_id", "call_id").agg(F.min("after").alias("after")))
    answers = results.filter("nth = 0 and conv_id is not null and call_id is not null").select(
        "conv_id", "call_id", F.lit(True).alias("answered"), "content"
    )
    key = ["conv_id", "call_id"]
    linked = (
        first.join(answers, key, "left")
        .join(order, key)
        .withColumn("status", F.when(F.col("answered"), "linked").otherwise("unanswered"))
    )
    again = calls.filter("nth = 1 or conv_id is null or call_id is null").withColumn(
        "status", F.when((F.col("nth") == 1), "repeated").otherwise("unanswered")
    )
    orphans = results.filter("nth = 0").join(first.select(*key).distinct(), key, "left_anti").withColumn("status", F.lit("orphan"))
    late = results.filter("nth = 1").withColumn("status", F.lit("repeated"))
    columns = {
        "conv_id": "long",
        "call_id": "string",
        "turn": "long",
        "depth": "long",
        "status": "string",
        "name": "string",
        "arguments": "string",
        "content": "string",
        "is_call": "boolean",
    }

    def shaped(df: DataFrame, is_call: bool) -> DataFrame:
        df = df.withColumn("is_call", F.lit(is_call))
        return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in columns.items()])

    rows = shaped(linked, True).unionByName(shaped(again, True))
    rows = rows.unionByName(shaped(orphans, False)).unionByName(shaped(late, False))

    def serialise(batches):
        for pdf in batches:
            out = {"valid": [], "error": [], "json": []}
            for r in pdf.to_dict("records"):
                record = {"id": r["call_id"], "status": r["status"]}
                error = None
                if r["is_call"]:
                    record["name"] = r["name"]
                    record["arguments"], error = check_call(r["name"], r["arguments"], schemas)
                if r["content"] is not None:
                    record["result"] = r["content"]
                out["valid"].append(error is None if r["is_call"] else None)
                out["error"].append(error)
                out["json"].append(canonical(record))
            yield pdf[["conv_id", "call_id", "turn", "depth", "status"]].assign(**out)

    return rows.mapInPandas(
        _nullable(serialise),
        "conv_id long, call_id string, turn long, depth long, status string, valid boolean, error string, json string",
    )


def _nullable(serialise):
    """Numbers with nulls as pandas' nullable integers, missing texts as None."""

    def run(batches):
        def clean():
            for pdf in batches:
                for c in ("conv_id", "turn", "depth"):
                    pdf[c] = pdf[c].astype("Int64")
                yield pdf.astype({c: object for c in ("call_id", "name", "arguments", "content")}).where(pdf.notna(), None)

        yield from serialise(clean())

    return run


# The tool as which a conversation's assistant is called by its user's turns.
REPLY_SCHEMA = {
    "type": "object",
    "required": ["prompt", "turn"],
    "properties": {
        "prompt": {"type": "string", "minLength": 1},
        "turn": {"type": "integer", "minimum": 0},
        "words": {"type": "integer", "minimum": 1, "maximum": 250},
    },
    "additionalProperties": False,
}


def reply_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """User turns as calls of the tool ``reply``, assistant turns as results of the turn before.

    A call comes after the call two turns earlier. Other roles make neither.
    """
    own = F.concat(F.lit("call-"), F.col("turn").cast("string"))
    words = F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    arguments = F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("prompt"), "turn", words.alias("words")))
    calls = conversations.filter("role = 'user'").select(
        F.col("conv_id").cast("long"),
        own.alias("call_id"),
        F.col("turn").cast("long"),
        F.lit("reply").alias("name"),
        arguments.alias("arguments"),
        F.concat(F.lit("call-"), (F.col("turn") - 2).cast("string")).alias("after"),
    )
    results = conversations.filter("role = 'assistant'").select(
        F.col("conv_id").cast("long"),
        F.concat(F.lit("call-"), (F.col("turn") - 1).cast("string")).alias("call_id"),
        F.col("turn").cast("long"),
        F.coalesce("text", F.lit("")).alias("content"),
    )
    return calls, results
