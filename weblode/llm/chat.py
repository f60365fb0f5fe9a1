"""Conversations with tool calls as canonical JSON lines."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weblode.session import stored, work_path

LINE_DDL = "conv_id string, level long, turn long, position long, kind string, call_id string, status string, errors array<string>, line string"
KINDS = {
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
    "number": lambda v: isinstance(v, int | float) and not isinstance(v, bool),
    "integer": lambda v: (isinstance(v, int) and not isinstance(v, bool)) or (isinstance(v, float) and v.is_integer()),
}


def canonical(value) -> str:
    """JSON with sorted keys and no spaces; whole numbers are written without a fraction."""

    def plain(v):
        if isinstance(v, float) and v.is_integer() and abs(v) < 2**53:
            return int(v)
        if isinstance(v, dict):
            return {k: plain(x) for k, x in v.items()}
        return [plain(x) for x in v] if isinstance(v, list) else v

    return json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def faults(value, schema: dict, at: str = "$") -> Iterator[str]:
    """What in a value breaks a schema: type, enum, bounds, lengths, required and further properties, items."""
    wanted = schema.get("type")
    kinds = [wanted] if isinstance(wanted, str) else wanted
    if kinds and not any(KINDS[k](value) for k in kinds):
        yield f"{at}: not {' or '.join(kinds)}"
        return
    if "enum" in schema and not any(canonical(value) == canonical(v) for v in schema["enum"]):
        yield f"{at}: not one of the values"
    if KINDS["number"](value):
        if value < schema.get("minimum", -math.inf) or value > schema.get("maximum", math.inf):
            yield f"{at}: out of bounds"
    if isinstance(value, str) and not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", math.inf):
        yield f"{at}: length"
    if isinstance(value, list):
        for i, item in enumerate(value):
            yield from faults(item, schema.get("items", {}), f"{at}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        for name in schema.get("required", ()):
            if name not in value:
                yield f"{at}.{name}: missing"
        for name in sorted(value):
            if name in known:
                yield from faults(value[name], known[name], f"{at}.{name}")
            elif schema.get("additionalProperties", True) is False:
                yield f"{at}.{name}: not known"


def read_json(text: str):
    def no_constant(name):
        raise ValueError(name)

    return json.loads(text, parse_constant=no_constant)


def call_line(call_id, name, arguments, schemas: dict) -> tuple[str, list[str]]:
    """The line of a call and its faults; arguments that are no JSON are kept as a string."""
    wrong = []
    try:
        value = read_json(arguments or "")
        written = canonical(value)
        wrong = list(faults(value, schemas[name])) if name in schemas else ["$: no such tool"]
    except (ValueError, RecursionError):
        written, wrong = arguments or "", ["$: not JSON"]
    call = {"id": call_id, "type": "function", "function": {"name": name, "arguments": written}}
    return canonical({"role": "assistant", "tool_calls": [call]}), wrong


def levels(calls: DataFrame) -> DataFrame:
    """(call_id, level, cyclic) so that (level, turn, position) puts each call after those it needs.

    ``calls`` has one row per call_id, with conv_id, turn, position and the ids it ``needs``. Where every need lies earlier in the
    conversation the order is right as it is and all levels are 0. Only the calls of other conversations are layered:
    in each round those whose needs all have a level get the next one. What remains needs itself, and is ``cyclic``.
    """
    spark = calls.sparkSession
    place = F.struct("turn", "position", "call_id")
    needs = calls.select("conv_id", "call_id", place.alias("at"), F.explode(F.array_distinct("needs")).alias("need"))
    targets = calls.select(F.col("conv_id").alias("_conv"), F.col("call_id").alias("need"), place.alias("need_at"))
    edges = needs.join(targets, "need").where("conv_id = _conv")
    edges = stored(edges.select("conv_id", "call_id", "need", (F.col("need_at") >= F.col("at")).alias("forward")), work_path(spark, "needs"))
    odd = edges.where("forward").select("conv_id").distinct()
    open_calls = stored(calls.join(odd, "conv_id", "left_semi").select("call_id"), work_path(spark, "open"))
    open_edges = stored(edges.join(odd, "conv_id", "left_semi").select("call_id", "need"), work_path(spark, "open"))
    placed, level = [], 0
    while not open_calls.isEmpty():
        waiting = open_edges.join(open_calls.withColumnRenamed("call_id", "need"), "need", "left_semi").select("call_id").distinct()
        ready = stored(open_calls.join(waiting, "call_id", "left_anti").select("call_id", F.lit(level).cast("long").alias("level"), F.lit(False).alias("cyclic")), work_path(spark, "level"))
        if ready.isEmpty():
            ready = open_calls.select("call_id", F.lit(level).cast("long").alias("level"), F.lit(True).alias("cyclic"))
            placed.append(ready)
            break
        placed.append(ready)
        open_calls = stored(open_calls.join(waiting, "call_id", "left_semi"), work_path(spark, "open"))
        level += 1
    out = spark.createDataFrame([], "call_id string, level long, cyclic boolean")
    for part in placed:
        out = out.unionByName(part)
    return out


def chat_lines(messages: DataFrame, calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One JSON line per message, call and result, ordered in a conversation by (level, turn, position).

    ``messages``: conv_id, turn, role, content. ``calls``: conv_id, turn, position, call_id, name, arguments (JSON), needs (ids of
    calls whose results it uses; null is none). ``results``: call_id, turn, content. Conversations are not gathered: each line is a row.

    Calls and results are hash-joined by identifier. ``status`` of a call: ``linked``, ``unanswered``, ``repeated`` (an identifier's further
    calls; the first by conversation, turn and position counts), ``no id``, or ``cycle``. A result is ``linked``, or ``orphan``
    without its call; of several results of a call the first by turn and content is linked, further ones are ``repeated``. ``errors`` holds
    what breaks the tool's schema. Null content is an empty text, null role is ``user``, null turn counts as -1. Empty tables give no lines; further columns do not matter.
    """
    spark = calls.sparkSession
    long0 = F.lit(0).cast("long")
    calls = calls.select(
        F.col("conv_id").cast("string").alias("conv_id"),
        F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"),
        F.coalesce(F.col("position").cast("long"), long0).alias("position"),
        F.col("call_id").cast("string").alias("call_id"),
        F.col("name").cast("string").alias("name"),
        F.col("arguments").cast("string").alias("arguments"),
        F.coalesce(F.col("needs").cast("array<string>"), F.array().cast("array<string>")).alias("needs"),
    )
    results = results.select(
        F.col("call_id").cast("string").alias("call_id"),
        F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"),
        F.coalesce(F.col("content").cast("string"), F.lit("")).alias("content"),
    )
    order = F.struct("conv_id", "turn", "position", "name", "arguments", "needs")
    answer = F.struct("turn", "content")
    first_calls = calls.where("call_id is not null").groupBy("call_id").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
    first_calls = stored(first_calls.select("call_id", "n", "first.*"), work_path(spark, "calls"))
    first_results = results.where("call_id is not null").groupBy("call_id").agg(F.min(answer).alias("answer"), F.count(F.lit(1)).alias("answers"))
    layered = levels(first_calls)
    linked = first_calls.join(first_results.hint("shuffle_hash"), "call_id", "full_outer").join(layered, "call_id", "left")
    linked = stored(linked.withColumn("is_call", F.col("n").isNotNull()), work_path(spark, "linked"))

    @F.pandas_udf(T.StructType.fromDDL("line string, errors array<string>"))
    def lines_of_calls(ids: pd.Series, names: pd.Series, arguments: pd.Series) -> pd.DataFrame:
        made = [call_line(*row, schemas) for row in zip(*(x.astype(object).where(x.notna(), None) for x in (ids, names, arguments)), strict=True)]
        return pd.DataFrame({"line": [m[0] for m in made], "errors": [m[1] for m in made]})

    @F.pandas_udf(T.StringType())
    def lines_of_texts(roles: pd.Series, ids: pd.Series, texts: pd.Series) -> pd.Series:
        out = []
        for role, call_id, text in zip(roles, ids, texts, strict=True):
            out.append(canonical({"role": role, "content": text} | ({"tool_call_id": call_id} if role == "tool" and isinstance(call_id, str) else {})))
        return pd.Series(out, dtype=object)

    none = F.array().cast("array<string>")
    own = linked.where("is_call").select(
        "conv_id", F.coalesce("level", long0).alias("level"), "turn", "position", "call_id", "name", "arguments",
        F.when(F.col("cyclic"), "cycle").when(F.col("answers").isNull(), "unanswered").otherwise("linked").alias("status"),
    )
    firsts = first_calls.select("call_id", order.alias("first"))
    no_id = calls.where("call_id is null").withColumn("status", F.lit("no id"))
    again = calls.where("call_id is not null").join(firsts, "call_id").where(order != F.col("first")).withColumn("status", F.lit("repeated"))
    same = first_calls.join(calls.groupBy("call_id", order.alias("same")).agg(F.count(F.lit(1)).alias("copies")), "call_id").where(F.col("same") == order)
    same = same.where("copies > 1").withColumn("status", F.lit("repeated")).withColumn("_", F.explode(F.sequence(F.lit(2).cast("long"), "copies")))
    plain = ["conv_id", "turn", "position", "call_id", "name", "arguments", "status"]
    rest = no_id.select(plain).unionByName(again.select(plain)).unionByName(same.select(plain)).withColumn("level", long0)
    all_calls = own.unionByName(rest).withColumn("made", lines_of_calls("call_id", "name", "arguments"))
    call_rows = all_calls.select("conv_id", "level", "turn", "position", F.lit("call").alias("kind"), "call_id", "status", "made.errors", "made.line")

    known = linked.select("call_id", "is_call", F.col("conv_id").alias("_conv"), F.coalesce("level", long0).alias("level"), "answer")
    counted = results.groupBy("call_id", answer.alias("own")).agg(F.count(F.lit(1)).alias("copies"))
    placed = counted.join(known, "call_id", "left")
    is_first = F.col("own") == F.col("answer")
    placed = placed.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    state = F.when(~F.coalesce("is_call", F.lit(False)), "orphan").when(is_first & (F.col("copy") == 1), "linked").otherwise("repeated")
    result_rows = placed.select(
        F.col("_conv").alias("conv_id"), F.coalesce("level", long0).alias("level"), F.col("own.turn").alias("turn"), F.lit(0).cast("long").alias("position"),
        F.lit("result").alias("kind"), "call_id", state.alias("status"), none.alias("errors"),
        lines_of_texts(F.lit("tool"), F.col("call_id"), F.col("own.content")).alias("line"),
    )
    texts = messages.select(
        F.col("conv_id").cast("string").alias("conv_id"), long0.alias("level"), F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"), long0.alias("position"),
        F.lit("message").alias("kind"), F.lit(None).cast("string").alias("call_id"), F.lit("kept").alias("status"), none.alias("errors"),
        lines_of_texts(F.coalesce(F.col("role").cast("string"), F.lit("user")), F.lit(None).cast("string"), F.coalesce(F.col("content").cast("string"), F.lit(""))).alias("line"),
    )
    return texts.unionByName(call_rows).unionByName(result_rows)
