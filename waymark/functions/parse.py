"""Model responses: reasoning, tool calls, answer, boxed answer, content."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import first_filled, strip

THINK, TOOL_CALL, ANSWER = (rf"(?isu)<{t}>(.*?)</{t}>" for t in ("think", "tool_call", "answer"))
BOXED = r"(?s)(?:\\boxed|/boxed)\{(.*)\}"
CALLS = T.ArrayType(T.StructType().add("name", "string").add("arguments_json", "string").add("keys", T.ArrayType(T.StringType())).add("kinds", T.ArrayType(T.StringType())))
#: JSON schema's names of the types that Python reads.
KINDS = {str: "string", bool: "boolean", int: "integer", float: "number", list: "array", dict: "object", type(None): "null"}


def close_think(text: Column) -> Column:
    """One <think>, no </think> and a tool call: the reasoning ends where the first call begins."""
    count = lambda tag: (F.char_length(text) - F.char_length(F.replace(text, F.lit(tag), F.lit("")))) / len(tag)
    at = F.instr(text, "<tool_call>")
    closed = F.concat(F.substring(text, F.lit(1), at - 1), F.lit("</think>"), F.substring(text, at, F.char_length(text)))
    return F.when((count("<think>") == 1) & (count("</think>") == 0) & (at > 0), closed).otherwise(text)


def _call(block: str):
    try:
        call = json.loads(block)
        if not isinstance(call, dict):
            return None
        name = call.get("name") or call.get("tool")
        arguments = next((call[k] for k in ("arguments", "args", "kwargs") if k in call), {})
        arguments = json.loads(arguments) if isinstance(arguments, str) else arguments
    except ValueError:
        return None
    return {"name": name, "arguments_json": json.dumps(arguments, ensure_ascii=False), "keys": list(arguments), "kinds": [KINDS[type(v)] for v in arguments.values()]} if isinstance(name, str) and isinstance(arguments, dict) else None


@F.pandas_udf(CALLS)
def calls_of(blocks: pd.Series) -> pd.Series:
    """Well-formed calls among JSON blocks, in order. Python's JSON rules hold, which SQL readers do not share."""
    return blocks.map(lambda bs: [c for c in map(_call, bs if bs is not None else []) if c])


def parse_response(turns: DataFrame, text: str = "assistant_raw") -> DataFrame:
    """turns with raw, reasoning, tool_calls, malformed, answer, boxed, content, seed_content, has_answer_tag, answer_present. Null text is empty."""
    raw = turns.withColumn("raw", close_think(F.coalesce(F.col(text), F.lit(""))))
    blocks = F.transform(F.regexp_extract_all("raw", F.lit(TOOL_CALL), F.lit(1)), strip)
    out = (
        raw.withColumn("reasoning", strip(F.regexp_extract("raw", THINK, 1)))
        .withColumn("blocks", blocks)
        .withColumn("answer", strip(F.regexp_extract("raw", ANSWER, 1)))
        .withColumn("content", strip(F.regexp_replace(F.regexp_replace("raw", THINK, ""), TOOL_CALL, "")))
        .withColumn("has_answer_tag", F.contains(F.lower("raw"), F.lit("<answer>")))
    )
    tail = F.when(F.contains("raw", F.lit("</think>")), strip(F.substring_index("raw", "</think>", -1))).otherwise(F.col("content"))
    out = out.withColumn("seed_content", first_filled(tail, F.col("reasoning"))).withColumn("boxed", strip(F.regexp_extract(first_filled(F.col("answer"), F.col("content"), F.col("raw")), BOXED, 1)))
    out = out.withColumn("tool_calls", F.when(F.size("blocks") > 0, calls_of("blocks")).otherwise(F.array().cast(CALLS)))
    return out.withColumn("malformed", F.size("blocks") - F.size("tool_calls")).withColumn("answer_present", F.col("has_answer_tag") | (F.col("boxed") != "")).drop("blocks")


def merge_reasoning(reasoning: Column, text: Column) -> Column:
    body = F.when(strip(text) != "", F.concat(F.lit("\n"), strip(text))).otherwise("")
    return F.when((strip(reasoning) == "") | F.contains(F.lower(text), F.lit("<think>")), text).otherwise(F.concat(F.lit("<think>"), strip(reasoning), F.lit("</think>"), body))


def content_text(parts: Column) -> Column:
    """Text of a message's content parts (type, text): the texts, one to a line."""
    return strip(F.array_join(F.transform(F.filter(parts, lambda p: p["type"] == "text"), lambda p: F.coalesce(p["text"], F.lit(""))), "\n"))


def usage_total(prompt: Column, completion: Column, total: Column) -> Column:
    given = F.nullif(total, F.lit(0))
    return F.coalesce(given, F.coalesce(prompt, F.lit(0)) + F.coalesce(completion, F.lit(0)))


def usage(prompt: Column, completion: Column, total: Column, empty_is_null: Column | bool = False) -> Column:
    """A struct of three counters, missing ones 0. empty_is_null: usage that came as an object, whose zeros say nothing, not as a mapping."""
    counts = [F.coalesce(prompt, F.lit(0)).cast("long"), F.coalesce(completion, F.lit(0)).cast("long"), usage_total(prompt, completion, total).cast("long")]
    whole = F.struct(*[c.alias(n) for c, n in zip(counts, ("prompt_tokens", "completion_tokens", "total_tokens"))])
    said = ~(F.lit(empty_is_null) if isinstance(empty_is_null, bool) else empty_is_null) | (counts[0] != 0) | (counts[1] != 0) | (counts[2] != 0)
    return F.when(said, whole)
